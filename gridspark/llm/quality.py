"""Quality rules: counts of every whole text, and a line model that tells content from boilerplate.

A linear-chain conditional random field labels the lines of a document; Viterbi decoding
gives the best sequence, and a document is kept if its content lines hold at least
``CONTENT_SHARE`` of its words (and the counts pass).

Training takes a bounded sample of labelled documents (``TRAIN_DOCS`` per label, of at most
``TRAIN_LINES`` lines). Their labels say good or bad of a whole document, so the lines of a
bad document are relabelled once by a line classifier before the field is fitted.

Edge cases: a null text counts as empty (no word, so it fails); empty lines are labelled
like others but hold no words; equal rows get equal results; without labels of both
kinds every line counts as content. Only the named columns are read.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import text_chunks

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
CONTENT_SHARE = 0.5
TRAIN_DOCS, TRAIN_LINES = 1000, 100

WORD_SPACE, SYMBOL, UPPER, LOWER, DIGIT, PIPE, BANG, STOP, NEWLINE = (1 << i for i in range(9))
KNOWN = 0x250  # code points told apart; all others are neither case nor digit
FEATURES = (
    "bias", "symbols .1", "symbols .5", "pipes .3", "capitals .6", "bangs .3", "digits .2", "words <= 2", "words <= 9",
    "words >= 30", "sentence end", "seen before", "long words", "short words", "few letters", "empty", "echoes .2",
)


def _classes() -> np.ndarray:
    t = np.zeros(KNOWN + 1, np.uint16)
    for c in range(KNOWN):
        ch = chr(c)
        t[c] = (
            (WORD_SPACE if c == 0x20 or 9 <= c <= 13 else 0) | (SYMBOL if ch in SYMBOLS else 0)
            | (UPPER if ch.isupper() else 0) | (LOWER if ch.islower() else 0) | (DIGIT if ch.isdigit() else 0)
            | (PIPE if ch == "|" else 0) | (BANG if ch == "!" else 0) | (STOP if ch in ".!?:;" else 0) | (NEWLINE if ch == "\n" else 0)
        )
    t[KNOWN] = LOWER  # letters of other scripts, mostly
    return t


CLASSES = _classes()


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Per document the words that stand in a window found twice or more in it. ``ids`` are the words, ``doc`` their documents."""
    n = len(ids)
    out = np.zeros(n_docs, np.int64)
    if n <= window:
        return out
    code, width = ids.astype(np.int64), 1
    while width < window:  # windows of 2, 4, 8 words as pairs of the windows before
        most = int(code.max()) + 1
        code = pd.factorize(code[:-width] * most + code[width:])[0].astype(np.int64)
        width *= 2
    whole = doc[: n - window + 1] == doc[window - 1 :]
    at = np.flatnonzero(whole)
    if not len(at):
        return out
    key = pd.factorize(code[at] * n_docs + doc[at])[0]
    twice = at[np.bincount(key)[key] > 1]
    cover = np.zeros(n + 1, np.int32)
    cover[twice] += 1
    cover[twice + window] -= 1
    return np.bincount(doc, weights=np.cumsum(cover[:-1]) > 0, minlength=n_docs).astype(np.int64)


def measure(texts: list[str | None]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Counts per document; per line its features (bits), its words; and the first line of every document."""
    texts = [t or "" for t in texts]
    n_docs = len(texts)
    words = [t.encode().split() for t in texts]  # bytes split at exactly space and U+0009 to U+000D
    n_words = np.fromiter(map(len, words), np.int64, n_docs)
    doc_of_word = np.repeat(np.arange(n_docs), n_words)
    ids = pd.factorize(np.array(list(chain.from_iterable(words)), dtype=object))[0] if len(doc_of_word) else np.zeros(0, np.int64)
    repeats = repeated_words(ids, doc_of_word, n_docs)

    codes = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    kind = CLASSES[np.minimum(codes, KNOWN)]
    ends = np.flatnonzero(kind & NEWLINE)
    starts = np.concatenate([[0], ends[:-1] + 1])
    doc_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, n_docs) + 1) - 1
    first = np.searchsorted(starts, np.concatenate([[0], doc_ends[:-1] + 1]))

    def per_line(mask: np.ndarray) -> np.ndarray:
        return np.add.reduceat(mask, starts, dtype=np.int32)

    space = (kind & WORD_SPACE) != 0
    opens = ~space
    opens[1:] &= space[:-1]
    chars, line_words = per_line(~space), per_line(opens)
    symbols, pipes, bangs = (per_line((kind & k) != 0) for k in (SYMBOL, PIPE, BANG))
    upper, lower, digits = (per_line((kind & k) != 0) for k in (UPPER, LOWER, DIGIT))
    last = kind[np.maximum(ends - 1, starts)]

    seen_before = np.zeros(len(starts), bool)
    dup = np.zeros(n_docs, np.int64)
    for d, t in enumerate(texts):
        lines = t.split("\n")
        if len(set(lines)) < len(lines):
            seen, base = set(), first[d]
            for i, line in enumerate(lines):
                if line_words[base + i]:
                    if line in seen:
                        seen_before[base + i] = True
                        dup[d] += 1
                    seen.add(line)
    again = np.flatnonzero((ids[1:] == ids[:-1]) & (doc_of_word[1:] == doc_of_word[:-1])) + 1
    line_of_word = np.searchsorted(starts, np.flatnonzero(opens), "right") - 1
    echoes = np.bincount(line_of_word[again], minlength=len(starts))  # words equal to the one before
    w, c, letters = np.maximum(line_words, 1), np.maximum(chars, 1), upper + lower
    flags = (
        np.ones(len(starts), bool), symbols >= 0.1 * w, symbols >= 0.5 * w, pipes >= 0.3 * w,
        (upper >= 0.6 * np.maximum(letters, 1)) & (line_words >= 2), bangs >= 0.3 * w, digits >= 0.2 * c, line_words <= 2,
        line_words <= 9, line_words >= 30, (last & STOP) != 0, seen_before, chars > 12 * w, chars < 2.5 * w,
        letters < 0.6 * c, line_words == 0, echoes >= 0.2 * w,
    )
    bits = np.zeros(len(starts), np.int32)
    for i, f in enumerate(flags):
        bits |= f.astype(np.int32) << i
    per_doc = lambda x: np.add.reduceat(x, first, dtype=np.int64)
    counts = {
        "n_words": n_words, "word_chars": per_doc(chars), "n_symbols": per_doc(symbols),
        "n_dup_lines": dup, "n_repeat_words": repeats,
    }
    return counts, bits, line_words, first


def unpack(bits: np.ndarray) -> np.ndarray:
    return ((bits[:, None] >> np.arange(len(FEATURES))) & 1).astype(np.float32)


def viterbi(emission: np.ndarray, first: np.ndarray, moves: list[list[float]]) -> np.ndarray:
    """Best labels (1 content) of the lines of each document. ``emission`` is the score of content against boilerplate."""
    (m00, m01), (m10, m11) = moves
    e = emission.tolist()
    bounds = first.tolist() + [len(e)]
    labels = [0] * len(e)
    for a, b in zip(bounds, bounds[1:]):
        s0, s1 = 0.0, e[a]
        back = []
        for x in e[a + 1 : b]:
            f0, f1 = s0 + m00 >= s1 + m10, s0 + m01 > s1 + m11  # came from boilerplate
            s0, s1 = (s0 + m00 if f0 else s1 + m10), (s0 + m01 if f1 else s1 + m11) + x
            back.append((0 if f0 else 1, 0 if f1 else 1))
        y = int(s1 >= s0)
        labels[b - 1] = y
        for i in range(b - 2, a - 1, -1):
            y = back[i - a][y]
            labels[i] = y
    return np.array(labels, np.int8)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 200, l2: float = 1e-3) -> np.ndarray:
    w, weight = np.zeros(x.shape[1]), np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(x @ w)))
        g = x.T @ ((p - y) * weight) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def fit_field(bits: list[np.ndarray], good: list[int], steps: int = 80) -> dict:
    """Weights of the field from line features and labels of documents."""
    neutral = {"weights": [1.0] + [0.0] * (len(FEATURES) - 1), "moves": [[0.0, 0.0], [0.0, 0.0]]}
    if len(set(good)) < 2:
        return neutral
    n = np.array([len(b) for b in bits])
    x = unpack(np.concatenate(bits)).astype(np.float64)
    doc = np.repeat(np.array(good), n)
    line = _logistic(x, doc)
    sure = 1 / (1 + np.exp(-(x @ line)))
    y = np.where(doc == 1, sure > 0.02, sure > 0.5).astype(np.float64)

    longest = int(n.max())
    where = np.cumsum(n) - n
    place = where[:, None] + np.arange(longest)[None, :]
    live = np.arange(longest)[None, :] < n[:, None]
    place = np.where(live, place, 0)
    w, moves = line.copy(), np.zeros((2, 2))
    labels = np.where(live, y[place], 0).astype(int)
    pair_live = live[:, 1:]
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((labels[:, :-1] == a) & (labels[:, 1:] == b) & pair_live).sum()
    total = n.sum()
    mw, vw, mm, vm = np.zeros_like(w), np.zeros_like(w), np.zeros((2, 2)), np.zeros((2, 2))
    for t in range(1, steps + 1):
        e = np.where(live, (x @ w)[place], 0.0)
        alpha = np.zeros((len(n), longest, 2))
        alpha[:, 0, 1] = e[:, 0]
        for i in range(1, longest):
            step = np.logaddexp(alpha[:, i - 1, :1] + moves[0], alpha[:, i - 1, 1:] + moves[1])
            step[:, 1] += e[:, i]
            alpha[:, i] = np.where(live[:, i : i + 1], step, alpha[:, i - 1])
        beta = np.zeros((len(n), longest, 2))
        expected = np.zeros((2, 2))
        z = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        for i in range(longest - 2, -1, -1):
            ahead = beta[:, i + 1] + np.stack([np.zeros(len(n)), e[:, i + 1]], 1)
            step = np.logaddexp(moves[:, 0] + ahead[:, :1], moves[:, 1] + ahead[:, 1:])
            on = live[:, i + 1]
            beta[:, i] = np.where(on[:, None], step, beta[:, i + 1])
            joint = np.exp(alpha[:, i, :, None] + moves[None] + ahead[:, None, :] - z[:, None, None])
            expected += joint[on].sum(0)
        content = np.exp(alpha[:, :, 1] + beta[:, :, 1] - z[:, None])[live]
        gw = x.T @ (content - y) / total + 1e-3 * w
        gm = (expected - seen) / total + 1e-2 * moves
        mw, vw = 0.9 * mw + 0.1 * gw, 0.99 * vw + 0.01 * gw * gw
        mm, vm = 0.9 * mm + 0.1 * gm, 0.99 * vm + 0.01 * gm * gm
        a, b = 1 - 0.9**t, 1 - 0.99**t
        w -= 0.05 * (mw / a) / (np.sqrt(vw / b) + 1e-8)
        moves -= 0.05 * (mm / a) / (np.sqrt(vm / b) + 1e-8)
    return {"weights": w.tolist(), "moves": moves.tolist()}


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Field fitted on at most ``2 * TRAIN_DOCS`` labelled documents."""
    known = labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.min("quality").alias("good"))
    pick = F.xxhash64("__id")
    chosen = [known.filter(F.col("good") == g).orderBy(pick, "__id").limit(TRAIN_DOCS) for g in (0, 1)]
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "__id")  # 2 * TRAIN_DOCS rows

    @F.arrow_udf("array<int>")
    def features(column: pa.Array) -> pa.Array:
        out = []
        for part in text_chunks(column):
            _, bits, _, first = measure(part)
            out += [b.tolist() if len(b) <= TRAIN_LINES else None for b in np.split(bits, first[1:])]
        return pa.array(out, pa.list_(pa.int32()))

    # long documents are left out here: a filter in the plan moves below the join and measures every document
    rows = sample.select("__id", "good", features("text").alias("bits")).collect()
    rows = sorted((r for r in rows if r.bits is not None), key=lambda r: (r["__id"], r.bits))
    return fit_field([np.array(r.bits, np.int32) for r in rows], [r.good for r in rows])


VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content_words long, n_lines long, base_failed boolean, kept boolean"
)


def judge(text: Column, model: dict, share: float = CONTENT_SHARE) -> Column:
    """Counts, content words and verdict of a text as one struct (see ``VERDICT``)."""
    weights, moves = np.array(model["weights"]), model["moves"]

    @F.arrow_udf(VERDICT)
    def verdict(column: pa.Array) -> pa.Array:
        parts: dict[str, list] = {}
        for texts in text_chunks(column):
            counts, bits, line_words, first = measure(texts)
            kinds, at = np.unique(bits, return_inverse=True)
            label = viterbi((unpack(kinds) @ weights)[at], first, moves)
            n = counts["n_words"]
            counts["content_words"] = np.add.reduceat(line_words * label, first, dtype=np.int64)
            counts["n_lines"] = np.diff(np.append(first, len(bits)))
            counts["base_failed"] = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
            counts["kept"] = ~counts["base_failed"] & (counts["content_words"] >= share * n)
            for k, v in counts.items():
                parts.setdefault(k, []).append(v)
        names = [f.split()[0] for f in VERDICT.split(", ")]
        empty = {k: np.zeros(0, bool if k in ("base_failed", "kept") else np.int64) for k in names}
        return pa.StructArray.from_arrays([pa.array(np.concatenate(parts[k]) if k in parts else empty[k]) for k in names], names)

    return verdict(text)


def keep_good(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they were."""
    return docs.filter(judge(F.col(text_col), model)["kept"])
