"""Toxicity by weak supervision.

Many voters look at a text: lexicons, word and stem voters found in labelled rows, and
patterns; each votes toxic, clean or abstains. A generative label model estimates by
expectation maximisation how often each voter is right and how voters depend on one
another (a tree of the strongest conditional dependencies), with the given label as
one more, fallible voter. A linear classifier over the words is then trained on the
posterior labels and scores every whole text.

Labels are learnt only from rows outside the held-out third (CRC-32 of the id as text,
modulo 3, is 1), at most ``SAMPLE`` of either label, chosen by a hash of the id.

Edge cases: null and empty texts are scored as texts without words; a null id is not held
out and not learnt from; repeated labels of one id count as toxic if any is; without
labels of both kinds the lexicons alone decide. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import cut, slices, text_chunks

SAMPLE = 5000
CANDIDATES = 3000
TERMS = 400
COVER = 4  # terms that each toxic document of the sample should hold, where there are so many
STEMS = (4, 5, 6, 7, 8)
THRESHOLD = 0.7
WORDS = re.compile(r"[^\W\d_]+")

# Common insults, by language.
LEXICONS = {
    "en": "idiot moron stupid loser trash scum clown pathetic worthless disgusting dumb imbecile filth vermin garbage jerk",
    "de": "idiot dummkopf trottel abschaum versager widerlich erbärmlich wertlos arschloch schwachkopf",
    "fr": "idiot crétin imbécile débile ordure minable salaud dégoûtant abruti connard",
    "es": "idiota imbécil estúpido basura escoria payaso patético asqueroso tonto cabrón",
}
LEXICON = {k: frozenset(v.split()) for k, v in LEXICONS.items()}
INSULTS = {w: 5.0 for lexicon in LEXICON.values() for w in sorted(lexicon)}  # weight of evidence without any label
PERSON = frozenset("you your youre du dein tu ton ta tes eres usted".split())


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def terms_of(word: str) -> list[str]:
    """A word and its stems (``abcd*``)."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def term_counts(words: list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for w in words:
        for t in terms_of(w):
            out[t] = out.get(t, 0) + 1
    return out


class Spotter:
    """Finds the telling term of each word, the one with most weight; remembers the words it has met."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.met: dict[str, str | None] = {}

    def __call__(self, words: list[str]) -> dict[str, int]:
        met, weights = self.met, self.weights
        if len(met) > 150_000:  # bounds memory only: forgotten words are looked up again
            met.clear()
        for w in [w for w in set(words) if w not in met]:
            met[w] = max((t for t in terms_of(w) if t in weights), key=weights.__getitem__, default=None)
        out: dict[str, int] = {}
        for t in filter(None, map(met.__getitem__, words)):
            out[t] = out.get(t, 0) + 1
        return out


def votes_of(text: str | None, words: list[str], hits: dict[str, int], voters: list[str], weights: dict[str, float]) -> list[int]:
    """Votes (1 toxic, -1 clean, 0 abstains): one per term, then lexicons and patterns."""
    have, n = set(words), max(1, len(words))
    found, evidence = sum(hits.values()), sum(weights[t] * k for t, k in hits.items())
    insults = sum(len(have & lexicon) for lexicon in LEXICON.values())
    bangs = (text or "").count("!")
    out = [1 if t in hits else 0 for t in voters]
    out += [1 if have & lexicon else 0 for lexicon in LEXICON.values()]
    out += [
        1 if found >= 3 and found >= 0.01 * n else 0,
        1 if evidence >= 8 and evidence >= 0.03 * n else 0,
        -1 if not found else 0,
        -1 if found < 0.005 * n else 0,
        1 if insults >= 2 else -1 if not insults and found < 2 else 0,
        1 if insults and have & PERSON else 0,
        1 if insults and bangs >= 3 else 0,
    ]
    return out


def signals(hits: dict[str, int], n_words: int, weights: dict[str, float]) -> list[float]:
    """Inputs of the classifier besides single terms: how many, how dense and how telling the terms are."""
    found, evidence, n = sum(hits.values()), sum(weights[t] * k for t, k in hits.items()), max(1, n_words)
    return [
        1.0, float(found >= 1), float(found >= 2), float(found >= 3), min(4.0, 100 * found / n), min(6.0, 50 * evidence / n),
        min(6.0, evidence / 4), math.log1p(n) / 5,
    ]


def _tree(votes: np.ndarray, post: np.ndarray) -> list[int]:
    """For each voter the one it depends on most given the label (-1: none): a maximum spanning tree."""
    n, j = votes.shape
    need = np.zeros((j, j))
    y = np.stack([1 - post, post])
    hot = [(votes == v).astype(np.float64) for v in (-1, 0, 1)]
    for c in (0, 1):
        w = y[c][:, None]
        mass = y[c].sum() + 1e-9
        single = [(h * w).sum(0) / mass for h in hot]
        for a in range(3):
            for b in range(3):
                joint = (hot[a] * w).T @ hot[b] / mass
                ratio = joint / (np.outer(single[a], single[b]) + 1e-12)
                need += mass / n * np.where(joint > 0, joint * np.log(np.maximum(ratio, 1e-12)), 0)
    np.fill_diagonal(need, -1)
    parent, inside = [-1] * j, {0} if j else set()
    while len(inside) < j:
        rest = [k for k in range(j) if k not in inside]
        part = need[np.ix_(rest, sorted(inside))]
        r, c = np.unravel_index(part.argmax(), part.shape)
        if part[r, c] > 1e-3:
            parent[rest[r]] = sorted(inside)[c]
        inside.add(rest[r])
    return parent


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, dict]:
    """Posterior of toxic for each row, and the estimated accuracies and dependencies."""
    post = np.where(given == 1, 0.9, 0.1)
    category = votes.astype(np.int64) + 1
    parent = _tree(votes, post)
    columns = [category[:, k] + 3 * (category[:, p] if p >= 0 else 1) for k, p in enumerate(parent)]
    for _ in range(rounds):
        prior = np.clip(post.mean(), 1e-3, 1 - 1e-3)
        right = (post @ (given == 1) + (1 - post) @ (given == 0) + 45) / (len(post) + 50)  # labels are right mostly
        score = np.log(prior / (1 - prior)) + np.where(given == 1, 1, -1) * math.log(right / (1 - right))
        for col in columns:
            p1 = np.bincount(col, post, 9) + 0.1
            p0 = np.bincount(col, 1 - post, 9) + 0.1
            c1 = p1.reshape(3, 3) / p1.reshape(3, 3).sum(1, keepdims=True)
            c0 = p0.reshape(3, 3) / p0.reshape(3, 3).sum(1, keepdims=True)
            score = score + np.log(c1.ravel() / c0.ravel())[col]
        before, post = post, 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        if np.abs(post - before).max() < 1e-4:
            break
    voted = votes != 0
    agree = ((votes == 1) * post[:, None] + (votes == -1) * (1 - post)[:, None]).sum(0)
    return post, {"accuracy": (agree / np.maximum(voted.sum(0), 1)).tolist(), "parent": parent, "label_accuracy": float(right)}


def fit_linear(x: np.ndarray, n_signals: int, target: np.ndarray, steps: int = 400) -> np.ndarray:
    """Logistic weights; those of single terms are held back by a penalty."""
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    weight = np.where(target >= 0.5, 0.5 / max(1e-9, target.sum()), 0.5 / max(1e-9, (1 - target).sum()))
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ ((p - target) * weight) + 1e-5 * w
        g[n_signals:] += 1e-3 * w[n_signals:]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def choose_terms(rows: list[dict[str, int]], weights: dict[str, float]) -> list[str]:
    """Terms that between them explain every toxic row ``COVER`` times, those that explain most first."""
    holds: dict[str, np.ndarray] = {}
    for r, counts in enumerate(rows):
        for t in counts:
            holds.setdefault(t, []).append(r)
    same: dict[tuple, str] = {}  # of terms in the same rows only the longest
    for t in sorted(holds, key=lambda t: (len(t.rstrip("*")), t)):
        same[tuple(holds[t])] = t
    holds = {t: np.array(holds[t]) for t in same.values()}
    lack, fewest = np.full(len(rows), COVER), max(3, len(rows) // 200)
    chosen: list[str] = []
    left = set(holds)
    while left and len(chosen) < TERMS:
        best = max(left, key=lambda t: ((lack[holds[t]] > 0).sum() * weights[t], t))
        if (lack[holds[best]] > 0).sum() < fewest:
            break
        lack[holds[best]] -= 1
        left.discard(best)
        chosen.append(best)
    return chosen


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict:
    known = labels.filter(F.col("toxic").isin(0, 1)).groupBy(F.col(id_col).alias("__id")).agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.col("__id").isNotNull() & ~held_out("__id"))
    chosen = [known.filter(F.col("toxic") == g).orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE) for g in (0, 1)]
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    sample = cut(texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "__id"))  # 2 * SAMPLE rows

    size = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(size) < 2:
        return {"terms": INSULTS, "signals": [-4.0, 2.0, 1.0, 1.0, 1.0, 0.5, 0.5, 0.0], "single": {}, "report": {}}

    def count(batches):
        """Rows and words of toxic documents with a term, and how often it is said in toxic and other ones."""
        found: dict[str, list[int]] = {"": [0, 0, 0, 0]}  # the empty term counts all words

        def report():
            columns = list(zip(*found.values(), strict=True))
            batch = pa.RecordBatch.from_arrays([pa.array(list(found)), *(pa.array(c, pa.int64()) for c in columns)], ["term", "rows", "among", "t", "c"])
            found.clear()
            found[""] = [0, 0, 0, 0]
            return batch

        for batch in slices(batches, "text"):
            for is_toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for t, k in [*term_counts(words).items(), ("", len(words))]:
                    sums = found.setdefault(t, [0, 0, 0, 0])
                    if is_toxic:
                        sums[0] += 1
                        sums[1] += len(words)
                        sums[2] += k
                    else:
                        sums[3] += k
                if len(found) > 100_000:
                    yield report()
        yield report()

    toxic = F.col("toxic") == 1
    counts = sample.select("toxic", "text").mapInArrow(count, "term string, rows long, among long, t long, c long")
    counts = cut(counts.groupBy("term").agg(*[F.sum(c).alias(c) for c in ("rows", "among", "t", "c")]))
    spoken = counts.filter("term = ''").first()
    tokens = {1: max(1, spoken.t), 0: max(1, spoken.c)}
    counts = counts.filter("term <> '' and t > 0")
    rate = F.log((F.col("t") / F.col("among")) / ((F.col("c") + 0.5) / tokens[0]))
    wide = (F.col("t") / tokens[1]) / ((F.col("c") + 0.5) / tokens[0])
    telling = counts.filter((F.col("rows") >= max(5, size[1] // 500)) & (rate >= 2) & (wide >= 4))
    telling = telling.select("term", rate.alias("weight"), "rows").orderBy(F.desc(F.col("rows") * F.col("weight")), "term").limit(CANDIDATES).collect()
    candidates = {r.term: min(8.0, r.weight) for r in telling}

    @F.arrow_udf("map<string,int>")
    def held(column: pa.Array) -> pa.Array:
        return pa.array(
            [[(t, k) for t, k in term_counts(words_of(x)).items() if t in candidates] for x in chain.from_iterable(text_chunks(column))], pa.map_(pa.string(), pa.int32())
        )

    rows = [r.h for r in sample.filter(toxic).select(held("text").alias("h")).collect()]  # SAMPLE rows
    picked = {t: candidates[t] for t in choose_terms(rows, candidates)}
    terms = picked | {w: v for w, v in INSULTS.items() if w not in picked}
    noticed = frozenset().union(PERSON, *LEXICON.values())

    @F.arrow_udf("struct<hits:map<string,int>,n:int,text:string>")
    def spotted(column: pa.Array) -> pa.Array:
        spot, out = Spotter(terms), []
        for t in chain.from_iterable(text_chunks(column)):
            words = words_of(t)
            brief = " ".join(sorted(noticed.intersection(words))) + "!" * min(3, (t or "").count("!"))
            out.append({"hits": list(spot(words).items()), "n": len(words), "text": brief})
        return pa.array(out, pa.struct([("hits", pa.map_(pa.string(), pa.int32())), ("n", pa.int32()), ("text", pa.string())]))

    rows = sample.select("__id", "toxic", spotted("text").alias("s")).select("__id", "toxic", "s.*").collect()  # 2 * SAMPLE rows
    rows.sort(key=lambda r: (r["__id"], r.toxic, r.n, r.text))
    given = np.array([r.toxic for r in rows])
    voters = list(picked)[:24]
    votes = np.array([
        votes_of(r.text, words_of(r.text) + ["x"] * max(0, r.n - len(words_of(r.text))), r.hits, voters, terms) for r in rows
    ], np.int8)
    post, report = label_model(votes, given)
    place = {t: i for i, t in enumerate(terms)}
    base = np.array([signals(r.hits, r.n, terms) for r in rows])
    single = np.zeros((len(rows), len(terms)))
    for i, r in enumerate(rows):
        for t in r.hits:
            single[i, place[t]] = 1
    w = fit_linear(np.hstack([base, single]), base.shape[1], post)
    return {
        "terms": terms, "signals": w[: base.shape[1]].tolist(), "single": dict(zip(terms, w[base.shape[1] :].tolist(), strict=True)), "report": report,
    }


def score(text: Column, model: dict) -> Column:
    """Probability of toxic, between 0 and 1."""
    terms, level, single = model["terms"], model["signals"], model["single"]

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        spot, out = Spotter(terms), []
        for t in chain.from_iterable(text_chunks(column)):
            words = words_of(t)
            hits = spot(words)
            z = sum(a * b for a, b in zip(level, signals(hits, len(words), terms), strict=True)) + sum(single.get(t, 0.0) for t in hits)
            out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        return pa.array(out, pa.float64())

    return scored(text)


def keep_clean(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not toxic, all columns as they were."""
    return docs.filter(score(F.col(text_col), model) < THRESHOLD)
