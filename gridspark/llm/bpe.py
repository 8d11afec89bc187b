"""BPE encoding and decoding as a streaming transducer with bounded lookahead.

A merge is decided by what stands to its right, but only so far: how far is computed from the
merge list (``lookahead``). A boundary between two tokens of a prefix that lies at least
so many symbols before the prefix's end is a boundary of every continuation, so the tokens
before it are emitted at once and what follows is encoded on its own. A text is walked in
slices; only the open word's last symbols, a window of them and the lookahead, are carried on.
Decoding is a state machine over token ids that holds the bytes of an unfinished character at most.

The tokenizer is a JSON file of the public ``tokenizers`` format: byte-level BPE whose words end in a
suffix, text composed (NFC), white space collapsed, lower-cased by character, words split by
the pattern of the file. Special tokens are found in the text as it stands. Any other kind of file is refused.

Edge cases: a null text is an empty one and has no tokens; ids and all other columns pass
through whatever they hold; repeated rows stay repeated; an empty table gives an empty
result. Memory does not grow with a text, beyond the text itself and a run of combining
marks, which has to be held whole to be put in order.
"""

from __future__ import annotations

import codecs
import json
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridspark.llm.common import text_chunks

SLICE = 1 << 16  # characters of a text looked at together
WINDOW = 256  # symbols merged together, beyond the lookahead
HELD = 256  # characters of an open word that are looked at again with what follows
MEMO_WORDS, MEMO_CHARS = 1 << 19, 48

# The parts of a tokenizer file that this transducer stands for.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters and numbers assigned after Unicode 16, which the pattern of the format does not count as such.
LATE = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    r"\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3"
    r"\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191"
    r"\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96"
    r"\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    r"\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
# Capitals that Python 3.13 does not know yet, with their small letters.
CAPITALS = {
    0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
    **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)},
}


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it is printable Latin-1, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def lookahead(merges: list[tuple[str, str]], size) -> int:
    """Symbols to the right of a boundary that can have a say in it.

    Let the leftmost boundary at which two continuations differ be removed, in one of them, by a rule
    ``u + v``. In the other ``v`` was missing, so within ``v`` or at its end another boundary had
    differed before, under an earlier rule whose left part is a token on the way to ``v`` and
    whose right part reaches beyond ``v``. The bound is the longest such chain; ranks fall along it.
    """
    rank = {a + b: r for r, (a, b) in enumerate(merges)}
    if len(rank) < len(merges) or any(size(p) > 1 and rank.get(p, r) >= r for r, ab in enumerate(merges) for p in ab):
        raise ValueError("the merge list makes a token twice, or before its parts")
    by_left: dict[str, tuple[list[int], list[int]]] = {}  # ranks of the rules with this left part, farthest reach up to each
    most = 0
    for r, (u, v) in enumerate(merges):
        reach, parts = size(v), [(size(v), v, r)]
        while parts:  # every token on the way to v: where it ends, and the rank that consumes it
            end, token, until = parts.pop()
            ranks, reaches = by_left.get(token, ((), ()))
            k = bisect_left(ranks, until)
            if k:
                reach = max(reach, end + reaches[k - 1])
            made = rank.get(token)
            if made is not None:
                a, b = merges[made]
                parts += [(end - size(b), a, made), (end, b, made)]
        ranks, reaches = by_left.setdefault(u, ([], []))
        ranks.append(r)
        reaches.append(max(reach, reaches[-1] if reaches else 0))
        most = max(most, reach)
    return most


class Scan:
    """The pattern that finds words, and those that go on with one."""

    def __init__(self, letter: str, number: str, other: str):
        self.word = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|{other}+")
        self.more = {"L": regex.compile(rf"(?V1){letter}*"), "O": regex.compile(rf"(?V1){other}*")}


class Codec:
    """Tables of one tokenizer; ``spec`` is the content of its JSON file."""

    def __init__(self, spec: bytes):
        t = json.loads(spec)
        model, split = t["model"], t["pre_tokenizer"]["pretokenizers"]
        known = (
            model["type"] == "BPE" and model["end_of_word_suffix"] and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
            and t["normalizer"] == {"type": "Sequence", "normalizers": NORMALIZERS} and t["post_processor"] is None and t["decoder"] is None
            and [s["type"] for s in split] == ["Split", "ByteLevel"] and split[0]["pattern"] == {"Regex": PATTERN} and (split[0]["behavior"], split[0]["invert"]) == ("Removed", True)
            and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
            and not any(a[k] for a in t["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not known:
            raise ValueError("not a tokenizer of the kind this transducer stands for")
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.lookahead = lookahead(merges, lambda s: len(s.removesuffix(suffix)))
        letters = byte_letters()
        names = [letters[b] for b in range(256)] + [letters[b] + suffix for b in range(256)] + [a + b for a, b in merges]
        number = {name: i for i, name in enumerate(names)}
        self.none = len(names)
        self.rules = {(number[a], number[b]): 512 + r for r, (a, b) in enumerate(merges)}
        self.ids = [vocab[name] for name in names]
        self.size = [len(name.removesuffix(suffix)) for name in names]
        self.window = max(WINDOW, max(self.size) + 1)  # always room for a token
        self.special = {a["content"]: a["id"] for a in t["added_tokens"]}
        self.tokens = {i: s for s, i in (vocab | self.special).items()}
        of = {c: b for b, c in letters.items()}
        self.spelled = {i: (bytes(of[c] for c in s.removesuffix(suffix)), s.endswith(suffix)) for s, i in vocab.items()}
        self.spelled |= {i: (s.encode(), True) for s, i in self.special.items()}
        self.marked = regex.compile("|".join(sorted(map(regex.escape, self.special), key=len, reverse=True)) or r"(?!)")
        self.common = Scan(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
        self.rare = Scan(rf"[\p{{L}}--[{LATE}]]", rf"[\p{{N}}--[{LATE}]]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{LATE}])")
        self.unusual = regex.compile(f"[{LATE}{''.join(map(chr, CAPITALS))}]")
        self.ids_of: dict[str, str] = {}
        self.text_of: dict[str, str] = {}

    def merge(self, data: bytes, ends: bool) -> list[int]:
        """Rules in order of rank, the leftmost first; tokens are numbered so that a made token's number tells its rule's rank."""
        ids, get, none = [*data], self.rules.get, self.none
        if ends:
            ids[-1] += 256
        made = [get(p, none) for p in zip(ids, ids[1:], strict=False)]
        while made:
            m = min(made)
            if m == none:
                break
            i = made.index(m)
            ids[i : i + 2] = [m]
            del made[i]
            if i:
                made[i - 1] = get((ids[i - 1], m), none)
            if i < len(made):
                made[i] = get((m, ids[i + 1]), none)
        return ids

    def whole_word(self, word: str) -> list[int]:
        data = word.encode()
        if len(data) > self.window + self.lookahead:
            return WordStream(self).push(word, last=True)
        return [self.ids[t] for t in self.merge(data, True)] if data else []


class WordStream:
    """One word, given piece by piece; ``push`` returns the tokens that no continuation can change."""

    def __init__(self, codec: Codec):
        self.codec, self.held = codec, b""

    def push(self, piece: str, last: bool = False) -> list[int]:
        c, out, data = self.codec, [], self.held + piece.encode()
        while len(data) > c.window + c.lookahead:
            at = 0
            for t in c.merge(data[: c.window + c.lookahead], False):
                if at + c.size[t] >= c.window:  # no longer more than the lookahead before the end of the window
                    break
                out.append(c.ids[t])
                at += c.size[t]
            data = data[at:]
        if last and data:
            out += [c.ids[t] for t in c.merge(data, True)]
            data = b""
        self.held = data
        return out


@lru_cache(maxsize=1)
def _joining() -> frozenset[str]:
    """Characters that can compose with, or be ordered before, what stands before them."""
    second = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for c in map(chr, range(0x110000)):
        if unicodedata.combining(c):
            second.add(c)
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(chr(int(parts[1], 16)))
    return frozenset(second)


def _pieces(text: str) -> Iterator[str]:
    """The text in slices that can be composed one by one, cut before white space where there is any."""
    at, n = 0, len(text)
    while n - at > SLICE:
        end = max(text.rfind(" ", at + 1, at + SLICE), text.rfind("\n", at + 1, at + SLICE))
        if end < 0:
            end = at + SLICE
            while end < n and text[end] in _joining():
                end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def _plain(piece: str) -> bool:
    try:
        piece.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _normal(piece: str) -> str:
    if not _plain(piece):
        piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ").translate(CAPITALS)  # character by character: no final sigma
    return piece.lower()


def words(codec: Codec, text: str) -> Iterator[list[str] | tuple[str, bool]]:
    """Whole words in lists; a word too long to hold comes as ``(piece, last)``."""
    held, run = "", None
    scan = codec.rare if not _plain(text) and codec.unusual.search(text) else codec.common
    for piece in _pieces(text):
        piece = held + _normal(piece)
        held, start = "", 0
        if run:
            start = scan.more[run].match(piece).end()
            if start == len(piece):
                yield piece, False
                continue
            yield piece[:start], True
            run = None
        found = scan.word.findall(piece, start)
        if found and piece.endswith(found[-1]):  # the last word may go on
            held = found.pop()
            if len(held) == 1 and found and found[-1] == "'" and piece.endswith("'" + held):
                held = found.pop() + held
        yield found
        if len(held) > HELD:
            run = "L" if scan.more["L"].fullmatch(held) else "O"
            yield held, False
            held = ""
    if run:
        yield "", True
    if held:
        yield scan.word.findall(held)


def encoded(codec: Codec, text: str | None) -> Iterator[list[str] | list[int]]:
    """The text's tokens in order: lists of whole words, and lists of ids."""
    text, at = text or "", 0
    spans = [(m.start(), m.end()) for m in codec.marked.finditer(text)] if "<" in text else []
    for start, end in [*spans, (len(text), len(text))]:
        stream = None
        for got in words(codec, text[at:start] if spans else text):
            if isinstance(got, list):
                if got:
                    yield got
                continue
            stream = stream or WordStream(codec)
            yield stream.push(got[0], got[1])
            if got[1]:
                stream = None
        if end > start:
            yield [codec.special[text[start:end]]]
        at = end


def encode_text(codec: Codec, text: str | None) -> list[int]:
    out: list[int] = []
    for got in encoded(codec, text):
        for x in got:
            out += codec.whole_word(x) if isinstance(x, str) else [x]
    return out


class Decoder:
    """Ids to text, piece by piece.

    ``tokens`` writes the tokens as the file spells them, one space between; it is what a file without a
    decoder asks for. ``bytes`` writes the bytes that tokens stand for: characters as soon as they are
    whole, U+FFFD for broken ones, a space after each word.
    """

    def __init__(self, codec: Codec, style: str = "tokens"):
        if style not in ("tokens", "bytes"):
            raise ValueError(f"unknown style {style!r}")
        self.codec, self.style, self.begun, self.gap = codec, style, False, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace") if style == "bytes" else None

    def push(self, ids: list[int], last: bool = False) -> str:
        if self.style == "tokens":
            text = " ".join([self.codec.tokens[i] for i in ids if i in self.codec.tokens])
            if text and self.begun:
                text = " " + text
            self.begun = self.begun or bool(text)
            return text
        out = []
        for i in ids:
            data, ends = self.codec.spelled.get(i, (b"", False))
            if self.gap and data:
                out.append(" ")
                self.gap = False
            out.append(self.utf8.decode(data, ends))
            self.gap = self.gap or ends
        return "".join(out) + (self.utf8.decode(b"", last) if last else "")


def fingerprint(codec: Codec, text: str | None) -> tuple[int, str, str]:
    """Number of tokens, hash of the ids joined by a space, hash of the decoded text."""
    n, of_ids, of_text, decoder = 0, sha256(), sha256(), Decoder(codec)
    ids_of, text_of = codec.ids_of, codec.text_of

    def both(ids: list[int]) -> tuple[str, str]:
        return " ".join(map(str, ids)), Decoder(codec).push(ids, last=True)

    for got in encoded(codec, text):
        if not got:
            continue
        if isinstance(got[0], str):
            long = {}
            for w in [w for w in set(got) if w not in ids_of]:
                pair = both(codec.whole_word(w))
                if len(w) > MEMO_CHARS:
                    long[w] = pair
                else:
                    ids_of[w], text_of[w] = pair
            if long:
                ids = " ".join([ids_of[w] if w in ids_of else long[w][0] for w in got])
                plain = " ".join([text_of[w] if w in text_of else long[w][1] for w in got])
            else:
                ids, plain = " ".join(map(ids_of.__getitem__, got)), " ".join(map(text_of.__getitem__, got))
            if len(ids_of) > MEMO_WORDS:
                ids_of.clear()
                text_of.clear()
        else:
            ids, plain = both(got)
        if n:
            ids, plain = " " + ids, " " + plain
        n += ids.count(" ") + (not n)
        of_ids.update(ids.encode())
        of_text.update(plain.encode())
    return n, of_ids.hexdigest(), of_text.hexdigest()


@lru_cache(maxsize=2)
def codec_of(spec: bytes) -> Codec:
    """One set of tables per worker process; a known word is not encoded again."""
    return Codec(spec)


def _shipped(df: DataFrame, path: str):
    """The tokenizer file, a few megabytes whatever the corpus, read here and sent to the executors."""
    with open(path, "rb") as f:
        spec = f.read()
    codec_of(spec)  # refuse a wrong file before any task starts
    return df.sparkSession.sparkContext.broadcast(spec)


def _mapped(df: DataFrame, path: str, column: str, fields: list[tuple[str, T.DataType, pa.DataType]], values) -> DataFrame:
    """``df`` with further columns computed from one column; they replace columns of the same name."""
    spec = _shipped(df, path)
    names = [n for n, _, _ in fields]
    kept = [c for c in df.columns if c not in names]
    given_name = "given"
    while given_name in kept:
        given_name += "_"
    given = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias(given_name))
    schema = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(n, t) for n, t, _ in fields]])

    def run(batches):
        codec = codec_of(spec.value)
        for batch in batches:
            got = list(values(codec, batch.column(len(kept))))
            new = [pa.array([g[k] for g in got], t) for k, (_, _, t) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(kept))], *new], [*kept, *names])

    return given.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with their token ids."""

    def values(codec, column):
        return ((encode_text(codec, s),) for chunk in text_chunks(column) for s in chunk)

    return _mapped(df, path, text_col, [(ids_col, T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))], values)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded", style: str = "tokens") -> DataFrame:
    """The text of each row's ids; null ids give an empty text, ids without a token are passed over."""

    def values(codec, column):
        for k in range(len(column)):
            ids = column[k].as_py() or []
            yield (Decoder(codec, style).push([i for i in ids if i is not None], last=True),)

    return _mapped(df, path, ids_col, [(text_col, T.StringType(), pa.string())], values)


def token_digests(df: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The documents with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``; ids and texts are hashed as they are made."""

    def values(codec, column):
        return (fingerprint(codec, s) for chunk in text_chunks(column) for s in chunk)

    fields = [("n_tokens", T.LongType(), pa.int64()), ("ids_sha256", T.StringType(), pa.string()), ("decoded_sha256", T.StringType(), pa.string())]
    return _mapped(df, path, text_col, fields, values)
