"""The transducer against the library, at every window size; decoding piece by piece; edge cases."""

import random
from hashlib import sha256

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridspark.llm import bpe
from gridspark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
END = "<|endoftext|>"


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text, add_special_tokens=False).ids


EDGES = [
    "", " ", "\n\t", "'", "''s", "it's they'll we'd x're '", "a" * 5000, "!" * 5000, "aé́" * 900, "Σσς ΑΣ İ ǅ", "½²Ⅷ٣", "日本語のテキスト" * 700,
    END, f"a{END}b{END}{END}<|startoftext|>'s", "<|endoftext", "Á̧ 각", "x\u0000y\u001cz\u0085 w", "\U0001f600‍'", "ᲉꟋ\U00010d50\U00016ea0\U00012480",
]


def test_edges(codec, library):
    for text in EDGES:
        assert bpe.encode_text(codec, text) == ids(library, text), repr(text[:40])
    assert bpe.encode_text(codec, None) == []


def test_every_code_point(codec, library):
    chars = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    lines = ["x".join(f" a{c}a {c}" for c in chars[i : i + 64]) for i in range(0, len(chars), 64)]
    for line, want in zip(lines, library.encode_batch(lines, add_special_tokens=False), strict=True):
        assert bpe.encode_text(codec, line) == want.ids


@pytest.mark.parametrize(("piece", "window", "held"), [(17, 40, 3), (50, 8, 8), (300, 64, 4), (1 << 16, 256, 256)])
def test_windows_and_slices_do_not_show(codec, library, monkeypatch, piece, window, held):
    monkeypatch.setattr(bpe, "SLICE", piece)
    monkeypatch.setattr(codec, "window", max(window, max(codec.size) + 1))
    monkeypatch.setattr(bpe, "HELD", held)
    rnd, spelled = random.Random(piece), list(library.get_vocab())
    for letters in ("abcdefghijklmnopqrstuvwxyz", "aeinrstlo", "'!?.,", "aé́ñ ", "가ᄀ한ᅡ", "a'ls ", "日本", f"aA{END}"):
        for length in (5, 400, 3000):
            text = "".join(rnd.choice(letters) for _ in range(length))
            assert bpe.encode_text(codec, text) == ids(library, text)
    for _ in range(20):  # long words made of tokens
        text = "".join(rnd.choice(spelled).removesuffix("</w>") for _ in range(300))
        assert bpe.encode_text(codec, text) == ids(library, text)


def test_a_boundary_is_settled_by_the_lookahead(codec):
    rnd = random.Random(3)
    for _ in range(300):
        word = "".join(rnd.choice("aeinrstlohcdm") for _ in range(rnd.randint(200, 400))).encode()
        cut = rnd.randint(codec.lookahead + 1, len(word))
        ends = lambda tokens: [sum(codec.size[t] for t in tokens[: i + 1]) for i in range(len(tokens))]
        short, whole = ends(codec.merge(word[:cut], False)), ends(codec.merge(word, True))
        limit = cut - codec.lookahead
        assert [e for e in short if e < limit] == [e for e in whole if e < limit]


def test_bad_merge_lists_are_refused():
    size = len
    assert bpe.lookahead([("a", "b")], size) == 1
    with pytest.raises(ValueError):
        bpe.lookahead([("ab", "c"), ("a", "b")], size)
    with pytest.raises(ValueError):
        bpe.lookahead([("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc")], size)
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f, pytest.raises((ValueError, KeyError)):
        bpe.Codec(f.read())


def test_decoding_piece_by_piece(codec, library):
    rnd = random.Random(4)
    for text in EDGES:
        t = ids(library, text)
        cuts = sorted(rnd.randint(0, len(t)) for _ in range(4))
        d = bpe.Decoder(codec)
        parts = [d.push(t[a:b]) for a, b in zip([0, *cuts], [*cuts, len(t)], strict=True)]
        assert "".join(parts) + d.push([], last=True) == library.decode(t, skip_special_tokens=False)
    plain = "naïve façade  日本 it's"
    t = ids(library, plain)
    d = bpe.Decoder(codec, "bytes")
    assert "".join(d.push([i]) for i in t) + d.push([], last=True) == "naïve façade 日本 it 's"
    assert bpe.Decoder(codec, "bytes").push([codec.ids[0xC3]], last=True) == "�"


def test_tables(spark, codec, library):
    texts = [None, "", "Hello world's", "Hello world's", "z" * 70_000, " ".join(EDGES)]
    rows = [(i if i else None, t, "clash", 7) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, given string, n_tokens int")
    got = {r.doc_id: r for r in bpe.token_digests(docs, PATH).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want, r = ids(library, t or ""), got[i if i else None]
        assert (r.n_tokens, r.given) == (len(want), "clash")
        assert r.ids_sha256 == sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
    back = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((str(i or None), library.decode(ids(library, t or ""), skip_special_tokens=False)) for i, t in enumerate(texts))
    assert bpe.token_digests(docs.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op13_bpe_codec"](spark, folder).collect():
        want = ids(library, texts[r.doc_id] or "")
        assert r.n_tokens == len(want) and r.ids_sha256 == sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest()
