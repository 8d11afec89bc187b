"""Dual-tree search and divergence audit against brute force, with edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from gridspark.llm import divergence, lexical
from gridspark.llm.common import TERM_PIECE, term_pieces
from gridspark.llm.divergence import audit_sources
from gridspark.llm.lexical import best_documents

LOWER = {c: c + 32 for c in range(65, 91)}


def split(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


def slow_search(docs, items, k):
    words = [(d, split(t, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")) for d, t in docs]
    n, total = sum(bool(w) for _, w in words), sum(len(w) for _, w in words)
    df = Counter(t for _, w in words for t in set(w))
    out = []
    for item, text in items:
        asked, scores = split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), []
        for d, w in words:
            tf = Counter(w)
            m = 25 + 75 * len(w) * n // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in asked if tf[t])
            if s > 0:
                scores.append((-s, d is None, d if d is not None else 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, k=10):
    rows = [(d, t, "x", 1) for d, t in docs]
    left = spark.createDataFrame(rows, "doc_id long, text string, item_id string, score int").repartition(3)
    right = spark.createDataFrame([(i, t, 2.0) for i, t in items], "item_id int, text string, rank double")
    return sorted(map(tuple, best_documents(left, right, k).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_search(spark, monkeypatch, seed):
    rnd = random.Random(seed)
    monkeypatch.setattr(lexical, "LEAF", 4)
    monkeypatch.setattr(lexical, "BLOCK", 64)
    monkeypatch.setattr(lexical, "FANOUT", 3)
    monkeypatch.setattr(lexical, "LEAF_ITEMS", 2)
    vocabulary = ["".join(rnd.choice("abcäß9") for _ in range(rnd.randint(1, 4))) for _ in range(60)]
    make = lambda n: " ".join(rnd.choice(vocabulary[: rnd.choice([5, 60])]) for _ in range(n))
    docs = [(i if i % 50 else None, make(rnd.randint(0, 40))) for i in range(400)]
    docs += [(1000 + i, "Same, same text ZZ ab") for i in range(40)] + [(7, "same text"), (7, "same text"), (8, None), (9, "")]
    items = [(i, make(rnd.randint(0, 12))) for i in range(25)] + [(25, "same SAME text"), (26, None), (27, ""), (28, "nowhere.found"), (5, "same text"), (5, "same text")]
    assert searched(spark, docs, items, 7) == slow_search(docs, items, 7)


def test_search_in_many_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CELLS", 60)
    rnd = random.Random(9)
    docs = [(i, " ".join(rnd.choice("abcdefghij") for _ in range(20))) for i in range(50)]
    items = [(i, " ".join(rnd.choice("abcdefghijk") for _ in range(5))) for i in range(30)]
    assert searched(spark, docs, items) == slow_search(docs, items, 10)


def test_search_without_rows_and_with_long_texts(spark):
    docs, items = [(1, "a b"), (2, "c " * 700_000 + "é" * 400_000 + " a")], [(1, "a"), (2, "é" * 400_000), (3, "c")]
    assert searched(spark, docs, items) == slow_search(docs, items, 10)
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == [] and searched(spark, [(1, None)], items) == []


def test_pieces_cut_no_term():
    text = ("Ab" * 300_000 + " x1 ") * 3 + "ü" * TERM_PIECE
    assert [w.decode() for p in term_pieces(text.encode(), lexical.ALNUM) for w in p] == split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    assert [w for p in term_pieces(b"", lexical.ALNUM) for w in p] == []


def slow_audit(docs, least=3, top=200):
    words = defaultdict(list)
    for lang, source, text in docs:
        words[lang or ""].append((source or "", split(text, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")))
    out = []
    for lang, rows in words.items():
        df = Counter(t for _, w in rows for t in set(w))
        kept = sorted(t for t, c in df.items() if c >= least)
        counts = {s: Counter() for s, _ in rows}
        whole = Counter(t for _, w in rows for t in w)
        for s, w in rows:
            counts[s].update(w)

        def shares(c):
            size = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // size for t in kept}

        gap = lambda p, q: (p - q) ** 2 // q
        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = [(sum(gap(p[s][t], p[o][t]) for t in kept), o) for o in counts if o != s]
            terms = [(gap(p[s][t], q[t]), t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (-f[0], f[1].encode()))[:most]
                out += [(lang, s, part, item, v, r + 1) for r, (v, item) in enumerate(ranked)]
    return sorted(out)


def audited(spark, docs, **more):
    rows = [(la, so, te, 1, "x") for la, so, te in docs]
    df = spark.createDataFrame(rows, "lang string, source string, text string, sid int, h string").repartition(3)
    return sorted(map(tuple, audit_sources(df, **more).collect()))


@pytest.mark.parametrize("settings", [{}, {"TILE": 2, "HELD": 1, "SMALL": 0, "CHUNK": 3}])
def test_audit(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(divergence, name, value)
    rnd = random.Random(len(settings))
    vocabulary = ["".join(rnd.choice("abÄß") for _ in range(rnd.randint(1, 4))) for _ in range(40)]
    make = lambda: " ".join(rnd.choice(vocabulary[: rnd.choice([4, 40])]) + rnd.choice(["", ".", "7", "_x"]) for _ in range(rnd.randint(0, 30)))
    docs = [(rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "s3", "s4", "", None]), make()) for _ in range(120)]
    docs += [("en", rnd.choice(["s1", "s2"]), "Copy of a text") for _ in range(50)] + [("de", "s1", "Copy of a text")]
    docs += [("en", "only empty", None), ("xx", "a", "rare words"), ("xx", "b", ""), ("yy", "alone", "w w w"), ("en", "s1", "word " * 3000)]
    assert audited(spark, docs, top=5) == slow_audit(docs, top=5)


def test_audit_without_rows(spark):
    assert audited(spark, []) == []


def test_shares_are_exact_for_large_counts(spark):
    rows = [(c, w) for w in (10**13 + 7, 3, 10**9 + 1) for c in (0, 2, 999_999_937, 10**13) if c < w]
    got = spark.createDataFrame(rows, "c long, w long").withColumn("p", divergence._share(divergence.F.col("c"), divergence.F.col("w"))).collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 1) // w for c, w in rows]
