"""Near-duplicates of texts and vectors, and components, against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest

from gridspark.llm import text_dups, vector_dups
from gridspark.llm.components import components


def classes_of(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if (least[a], least[b]) != (m, m):
                least[a] = least[b] = m
                changed = True
    return least


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(100, 101), (101, 100)], [(9, 3), (3, None), (5, 9), (7, 8), (8, 2)],
])
def test_components(spark, links):
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == classes_of({n for e in real for n in e}, real)


def texts(seed):
    r = random.Random(seed)
    word = [f"w{i}" for i in range(900)]
    out = [None, None, "", "", " ", "a b", "a b", "a  b", "a b c", "one two three four five"]
    for _ in range(60):
        base = [r.choice(word) for _ in range(r.randint(8, 160))]
        out.append(" ".join(base))
        for _ in range(r.choice([0, 1, 3])):
            copy = base[:]
            for _ in range(r.randint(0, 4)):
                copy[r.randrange(len(copy))] = r.choice(word)
            out.append(" ".join(copy))
    hub = [r.choice(word) for _ in range(200)]
    for _ in range(80):  # a large group of near copies
        copy = hub[:]
        for _ in range(r.randint(0, 3)):
            copy[r.randrange(len(copy))] = r.choice(word)
        out.append(" ".join(copy))
    out += [" ".join(hub)] * 40 + ["spam " * 4000]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_text_classes_against_all_pairs(spark, seed, monkeypatch):
    if seed == 2:  # large buckets in many small tiles
        monkeypatch.setattr(text_dups, "SMALL", 4)
        monkeypatch.setattr(text_dups, "TILE_TEXTS", 16)
    some = texts(seed)
    df = spark.createDataFrame([(i, t, "clash", 1.0) for i, t in enumerate(some)], "doc_id long, text string, mark string, size double").repartition(4)
    got = {r.doc_id: r for r in text_dups.text_classes(df).collect()}
    assert len(got) == len(some)
    docs = defaultdict(int)
    sets = text_dups.shingles(some)
    for h, _ in sets:
        for x in h.tolist():
            docs[x] += 1
    n = sum(t is not None for t in some)
    fall = (1 - text_dups.LEAST_IDF) / np.log(1 / text_dups.RARE)
    w = text_dups.Weights({x: float(1 - fall * np.log(k / (text_dups.RARE * n))) for x, k in docs.items() if k > text_dups.RARE * n})
    weighted = [(h, w(h, c)) for h, c in sets]
    links, near = [], 0
    for i in range(len(some)):
        for j in range(i):
            if some[i] is not None and some[i] == some[j]:
                links.append((i, j))
            else:
                s = text_dups.similarity(weighted[i], weighted[j])
                links += [(i, j)] * (s >= 0.8)
                near += abs(s - 0.8) < 0.005
    want = classes_of(range(len(some)), links)
    wrong = [i for i in want if got[i].class_id != want[i]]
    assert len(wrong) <= 3 * near  # chunks of few documents may count a shingle a little lower
    assert all(got[i].kept == (got[i].class_id == i) for i in got)
    kept = text_dups.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in got if got[i].kept)


@pytest.mark.parametrize("partitions", [1, 7, 400])
def test_document_frequencies_are_exact(spark, partitions):
    r = random.Random(partitions)
    parts = [[f"w{k}x{i}" for i in range(8)] for k in range(12)]
    texts = []
    for i in range(5000):
        words = [f"u{i}y{j}" for j in range(6)]
        for k, part in enumerate(parts):
            if r.random() < 0.005 + k * 0.002:
                words += part
        texts.append(" ".join(words))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").repartition(partitions, "i")
    counts = defaultdict(int)
    for hashes, _ in text_dups.shingles(texts):
        for h in hashes.tolist():
            counts[h] += 1
    fall = (1 - text_dups.LEAST_IDF) / np.log(1 / text_dups.RARE)
    least = text_dups.RARE * len(texts)
    want = {h: float(1 - fall * np.log(n / least)) for h, n in counts.items() if n > least}
    assert text_dups.frequent_shingles(df.select("text")) == want


def test_samples_agree_as_often_as_texts_are_similar():
    r = random.Random(7)
    word = [f"w{i}" for i in range(3000)]
    none = text_dups.Weights({})
    for changes in (3, 8, 20):
        agree, alike = [], []
        for _ in range(60):
            a = [r.choice(word) for _ in range(300)]
            b = a[:]
            for i in r.sample(range(300), changes):
                b[i] = r.choice(word)
            one, two = ((h, none(h, c)) for h, c in text_dups.shingles([" ".join(a), " ".join(b)]))
            agree.append((text_dups.signature(*one) == text_dups.signature(*two)).mean())
            alike.append(text_dups.similarity(one, two) ** text_dups.ROWS)
        assert np.mean(agree) == pytest.approx(np.mean(alike), abs=0.05)


def test_bounds_lose_no_similar_pair():
    some = [t for t in texts(3) if t]
    none = text_dups.Weights({})
    sets = [(h, none(h, c)) for h, c in text_dups.shingles(some)]
    asked = np.triu(np.ones((len(sets), len(sets)), bool), 1)
    got = set(text_dups.similar_pairs(sets, sets, asked, 0.8, 50_000))
    assert got == {(i, j) for j in range(len(sets)) for i in range(j) if text_dups.similarity(sets[i], sets[j]) >= 0.8}


def test_text_edge_cases(spark):
    schema = "doc_id long, text string, lang string"
    empty = spark.createDataFrame([], schema)
    assert text_dups.text_classes(empty).count() == 0 and text_dups.keep_one(empty).count() == 0
    rows = [(3, "x y", "a"), (3, "x y", "a"), (1, None, None), (2, None, None), (None, "x y", "b"), (None, None, None), (4, "", ""), (5, "", "")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in text_dups.text_classes(df).collect()), key=str)
    assert got == sorted([(3, 3, True), (3, 3, True), (1, 1, True), (2, 2, True), (None, 3, False), (None, None, True), (4, 4, True), (5, 4, False)], key=str)
    assert sorted(map(str, (r.doc_id for r in text_dups.keep_one(df).collect()))) == sorted(map(str, [3, 1, 2, None, 4]))


def slow_links(vectors, threshold=0.9):
    unit = []
    for v in vectors:
        ok = v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / max(map(abs, v)) if ok else None)
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    n = len(vectors)
    return [(i, j) for i in range(n) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold]


@pytest.mark.parametrize("tile", [16, 4096])
def test_vectors_against_all_pairs(spark, tile):
    r = np.random.default_rng(3)
    some = []
    for _ in range(25):
        base = r.normal(size=24)
        some += [base + r.normal(size=24) * s for s in (0, 0.1, 0.3, 0.45)]
    hub = r.normal(size=24)
    some += [hub + r.normal(size=24) * 0.1 for _ in range(60)] + [hub] * 30 + [hub * 1e-200, hub * 1e200, -hub]
    rows = [[float(x) for x in v] for v in some]
    rows += [None, [], [0.0] * 24, [1.0, None] + [0.0] * 22, [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0, 2.0], [2.0, 4.0], [-1.0, 2.0]]
    order = r.permutation(len(rows))
    rows = [rows[i] for i in order]
    df = spark.createDataFrame([(i, v, "clash", 2) for i, v in enumerate(rows)] , "vec_id long, embedding array<double>, mark string, copies int")
    got = {g.vec_id: g for g in vector_dups.link_vectors(df, tile=tile).collect()}
    links = slow_links(rows)
    least = classes_of(range(len(rows)), links)
    count = defaultdict(int)
    for i, j in links:
        count[i] += 1
        count[j] += 1
    assert {i: (g.n_links, g.component_id, g.kept) for i, g in got.items()} == {i: (count[i], least[i], least[i] == i) for i in range(len(rows))}


@pytest.mark.parametrize("rows, length", [(700, 16), (120, 1040), (120, 1041), (60, 30_000)])
def test_error_bounds_settle_no_pair_wrongly(rows, length):
    r = np.random.default_rng(8)
    a = r.normal(size=(rows, length))
    b = a + r.normal(size=a.shape) * 0.47  # cosines around the threshold
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    assert (vector_dups.tile_links(a, b, 0.9) == (np.einsum("ik,jk->ij", a, b) >= 0.9)).all()


@pytest.mark.parametrize("density", [0.01, 0.2, 0.9])
def test_forest_connects_what_links_connect(density):
    r = np.random.default_rng(1)
    links = r.random((40, 50)) < density
    links[5] = False
    edges = vector_dups.forest(links)
    assert len(edges) <= 90 and all(links[i, j] for i, j in edges)
    nodes = range(90)
    assert classes_of(nodes, [(i, 40 + j) for i, j in edges]) == classes_of(nodes, [(i, 40 + j) for i, j in zip(*np.nonzero(links), strict=True)])


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_dups.link_vectors(empty).count() == 0
    rows = spark.createDataFrame([(None, [1.0]), (7, [1.0]), (7, [1.0]), (8, None)], "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in vector_dups.link_vectors(rows).collect()), key=str)
    assert got == sorted([(None, 0, None, True), (7, 1, 7, True), (7, 1, 7, True), (8, 0, 8, True)], key=str)
