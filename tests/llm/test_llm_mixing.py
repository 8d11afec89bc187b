"""Mixing and packing against brute force."""

import re
from collections import Counter, defaultdict

import pytest

from gridspark.llm.mixing import mix, mixed_documents, share_targets
from gridspark.llm.packing import pack, plan

SCHEMA = "doc_id long, text string, source string, size string, row int, epoch int, position int, target string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2, 3, "y") for i, t, s in rows], SCHEMA)


ROWS = [(i, " ".join(["w"] * (i * 7 % 41)), ["a", "b", "é", "z", None][i % 5] if i % 3 else "a") for i in range(300)]
ROWS += [(None, None, "b"), (5, "one two", "lone"), (9, "", None), (12, "x y z", "a"), (12, "x y z", "a"), (1000, "w " * 9000, "b")]


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def slow_targets(sizes, weights, total):
    low, high = 0.0, 1e12
    for _ in range(300):  # the water level by bisection
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(2 * n, w * mid) for n, w in zip(sizes, weights, strict=True)) < total else (low, mid)
    return [min(2 * n, w * high) for n, w in zip(sizes, weights, strict=True)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1, 500], [0, 0], [7], [0, 5, 900, 3, 12]])
def test_targets_are_a_water_level(sizes):
    weights = [[5, 2, 1][i % 3] for i in range(len(sizes))]
    got = share_targets(sizes, weights, 1.5 * sum(sizes), 2)
    assert got == pytest.approx(slow_targets(sizes, weights, 1.5 * sum(sizes)), abs=1e-6)


def test_mix_meets_targets_block_by_block(spark):
    mixed, docs = mix(docs_of(spark, ROWS), block_tokens=64)
    docs, mixed = docs.collect(), mixed.collect()
    assert Counter((r.id, r["size"], r.source) for r in docs) == Counter((i, words(t), s) for i, t, s in ROWS)
    size = defaultdict(int)
    for _, t, s in ROWS:
        size[s] += words(t)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    want = dict(zip(names, slow_targets([size[s] for s in names], [[5, 2, 1][i % 3] for i in range(len(names))], 1.5 * sum(size.values())), strict=True))
    by_row = {r.row: r for r in docs}
    assert len(by_row) == len(docs)
    taken, block, spans = defaultdict(int), defaultdict(list), defaultdict(list)
    for m in mixed:
        taken[by_row[m.row].source] += m.tokens
        block[m.position].append((m["at"], m.tokens, by_row[m.row].source))
        spans[m.row, m.epoch].append((m["first"], m.tokens))
    for r in docs:
        assert r.source_size == size[r.source] and r.target == pytest.approx(want[r.source], abs=1e-6)
    for s in names:
        assert abs(taken[s] - want[s]) <= 1
    for parts in block.values():  # a block is whole: stretches of one source without gaps, 64 tokens but for the last of a source
        assert len({s for _, _, s in parts}) == 1
        at = 0
        for start, n, _ in sorted(parts):
            assert start == at
            at += n
        assert at <= 64
    assert sum(sum(n for _, n, _ in p) < 64 for p in block.values()) <= len(names)
    for (row, _), parts in spans.items():
        at = 0
        for first, n in sorted(parts):
            assert first == at
            at += n
        assert at <= by_row[row]["size"]
    # the schedule interleaves: any run of blocks holds a source about as often as the whole
    order = [block[p][0][2] for p in sorted(block)]
    share = {s: order.count(s) / len(order) for s in set(order)}
    for s in share:
        for k in range(1, len(order)):
            assert abs(order[:k].count(s) - share[s] * k) <= 6


def test_mixed_documents_follow_the_mix(spark):
    df = docs_of(spark, ROWS)
    got = mixed_documents(df, block_tokens=64)
    assert got.columns == df.columns
    counts = Counter((r.doc_id, r.text) for r in got.collect())
    mixed, docs = mix(df, block_tokens=64)
    rows = {r.row: (r.id, r["size"]) for r in docs.collect()}
    tokens = defaultdict(int)
    for m in mixed.collect():
        tokens[m.row, m.epoch] += m.tokens
    want = Counter(rows[row][0] for (row, _), n in tokens.items() if 2 * n >= rows[row][1])
    assert sum(counts.values()) == sum(want.values())
    assert Counter({i: n for (i, _), n in counts.items() if i not in (5, 9, 12)}) == Counter({i: n for i, n in want.items() if i not in (5, 9, 12)})


def test_empty_mix(spark):
    mixed, docs = mix(docs_of(spark, []))
    assert mixed.count() == 0 and docs.count() == 0
    assert mixed_documents(docs_of(spark, [(1, None, None)])).count() == 0


def check_bins(rows, sizes):
    inside = defaultdict(list)
    for r in rows:
        if r.bin_id is not None:
            inside[r.bin_id, r.bin_capacity].append((r.bin_offset, r.n_tokens))
    assert len({b for b, _ in inside}) == len(inside)
    for (_, capacity), parts in inside.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity and capacity == min(c for c in sizes if c >= at)
    return inside


def test_packing_places_every_token_once(spark):
    sizes = (16, 32, 64)
    rows = pack(docs_of(spark, ROWS), sizes, 4).collect()
    tokens = defaultdict(list)
    for r in rows:
        tokens[r.doc_id].append((r.piece, r.first_token, r.n_tokens))
        assert (r.bin_id is None) == (r.n_tokens == 0)
    lengths = defaultdict(int)
    for i, t, _ in ROWS:
        lengths[i] += words(t)
    assert {i: sum(n for _, _, n in p) for i, p in tokens.items()} == dict(lengths)
    long = sorted(tokens[1000])
    assert [n for _, _, n in long] == [64] * 140 + [40] and all(f == 64 * k for k, f, _ in long)
    check_bins(rows, sizes)
    assert pack(docs_of(spark, []), sizes).count() == 0
    assert pack(docs_of(spark, [(1, None, "a")]), sizes).first().bin_id is None


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    import random

    r = random.Random(seed)
    lengths = [r.randint(1, 50) for _ in range(400)]
    _, bins = plan(dict(Counter(lengths)), (50,), 0)
    assert sum(n for _, n, _, _ in bins) == best_fit(lengths, 50)
    runs, bins = plan(dict(Counter(lengths)), (10, 25, 50), 5)
    assert sum(n * used for _, n, used, _ in bins) == sum(lengths)
    assert sum(n for _, _, n, *_ in runs) == len(lengths)
    assert sum(n * (c + 5) for _, n, _, c in bins) <= 55 * best_fit(lengths, 50)
