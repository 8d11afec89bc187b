"""URL filter and histogram sort: brute force, edge cases, and no Python in the plan."""

import random
import zlib
from collections import defaultdict

import pytest

from gridspark.llm.histogram_sort import shard_by_bytes
from gridspark.llm.queries import QUERIES, URL_RULES
from gridspark.llm.url_filter import url_verdicts

URLS = [
    None, "", "no scheme", "http://", "http://ORG/", "https://a.Example.ORG/es/x?y#z", "https://example.org/en/1", "http://example.org/en/12",
    "http://notexample.org/es/", "http://x.com/fr/a", "http://com/de/", "http://x.com/fr", "http://x.com?q=/de/", "ftp://u@x.com/de/é#/fr/",
    "http://a.b.c.d.example.org/es/", "x://y.org", "http://example.org./es/", "a://b://c.org/", "http://ÄX.com/de/1\n2", "http://x.com/de/" + "p" * 50_000,
    "http://example.org/es/", "http://example.org/es/",
]


def slow_verdict(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.index(c) for c in "?#" if c in path] + [len(path)])]
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, False, None, default))
    return host, path, best[2], best[3]


def test_urls_against_brute_force(spark):
    rows = [(i % 19 if i else None, u, "clash", 1, "x") for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, best int, verdict string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    got = sorted(map(tuple, url_verdicts(pages, rules).collect()), key=str)
    assert got == sorted(((r[0], *slow_verdict(r[1], URL_RULES)) for r in rows), key=str)


def test_block_wins_a_tie_and_rules_may_be_missing(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    both = [("org", "/x", "allow"), ("org", "/x", "block"), ("org", "", "allow")]
    rules = spark.createDataFrame(both, "host string, path string, verdict string")
    assert url_verdicts(pages, rules).first().verdict == "block"
    none = url_verdicts(pages, rules.limit(0)).first()
    assert none.rule is None and none.verdict == "allow"
    assert url_verdicts(pages.limit(0), rules).count() == 0


@pytest.mark.parametrize("texts", [
    ["a"] * 3000, [None] * 5 + [""] * 5, ["x" * random.Random(i).randint(0, 900) + str(i % 700) for i in range(4000)], ["same" * 50] * 1500 + [str(i) * 9 for i in range(2500)],
])
def test_shards_are_even_gapless_and_keep_small_groups(spark, texts):
    rows = [(None if i == 7 else i, t, "clash", -1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int").repartition(3)
    got = shard_by_bytes(df, shards=8).collect()
    assert len(got) == len(texts)
    size, slots, where = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in got:
        data = (r.text or "").encode()
        assert r["size"] == len(data) + 1 and r.text_crc32 == zlib.crc32(data)
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        where[r.text or ""].add(r.shard)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    whole, largest = sum(size.values()), max(len((t or "").encode()) + 1 for t in texts)
    groups = {t: sum(len((x or "").encode()) + 1 for x in texts if (x or "") == t) for t in where}
    for s in range(8):
        assert abs(size[s] - whole / 8) <= 2 * (0.005 * whole / 8 + largest + max([g for g in groups.values() if g < 0.005 * whole / 8], default=0))
    again = {(r.doc_id, r.shard, r.slot) for r in shard_by_bytes(df.repartition(5), shards=8).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in got}


def test_no_rows_no_shards(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shard_by_bytes(empty).count() == 0


@pytest.mark.parametrize("name", ["op4_url_filter", "op8_histogram_sort"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("texts", [["x" * (i * 37 % 500) + str(i % 900) for i in range(3000)], ["hot " * 9] * 1000 + [f"cold {i}" * (i % 30) for i in range(2000)]])
def test_splitters_against_the_sorted_list(spark, texts):
    from pyspark.sql import functions as F

    shards, tolerance = 8, 0.005
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = shard_by_bytes(df, shards, tolerance).withColumn("h", F.xxhash64("text")).orderBy("h", "doc_id").collect()
    total, below, bounds, slots = sum(r.size for r in got), 0, [0], defaultdict(int)
    starts = {}
    for r in got:
        assert r.shard >= max(starts, default=0) and r.slot == slots[r.shard]
        slots[r.shard] += 1
        for k in range(max(starts, default=0) + 1, r.shard + 1):
            starts[k] = below
        starts.setdefault(0, 0)
        below += r.size
        bounds.append(below)
    slack = tolerance * total / shards
    for k in range(1, shards):
        target = total * k / shards
        assert abs(starts[k] - target) <= max(slack, min(abs(b - target) for b in bounds))


def test_columns_named_like_helpers_are_kept(spark):
    rows = [(i, f"text {i % 50}", i, -i, f"s{i}", i * 2, "b", "c") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __h int, __ID int, __size string, __h_ int, __blk string, __c_slot string")
    out = shard_by_bytes(df, shards=4)
    assert set(df.columns) <= set(out.columns)
    assert sorted(map(tuple, out.select(*df.columns).collect())) == rows
