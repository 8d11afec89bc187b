"""Merkle audit against a plain comparison."""

import pytest
from pyspark.sql import functions as F

from gridspark.llm.fixity import audit, lay_out

PAGES = [(i, f"http://x/{i}", "b" * (i * 37 % 900)) for i in range(1300)] + [(None, None, None), (None, None, None), (3, "http://x/3", "twin")]


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", 0) for r in rows], "page_id long, url string, html string, file string, nth int")


def told(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("range_bytes", [1 << 10, 1 << 16])
def test_audit_finds_just_the_damage(spark, range_bytes):
    want = lay_out(pages_of(spark, PAGES)).cache()
    assert want.count() == len(PAGES)
    hurt = want.filter("id is null or id % 101 <> 7 or nth > 400").withColumn(
        "digest", F.when(F.col("id") % 97 == 5, F.reverse("digest")).otherwise(F.col("digest"))
    ).filter("file <> 2")
    new = want.filter("id = 8").withColumn("offset", F.lit(10_000_000))
    have = hurt.unionByName(new)
    have = have.select("file", "offset", "length", "digest").cache()
    clean = want.select("file", "offset", "length", "digest")
    expected = []
    a = {(r.file, r.offset): r.digest for r in clean.collect()}
    b = {(r.file, r.offset): r.digest for r in have.collect()}
    for k in a.keys() | b.keys():
        if a.get(k) != b.get(k):
            kind = "missing" if k not in b else "extra" if k not in a else "altered"
            expected.append((*k, kind, a.get(k), b.get(k)))
    assert {k for _, _, k, _, _ in expected} == {"missing", "extra", "altered"}
    key = lambda r: tuple(map(str, r))
    assert sorted(told(audit(clean, have, range_bytes)), key=key) == sorted(expected, key=key)
    assert audit(clean, clean, range_bytes).count() == 0


def test_records_lie_end_to_end(spark):
    by_file = {}
    for r in lay_out(pages_of(spark, PAGES)).orderBy("file", "nth").collect():
        assert r.offset == by_file.get(r.file, 0)
        by_file[r.file] = r.offset + r.length


def test_copies_and_bodies_of_one_id_are_not_laid_out_in_one_task(spark):
    rows = [(7, "u", "same")] * 9000 + [(None, None, None)] * 5000 + [(7, "u", f"body {i}") for i in range(300)] + [(i, "v", "x" * i) for i in range(20)]
    laid = lay_out(pages_of(spark, rows).repartition(3))
    by_file = {}
    for r in laid.orderBy("file", "nth").collect():
        n, end = by_file.get(r.file, (0, 0))
        assert (r.nth, r.offset) == (n, end)
        by_file[r.file] = (n + 1, end + r.length)
    assert sorted(n for n, _ in by_file.values()) == [5000, 9320]
    assert audit(*[laid.select("file", "offset", "length", "digest")] * 2).count() == 0


def test_records_name_what_an_archive_needs(spark):
    from gridspark.llm.fixity import warc_record

    lines = pages_of(spark, [(5, "http://x", "é")]).select(warc_record("page_id", "url", F.col("html"))).first()[0].split("\r\n")
    assert lines == ["WARC/1.1", "WARC-Type: resource", "WARC-Record-ID: <urn:page:5>", "WARC-Date: 1970-01-01T00:00:00Z", "WARC-Target-URI: http://x", "Content-Length: 2", "", "é", "", ""]


def test_empty_replicas(spark):
    empty = lay_out(pages_of(spark, [])).select("file", "offset", "length", "digest")
    full = lay_out(pages_of(spark, PAGES[:3])).select("file", "offset", "length", "digest")
    assert audit(empty, empty).count() == 0
    assert [r.kind for r in audit(full, empty).collect()] == ["missing"] * 3
    assert [r.kind for r in audit(empty, full).collect()] == ["extra"] * 3
