"""Merkle fixity audit of archive replicas.

A record of an archive file (WARC) is hashed; the records of an ordered offset range
(64 KiB of the file) are hashed together, sixteen neighbouring ranges again, up to one
root per file. Two replicas compare their roots, and descend only below nodes that
differ, down to the records.

Edge cases: a file or record that one replica lacks is reported as ``missing`` or
``extra``; null URLs and bodies are written as empty; a null id gets a file of its own
kind; equal rows are equal records, each at its own offset, counted before they are laid
out, so neither many copies nor many bodies of one id meet in one task; empty tables give
no finding. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import cut, text_of
from gridspark.scale import running

RANGE_BYTES = 1 << 16
FANOUT = 16
FILE_IDS = 512  # consecutive ids that share an archive file
DATE = "1970-01-01T00:00:00Z"  # every record needs a date; the pages hold none
PREFIX = 3  # hex digits of the digest that tell the blocks of one id apart
COPIES = 4096  # equal records laid out by one row


def warc_record(id_col: str, url_col: str, body: Column, date: str = DATE) -> Column:
    """One archive record as text: header lines, an empty line, the body."""
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "), text_of(url_col),
        F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"),
    )


def lay_out(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``(id, file, nth, offset, length, digest)`` of every record of an archive of ``pages``."""
    record = warc_record(id_col, url_col, text_of(body_col))
    file = F.coalesce(F.floor(F.col(id_col) / FILE_IDS), -1 - F.pmod(F.xxhash64(url_col, body_col), F.lit(4096)))
    hashed = pages.select(
        F.col(id_col).cast("long").alias("id"), file.cast("long").alias("file"), record.alias("record")
    ).select("id", "file", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    # equal records are counted, a file is scanned in blocks of an id and a digest prefix, then the copies are laid out again
    counted = hashed.groupBy("id", "file", "length", "digest").agg(F.count(F.lit(1)).alias("copies"))
    block = F.struct("id", F.substring("digest", 1, PREFIX).alias("prefix"))
    ends = {"nth": ("sum", F.col("copies")), "offset": ("sum", F.col("copies") * F.col("length"))}
    placed = running(counted, ["file"], ["id", "digest"], ends, block).withColumns({
        "nth": F.col("nth") - F.col("copies"), "offset": F.col("offset") - F.col("copies") * F.col("length"),
        "lead": F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))),
    }).repartition("file", "lead")
    last = F.least(F.col("lead") + COPIES, F.col("copies")) - 1
    laid = placed.withColumn("copy", F.explode(F.sequence("lead", last)))
    return laid.select(
        "id", "file", (F.col("nth") + F.col("copy")).alias("nth"), (F.col("offset") + F.col("copy") * F.col("length")).alias("offset"), "length", "digest",
    )


def merkle_levels(leaves: DataFrame, levels: int, range_bytes: int = RANGE_BYTES) -> list[DataFrame]:
    """Tables ``(file, node, digest)`` from the offset ranges up to the roots."""
    one = F.struct("offset", F.concat_ws(":", "offset", "length", "digest").alias("leaf"))
    told = F.transform(F.array_sort(F.collect_list(one)), lambda x: x["leaf"])
    ranges = leaves.groupBy("file", F.floor(F.col("offset") / range_bytes).alias("node")).agg(told.alias("leaves"))
    tables = [cut(ranges.select("file", "node", F.sha2(F.concat_ws("|", "leaves"), 256).alias("digest")))]
    child = F.struct("node", F.concat_ws(":", "node", "digest").alias("leaf"))
    told = F.transform(F.array_sort(F.collect_list(child)), lambda x: x["leaf"])
    for _ in range(levels):
        up = tables[-1].groupBy("file", F.floor(F.col("node") / FANOUT).alias("up")).agg(told.alias("children"))
        tables.append(up.select("file", F.col("up").alias("node"), F.sha2(F.concat_ws("|", "children"), 256).alias("digest")))
    return tables


def _differing(want: DataFrame, have: DataFrame, keys: list[str]) -> DataFrame:
    w = want.withColumnRenamed("digest", "want")
    h = have.withColumnRenamed("digest", "have")
    return w.join(h, keys, "full_outer").filter(~F.col("want").eqNullSafe(F.col("have")))


def audit(want: DataFrame, have: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(file, offset, kind, want, have)`` of every record in which two replicas differ.

    Both have ``file, offset, length, digest``. ``kind`` is ``altered``, ``missing`` (from
    ``have``) or ``extra``; ``want`` and ``have`` are the digests.
    """
    wide = want.select("offset").unionByName(have.select("offset")).agg(F.max("offset")).first()[0]
    levels, reach = 0, range_bytes
    while wide is not None and reach <= wide:
        levels, reach = levels + 1, reach * FANOUT
    a, b = (merkle_levels(x, levels, range_bytes) for x in (want, have))
    frontier = cut(_differing(a[-1], b[-1], ["file", "node"]).select("file", "node"))
    for level in range(levels - 1, -1, -1):
        parents = frontier.withColumnRenamed("node", "up")
        below = [
            t[level].withColumn("up", F.floor(F.col("node") / FANOUT)).join(parents, ["file", "up"], "left_semi").drop("up") for t in (a, b)
        ]
        frontier = cut(_differing(*below, ["file", "node"]).select("file", "node"))
    rows = [
        x.select("file", "offset", "length", "digest", F.floor(F.col("offset") / range_bytes).alias("node"))
        .join(frontier, ["file", "node"], "left_semi").groupBy("file", "offset")
        .agg(F.concat_ws("+", F.sort_array(F.collect_list(F.concat_ws(":", "length", "digest")))).alias("digest"))
        for x in (want, have)
    ]
    found = _differing(*rows, ["file", "offset"])
    kind = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "extra").otherwise("altered")
    tail = lambda c: F.substring_index(F.col(c), ":", -1)
    return found.select("file", "offset", kind.alias("kind"), tail("want").alias("want"), tail("have").alias("have"))
