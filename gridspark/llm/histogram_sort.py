"""Histogram sort of documents into shards of nearly equal bytes.

Rows are ordered by (64-bit hash of the text, id). The splitters between shards are
found by counting, exactly and over all partitions, the bytes below candidate keys:
each round lays 4096 probes over the key ranges that still hold an unsettled
splitter, until the bytes below a probe meet the target within the tolerance. Only
probe totals, at most 4096 for each splitter, reach the driver. Then every row
moves once. Equal texts are neighbours; a group of them is cut (by id) only if it is
itself larger than the tolerance around the splitter.

Edge cases: a null text counts as empty (size 1, checksum 0), a null id as the least
id. Rows equal in text and id are one key and stay together. Empty input gives an
empty result. Input columns named like an output column are replaced, all others kept.
"""

from __future__ import annotations

from math import floor, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import cut, free, text_of
from gridspark.scale import running

LEAST = -(1 << 63)
PROBE_BITS = 12
HELPERS = {"__h", "__id", "__size", "__blk", "__c_slot", "__v_slot"}  # names used on the way; input columns called so step aside


def _ordered(c: Column) -> Column:
    """A signed long as bits that sort like an unsigned one."""
    return c.bitwiseXOR(F.lit(LEAST))


def _u(v: int) -> int:
    return v - LEAST


def keys(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the sort key ``__h``, ``__id`` and the size ``__size`` in bytes, one more than the text has."""
    text = text_of(text_col)
    return df.withColumns({
        "__h": F.xxhash64(text),
        "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)),
        "__size": (F.octet_length(text) + 1).cast("long"),
    })


def find_splitters(keyed: DataFrame, shards: int, tolerance: float) -> dict:
    """Splitters ``(h, id)``: a row at or above its k-th one belongs to shard k or later.

    Also returns what the first histogram tells about the rows.
    """
    facts = keyed.agg(
        F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
        F.min("__h").alias("h0"), F.max("__h").alias("h1"), F.min("__id").alias("i0"), F.max("__id").alias("i1"),
    ).first()
    found = {"rows": facts.rows, "i0": facts.i0, "i1": facts.i1, "splitters": [], "probe_rows": {}, "probe_shift": 0}
    if not facts.rows:
        return found
    slack = tolerance * facts.bytes / shards
    edges: dict[int, tuple[float, tuple[int, int]]] = {k: (float("inf"), (facts.h1, facts.i1)) for k in range(1, shards)}
    # A cell is a key range with the bytes below it: (h0, h1, i0, i1, below); one value of h means the ids are probed.
    cells = {(facts.h0, facts.h1, facts.i0, facts.i1, 0): set(edges)}
    first = True
    while cells:
        asked, inside = list(cells), F.lit(None).cast("int")
        probe = F.lit(None).cast("long")
        for n, (h0, h1, i0, i1, _) in enumerate(asked):
            by_id = h0 == h1
            low, high, column = (i0, i1, "__id") if by_id else (h0, h1, "__h")
            shift = max(0, (_u(low) ^ _u(high)).bit_length() - PROBE_BITS)
            here = F.col("__h").between(h0, h1) & (F.col("__id").between(i0, i1) if by_id else F.lit(True))
            inside = F.when(here, F.lit(n)).otherwise(inside)
            probe = F.when(here, F.shiftrightunsigned(_ordered(F.col(column)), shift)).otherwise(probe)
            if first:
                found["probe_shift"] = shift
        counted = (
            keyed.select("__h", "__id", "__size", inside.alias("cell"), probe.alias("probe"))
            .filter(F.col("cell").isNotNull())
            .groupBy("cell", "probe")
            .agg(
                F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("rows"),
                F.min("__h").alias("h0"), F.max("__h").alias("h1"), F.min("__id").alias("i0"), F.max("__id").alias("i1"),
            ).collect()
        )
        counted.sort(key=lambda r: (r.cell, r.h0, r.i0 if asked[r.cell][0] == asked[r.cell][1] else 0))
        if first:
            if facts.h0 == facts.h1:  # a single text: its ids were probed
                found["probe_rows"], found["probe_shift"] = {facts.h0 ^ LEAST: facts.rows}, 0
            else:
                found["probe_rows"] = {r.probe: r.rows for r in counted}
            first = False
        refined: dict[tuple, set[int]] = {}
        below, at = 0, None
        for r in counted:
            if r.cell != at:
                at, below = r.cell, asked[r.cell][4]
            by_id = asked[at][0] == asked[at][1]
            for k in cells[asked[at]]:
                target = facts.bytes * k / shards
                if abs(below - target) < edges[k][0]:
                    edges[k] = (abs(below - target), (r.h0, r.i0 if by_id else LEAST))
                if below < target < below + r.bytes and min(target - below, below + r.bytes - target) > slack:
                    one_key = r.h0 == r.h1 and r.i0 == r.i1
                    if not one_key:
                        refined.setdefault((r.h0, r.h1, r.i0, r.i1, below), set()).add(k)
            below += r.bytes
        cells = {c: {k for k in ks if edges[k][0] > slack} for c, ks in refined.items()}
        cells = {c: ks for c, ks in cells.items() if ks}
    found["splitters"] = [edges[k][1] for k in sorted(edges)]
    return found


def shard_column(found: dict) -> Column:
    at = F.lit(0)
    for h, i in found["splitters"]:
        above = (F.col("__h") > h) | ((F.col("__h") == h) & (F.col("__id") >= i))
        at = at + above.cast("int")
    return at.cast("int")


def _blocks(found: dict) -> Column:
    """Order blocks of some hundred to 16,384 rows; keys with many rows are cut further by id."""
    rows = max(1, found["rows"])
    size = min(16_384, max(256, rows // 512))
    bits = max(1, int(log2(max(2, rows / size))))
    first = F.shiftrightunsigned(_ordered(F.col("__h")), found["probe_shift"])
    mean = rows / max(1, len(found["probe_rows"]))
    heavy = sorted(p for p, n in found["probe_rows"].items() if n > 2 * size + 4 * mean)  # less than a quarter of 4096
    span = (found["i1"] or 0) - (found["i0"] or 0) + 1
    step = min(62, max(0, floor(log2(max(1, span * size / rows)))))
    is_heavy = first.isin(heavy) if heavy else F.lit(False)
    top, coarser = F.shiftrightunsigned(_ordered(F.col("__h")), 64 - bits), 64 - bits - found["probe_shift"]
    around = sorted({(p % (1 << 64)) >> coarser for p in heavy}) if coarser > 0 else []  # tops that hold more than a heavy probe
    return F.struct(
        top.alias("top"),
        F.when(top.isin(around), first).otherwise(F.lit(0)).alias("first"),
        F.when(is_heavy, _ordered(F.col("__h"))).otherwise(F.lit(0)).alias("h"),
        F.when(is_heavy, F.shiftright(F.col("__id"), step)).otherwise(F.lit(0)).alias("i"),
    )


def shard_by_bytes(
    df: DataFrame, shards: int = 16, tolerance: float = 0.005, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns of ``df`` with ``size``, ``text_crc32``, ``shard`` and ``slot``.

    ``slot`` counts from 0 within a shard in key order; shards differ in bytes by the
    tolerance (a share of a shard) on either side, or by one row where rows are larger.
    """
    df = df.drop("size", "text_crc32", "shard", "slot")
    clashing = [c for c in df.columns if c.lower() in HELPERS]
    aside = dict(zip(clashing, free(df, *[f"{c}_" for c in clashing])))
    keyed = keys(df.withColumnsRenamed(aside), aside.get(id_col, id_col), aside.get(text_col, text_col))
    found = find_splitters(cut(keyed.select("__h", "__id", "__size")), shards, tolerance)
    placed = keyed.withColumn("size", F.col("__size")).withColumn("text_crc32", F.crc32(text_of(aside.get(text_col, text_col))))
    placed = placed.withColumn("shard", shard_column(found))
    slotted = running(placed, ["shard"], ["__h", "__id"], {"slot": ("row_number", None)}, _blocks(found))
    slotted = slotted.withColumn("slot", F.col("slot").cast("long") - 1).drop("__h", "__id", "__size")
    return slotted.withColumnsRenamed({new: old for old, new in aside.items()})
