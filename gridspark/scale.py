"""Skew-safe building blocks shared by the operators.

* ``balanced``     blocks of about equally many rows along an order, for scans whose values may lie anyhow.
* ``running``      ordered scans (row numbers, running sums, fill-down, lag) that
                   split every group into order blocks, so one hot sheet or key
                   is spread over many tasks.
* ``salted_join``  equi join against a keyed table with hot keys on the fact side.
* ``tile_join``    cells against rectangular ranges, as an equi join on row tiles.
* ``whole``        one-row statistics as a scalar subquery, no join at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.session import cut_lineage

SALTS = 16
TILE_ROWS = 4096
HOT_ROWS = 1_000_000
HOT_KEYS = 4096


def block_of(column: str | Column, size: int = 1 << 18) -> Column:
    """Order block of an integer key: consecutive key values share a block."""
    c = F.col(column) if isinstance(column, str) else column
    return F.floor(c / F.lit(size))


def balanced(df: DataFrame, *order: Column, name: str = "__part") -> DataFrame:
    """``df`` with the number of its block along ``order``; blocks hold about equally many rows, whatever the values.

    Spark samples the rows to cut the ranges. The result is saved once, since another sample would cut elsewhere.
    Rows equal in all of ``order`` share a block, so end ``order`` with something that tells rows apart.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *order).withColumn(name, F.spark_partition_id()))


def _before(summary: DataFrame, names: list[str]) -> DataFrame:
    """Sums of all earlier blocks for a scan without keys: one array of a row per block, folded from the first to the last."""
    fields = {n: summary.schema[f"__p_{n}"].dataType for n in names}
    blocks = F.array_sort(F.collect_list(F.struct("__blk", *[F.col(f"__p_{n}") for n in names])))
    entry = lambda blk, sums: F.struct(blk.alias("__blk"), *[sums[n].alias(f"__c_{n}") for n in names])
    item = f"struct<__blk:{summary.schema['__blk'].dataType.simpleString()},{','.join(f'__c_{n}:{t.simpleString()}' for n, t in fields.items())}>"
    start = F.struct(*[F.lit(0).cast(t).alias(n) for n, t in fields.items()], F.array().cast(f"array<{item}>").alias("done"))

    def step(acc: Column, e: Column) -> Column:
        sums = {n: (acc[n] + F.coalesce(e[f"__p_{n}"], F.lit(0))).cast(t) for n, t in fields.items()}
        done = F.concat(acc["done"], F.array(entry(e["__blk"], acc)).cast(f"array<{item}>"))
        return F.struct(*[v.alias(n) for n, v in sums.items()], done.alias("done"))

    one = summary.agg(blocks.alias("__all")).select(F.aggregate("__all", start, step)["done"].alias("__all"))
    return one.select(F.explode("__all").alias("__e")).select("__e.*")


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    outputs: dict[str, tuple[str, Column | None]],
    block: Column,
    by: list[Column] | None = None,
) -> DataFrame:
    """Ordered scan of each ``keys`` group in ascending ``order``.

    Row numbers and sums may follow other sort expressions, ``by``.

    ``outputs`` maps a new column to ``(kind, value)`` where kind is
    ``row_number``, ``sum`` (running, inclusive), ``max`` (largest so far, inclusive),
    ``last`` (latest non-null so far, inclusive) or ``lag`` (value of the row before). ``block`` must not
    decrease along ``order``; it bounds the rows one task sorts. Blocks are
    first summarised (partial aggregation), the summaries are scanned, and each
    block then continues from what came before it. Null keys are a group, and rows
    of a null block come first: keys and block meet as one struct, which is never null.
    """
    names = list(outputs)
    blocked = df.withColumn("__blk", F.struct(*keys, block.alias("__blk")))
    for n, (_, value) in outputs.items():
        if value is not None:
            blocked = blocked.withColumn(f"__v_{n}", value)
    position = F.struct(*[F.col(o) for o in order])

    parts = []
    for n, (kind, _) in outputs.items():
        v = F.col(f"__v_{n}")
        if kind == "row_number":
            parts.append(F.count(F.lit(1)).alias(f"__p_{n}"))
        elif kind == "sum":
            parts.append(F.sum(v).alias(f"__p_{n}"))
        elif kind == "max":
            parts.append(F.max(v).alias(f"__p_{n}"))
        elif kind == "last":
            parts.append(F.max_by(v, F.when(v.isNotNull(), position)).alias(f"__p_{n}"))
        elif kind == "lag":
            parts.append(F.max_by(F.struct(v.alias("v")), position).alias(f"__p_{n}"))
        else:
            raise ValueError(f"unknown scan kind {kind!r}")
    summary = blocked.groupBy("__blk").agg(*parts)

    if not keys and all(kind in ("row_number", "sum") for kind, _ in outputs.values()):
        return _continued(blocked, _before(summary, names), outputs, order, by)

    group = [F.col("__blk")[k] for k in keys]
    earlier = Window.partitionBy(*group).orderBy(F.col("__blk")["__blk"]).rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for n, (kind, _) in outputs.items():
        p = F.col(f"__p_{n}")
        if kind in ("row_number", "sum"):
            carried.append(F.coalesce(F.sum(p).over(earlier), F.lit(0)).alias(f"__c_{n}"))
        elif kind == "max":
            carried.append(F.max(p).over(earlier).alias(f"__c_{n}"))
        else:
            carried.append(F.last(p, ignorenulls=True).over(earlier).alias(f"__c_{n}"))
    return _continued(blocked, summary.select("__blk", *carried), outputs, order, by)


def _continued(blocked: DataFrame, carry: DataFrame, outputs: dict, order: list[str], by: list[Column] | None) -> DataFrame:
    """The scan inside every block, from what its earlier blocks carry over."""
    names = list(outputs)
    rows = blocked.join(carry, "__blk")
    inside = Window.partitionBy("__blk").orderBy(*(by or order))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    for n, (kind, _) in outputs.items():
        v, c = F.col(f"__v_{n}"), F.col(f"__c_{n}")
        if kind == "row_number":
            out = F.row_number().over(inside) + c
        elif kind == "sum":
            out = F.coalesce(F.sum(v).over(so_far), F.lit(0)) + c
        elif kind == "max":
            out = F.greatest(F.max(v).over(so_far), c)
        elif kind == "last":
            out = F.coalesce(F.last(v, ignorenulls=True).over(so_far), c)
        else:
            first = F.row_number().over(inside) == 1
            out = F.when(first, c["v"]).otherwise(F.lag(v).over(inside))
        rows = rows.withColumn(n, out)
    helpers = ["__blk"] + [f"__c_{n}" for n in names] + [f"__v_{n}" for n in names]
    return rows.drop(*helpers)


def hot_keys(facts: DataFrame, on: list[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys that hold more than ``rows`` facts, and more than one in ``HOT_KEYS`` of all: so at most ``HOT_KEYS`` of them."""
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    least = F.greatest(F.lit(rows), F.floor(whole(counts, n=F.sum("__n"))["n"] / HOT_KEYS))
    return counts.filter(F.col("__n") > least).select(*on)


def salted_join(
    facts: DataFrame,
    keyed: DataFrame,
    on: list[str],
    how: str = "left",
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join with a keyed table, hot keys of the facts spread over ``salts`` tasks.

    The salt hashes the other fact columns, so a recomputed task salts alike.
    By default every keyed row is repeated per salt, which suits small keyed
    tables. For a keyed table that grows with the data pass ``hot`` (see
    ``hot_keys``, its size is bounded): only those keys are salted and repeated. ``hot`` may name some of the key columns only.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"salted join cannot be {how!r}")
    others = [c for c in facts.columns if c not in on] or list(on)
    salt = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    last = F.lit(salts - 1)
    left, right = facts, keyed
    if hot is not None:
        named = [c for c in on if c in hot.columns]
        marked = F.broadcast(hot.select(*named).distinct().withColumn("__hot", F.lit(True)))
        left, right = facts.join(marked, named, "left"), keyed.join(marked, named, "left")
        salt = F.when(F.col("__hot"), salt).otherwise(F.lit(0))
        last = F.when(F.col("__hot"), last).otherwise(F.lit(0))
    left = left.withColumn("__salt", salt).drop("__hot")
    right = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), last))).drop("__hot")
    return left.join(right, [*on, "__salt"], how).drop("__salt")


def split_join(facts: DataFrame, keyed: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Equi join that leaves hot keys to adaptive execution, which splits their partitions and repeats only what they meet.

    For keyed tables that grow with the data, where counting the hot keys would mean making the facts twice.
    """
    return facts.join(keyed, on, how)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows over all shuffle partitions by hash, kept apart even when they are few and tiny."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *columns)


def widened(df: DataFrame) -> DataFrame:
    """Rows of a few large files over all tasks, for work that is dear per row.

    Left alone where the scan is as wide as the session, and where rows have been exchanged already.
    """
    plan, width = df._jdf.queryExecution(), df.sparkSession.sparkContext.defaultParallelism
    if "Exchange" in plan.executedPlan().toString() or plan.toRdd().getNumPartitions() >= width:
        return df
    return df.repartition(width)


def tile_join(
    cells: DataFrame, ranges: DataFrame, how: str = "inner", tile: int = TILE_ROWS
) -> DataFrame:
    """Cells against ranges ``(book, sheet, min_col, min_row, max_col, max_row, …)``.

    Each range is cut into row tiles, so the join is an equi join on
    ``(book, sheet, tile)`` and a cell meets only the ranges of its own tile.
    Range columns come out prefixed ``r_``; a cell covered twice appears twice.
    """
    r = ranges.select(*[F.col(c).alias(f"r_{c}") for c in ranges.columns]).withColumn(
        "r_tile",
        F.explode(F.sequence(F.floor(F.col("r_min_row") / tile), F.floor(F.col("r_max_row") / tile))),
    )
    c = cells.withColumn("__tile", F.floor(F.col("row") / tile))
    same = (
        (F.col("book") == F.col("r_book"))
        & (F.col("sheet") == F.col("r_sheet"))
        & (F.col("__tile") == F.col("r_tile"))
        & F.col("row").between(F.col("r_min_row"), F.col("r_max_row"))
        & F.col("col").between(F.col("r_min_col"), F.col("r_max_col"))
    )
    return c.join(r, same, how).drop("__tile", "r_tile", "r_book", "r_sheet")


def whole(df: DataFrame, **aggregates: Column) -> Column:
    """Whole-table statistics as one struct-valued scalar subquery."""
    fields = [a.alias(n) for n, a in aggregates.items()]
    return df.agg(F.struct(*fields).alias("whole")).scalar()
