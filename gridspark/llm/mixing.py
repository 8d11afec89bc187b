"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule takes the golden-ratio point i * phi mod 1 through the
cumulative weights to a source; slots are ranked per source, and the n-th slot of a
source takes the n-th block of its stream. A stream is the source's documents in a
shuffled order, again and in another order for every further pass, cut into blocks of
equally many tokens (words). The last block of a source is cut short where its
target ends, and blocks that the schedule leaves over (a few per source) follow at
its end, so a source gives its target to the token.

Edge cases: null texts and texts without words have size 0 and are never taken; a
null source is a source of its own, ordered last; null ids sort first. Rows equal in
id, text and source are interchangeable. An empty table gives an empty mix. Only the
named columns are read.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import cut, free, text_of, word_count
from gridspark.scale import block_of, running

# Neighbours in the Fibonacci sequence; their ratio is the golden ratio to 18 digits.
STEP, POINTS = 701_408_733, 1_134_903_170
TILES = 4096
BLOCK_ROWS = 16_384


def share_targets(sizes: list[int], weights: list[float], total: float, repeats: float) -> list[float]:
    """Targets in proportion to the weights, none above ``repeats`` times its size; the excess is shared again."""
    capped = [repeats * n for n in sizes]
    order = sorted(range(len(sizes)), key=lambda i: capped[i] / weights[i])
    filled, open_weight = 0, sum(weights)
    level = float("inf")  # of the sources that stay below their cap
    for i in order:
        level = (total - filled) / open_weight
        if capped[i] > weights[i] * level:
            break
        filled, open_weight, level = filled + capped[i], open_weight - weights[i], float("inf")
    return [float(min(c, w * level)) for c, w in zip(capped, weights, strict=True)]


def source_targets(sized: DataFrame, weights: list[float], share: float, repeats: int) -> list[dict]:
    """One entry per source, by code point and null last: ``sid, source, size, target, tokens``.

    One row per source reaches the driver, as every mix names its sources one by one.
    """
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    rows.sort(key=lambda r: (r.source is None, [ord(c) for c in r.source or ""]))
    w = [weights[i % len(weights)] for i in range(len(rows))]
    sizes = [r["size"] for r in rows]
    targets = share_targets(sizes, w, share * sum(sizes), repeats)
    return [
        {"sid": i, "source": r.source, "source_size": r["size"], "target": t, "tokens": int(t), "rows": r["rows"]}
        for i, (r, t) in enumerate(zip(rows, targets, strict=True))
    ]


def schedule(sources: DataFrame, n_sources: int, slots: int) -> DataFrame:
    """``(sid, rank, position)``: which block of which source stands where in the mix.

    ``sources`` has ``sid, low, high`` (its stretch of the cumulative targets) and ``blocks``.
    """
    spark = sources.sparkSession
    lattice = F.col("position") % POINTS * STEP % POINTS
    points = spark.range(slots).select(F.col("id").alias("position"), (lattice / F.lit(float(POINTS))).alias("u"))
    tiles = sources.filter(F.col("high") > F.col("low")).withColumn(
        "tile", F.explode(F.sequence(F.floor(F.col("low") * TILES), F.floor(F.col("high") * TILES)))
    )
    placed = points.withColumn("tile", F.floor(F.col("u") * TILES)).join(F.broadcast(tiles), "tile")  # 4096 + sources rows
    placed = placed.filter((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))).select("sid", "position")
    ranked = running(placed, ["sid"], ["position"], {"rank": ("row_number", None)}, block_of("position", BLOCK_ROWS))
    ranked = cut(ranked.withColumn("rank", F.col("rank").cast("long") - 1))
    # what the sequence has not reached yet: all but its discrepancy, which grows with the logarithm of the slots
    reached = ranked.groupBy("sid").agg(F.count(F.lit(1)).alias("reached"))
    rest = sources.join(reached, "sid", "left").withColumn("reached", F.coalesce("reached", F.lit(0)))
    rest = rest.filter(F.col("blocks") > F.col("reached")).withColumn(
        "rank", F.explode(F.sequence(F.col("reached"), F.col("blocks") - 1))
    )
    rest = rest.select("sid", (F.lit(slots) + F.col("rank") * n_sources + F.col("sid")).alias("position"), "rank")
    return ranked.select("sid", "position", "rank").unionByName(rest)


def _order(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("-")), F.col("mark")))


def mix(
    docs: DataFrame,
    weights: list[float] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    block_tokens: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The mix and its documents.

    The mix has a row per stretch of a document in a block: ``(row, epoch, position,
    at, first, tokens)`` where the stretch starts with the document's word ``first`` and
    stands ``at`` words into the block at ``position``. The documents are ``(row, id, mark,
    size, source, source_size, target)``; ``row`` is unique, ``mark`` the hash of the text.
    """
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.md5(text_of(text_col)).alias("mark"), word_count(text_col).alias("size"),
    )
    sized = cut(sized)
    spark = docs.sparkSession
    found = source_targets(sized, list(weights), share, repeats)
    total = sum(s["tokens"] for s in found)
    low, stretches = 0, []
    for s in found:
        high = low + s["tokens"]
        stretches.append((
            s["sid"], s["source"], s["source_size"], s["target"], s["tokens"], low / max(1, total), high / max(1, total),
            -(-s["tokens"] // block_tokens), s["rows"],
        ))
        low = high
    sources = spark.createDataFrame(
        stretches,
        "sid int, source string, source_size long, target double, tokens long, low double, high double, blocks long, source_rows long",
    )
    known = sized.join(F.broadcast(sources.drop("low", "high", "blocks")), sized["source"].eqNullSafe(sources["source"])).drop(sources["source"])

    for e in range(repeats):
        # hexadecimal digits in front as a number: order blocks of about BLOCK_ROWS rows in every source
        known = known.withColumn(f"o{e}", _order(e))
        front = F.conv(F.substring(f"o{e}", 1, 10), 16, 10).cast("long")
        blocks = F.greatest(F.lit(1), F.ceil(F.col("source_rows") / F.lit(_block_rows(found))))
        block = F.floor(front * blocks / F.lit(float(1 << 40)))
        outputs = {f"end{e}": ("sum", F.col("size"))}
        if e == 0:
            outputs["n"] = ("row_number", None)
        known = running(known, ["sid"], [f"o{e}", "id"], outputs, block)
    known = cut(known.withColumn("row", F.struct("sid", "n")))

    passes = []
    for e in range(repeats):
        first = F.col(f"end{e}") - F.col("size") + F.lit(e) * F.col("source_size")
        passes.append(F.struct(F.lit(e).alias("epoch"), first.alias("start"), F.least(first + F.col("size"), F.col("tokens")).alias("stop")))
    spans = known.select("sid", "row", F.explode(F.array(*passes)).alias("p")).select("sid", "row", "p.*").filter("stop > start")
    b = F.lit(block_tokens)
    pieces = spans.withColumn("rank", F.explode(F.sequence(F.floor(F.col("start") / b), F.floor((F.col("stop") - 1) / b))))
    begin = F.greatest("start", F.col("rank") * b)
    pieces = pieces.select(
        "sid", "rank", "row", "epoch", (begin % b).alias("at"), (begin - F.col("start")).alias("first"),
        (F.least(F.col("stop"), (F.col("rank") + 1) * b) - begin).alias("tokens"),
    )
    slots = -(-total // block_tokens)
    mixed = pieces.join(schedule(sources, len(found), slots), ["sid", "rank"])
    return mixed.select("row", "epoch", "position", "at", "first", "tokens"), known.select(
        "row", "id", "mark", "size", "source", "source_size", "target"
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes half of their words or more, all columns, in the order of the schedule."""
    mixed, known = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **how)
    passes = mixed.groupBy("row", "epoch").agg(F.sum("tokens").alias("tokens"), F.min("position").alias("position"))
    takes = known.join(passes, "row").filter(2 * F.col("tokens") >= F.col("size"))
    own, given, mark, src, places, alike, at = free(docs, "__own", "__id", "__mark", "__source", "__positions", "__rows", "__position")
    takes = takes.groupBy("row", F.col("id").alias(given), F.col("mark").alias(mark), F.col("source").alias(src)).agg(
        F.collect_list("position").alias(places)  # one per pass
    )
    # rows equal in id, text and source each have a place of their own in the mix, one of them stands for all
    key = [given, mark, src]
    takes = cut(takes.groupBy(*key).agg(F.flatten(F.collect_list(places)).alias(places), F.count(F.lit(1)).alias(alike)))
    marked = docs.withColumn(own, F.md5(text_of(text_col)))
    same = F.col(id_col).eqNullSafe(F.col(given)) & (F.col(own) == F.col(mark)) & F.col(source_col).eqNullSafe(F.col(src))
    single = marked.join(takes.filter(F.col(alike) == 1), same)
    repeated = marked.join(takes.filter(F.col(alike) > 1), same).dropDuplicates(key)
    chosen = single.unionByName(repeated).select(*docs.columns, F.explode(places).alias(at))
    return chosen.repartitionByRange(at).sortWithinPartitions(at).drop(at)


def _block_rows(found: list[dict]) -> int:
    """Rows of an order block: a 512th of all, between 256 and BLOCK_ROWS."""
    return min(BLOCK_ROWS, max(256, sum(s["rows"] for s in found) // 512))
