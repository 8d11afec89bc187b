"""Best-fit packing into bins of several permitted capacities.

Pieces of equal length are interchangeable, so the packing is planned on the
histogram of lengths (at most one entry per length up to the largest capacity,
whatever the number of documents): lengths in descending order, each piece into the
open bin it fills best, and where none has room into a new bin of the capacity that
costs least per token it can hold of what is left. Every opening rule is
simulated, bins are downsized to the smallest capacity that holds their contents, and
the cheapest plan is kept. Pieces then find their place by their rank among pieces of
the same length, in Spark.

Edge cases: documents longer than the largest capacity are cut into full pieces and
a rest, none is dropped; documents without tokens (and null texts) come back with
null bin columns; an empty table gives an empty packing; repeated rows are packed each.
Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import cut, text_of, word_count
from gridspark.scale import running

CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 64  # cost of a bin besides its capacity, in tokens: opening many small bins is dear
RANK_TILE = 1 << 14


class _Open:
    """Open bins by room: intervals of bin numbers with the same contents, least room first."""

    def __init__(self):
        self.rooms: list[int] = []
        self.bins: dict[int, list] = {}

    def put(self, room: int, interval: tuple):
        if room not in self.bins:
            insort(self.rooms, room)
            self.bins[room] = []
        self.bins[room].append(interval)

    def best(self, length: int):
        """Takes an interval out of the bins with least room for ``length``."""
        at = bisect_left(self.rooms, length)
        if at == len(self.rooms):
            return None
        room = self.rooms[at]
        interval = self.bins[room].pop()
        if not self.bins[room]:
            del self.bins[room]
            self.rooms.pop(at)
        return room, interval


def plan(histogram: dict[int, int], capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD) -> tuple[list, list]:
    """Best-fit decreasing on a histogram ``{length: pieces}``.

    Returns ``runs`` and ``bins``. A run ``(length, rank, pieces, bin, per_bin, offset, capacity)``
    places the pieces of that length from ``rank`` on, ``per_bin`` to a bin, from bin ``bin`` and
    ``offset`` tokens into it. Bins are ``(bin, bins, used, capacity)``.
    """
    sizes = tuple(sorted(set(capacities)))
    cheapest = None
    for rule in ("full", "single", "largest"):
        result = _simulate(histogram, sizes, overhead, rule)
        cost = sum(n * (c + overhead) for _, n, _, c in result[1])
        if cheapest is None or cost < cheapest[0]:
            cheapest = (cost, result)
    return cheapest[1]


def _simulate(histogram, sizes, overhead, rule):
    open_, made = _Open(), 0
    tokens = {}  # tokens in pieces of at most this length
    below = 0
    for length in sorted(histogram):
        below += length * histogram[length]
        tokens[length] = below

    def opening(length: int, left: int) -> int:
        fitting = [c for c in sizes if c >= length]
        if rule == "largest":
            return sizes[-1]
        if rule == "single":  # by what pieces of this length alone fill
            return min(fitting, key=lambda c: ((c + overhead) / (c // length * length), -c))
        return min(fitting, key=lambda c: ((c + overhead) / min(c, max(left, length)), -c))

    # an interval is (first bin, bins, chain); a chain is (length, rank, per_bin, first bin at that time, offset, before)
    for length in sorted(histogram, reverse=True):
        count, rank = histogram[length], 0
        left = tokens[length]
        while rank < count:
            todo = count - rank
            held = open_.best(length)
            if held is None:
                capacity = opening(length, left - rank * length)
                per = capacity // length
                need = -(-todo // per)
                held = (capacity, (made, need, (0, 0, 0, 0, 0, capacity, None)))
                made += need
            room, (first, bins, chain) = held
            per = room // length
            whole = min(bins, todo // per)
            used = chain[5] - room
            if whole:
                link = (length, rank, per, first, used, chain[5], chain)
                open_.put(room - per * length, (first, whole, link))
                rank += whole * per
                first, bins = first + whole, bins - whole
            if bins and rank < count and count - rank < per:
                some = count - rank
                link = (length, rank, some, first, used, chain[5], chain)
                open_.put(room - some * length, (first, 1, link))
                rank += some
                first, bins = first + 1, bins - 1
            if bins:
                open_.put(room, (first, bins, chain))
    runs, final = [], []
    for room in list(open_.rooms):
        for first, bins, chain in open_.bins[room]:
            used = chain[5] - room
            if not used:
                continue
            capacity = next(c for c in sizes if c >= used)
            final.append((first, bins, used, capacity))
            link = chain
            while link[6] is not None:
                length, rank, per, start, offset, _, before = link
                runs.append((length, rank + (first - start) * per, bins * per, first, per, offset, capacity))
                link = before
    return runs, final


def pack(
    docs: DataFrame,
    capacities: tuple[int, ...] = CAPACITIES,
    overhead: int = OVERHEAD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(id, piece, first_token, n_tokens, bin_id, bin_capacity, bin_offset)`` for every piece of every document."""
    largest = max(capacities)
    spark = docs.sparkSession
    sized = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text_of(text_col)).alias("mark"), word_count(text_col).alias("size"))
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.ceil(F.col("size") / largest) - 1)))
    pieces = sized.select("*", piece.alias("piece"))
    pieces = cut(pieces.select(
        "id", "mark", "piece", (F.col("piece") * largest).alias("first_token"),
        F.least(F.col("size") - F.col("piece") * largest, F.lit(largest)).cast("int").alias("n_tokens"),
    ))
    counts = {r.n_tokens: r.n for r in pieces.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per length
    counts.pop(0, None)
    runs, _ = plan(counts, capacities, overhead)
    rows = [(length, rank, rank + n, first, per, offset, capacity) for length, rank, n, first, per, offset, capacity in runs]
    run_table = spark.createDataFrame(rows, "n_tokens int, low long, high long, first long, per int, offset int, bin_capacity int")
    run_table = run_table.withColumn(
        "tile", F.explode(F.sequence(F.floor(F.col("low") / RANK_TILE), F.floor((F.col("high") - 1) / RANK_TILE)))
    )
    total = max(1, sum(counts.values()))
    size = min(16_384, max(256, total // 512))
    spread = F.xxhash64("mark", "id", "piece")
    # order blocks of about ``size`` pieces for every length
    share = spark.createDataFrame([(k, max(1, -(-n // size))) for k, n in counts.items()], "n_tokens int, blocks long")
    ordered = pieces.filter("n_tokens > 0").withColumn("spread", spread).join(F.broadcast(share), "n_tokens")  # one row per length
    block = F.floor(F.shiftrightunsigned(F.col("spread").bitwiseXOR(F.lit(-(1 << 63))), 24) * F.col("blocks") / F.lit(float(1 << 40)))
    ranked = running(ordered, ["n_tokens"], ["spread", "id", "piece"], {"rank": ("row_number", None)}, block)
    ranked = ranked.withColumn("rank", F.col("rank").cast("long") - 1).withColumn("tile", F.floor(F.col("rank") / RANK_TILE))
    met = ranked.join(
        run_table, (ranked["n_tokens"] == run_table["n_tokens"]) & (ranked["tile"] == run_table["tile"])
        & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")),
    )
    nth = F.col("rank") - F.col("low")
    placed = met.select(
        "id", "piece", "first_token", ranked["n_tokens"],
        (F.col("first") + F.floor(nth / F.col("per"))).alias("bin_id"), "bin_capacity",
        (F.col("offset") + nth % F.col("per") * ranked["n_tokens"]).cast("int").alias("bin_offset"),
    )
    empty = pieces.filter("n_tokens <= 0").select(
        "id", "piece", "first_token", "n_tokens", F.lit(None).cast("long").alias("bin_id"),
        F.lit(None).cast("int").alias("bin_capacity"), F.lit(None).cast("int").alias("bin_offset"),
    )
    return placed.unionByName(empty).withColumnRenamed("id", id_col)
