"""Near-duplicate texts by improved consistent weighted sampling over TF-IDF shingles.

A text is its bag of five-word shingles; the weight of a shingle is its count times an inverse
document frequency. Consistent weighted samples (Ioffe 2010) agree between two texts with
the probability of their weighted Jaccard similarity; four samples make a band, sixteen
bands a signature, so that texts of similarity 0.8 share a band with probability 0.9998. Texts
that share a band are verified by their exact weighted Jaccard similarity, and verified
links make classes.

Inverse document frequency: shingles in up to one document of ``RARE`` weigh 1; beyond, the
weight falls with the logarithm of the frequency to ``LEAST_IDF`` for a shingle of all
documents. Only frequent shingles therefore need counting. Every chunk of documents reports
the shingles in more than ``SLACK`` of it; what these reports leave possible is then counted
exactly over all documents, so the weights do not depend on how the rows are dealt.

Buckets are never expanded into all pairs. Each bucket links its members to its smallest one.
Members that this leaves in different classes are compared with each other: in buckets of
up to ``SMALL`` texts as pairs, as far as their sizes and the triangle inequality of the
Jaccard distance leave a link possible; in larger ones in tiles, where a product of hashed
shingle counts bounds all similarities from above and only pairs it leaves open are verified.

Edge cases: equal texts are one class however short; a null text is a class of its own; texts of
fewer than five words are one shingle, texts without words have none and only equal ones
meet; repeated rows share a class; ids that are null make a class named null. Only the
named columns are read.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import cut, free, settled, slices
from gridspark.llm.components import components
from gridspark.llm.vector_dups import forest

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
RARE, LEAST_IDF = 1 / 64, 0.75
CHUNK_DOCS, SLACK = 2048, 1 / 512
FOLD = np.uint64(0x9E3779B97F4A7C15)
TABLE = 1 << 16
GROUP = 256
SMALL, TILE_TEXTS, TILE_SHINGLES = 64, 1024, 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    """Bits of a hash spread over the word (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _gamma_table() -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2 at ``TABLE`` even steps."""
    x = np.linspace(0, 40, 400_001)
    return np.interp((np.arange(TABLE) + 0.5) / TABLE, 1 - (1 + x) * np.exp(-x), x)


GAMMA = _gamma_table().astype(np.float32)
LOG_GAMMA = np.log(_gamma_table()).astype(np.float32)
ODD = _mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * FOLD) | np.uint64(1)


def shingles(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct shingles (64-bit hashes, ascending) and their counts."""
    words = [(t or "").encode().split() for t in texts]  # bytes split at exactly space and U+0009 to U+000D
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    n = int(lengths.sum())
    each = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(words)), np.uint64, n)
    windows = np.zeros(max(0, n - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        windows = windows * FOLD + each[k : k + len(windows)]
    windows = _mix(windows)
    out, at = [], 0
    for length in lengths.tolist():
        if length >= SHINGLE:
            own = windows[at : at + length - SHINGLE + 1]
        elif length:
            short = length
            for h in each[at : at + length].tolist():
                short = (short * int(FOLD) + h) % (1 << 64)
            own = _mix(np.array([short], np.uint64))
        else:
            own = windows[:0]
        out.append(np.unique(own, return_counts=True))
        at += length
    return out


class Weights:
    """Inverse document frequencies of the frequent shingles; 1 for all others."""

    def __init__(self, frequent: dict[int, float]):
        self.keys = np.array(sorted(frequent), np.uint64)
        self.idf = np.array([frequent[k] for k in sorted(frequent)], np.float64)

    def __call__(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        w = counts.astype(np.float64)
        if len(self.keys) and len(hashes):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            w *= np.where(self.keys[at] == hashes, self.idf[at], 1.0)
        return w


def signature(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    best = np.full(BANDS * ROWS, np.inf, np.float32)
    picked = np.zeros(BANDS * ROWS, np.uint64)
    logs = np.log(weights).astype(np.float32)[:, None]
    for i in range(0, len(hashes), 1024):  # long texts in pieces: the least sample of all is kept
        h = hashes[i : i + 1024, None]
        x = h * ODD
        x = (x ^ (x >> np.uint64(32))) * FOLD
        r = GAMMA[(x >> np.uint64(48)).astype(np.int32)]
        beta = ((x >> np.uint64(8)) & np.uint64(0xFFFFFF)).astype(np.float32) * np.float32(2**-24)
        log_c = LOG_GAMMA[((x >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int32)]
        t = np.floor(logs[i : i + 1024] / r + beta)
        log_a = log_c - r * (t - beta) - r
        k = log_a.argmin(0)
        low = log_a[k, np.arange(len(best))]
        step = t[k, np.arange(len(best))].astype(np.int64).astype(np.uint64)
        sample = _mix(hashes[i : i + 1024][k] + step * FOLD)
        better = low < best
        best = np.where(better, low, best)
        picked = np.where(better, sample, picked)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in picked.reshape(BANDS, ROWS).T:
        keys = _mix(keys * FOLD + row)
    return keys


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sorted weighted sets; 0 if both are empty."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][i], b[1][j]).sum())
    return least / (float(a[1].sum()) + float(b[1].sum()) - least)


def frequent_shingles(texts: DataFrame) -> dict[int, float]:
    """Inverse document frequency of every shingle in more than one document of ``RARE``.

    At most (shingles of a mean document / ``RARE``) entries, whatever the number of documents. The reports of the
    chunks lack at most ``SLACK`` of the documents, so at most (shingles of a mean document / (``RARE`` - ``SLACK``))
    shingles are counted again.
    """

    def often(parts):
        found, n = np.unique(np.concatenate(parts), return_counts=True)
        kept = n > int(SLACK * len(parts))
        return pa.RecordBatch.from_arrays([pa.array(found[kept].view(np.int64)), pa.array(n[kept])], ["shingle", "docs"])

    def report(batches):
        parts = []
        for batch in slices(batches, "text"):
            parts += [hashes for hashes, _ in shingles(batch.column(0).to_pylist())]
            while len(parts) >= CHUNK_DOCS:  # half stays, so that no short chunk is left at the end of a task
                yield often(parts[: CHUNK_DOCS // 2])
                del parts[: CHUNK_DOCS // 2]
        if parts:
            yield often(parts)

    total = texts.count()
    reported = texts.mapInArrow(report, "shingle long, docs long").groupBy("shingle").agg(F.sum("docs").alias("docs"))
    possible = reported.filter(F.col("docs") > (RARE - SLACK) * total).select("shingle").toArrow().column(0).to_numpy()
    asked = np.sort(possible.astype(np.int64).view(np.uint64))
    if not len(asked):
        return {}

    def count(batches):
        docs = np.zeros(len(asked), np.int64)
        for batch in slices(batches, "text"):
            for hashes, _ in shingles(batch.column(0).to_pylist()):
                at = np.minimum(np.searchsorted(asked, hashes), len(asked) - 1)
                docs[at[asked[at] == hashes]] += 1
        met = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(asked[met].view(np.int64)), pa.array(docs[met])], ["shingle", "docs"])

    counted = texts.mapInArrow(count, "shingle long, docs long").groupBy("shingle").agg(F.sum("docs").alias("docs"))
    frequent = counted.filter(F.col("docs") > RARE * total).collect()
    fall = (1 - LEAST_IDF) / np.log(1 / RARE)
    return {r.shingle & 0xFFFFFFFFFFFFFFFF: float(1 - fall * np.log(r.docs / (RARE * total))) for r in frequent}


def _signed(df: DataFrame, weights: Weights) -> DataFrame:
    """``(id, mark, size, bands)``; ``mark`` is the MD5 of the text, null for a null text."""

    def sign(batches):
        for batch in slices(batches, "text"):
            texts = batch.column(1).to_pylist()
            known: dict[str | None, tuple] = {None: (None, 0.0, [])}
            fresh = [t for t in dict.fromkeys(texts) if t is not None]
            for t, (hashes, counts) in zip(fresh, shingles(fresh), strict=True):
                w = weights(hashes, counts)
                bands = signature(hashes, w).view(np.int64).tolist() if len(hashes) else []
                known[t] = (hashlib.md5(t.encode()).digest(), float(w.sum()), bands)
            marks, sizes, bands = zip(*[known[t] for t in texts], strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(marks, pa.binary()), pa.array(sizes, pa.float64()), pa.array(bands, pa.list_(pa.int64()))],
                ["id", "mark", "size", "bands"],
            )

    return df.mapInArrow(sign, "id long, mark binary, size double, bands array<long>")


def similar_pairs(a: list[tuple], b: list[tuple], asked: np.ndarray, threshold: float, cells: int = 1_000_000) -> list[tuple[int, int]]:
    """Pairs (i, j) with ``asked[i, j]`` and a similarity of at least ``threshold``.

    The roots of the weights of the shingles are summed in hashed bins. The product of two texts is then at least
    their common weight (a root of a product is no less than the smaller factor), so it bounds the similarity from above.
    """
    bins = 1 << max(8, int(16 * max(len(h) for h, _ in (*a, *b)) - 1).bit_length())
    step = max(1, cells // bins)

    def spread(sets: list[tuple]) -> np.ndarray:
        out = np.zeros((len(sets), bins), np.float32)
        for i, (hashes, weights) in enumerate(sets):
            out[i] = np.bincount((hashes & np.uint64(bins - 1)).astype(np.int64), np.sqrt(weights), bins)
        return out

    total_a, total_b = (np.array([float(w.sum()) for _, w in x]) for x in (a, b))
    found = []
    for j in range(0, len(b), step):
        right = spread(b[j : j + step])
        for i in range(0, len(a), step):
            wanted = asked[i : i + step, j : j + step]
            if not wanted.any():
                continue
            both = total_a[i : i + step, None], total_b[None, j : j + step]
            common = np.minimum((spread(a[i : i + step]) @ right.T) * 1.00001, np.minimum(*both))
            open_ = wanted & (common >= (threshold - 1e-6) * (both[0] + both[1] - common))
            for x, y in zip(*np.nonzero(open_), strict=True):
                if similarity(a[i + x], b[j + y]) >= threshold:
                    found.append((int(i + x), int(j + y)))
    return found


def _texts(asked: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, text)`` of the nodes asked for."""
    asked = asked.distinct().join(nodes.select("node", F.col("mark").alias("own")), "node")
    texts = docs.join(asked, F.col("id") == F.col("node")).filter(F.unhex(F.md5("text")) == F.col("own")).select("node", "text")
    return cut(texts.dropDuplicates(["node"]))


def _tiled(members: DataFrame, texts: DataFrame, weights: Weights, threshold: float) -> DataFrame:
    """Links ``(a, b)`` between members of one bucket that are of different parts.

    ``members`` has ``bucket, band, node, part, bands, slices``. A pair is looked at in the first band it shares.
    """
    own = F.pmod(F.xxhash64("node"), F.col("slices"))
    dealt = members.join(texts, "node").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))
    )
    dealt = dealt.withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        left, right = pdf[pdf.own == pdf["first"]], pdf[pdf.own == pdf["second"]]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        same = pdf["first"].iloc[0] == pdf["second"].iloc[0]
        sets = [[(h, weights(h, c)) for h, c in shingles(x.text.tolist())] for x in ((left,) if same else (left, right))]
        asked = left.part.to_numpy()[:, None] != right.part.to_numpy()[None, :]
        if same:
            asked &= np.triu(np.ones(asked.shape, bool), 1)
        one, two = (np.stack([np.asarray(v, np.int64) for v in x.bands]) for x in (left, right))
        for earlier in range(int(pdf.band.iloc[0])):
            asked &= one[:, earlier][:, None] != two[:, earlier][None, :]
        pairs = similar_pairs(sets[0], sets[-1], asked, threshold)
        links = np.zeros(asked.shape, bool)
        links[tuple(np.array(pairs, np.int64).reshape(-1, 2).T)] = True
        ij = np.array(forest(links), np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": left.node.to_numpy()[ij[:, 0]], "b": right.node.to_numpy()[ij[:, 1]]})

    columns = ["bucket", "first", "second", "own", "band", "node", "part", "bands", "text"]
    return dealt.select(*columns).groupBy("bucket", "first", "second").applyInPandas(compare, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """``(a, b, similarity)`` of the pairs ``(a, b)`` of nodes.

    The texts ``a`` meet ``b`` in groups of about ``GROUP``; the text of a hot ``b`` is sent once to each of its groups.
    """
    pairs = settled(pairs)
    many = settled(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups")))
    dealt = pairs.join(many, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("groups")).alias("group"))
    members = dealt.join(texts.withColumnRenamed("node", "a"), "a").select("b", "group", "a", "text")
    hubs = texts.join(many.withColumnRenamed("b", "node"), "node").select(
        F.col("node").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"),
        F.lit(None).cast("long").alias("a"), "text",
    )
    together = members.unionByName(hubs).repartition("b", "group").sortWithinPartitions("b", "group", F.asc_nulls_first("a"))

    def verify(batches):
        hub = None
        for batch in slices(batches, "text"):
            b, a = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            out_a, out_b, out = [], [], []
            for i, (hashes, counts) in enumerate(shingles(batch.column(3).to_pylist())):
                weighted = (hashes, weights(hashes, counts))
                if a[i] is None:
                    hub = weighted
                else:
                    out_a.append(a[i])
                    out_b.append(b[i])
                    out.append(similarity(weighted, hub))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64()), pa.array(out, pa.float64())], ["a", "b", "similarity"])

    return together.mapInArrow(verify, "a long, b long, similarity double")


def text_classes(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, mark, class_id, kept)`` per row of ``df``.

    ``class_id`` is the smallest id of the class; ``kept`` is true for the row that has it. ``mark`` is
    the MD5 of the text, so classes can be joined by text as well.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    weights = Weights(frequent_shingles(docs.select("text").filter(F.col("text").isNotNull())))
    rows = cut(_signed(docs, weights))
    copies = rows.filter(F.col("mark").isNotNull() & F.col("id").isNotNull()).groupBy("mark").agg(
        F.min("id").alias("node"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    nodes = cut(copies)
    banded = nodes.select("node", "size", F.posexplode("bands").alias("band", "bucket"))
    hub = F.min(F.struct("node", "size")).alias("hub")
    buckets = banded.groupBy("bucket").agg(hub, F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = settled(buckets.select("bucket", F.col("hub.node").alias("hub"), F.col("hub.size").alias("hub_size")))
    inside = settled(banded.join(buckets, "bucket"))  # members of buckets with more than one text
    texts = _texts(inside.select("node"), docs, nodes)

    near = F.least("size", "hub_size") >= threshold * F.greatest("size", "hub_size") - F.lit(1e-9)
    stars = inside.filter((F.col("node") != F.col("hub")) & near).select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    measured = settled(_verified(stars, texts, weights))
    links = measured.filter(F.col("similarity") >= threshold).select("a", "b")
    first = components(links)

    # members of one bucket that are still apart
    placed = inside.join(settled(first), "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    placed = placed.join(measured.select(F.col("a").alias("node"), F.col("b").alias("hub"), "similarity"), ["node", "hub"], "left")
    placed = settled(placed)
    split = placed.groupBy("bucket").agg(
        F.min("part").alias("p0"), F.max("part").alias("p1"), F.count(F.lit(1)).alias("members"),
        F.greatest(F.ceil(F.count(F.lit(1)) / TILE_TEXTS), F.ceil(F.sum("size") / TILE_SHINGLES)).alias("slices"),
    ).filter("p0 <> p1").select("bucket", "members", "slices")
    rest = settled(placed.join(settled(split), "bucket").filter(F.col("node") != F.col("hub")))
    few = rest.filter(F.col("members") <= SMALL).select("bucket", "node", "part", "size", "similarity")
    other = few.select("bucket", *[F.col(c).alias(f"{c}2") for c in ("node", "part", "size", "similarity")])
    possible = (
        (few["node"] < other["node2"]) & (few["part"] != other["part2"])
        & (F.least("size", "size2") >= threshold * F.greatest("size", "size2") - F.lit(1e-9))
        & F.coalesce(F.abs(F.col("similarity") - F.col("similarity2")) <= 1 - threshold + 1e-9, F.lit(True))
    )
    more = few.join(other, (few["bucket"] == other["bucket"]) & possible).select(F.col("node2").alias("a"), F.col("node").alias("b")).distinct()
    found = _verified(more, texts, weights).filter(F.col("similarity") >= threshold).select("a", "b")
    many = settled(rest.filter(F.col("members") > SMALL).join(nodes.select("node", "bands"), "node").select("bucket", "band", "node", "part", "bands", "slices"))
    if not many.isEmpty():
        found = found.unionByName(_tiled(many, texts, weights, threshold))
    first = components(links.unionByName(settled(found)))

    known = nodes.select("mark", "node").join(first, "node", "left").select("mark", F.coalesce("component", "node").alias("class"))
    told = rows.select("id", "mark").join(cut(known), "mark", "left")
    return told.select(
        F.col("id").alias(id_col), "mark", F.coalesce("class", "id").alias("class_id")
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of every class, the one with the smallest id, all columns as they were."""
    classes = text_classes(docs, threshold, id_col, text_col)
    given, own, mark = free(docs, "__id", "__own", "__mark")
    chosen = classes.filter("kept").select(F.col(id_col).alias(given), F.col("mark").alias(own))
    marked = docs.withColumn(mark, F.unhex(F.md5(F.col(text_col).cast("string"))))
    same = F.col(id_col).eqNullSafe(F.col(given)) & F.col(mark).eqNullSafe(F.col(own))
    return marked.join(chosen, same, "left_semi").dropDuplicates([id_col, mark]).drop(mark)
