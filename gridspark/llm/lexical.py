"""Ranked lexical search: the best documents of every item, by a dual-tree search.

Items and documents are sparse vectors over the items' terms: how often an item asks for a term,
and what the term is worth in a document. A score is their product. Items form a tree, the documents
of a block (a batch inside a task) another; a node holds the largest value of each coordinate
below it. The product of two nodes bounds every score between them, so where it stays below the weakest
k-th best score of the node's items, the whole batch of documents is passed over. All numbers are whole and
below 2^53, so the products are exact in doubles and nothing is lost.

The k-th best scores start from a hash-chosen seed of the documents: any k scores found are a lower
bound. The results of all tasks are ranked per item in the end.

Items are searched for in blocks of bounded size (items times terms), each block in a pass over all
documents. A block's terms, weights and tree are sent to the executors.

Edge cases: null and empty texts have no terms; a document without terms counts nowhere; items without terms,
or whose terms no document has, give no rows; equal scores rank by ascending document id, null ids
last; every row of the items is an item, every row of the documents a document, so repeated rows each
appear; an empty table on either side gives an empty result. Only the named columns are read; long
texts are split piece by piece.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gridspark.llm.common import cut, term_bytes, term_pieces, text_chunks, text_of

ALNUM = term_bytes(ascii_letters + digits)
CELLS = 4_000_000  # items times terms of a block of items
LEAF_ITEMS = 8
LEAF, BLOCK, ENTRIES = 32, 4096, 1_000_000  # documents of a leaf and of a block, entries of a block
FANOUT = 8
SEEDS = 20_000


@dataclass
class Items:
    """A block of items in the order of their tree: what each asks for, the terms' weights and the nodes."""

    ids: list
    rows: list[list[tuple[int, int]]]  # per item: (term, times)
    terms: list[bytes]
    nodes: list[tuple[int, int, tuple[int, ...]]]  # first item, end, children; the root comes first
    weights: list[int] | None = None

    def matrix(self) -> np.ndarray:
        out = np.zeros((len(self.rows), len(self.terms)))
        for i, row in enumerate(self.rows):
            for t, c in row:
                out[i, t] = c
        return out


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Items]:
    """Items in blocks; the driver holds one block and one partition of the items at a time."""
    held: list[tuple[object, Counter]] = []
    known: set[bytes] = set()
    for r in items.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).toLocalIterator():
        tf: Counter = Counter()
        for piece in term_pieces(r.text.encode(), ALNUM):
            tf.update(piece)
        if not tf:
            continue
        if held and (len(held) + 1) * len(known | tf.keys()) > CELLS:
            yield _tree(held)
            held, known = [], set()
        held.append((r.id, tf))
        known |= tf.keys()
    if held:
        yield _tree(held)


def _tree(held: list[tuple[object, Counter]]) -> Items:
    """Items halved again and again: those nearer to one of two far items by shared rare terms, half to each side."""
    df = Counter(t for _, tf in held for t in tf)
    names = sorted(df)
    number = {t: i for i, t in enumerate(names)}
    x = np.zeros((len(held), len(names)), np.float32)
    for i, (_, tf) in enumerate(held):
        for t in tf:
            x[i, number[t]] = 1 / df[t]
        x[i] /= max(np.sqrt((x[i] ** 2).sum()), 1e-9)
    nodes: list[list] = []
    order: list[int] = []

    def build(rows: np.ndarray) -> int:
        me, start = len(nodes), len(order)
        nodes.append([start, start, ()])
        if len(rows) <= LEAF_ITEMS:
            order.extend(rows.tolist())
        else:
            far = rows[np.argmin(x[rows] @ x[rows[0]])]
            side = x[rows] @ (x[rows[np.argmin(x[rows] @ x[far])]] - x[far])
            ranked = rows[np.argsort(side, kind="stable")]
            nodes[me][2] = (build(ranked[: len(rows) // 2]), build(ranked[len(rows) // 2 :]))
        nodes[me][1] = len(order)
        return me

    build(np.arange(len(held)))
    place: dict[bytes, int] = {}
    for i in order:  # terms of near items stand near each other
        for t in sorted(held[i][1]):
            place.setdefault(t, len(place))
    rows = [[(place[t], c) for t, c in held[i][1].items()] for i in order]
    return Items([held[i][0] for i in order], rows, list(place), [tuple(n) for n in nodes])


def term_vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """``(id, n, terms, tfs)``: all terms of a document counted, those of the vocabulary listed with their occurrences."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("n", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType())),
    ])
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shipped.value)}
        get, many = number.get, len(number)
        for batch in batches:
            at = 0
            for chunk in text_chunks(batch.column("text").cast(pa.binary())):
                n, keys = [], []
                for i, text in enumerate(chunk):
                    total = 0
                    for words in term_pieces(text or b"", ALNUM):
                        total += len(words)
                        codes = np.array([c for c in map(get, words) if c is not None], np.int64)
                        keys.append(codes + i * many)
                    n.append(total)
                key, tf = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
                ends = np.searchsorted(key, np.arange(len(chunk) + 1) * many)
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, len(chunk)), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(key % many, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int64()))],
                    ["id", "n", "terms", "tfs"],
                )
                at += len(chunk)

    return docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(run, schema)


class Level:
    """Nodes of one size over the documents of a block: the largest value of every coordinate in each."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, value: np.ndarray, span: int, many: int, count: int):
        key = doc // span * many + term
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        self.node, self.term = np.divmod(key[first], many)
        self.value, self.count = np.maximum.reduceat(value[order], first), count

    def bounds(self, asked: np.ndarray) -> np.ndarray:
        return np.bincount(self.node, weights=asked[self.term] * self.value, minlength=self.count)


class Search:
    """The items' side of a search inside one task, and the best documents found so far."""

    def __init__(self, items: Items, docs: int, terms: int, k: int, least: list[int]):
        self.items, self.k, self.docs, self.terms = items, k, docs, terms
        self.asks = items.matrix()
        self.peaks = [self.asks[a:b].max(axis=0) for a, b, _ in items.nodes]
        self.weights = np.array(items.weights, np.int64)
        self.least = np.maximum(np.array(least, np.float64), 1)  # what a score must reach to be of use
        self.best: list[list[tuple]] = [[] for _ in items.ids]

    def block(self, ids: pa.Array, n: list[int], doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """Documents in ascending order of id; entries sorted by document."""
        if not len(doc):
            return
        m = np.array([25 + 75 * x * self.docs // self.terms for x in n], np.int64)
        value = (self.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))).astype(np.float64)
        # documents with the same most valuable term side by side
        start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        peak = np.maximum.reduceat(value, start)
        top = np.full(len(n), len(self.weights), np.int64)
        is_peak = value == np.repeat(peak, np.diff(np.r_[start, len(doc)]))
        np.minimum.at(top, doc[is_peak], term[is_peak])
        place = np.empty(len(n), np.int64)
        by_place = np.lexsort((np.arange(len(n)), top))
        place[by_place] = np.arange(len(n))
        at = place[doc]
        order = np.argsort(at, kind="stable")
        at, term, value = at[order], term[order], value[order]
        begins = np.searchsorted(at, np.arange(len(n) + 1))
        spans = [LEAF]
        while spans[-1] < len(n):
            spans.append(spans[-1] * FANOUT)
        levels = [Level(at, term, value, s, len(self.weights), -(-len(n) // s)) for s in spans]
        self._meet(0, len(levels) - 1, np.zeros(1, np.int64), levels, (ids, by_place, begins, at, term, value))

    def _meet(self, node: int, level: int, nodes: np.ndarray, levels: list[Level], block: tuple) -> None:
        """One node of the items with nodes of the documents: drop the pairs that can give nothing, go down in the others."""
        first, end, below = self.items.nodes[node]
        bound = levels[level].bounds(self.peaks[node])[nodes]
        nodes = nodes[bound >= self.least[first:end].min()]
        if not len(nodes):
            return
        if level:
            under = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            nodes, level = under[under < levels[level - 1].count], level - 1
        elif not below:
            self._score(first, end, nodes, block)
            return
        for child in below or (node,):
            self._meet(child, level, nodes, levels, block)

    def _score(self, first: int, end: int, leaves: np.ndarray, block: tuple) -> None:
        ids, by_place, begins, at, term, value = block
        low = begins[np.minimum(leaves * LEAF, len(begins) - 1)]
        high = begins[np.minimum((leaves + 1) * LEAF, len(begins) - 1)]
        sizes = high - low
        pick = np.repeat(low - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        docs, local = np.unique(at[pick], return_inverse=True)
        term, value = term[pick], value[pick]
        for i in range(first, end):
            scores = np.bincount(local, weights=self.asks[i][term] * value, minlength=len(docs))
            hits = np.flatnonzero(scores >= self.least[i])
            if not len(hits):
                continue
            rows = by_place[docs[hits]]  # ascending by id
            chosen = np.lexsort((rows, -scores[hits]))[: self.k]
            found = [(-int(scores[hits[c]]), (d := ids[int(rows[c])].as_py()) is None, d) for c in chosen]
            best = sorted([*self.best[i], *found], key=lambda f: (f[0], f[1], f[2] if not f[1] else 0))[: self.k]
            self.best[i] = best
            if len(best) == self.k:
                self.least[i] = max(self.least[i], -best[-1][0])


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Blocks of at most ``BLOCK`` documents and about ``ENTRIES`` entries, documents in ascending order of id."""
    many = np.diff(batch.column("terms").offsets.to_numpy())
    total, start = np.cumsum(many), 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = min(start + BLOCK, max(start + 1, int(np.searchsorted(total, before + ENTRIES, side="right"))))
        part = batch.slice(start, end - start)
        part = part.take(pc.sort_indices(part.column("id"), null_placement="at_end"))
        sizes = np.diff(part.column("terms").offsets.to_numpy())
        yield (
            part.column("id"), part.column("n").to_pylist(), np.repeat(np.arange(part.num_rows), sizes),
            part.column("terms").flatten().to_numpy().astype(np.int64), part.column("tfs").flatten().to_numpy().astype(np.int64),
        )
        start = end


def _search(vectors: DataFrame, items: Items, docs: int, terms: int, k: int, least: list[int], item_type: T.DataType) -> DataFrame:
    """``(item, item_id, doc_id, score)``: at most ``k`` documents per item and task, among them all of the best."""
    id_type = vectors.schema["id"].dataType
    schema = T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("item_id", item_type), T.StructField("doc_id", id_type), T.StructField("score", T.LongType()),
    ])
    shipped, name_kind = vectors.sparkSession.sparkContext.broadcast((items, least)), to_arrow_type(item_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, kind = None, None
        for batch in batches:
            search = search or Search(shipped.value[0], docs, terms, k, shipped.value[1])
            kind = batch.column("id").type
            for block in _blocks(batch):
                search.block(*block)
        if search:
            rows = [(i, search.items.ids[i], d, -s) for i, best in enumerate(search.best) for s, _, d in best]
            if rows:
                item, names, found, scores = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(names, name_kind), pa.array(found, kind), pa.array(scores, pa.int64())], ["item", "item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, schema)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def best_documents(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents with the highest scores above 0 for every item.

    A document with ``n`` of all ``L`` terms of ``N`` documents has ``m = 25 + 75 n N div L``; a term in ``df`` documents
    weighs ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``; the score adds ``w (10^9 tf div (1000 tf + 8 m))`` over an
    item's terms, repeats included.
    """
    item_type = items.schema[item_id_col].dataType
    out = []
    for block in item_blocks(items, item_id_col, item_text_col):
        vectors = cut(term_vectors(docs, block.terms, id_col, text_col))
        size = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms"), F.count(F.lit(1)).alias("rows")).first()
        if not size.docs:
            continue
        df = {r.t: r.c for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c")).collect()}  # the block's terms at most
        block.weights = [math.floor(1000 * math.log((2 * size.docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(block.terms))]
        some = vectors.filter((F.size("terms") > 0) & (F.pmod(F.xxhash64("id", "n"), F.lit(max(16, size.rows // SEEDS))) == 0))
        seeds = _ranked(_search(some, block, size.docs, size.terms, k, [0] * len(block.ids), item_type), k)
        least = dict(seeds.filter(F.col("rank") == k).select("item", "score").collect())  # a number per item of the block
        found = _search(vectors.filter(F.size("terms") > 0), block, size.docs, size.terms, k, [least.get(i, 0) for i in range(len(block.ids))], item_type)
        out.append(_ranked(found, k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not out:
        schema = T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, out)
