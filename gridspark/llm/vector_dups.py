"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Equal vectors are compared once. The distinct ones are dealt to the nearest of a few pivots
and cut into tiles. Two tiles meet unless the triangle inequality between their pivots
rules out every link. In a pair of tiles all products are taken between vectors quantised
to int8 (exactly, as whole numbers below 2^24, up to 1,040 components; beyond, the rounding of longer
sums joins the bound); the quantisation error of each vector bounds the error of each cosine, and only pairs whose cosine is not settled by the bound
are computed again in double precision. A pair of tiles returns link counts and at most one
edge per vector (a spanning forest of its links), never all its links.

Edge cases: vectors that are null, empty, zero, or hold a null or non-finite component link
with nothing, nor do rows with a null id; vectors of different length do not link;
repeated vectors link with each other; an empty table gives an empty result. Only the
named columns are read.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import cut
from gridspark.llm.components import components

TILE = 4096
PIVOTS = 64
CHUNK = 512
EXACT = (1 << 24) // (127 * 127)  # components whose whole-number products single precision sums exactly
OPEN = 6_400_000  # components taken at a time where pairs are computed again


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of unit vectors as whole numbers up to 127: values, scale, norm of the rounded vector, norm of the error."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None])
    rounded = q * scale[:, None]
    return q.astype(np.float32), scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(x - rounded, axis=1)


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which unit vectors of ``a`` and ``b`` have a cosine of at least ``threshold``, as a matrix."""
    qa, sa, na, ea = quantise(a)
    qb, sb, nb, eb = quantise(b)
    out = np.zeros((len(a), len(b)), bool)
    sb32, nb32, eb32 = (v.astype(np.float32) for v in (sb, nb, eb))
    # single precision: the scales, and a sum of n terms is off by n / 2^24 of the vectors' lengths at most
    rounding = np.float32(4e-6 + (0 if a.shape[1] <= EXACT else 1.01 * a.shape[1] / (1 << 24)))
    pairs = max(1, OPEN // max(1, a.shape[1]))
    for i in range(0, len(a), CHUNK):
        rows = slice(i, i + CHUNK)
        about = qa[rows] @ qb.T  # whole numbers, at most 127 * 127 a component
        about *= sa[rows].astype(np.float32)[:, None]
        about *= sb32
        # |cos - about| <= |a'||e_b| + |e_a||b'| + |e_a||e_b|, and some for single precision
        slack = (na[rows] + ea[rows]).astype(np.float32)[:, None] * eb32 + ea[rows].astype(np.float32)[:, None] * nb32 + rounding
        open_ = about + slack >= threshold
        if not open_.any():
            continue
        sure = about - slack >= threshold
        out[rows] = sure
        r, c = np.nonzero(open_ & ~sure)
        for k in range(0, len(r), pairs):
            rr, cc = r[k : k + pairs], c[k : k + pairs]
            exact = np.einsum("ij,ij->i", a[i + rr], b[cc])
            out[i + rr, cc] = exact >= threshold
    return out


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges (row, column) that connect whatever ``links`` connects."""
    r, c = np.nonzero(links)
    if len(r) <= links.shape[0] + links.shape[1]:
        return list(zip(r.tolist(), c.tolist(), strict=True))
    edges: list[tuple[int, int]] = []
    free_rows, free_columns = links.any(1), np.ones(links.shape[1], bool)
    while free_rows.any():
        wave = np.array([int(free_rows.argmax())])
        free_rows[wave] = False
        while len(wave):
            met = links[wave] & free_columns
            columns = np.flatnonzero(met.any(0))
            if not len(columns):
                break
            edges += zip(wave[met[:, columns].argmax(0)].tolist(), columns.tolist(), strict=True)
            free_columns[columns] = False
            back = links[:, columns] & free_rows[:, None]
            wave = np.flatnonzero(back.any(1))
            if not len(wave):
                break
            edges += zip(wave.tolist(), columns[back[wave].argmax(1)].tolist(), strict=True)
            free_rows[wave] = False
    return edges


def _unit(raw: list[bytes] | pd.Series, dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _read(rows: DataFrame) -> DataFrame:
    """``(id, dim, raw, mark)``: the vector as bytes of doubles and its hash, null where it cannot link."""

    def read(batches):
        for batch in batches:
            raws = []
            for v in batch.column(1):
                x = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = np.asarray(v.values, dtype=np.float64) + 0.0  # turns -0.0 into 0.0
                raws.append(x.tobytes() if x is not None and np.isfinite(x).all() and x.any() else None)
            raw = pa.array(raws, pa.binary())
            dims = pa.array([0 if r is None else len(r) // 8 for r in raws], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), dims, raw], ["id", "dim", "raw"])

    found = rows.mapInArrow(read, "id long, dim int, raw binary")
    return found.withColumn("mark", F.when(F.col("id").isNotNull(), F.md5("raw")))


def link_vectors(df: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", tile: int = TILE) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row of ``df``."""
    spark = df.sparkSession
    rows = cut(_read(df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))))
    # a node is a distinct vector; its name starts with its smallest id, so names sort like ids
    shift = F.lit(Decimal(1 << 63)).cast("decimal(20,0)")
    name = F.concat(F.lpad((F.min("id").cast("decimal(20,0)") + shift).cast("string"), 20, "0"), F.lit("|"), F.col("mark"))
    nodes = rows.filter(F.col("mark").isNotNull()).groupBy("mark").agg(
        name.alias("node"), F.count(F.lit(1)).alias("copies"), F.first("dim").alias("dim"), F.first("raw").alias("raw")
    )
    nodes = cut(nodes)
    total = nodes.count()

    wanted = min(PIVOTS, -(-total // tile))
    pivots: dict[int, np.ndarray] = {}
    if wanted > 1:
        for r in nodes.select("dim", "raw", "mark").orderBy("mark").limit(wanted).collect():
            x = _unit([bytes(r.raw)], r.dim)
            pivots[r.dim] = np.vstack([pivots[r.dim], x]) if r.dim in pivots else x

    def place(batches):
        for batch in batches:
            dims, raws = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            cells, angles = np.zeros(len(dims), np.int64), np.full(len(dims), math.pi)
            for d in set(dims):
                at = [i for i, x in enumerate(dims) if x == d]
                cells[at] = d * PIVOTS
                if d in pivots:
                    near = _unit([raws[i] for i in at], d) @ pivots[d].T
                    cells[at] += near.argmax(1)
                    angles[at] = np.arccos(np.clip(near.max(1), -1, 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells), pa.array(angles)], ["node", "copies", "dim", "raw", "cell", "angle"]
            )

    placed = nodes.select("node", "copies", "dim", "raw").mapInArrow(
        place, "node string, copies long, dim int, raw binary, cell long, angle double"
    )
    placed = cut(placed)
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("reach")).collect()  # PIVOTS rows per length
    reach = math.acos(threshold) + 1e-9
    meet = []
    for x in cells:
        for y in cells:
            (dx, kx), (dy, ky) = divmod(x.cell, PIVOTS), divmod(y.cell, PIVOTS)
            if dx != dy:
                continue
            apart = 0.0 if dx not in pivots else math.acos(float(np.clip(pivots[dx][kx] @ pivots[dx][ky], -1, 1)))
            if apart <= x.reach + y.reach + reach:
                meet.append((x.cell, y.cell))
    counts = spark.createDataFrame([(c.cell, -(-c.n // tile)) for c in cells], "cell long, tiles long")
    dealt = placed.join(F.broadcast(counts), "cell").withColumn("nth", F.pmod(F.xxhash64("node"), F.col("tiles")))  # PIVOTS rows

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        return pd.DataFrame([{
            "tile": f"{key[0]}:{key[1]}", "cell": key[0], "dim": int(pdf.dim.iloc[0]), "raw": b"".join(pdf.raw),
            "nodes": pdf.node.tolist(), "copies": pdf.copies.tolist(),
        }])

    tiles = cut(dealt.select("cell", "nth", "node", "copies", "dim", "raw").groupBy("cell", "nth").applyInPandas(
        pack, "tile string, cell long, dim int, raw binary, nodes array<string>, copies array<long>"
    ))
    allowed = spark.createDataFrame(meet, "cell long, other long")
    names = tiles.select("tile", "cell")
    pairs = names.join(F.broadcast(allowed), "cell").join(  # at most PIVOTS squared rows per length
        names.select(F.col("cell").alias("other"), F.col("tile").alias("second")), "other"
    ).filter(F.col("tile") <= F.col("second")).select(F.col("tile").alias("first"), "second")
    swap = F.pmod(F.xxhash64("first", "second"), F.lit(2)) == 0  # spreads the pairs over both tiles
    pairs = cut(pairs.select(F.when(swap, F.col("second")).otherwise(F.col("first")).alias("first"), F.when(swap, F.col("first")).otherwise(F.col("second")).alias("second")))
    one = tiles.select(*[F.col(c).alias(f"{c}_a") for c in ("tile", "dim", "raw", "nodes", "copies")])
    two = tiles.select(*[F.col(c).alias(f"{c}_b") for c in ("tile", "dim", "raw", "nodes", "copies")])
    work = pairs.join(one, F.col("first") == F.col("tile_a")).join(two, F.col("second") == F.col("tile_b"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in pdf.itertuples():
            a, b = _unit([r.raw_a], r.dim_a), _unit([r.raw_b], r.dim_b)
            links = tile_links(a, b, threshold)
            same = r.tile_a == r.tile_b
            if same:
                np.fill_diagonal(links, False)
                links |= links.T
            first, second = np.asarray(r.nodes_a, object), np.asarray(r.nodes_b, object)
            weights = [np.asarray(w, np.float64) for w in (r.copies_a, r.copies_b)]
            for own, n in ((first, links @ weights[1]), (second, None if same else weights[0] @ links)):
                if n is not None and (at := np.flatnonzero(n)).size:
                    out.append(pd.DataFrame({"a": own[at], "b": None, "links": n[at].astype(np.int64)}))
            if links.any():
                ij = np.array(forest(links))
                out.append(pd.DataFrame({"a": first[ij[:, 0]], "b": second[ij[:, 1]], "links": 0}))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "links": []}).astype({"a": object, "b": object, "links": np.int64})

    found = cut(work.groupBy("second", "first").applyInPandas(compare, "a string, b string, links long"))
    joined = components(found.filter(F.col("b").isNotNull()).select("a", "b"))
    n_links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    least = (F.substring("name", 1, 20).cast("decimal(20,0)") - shift).cast("long")
    known = nodes.select("mark", "node", "copies").join(n_links, "node", "left").join(joined, "node", "left")
    known = known.withColumn("name", F.coalesce("component", "node")).select(
        "mark", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), least.alias("component_id")
    )
    told = rows.select("id", "mark").join(cut(known), "mark", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return told.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
