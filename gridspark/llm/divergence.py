"""How far the sources of a language lie from each other, from counts over collapsed duplicates.

Rows with the same text and language are collapsed to one with the number of copies per source:
first within each batch, then in one exchange by a hash of the text (the texts themselves are
compared, the hash only deals and sorts). Each distinct text is split into terms once; its
counts are added as often as a source holds it. Terms in too few documents go. Each pair
of sources is then evaluated sparsely: terms that both hold are visited in their rows, terms that one
of them holds are summed over the counts that occur (few, however many terms), and all
others share one value.

Terms are runs of letters A to Z, a to z and anything beyond ASCII; only A to Z are lower-cased. All
arithmetic is in whole numbers.

Edge cases: null text, language and source are read as ''; empty texts have no terms but
their group is reported; repeated rows count as often as they stand; ties rank by the item's UTF-8
bytes; a language without kept terms gets value 0 for its pairs and no terms; an empty table gives
an empty result. Only the named columns are read. A long text is split piece by piece.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from string import ascii_letters

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridspark.llm.common import cut, term_bytes, term_pieces, text_of
from gridspark.scale import salted_join

UNIT = 1_000_000_000  # the p of all terms of a group add up to about this
HELD = 400_000  # counts a task holds before it hands them on
SMALL = 50_000  # groups, one short row each, that a broadcast may carry
TILE = 256  # sources by sources whose sums a task holds at a time
CHUNK = 1 << 16
LETTERS = term_bytes(ascii_letters)

COPIES = "h long, lang string, text string, sources array<string>, copies array<long>"
COUNTS = "lang string, source string, term string, n long, docs long"


def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(h, lang, text, source)`` with the copies within a batch put together."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        h, sources = batch.column("h").to_numpy(zero_copy_only=False), batch.column("source").to_pylist()
        order = np.argsort(h, kind="stable")
        again = np.flatnonzero(h[order][1:] == h[order][:-1])
        shared = np.zeros(n, bool)
        shared[order[again]] = shared[order[again + 1]] = True
        first, per = {}, {}
        for i in np.flatnonzero(shared):
            key = (batch.column("lang")[i].as_py(), batch.column("text")[i].as_py())
            at = first.setdefault(key, i)
            held = per.setdefault(at, {})
            held[sources[i]] = held.get(sources[i], 0) + 1
        rows = [i for i in range(n) if not shared[i] or i in per]
        kept = batch.take(pa.array(rows, pa.int64()))
        names = [list(per[i]) if i in per else [sources[i]] for i in rows]
        copies = [list(per[i].values()) if i in per else [1] for i in rows]
        yield pa.RecordBatch.from_arrays(
            [kept.column("h"), kept.column("lang"), kept.column("text"), pa.array(names, pa.list_(pa.string())), pa.array(copies, pa.list_(pa.int64()))],
            ["h", "lang", "text", "sources", "copies"],
        )


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts ``(lang, source, term, n, docs)`` of collapsed texts sorted by ``h``; each distinct text is split once."""
    held: dict[tuple[str, str], dict[bytes, int]] = defaultdict(dict)
    room = 0  # entries at most
    run: dict[tuple[str, str], dict[str, int]] = {}
    mark = None

    def add() -> int:
        new = 0
        for (lang, text), per in run.items():
            tf: Counter = Counter()
            for terms in term_pieces(text.encode(), LETTERS):
                tf.update(terms)
            new += len(tf) * len(per)
            for source, m in per.items():
                counts, here = held[lang, source], m << 48  # documents above, occurrences below
                for t, c in tf.items():
                    counts[t] = counts.get(t, 0) + (c * m + here)
        run.clear()
        return new

    def out() -> Iterator[pa.RecordBatch]:
        low = (1 << 48) - 1
        for (lang, source), counts in held.items():
            terms, values = list(counts), list(counts.values())
            for at in range(0, len(terms), CHUNK):
                part, v = terms[at : at + CHUNK], values[at : at + CHUNK]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang), len(part)), pa.repeat(pa.scalar(source), len(part)), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array([x & low for x in v], pa.int64()), pa.array([x >> 48 for x in v], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
        held.clear()

    for batch in batches:
        columns = [batch.column(c) for c in ("h", "lang", "text", "sources", "copies")]
        for i in range(batch.num_rows):
            h, lang, text, sources, copies = (c[i].as_py() for c in columns)
            if h != mark:
                room += add()
                mark = h
                if room > 4 * HELD:
                    room = sum(map(len, held.values()))
                    if room > HELD:
                        yield from out()
                        room = 0
            per = run.setdefault((lang, text), {})
            for s, m in zip(sources, copies, strict=True):
                per[s] = per.get(s, 0) + m
    add()
    yield from out()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Partial counts ``(lang, source, term, n, docs)``: add them up per term."""
    lang, text = text_of(lang_col), text_of(text_col)
    named = docs.select(F.xxhash64(lang, text).alias("h"), lang.alias("lang"), text.alias("text"), text_of(source_col).alias("source"))
    met = named.mapInArrow(collapsed, COPIES).repartition("h").sortWithinPartitions("h")
    return met.mapInArrow(counted, COUNTS)


def _share(count: Column, whole: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / whole), exact beyond 64 bits; null where there is nothing to share."""
    scaled = (count.cast("decimal(19,0)") + 1) * F.lit(UNIT).cast("decimal(10,0)")
    return 1 + F.call_function("div", scaled, F.when(whole > 0, whole).cast("decimal(19,0)"))


def _joined(facts: DataFrame, keyed: DataFrame, on: list[str], small: bool) -> DataFrame:
    """``keyed`` has a row or an array entry for each group; broadcast only if the counted groups are few."""
    return facts.join(F.broadcast(keyed), on) if small else salted_join(facts, keyed, on, "inner")


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources what the terms both hold add beyond what each one's own terms say.

    Rows ``(lang, sids, ps, rests)``: the sources that hold one term, its p in each, and the p of a term that
    the source does not hold. Sums are kept per tile of pairs and handed on before there are many.
    """
    sums: dict[tuple[str, int, int], np.ndarray] = {}

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, x, y), s in sums.items():
            a, b = np.nonzero(s)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang), len(a)), pa.array(a + x * TILE, pa.int32()), pa.array(b + y * TILE, pa.int32()), pa.array(s[a, b], pa.int64())],
                ["lang", "a", "b", "value"],
            )
        sums.clear()

    for batch in batches:
        langs = batch.column("lang").to_numpy(zero_copy_only=False)
        starts = batch.column("sids").offsets.to_numpy()
        sid, p, rest = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("sids", "ps", "rests"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(starts))
        lang_of = langs[row]
        for lang in sorted(set(langs)):
            mine = lang_of == lang
            r, s, v, z = row[mine], sid[mine], p[mine], rest[mine]
            for y in np.unique(s // TILE):
                inside = s // TILE == y
                cols, at = np.unique(s[inside], return_inverse=True)
                rows, line = np.unique(r[inside], return_inverse=True)
                there = np.zeros((len(rows), len(cols)), np.int64)
                there[line, at] = v[inside]
                zero = np.ones(len(cols), np.int64)
                zero[at] = z[inside]
                where = np.full(batch.num_rows, -1)
                where[rows] = np.arange(len(rows))
                for a in np.unique(s):
                    own = (s == a) & (where[r] >= 0)
                    if not own.any():
                        continue
                    key = (lang, int(a // TILE), int(y))
                    total = sums.setdefault(key, np.zeros((TILE, TILE), np.int64))
                    za, pa_, q = z[own][0], v[own][:, None], there[where[r[own]]]
                    safe = np.maximum(q, 1)
                    extra = gap(pa_, safe) - gap(pa_, zero[None, :]) - gap(za, safe) + gap(za, zero)[None, :]
                    total[a % TILE, cols % TILE] += np.where(q > 0, extra, 0).sum(axis=0)
            if len(sums) > 64:
                yield from out()
    yield from out()


def own_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of sources what the terms of one of them add to the value that all other terms share.

    Rows ``(lang, sid, rest, ps, ns, rests)``: a source, the p that ``ns`` of its terms have, and the p of a missing
    term in every source of the language. The source is the first of the pair, then the second.
    """
    for batch in batches:
        for k in range(batch.num_rows):
            lang, sid, rest, ps, ns, rests = (batch.column(c)[k] for c in ("lang", "sid", "rest", "ps", "ns", "rests"))
            rest, sid = rest.as_py(), sid.as_py()
            p, n, z = (x.values.to_numpy(zero_copy_only=False) for x in (ps, ns, rests))
            first, second = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
            for b, q in enumerate(z):
                first[b] = (n * (gap(p, q) - gap(rest, q))).sum()
                second[b] = (n * (gap(q, p) - gap(q, np.int64(rest)))).sum()
            other, mine = np.arange(len(z), dtype=np.int32), np.full(len(z), sid, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang.as_py()), 2 * len(z)), pa.array(np.concatenate([mine, other])), pa.array(np.concatenate([other, mine])), pa.array(np.concatenate([first, second]))],
                ["lang", "a", "b", "value"],
            )


def audit_sources(
    docs: DataFrame, least_docs: int = 3, top: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: divergence from every other source of the language, and its ``top`` terms.

    A term's p in a group is 1 + floor(UNIT * (count + 1) / (N + V)), for V kept terms with N occurrences; the
    gap of p from q is floor((p - q)^2 / q). Part ``pair`` adds the gaps over all kept terms, q from the
    other source; part ``term`` ranks the terms that the group holds more of than its language.
    """
    named = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source")).distinct()
    numbered = named.withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    groups = cut(numbered)
    small = groups.count() <= SMALL

    parts = _joined(term_counts(docs, text_col, lang_col, source_col), groups, ["lang", "source"], small)
    whole = parts.select("lang", "term", "sid", "n", "docs").repartition("lang", "term").groupBy("lang", "term", "sid").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = whole.groupBy("lang", "term").agg(
        F.collect_list("sid").alias("sids"), F.collect_list("n").alias("ns"), F.sum("n").alias("all"), F.sum("docs").alias("df")
    ).filter(F.col("df") >= least_docs).drop("df")
    kept = cut(kept)

    # V and N of languages and groups; groups without terms stay
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all").alias("all"))
    entry = kept.select("lang", "term", "all", F.explode(F.arrays_zip("sids", "ns")).alias("e")).select("lang", "term", "all", F.col("e.sids").alias("sid"), F.col("e.ns").alias("n"))
    sums = entry.groupBy("lang", "sid").agg(F.sum("n").alias("n"))
    sized = groups.join(langs, "lang", "left").join(sums, ["lang", "sid"], "left").fillna(0, ["terms", "all", "n"])
    sized = sized.select("lang", "source", "sid", "terms", (F.col("n") + F.col("terms")).alias("size"), (F.col("all") + F.col("terms")).alias("lang_size"))
    zero = F.coalesce(_share(F.lit(0), F.col("size")), F.lit(1))
    sized = cut(sized.withColumn("rest", zero))

    # terms of a group against its language
    p, q = _share(F.col("n"), F.col("size")), _share(F.col("all"), F.col("lang_size"))
    shares = _joined(entry, sized, ["lang", "sid"], small).select("lang", "source", "sid", F.col("term").alias("item"), "n", p.alias("p"), q.alias("q"), "rest")
    over = shares.filter(F.col("p") > F.col("q")).select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = over.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top).withColumn("part", F.lit("term"))

    # pairs: a value all terms share, what each source's terms change, what terms in both change again
    entries = F.array_sort(F.collect_list(F.struct("sid", "size", "rest")))
    lists = sized.groupBy("lang").agg(entries.alias("g")).select("lang", F.col("g.size").alias("sizes"), F.col("g.rest").alias("rests"))
    every = _joined(sized.select("lang", "sid", "terms", "rest"), lists.drop("sizes"), ["lang"], small).select("lang", "sid", "terms", "rest", F.posexplode("rests").alias("b", "q"))
    base = every.select("lang", F.col("sid").alias("a"), "b", (F.col("terms") * F.expr("(rest - q) * (rest - q) div q")).alias("value"))

    held = _joined(entry, sized.select("lang", "sid", "size", "rest"), ["lang", "sid"], small)
    alike = held.groupBy("lang", "sid", "rest", "size", "n").agg(F.count(F.lit(1)).alias("times"))
    alike = alike.withColumn("p", _share(F.col("n"), F.col("size"))).groupBy("lang", "sid", "rest", F.floor(F.col("n") / CHUNK)).agg(F.collect_list("p").alias("ps"), F.collect_list("times").alias("ns"))
    single = _joined(alike.select("lang", "sid", "rest", "ps", "ns"), lists.drop("sizes"), ["lang"], small)
    sparse = "lang string, a int, b int, value long"
    single = single.mapInArrow(own_terms, sparse)

    rows = _joined(kept.filter(F.size("sids") > 1).select("lang", "sids", "ns"), lists, ["lang"], small)
    at = F.arrays_zip("sids", "ns")
    size_of = lambda e: F.element_at("sizes", e["sids"] + 1)
    rows = rows.select(
        "lang", "sids", F.transform(at, lambda e: _share(e["ns"], size_of(e))).alias("ps"), F.transform("sids", lambda s: F.element_at("rests", s + 1)).alias("rests")
    )
    both = rows.mapInArrow(shared_terms, sparse)

    value = base.unionByName(single).unionByName(both).filter(F.col("a") != F.col("b")).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    own = sized.select("lang", F.col("sid").alias("a"), "source")
    other = sized.select("lang", F.col("sid").alias("b"), F.col("source").alias("item"))
    pairs = _joined(_joined(value, own, ["lang", "a"], small), other, ["lang", "b"], small).select("lang", "source", "item", "value")
    pairs = pairs.withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
