"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def word_count(column: str) -> Column:
    """Number of words (runs of anything but space and U+0009 to U+000D) as a long; 0 for null."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder.

    Under adaptive execution its reader does not know how the rows were dealt, so a join
    on it exchanges both sides and can split the partitions of hot keys.
    """
    return cut_lineage(df)


def settled(df: DataFrame, rows: int = 20_000) -> DataFrame:
    """``cut``, read in tasks of about ``rows`` rows: small results do not spread over many tiny files."""
    saved = cut(df)
    return saved.coalesce(saved.count() // rows + 8)


def text_chunks(column: pa.Array, chars: int = 1_000_000) -> Iterator[list[str | None]]:
    """Texts of an Arrow array as lists of about ``chars`` bytes, a single text at least; only one list is held at a time."""
    start, held = 0, 0
    for i, s in enumerate(column):
        size = len(s.as_buffer()) if s.is_valid else 0
        if i > start and held + size > chars:
            yield column.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += size
    if len(column) > start:
        yield column.slice(start).to_pylist()


def slices(batches: Iterator[pa.RecordBatch], column: str, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the texts of one slice hold about ``chars`` bytes, a single text at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column)
        sizes = [0 if not s.is_valid else len(s.as_buffer()) for s in texts]
        start, held = 0, 0
        for i, s in enumerate(sizes):
            if i > start and held + s > chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += s
        yield batch.slice(start)


TERM_PIECE = 1 << 20


def term_bytes(kept: str) -> bytes:
    """Translation table for UTF-8 bytes: ASCII characters ``kept`` and all bytes beyond ASCII stay, A to Z in lower case, others become spaces."""
    keep = set(kept.encode())
    return bytes(b if b >= 128 else 32 if b not in keep else b + 32 if 65 <= b <= 90 else b for b in range(256))


def term_pieces(text: bytes, table: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a piece of the text at a time; no term is cut."""
    left = b""
    for at in range(0, len(text), TERM_PIECE):
        plain = left + text[at : at + TERM_PIECE].translate(table)
        end = len(plain) if at + TERM_PIECE >= len(text) else plain.rfind(b" ") + 1
        yield plain[:end].split()
        left = plain[end:]
