"""Documents to training bins: toxicity, quality, near-duplicates, mixing, packing.

``STAGES`` are functions ``(spark, docs, sf_dir) -> DataFrame``; each works on all that the one
before it kept, written as Parquet and read again. All but the last return the columns of
the documents; the last one returns a row per packed piece.

In every stage null and empty texts count as texts without words, null ids, sources and languages are values like others,
repeated rows are judged each (the near-duplicates keep one of them), extra columns pass through whatever they are called
(the last stage leaves them out), and an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import quality, toxicity
from gridspark.llm.common import table
from gridspark.llm.mixing import mixed_documents
from gridspark.llm.packing import pack
from gridspark.llm.text_dups import keep_one
from gridspark.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier does not call toxic; texts without words are scored as such, rows that repeat stay or go together."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counts and hold content by the line model; null, empty and short texts go, however long ones are read whole."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates, the one with the smallest id; shorter texts than five words are one shingle, those without words only meet equal ones, of repeated rows one stays."""
    return keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of its schedule; texts without words are never taken, rows equal in id, text and source stand for each other."""
    return mixed_documents(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in bins; texts without words have none, repeated rows have their own."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_poor),
    ("near-duplicates", drop_copies),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]

ORACLE_SQL = None  # trained models and sampled signatures have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the table of a stage goes once the next one stands."""
    home = f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        at = f"{home}/{k}"
        stage(spark, docs, sf_dir).write.parquet(at)
        if before is not None:
            path = spark._jvm.org.apache.hadoop.fs.Path(before)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        docs, before = spark.read.parquet(at), at
    return docs
