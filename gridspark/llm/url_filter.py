"""URL filter: host-suffix and path-prefix expressions met by short hash prefixes.

Every URL is expanded into the expressions ``host suffix + path prefix`` whose
shape (labels, path length) occurs among the rules. Expressions and rules meet in an
equi join on the first 32 bits of a SHA-256 digest; the full digests confirm the
match, and the longest confirmed rule decides.

Edge cases: a null URL, or one without ``://``, has an empty host and path, fits no
rule and gets the default verdict. Between rules of equal length ``block`` wins.
Repeated rows come back as often as they came in; null ids are kept; without rules
every row gets the default. Only the id and the URL are read, so extra columns with
any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridspark.scale import salted_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHORT_DIGITS = 8  # hexadecimal digits: a 32-bit prefix


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty when it is null or has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _hashed(df: DataFrame, expression: Column) -> DataFrame:
    digest = F.sha2(expression, 256)
    return df.withColumn("digest", digest).withColumn("short", F.substring(digest, 1, SHORT_DIGITS))


def url_verdicts(
    urls: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``(id, host, path, rule, verdict)`` per row of ``urls``.

    ``rules`` has ``host``, ``path`` (empty or starting with ``/``) and ``verdict``.
    The shapes of the rules (label count, path length) are read to the driver; there
    are at most 127 labels times the longest rule path of them, however many rules.
    """
    shapes = rules.select(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")
    ).distinct().collect()
    host, path = split_url(F.col(url_col))
    base = urls.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))

    candidate = "struct<chars:int,block:int,rule:string,verdict:string>"
    found = base.withColumn("best", F.lit(None).cast(candidate)).withColumn("rows", F.lit(1))
    if shapes:
        labels = F.size(F.split("host", r"\."))
        expressions = F.array_compact(F.array(*[
            F.when(
                (F.col("host") != "") & (labels >= s.labels) & (F.length("path") >= s.chars),
                F.concat(F.substring_index("host", ".", -s.labels), F.substring("path", 1, s.chars)),
            )
            for s in sorted(shapes)
        ]))
        asked = base.select("*", F.explode(F.array_distinct(expressions)).alias("expression"))
        asked = _hashed(asked, F.col("expression"))
        rule = F.concat("host", "path")
        keyed = _hashed(rules.select(rule.alias("rule"), F.col("verdict")).distinct(), F.col("rule"))
        keyed = keyed.select("short", F.col("digest").alias("full"), "rule", "verdict")
        met = salted_join(asked, keyed, ["short"], "inner").filter(F.col("digest") == F.col("full"))
        best = F.struct(
            F.length("rule").alias("chars"),
            (F.col("verdict") == "block").cast("int").alias("block"),
            "rule",
            "verdict",
        )
        found = found.unionByName(met.select("id", "host", "path", best.cast(candidate).alias("best"), F.lit(0).alias("rows")))
    decided = found.groupBy("id", "host", "path").agg(F.max("best").alias("best"), F.sum("rows").alias("rows"))
    return decided.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("__copy"),
    ).drop("__copy")
