"""B: typing, inference and scalar conversion, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridspark.functions import scalars as S
from gridspark.operators import typing as T
from gridspark.scale import block_of
from suite.registry import query


@query(
    "b1_type_cells",
    """SELECT event_id,
      CASE event_id % 7 WHEN 0 THEN round(value, 2) WHEN 6 THEN NULL END AS v_num,
      CASE event_id % 7 WHEN 1 THEN event_type WHEN 4 THEN event_type END AS v_str,
      CASE event_id % 7 WHEN 2 THEN user_id % 2 = 1 END AS v_bool,
      CASE event_id % 7 WHEN 3 THEN '#N/A' END AS err,
      CASE event_id % 7 WHEN 5 THEN strftime(TIMESTAMP '1899-12-30' + to_days((60 + user_id)::INT), '%Y-%m-%d') END AS day,
      CASE event_id % 7 WHEN 6 THEN user_id * 86400000 END AS span_ms FROM events""",
)
def _(t):
    ev, k = t.events, F.col("event_id") % 7
    raw = ev.select(
        "event_id",
        F.when(k == 1, "inlineStr").when(k == 2, "b").when(k == 3, "e").when(k == 4, "str").otherwise("n").alias("t"),
        F.when(k == 0, F.round("value", 2).cast("string")).when(k.isin(1, 4), F.col("event_type"))
        .when(k == 2, (F.col("user_id") % 2).cast("string")).when(k == 3, "#N/A")
        .when(k == 5, (F.col("user_id") + 60).cast("string")).otherwise(F.col("user_id").cast("string")).alias("v"),
        F.lit(None).cast("string").alias("formula"),
        F.when(k == 5, "date").when(k == 6, "timedelta").otherwise("number").alias("style_class"),
    )
    out = T.type_cells(raw)
    return out.select("event_id", "v_num", "v_str", "v_bool", "err", F.date_format("v_ts", "yyyy-MM-dd").alias("day"), "span_ms")


@query(
    "b2_cast_number",
    """SELECT l_orderkey, l_linenumber, l_suppkey, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END AS i,
       CASE WHEN l_linenumber % 2 = 1 THEN l_discount + l_quantity END AS d FROM lineitem""",
)
def _(t):
    text = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey").cast("string")).otherwise(
        (F.col("l_discount") + F.col("l_quantity")).cast("string"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", S.cast_number(text).alias("x")).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "x.*")


_SERIAL = """CASE WHEN l_orderkey % 10 = 0 THEN l_quantity * 1.25 - 1 WHEN l_orderkey % 10 = 1 THEN l_discount + l_tax
   WHEN l_orderkey % 10 = 2 THEN 59 + l_linenumber / 2.0 WHEN l_orderkey % 10 = 3 THEN 3000000 + l_quantity ELSE l_extendedprice / 3 END"""


def _serial():
    k = F.col("l_orderkey") % 10
    return (
        F.when(k == 0, F.col("l_quantity") * 1.25 - 1).when(k == 1, F.col("l_discount") + F.col("l_tax"))
        .when(k == 2, 59 + F.col("l_linenumber") / 2.0).when(k == 3, 3000000 + F.col("l_quantity"))
        .otherwise(F.col("l_extendedprice") / 3)
    )


def _from_serial_sql(epoch: int) -> str:
    fix = "CASE WHEN v > 0 AND v < 60 THEN 1 ELSE 0 END" if epoch == 1900 else "0"
    start = "1899-12-30" if epoch == 1900 else "1904-01-01"
    last = 2958466 if epoch == 1900 else 2957004
    return f"""SELECT l_orderkey, l_linenumber, l_extendedprice, {epoch} AS epoch,
      CASE WHEN NOT clock AND NOT off THEN strftime(TIMESTAMP '{start}' + to_milliseconds(total), '%Y-%m-%d %H:%M:%S.%g') END AS ts,
      CASE WHEN clock THEN ms END AS time_ms, CASE WHEN NOT clock AND off THEN '#VALUE!' END AS err
      FROM (SELECT *, v >= 0 AND v < 1 AND ms < 86400000 AS clock, (day * 86400000 + ms)::BIGINT AS total, day * 86400000 + ms >= {last}::BIGINT * 86400000 AS off
      FROM (SELECT *, floor(v)::BIGINT + {fix} AS day, round_even((v - floor(v)) * 86400000, 0)::BIGINT AS ms
      FROM (SELECT *, {_SERIAL} AS v FROM lineitem)))"""


@query("b3_from_serial", _from_serial_sql(1900) + " UNION ALL " + _from_serial_sql(1904))
def _(t):
    li, parts = t.lineitem, []
    for epoch in (1900, 1904):
        x = S.from_serial(_serial(), epoch)
        parts.append(li.select("l_orderkey", "l_linenumber", "l_extendedprice", F.lit(epoch).alias("epoch"), x.alias("x")).select(
            "l_orderkey", "l_linenumber", "l_extendedprice", "epoch",
            F.date_format("x.ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"), "x.time_ms", "x.err"))
    return parts[0].unionByName(parts[1])


@query(
    "b4_duration_from_serial",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, (floor(us / 1000000) * 1000 + round_even((us - floor(us / 1000000) * 1000000) / 1000, 0))::BIGINT AS ms
       FROM (SELECT *, round_even(l_quantity / 7 * 86400000000, 0)::BIGINT AS us FROM lineitem)""",
)
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", S.duration_from_serial(F.col("l_quantity") / 7).alias("ms"))


@query(
    "b5_to_serial",
    """SELECT event_id AS id, 'e' AS kind, round(date_diff('day', DATE '1899-12-30', ts::DATE) + (hour(ts) * 3600 + minute(ts) * 60 + (microsecond(ts) / 1000000.0)) / 86400.0, 7) AS s1900,
       round(date_diff('day', DATE '1904-01-01', ts::DATE) + (hour(ts) * 3600 + minute(ts) * 60 + (microsecond(ts) / 1000000.0)) / 86400.0, 7) AS s1904 FROM events
       UNION ALL SELECT o_orderkey, 'o', CASE WHEN d > 0 AND d <= 60 THEN d - 1 ELSE d END::DOUBLE, (d - 1462)::DOUBLE
       FROM (SELECT *, date_diff('day', DATE '1899-12-30', (o_orderdate - INTERVAL 96 YEAR)::DATE) AS d FROM orders)""",
)
def _(t):
    e = t.events.select(F.col("event_id").alias("id"), F.lit("e").alias("kind"), F.round(S.to_serial(F.col("ts")), 7).alias("s1900"),
                        F.round(S.to_serial(F.col("ts"), 1904), 7).alias("s1904"))
    early = F.col("o_orderdate") - F.expr("INTERVAL 96 YEAR")
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.lit("o").alias("kind"), S.to_serial(early).alias("s1900"), S.to_serial(early, 1904).alias("s1904"))
    return e.unionByName(o)


@query(
    "b6_from_iso",
    """SELECT event_id, CASE WHEN k = 0 THEN strftime(ts, '%Y-%m-%d') END AS day, CASE WHEN k = 1 THEN (hour(ts) * 3600 + minute(ts) * 60 + floor(microsecond(ts) / 1000000))::BIGINT * 1000000 END AS time_us,
       CASE WHEN k = 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS stamp, CASE WHEN k = 3 THEN ((event_id % 30) * 3600 + (user_id % 60) * 60)::BIGINT * 1000000 + 1500000 END AS duration_us,
       CASE WHEN k = 4 THEN 'invalid datetime' END AS err FROM (SELECT *, event_id % 5 AS k FROM events)""",
)
def _(t):
    k = F.col("event_id") % 5
    text = (
        F.when(k == 0, F.date_format("ts", "yyyy-MM-dd")).when(k == 1, F.date_format("ts", "HH:mm:ss"))
        .when(k == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(k == 3, F.concat(F.lit("PT"), F.col("event_id") % 30, F.lit("H"), F.col("user_id") % 60, F.lit("M1.5S")))
        .otherwise(F.col("event_type"))
    )
    return t.events.select("event_id", S.from_iso(text).alias("x")).select(
        "event_id", F.date_format("x.date", "yyyy-MM-dd").alias("day"), "x.time_us",
        F.date_format("x.ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("stamp"), "x.duration_us", "x.err")


@query(
    "b7_to_iso",
    """SELECT event_id, CASE WHEN microsecond(ts) % 1000000 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS iso,
       strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS iso_s FROM events""",
)
def _(t):
    return t.events.select("event_id", S.to_iso(F.col("ts")).alias("iso"), S.to_iso(F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("iso_s"))


_FORMAT_CASE = "CASE f " + " ".join(
    f"WHEN {i} THEN '{code.replace(chr(39), chr(39) * 2)}'" for i, code in S.BUILTIN_FORMATS.items()) + " END"


@query(
    "b8_classify_format",
    """SELECT CASE WHEN f IN (14, 15, 16, 17) THEN 'date' WHEN f IN (18, 19, 20, 21, 45, 47) THEN 'time' WHEN f = 22 THEN 'datetime'
       WHEN f = 46 THEN 'timedelta' ELSE 'number' END AS class, count(*) AS n FROM (SELECT (l_partkey % 50)::INT AS f FROM lineitem) GROUP BY 1""",
)
def _(t):
    styled = t.lineitem.select((F.col("l_partkey") % 50).alias("style_id"))
    return T.classify_cells(styled, S.format_code(F.col("style_id"))).groupBy("class").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b9_format_code",
    f"""SELECT f AS format_id, {_FORMAT_CASE} AS code, CASE WHEN {_FORMAT_CASE} IS NOT NULL THEN f END AS back, count(*) AS n
       FROM (SELECT (l_partkey % 60)::INT AS f FROM lineitem) GROUP BY ALL""",
)
def _(t):
    f = t.lineitem.select((F.col("l_partkey") % 60).cast("int").alias("format_id")).withColumn("code", S.format_code(F.col("format_id")))
    return f.withColumn("back", S.format_id(F.col("code"))).groupBy("format_id", "code", "back").agg(F.count(F.lit(1)).alias("n"))


@query(
    "b10_infer_numeric",
    """SELECT l_orderkey AS id, CASE l_linenumber WHEN 1 THEN l_partkey WHEN 2 THEN -l_suppkey END AS i,
       CASE l_linenumber WHEN 3 THEN l_tax + l_quantity WHEN 4 THEN l_linenumber * 1000.0 END AS d, count(*) AS n FROM lineitem GROUP BY ALL
       UNION ALL SELECT event_id, CASE WHEN props LIKE '{"k": %}' AND event_id % 2 = 0 THEN user_id END, NULL, 1 FROM events""",
)
def _(t):
    k = F.col("l_linenumber")
    text = (F.when(k == 1, F.col("l_partkey").cast("string")).when(k == 2, F.concat(F.lit("-"), F.col("l_suppkey").cast("string")))
            .when(k == 3, (F.col("l_tax") + F.col("l_quantity")).cast("string")).when(k == 4, "4e3").when(k == 5, "1,5").otherwise(F.col("l_returnflag")))
    li = t.lineitem.select(F.col("l_orderkey").alias("id"), S.infer_numeric(text).alias("x")).select("id", F.when(F.col("x.i") != 0, F.col("x.i")).otherwise(F.col("x.i")).alias("i"), "x.d").groupBy("id", "i", "d").agg(F.count(F.lit(1)).alias("n"))
    ev = t.events.select(F.col("event_id").alias("id"), S.infer_numeric(F.when(F.col("event_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(F.col("props"))).alias("x")).select("id", "x.i", "x.d", F.lit(1).cast("bigint").alias("n"))
    return li.unionByName(ev)


@query(
    "b11_infer_percent",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN -(l_quantity + l_discount) / 100 ELSE (l_quantity + l_discount) / 100 END AS p FROM lineitem""",
)
def _(t):
    shown = (F.col("l_quantity") + F.col("l_discount")).cast("string")
    text = F.when(F.col("l_linenumber") == 7, "%x").when(F.col("l_linenumber") == 6, F.concat(F.lit("-"), shown, F.lit("%"))).otherwise(F.concat(shown, F.lit(" %")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", S.infer_percent(text).alias("p"))


@query(
    "b12_infer_time",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN (hour(ts) * 3600 + minute(ts) * 60)::BIGINT * 1000000 WHEN 1 THEN (hour(ts) * 3600 + minute(ts) * 60 + floor(microsecond(ts) / 1000000))::BIGINT * 1000000
       WHEN 2 THEN (minute(ts) * 60)::BIGINT * 1000000 + microsecond(ts) // 1000 * 1000 END AS us FROM events""",
)
def _(t):
    k = F.col("event_id") % 4
    text = (F.when(k == 0, F.date_format("ts", "HH:mm")).when(k == 1, F.date_format("ts", "HH:mm:ss"))
            .when(k == 2, F.date_format("ts", "mm:ss.SSS")).otherwise(F.concat(F.lit("99:"), F.date_format("ts", "mm"))))
    return t.events.select("event_id", S.infer_time(text).alias("us"))


@query(
    "b13_bind_values",
    """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'f' WHEN doc_id % 11 = 1 THEN 'e' WHEN doc_id % 11 = 3 THEN 's' ELSE 's' END AS dtype,
       CASE WHEN doc_id % 11 = 0 THEN '=' || left(text, 32766) WHEN doc_id % 11 = 1 THEN '#REF!' WHEN doc_id % 11 = 2 THEN NULL WHEN doc_id % 11 = 3 THEN '=' ELSE left(text, 32767) END AS value,
       CASE WHEN doc_id % 11 = 2 THEN true ELSE regexp_matches(left(text, 32767), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]') AND doc_id % 11 NOT IN (1, 3) END AS rejected, doc_id % 11 NOT IN (1, 3) AND length(text) + (doc_id % 11 IN (0, 2))::INT > 32767 AS cut FROM documents""",
)
def _(t):
    k = F.col("doc_id") % 11
    text = (F.when(k == 0, F.concat(F.lit("="), "text")).when(k == 1, "#REF!").when(k == 2, F.concat(F.lit("\x0b"), "text")).when(k == 3, "=").otherwise(F.col("text")))
    return T.bind_values(t.documents.select("doc_id", text.alias("value")), "value")


@query(
    "b14_error_code",
    """SELECT CASE o_orderkey % 9 WHEN 0 THEN '#NULL!' WHEN 1 THEN '#DIV/0!' WHEN 2 THEN '#VALUE!' WHEN 3 THEN '#REF!' WHEN 4 THEN '#NAME?' WHEN 5 THEN '#NUM!' WHEN 6 THEN '#N/A' END AS err, count(*) AS n FROM orders GROUP BY 1""",
)
def _(t):
    shown = F.element_at(F.array(*[F.lit(x) for x in [*S.ERROR_CODES, "#GETTING_DATA"]], F.col("o_orderpriority")), (F.col("o_orderkey") % 9 + 1).cast("int"))
    return t.orders.select(S.error_code(shown).alias("err")).groupBy("err").agg(F.count(F.lit(1)).alias("n"))


def _escape_sql(c: str) -> str:
    for code in range(1, 26):
        c = f"replace({c}, chr({code}), '_x{code:04x}_')"
    return c


@query("b15_escape_ctl", f"SELECT doc_id, {_escape_sql('text')} AS escaped FROM documents")
def _(t):
    return t.documents.select("doc_id", S.escape_ctl(F.col("text")).alias("escaped"))


@query("b16_unescape_ctl", "SELECT doc_id, text AS back, 'a' || chr(9) || 'b_x00g1_' || chr(233) || '_x000a_' AS fixed FROM documents")
def _(t):
    made = F.concat(F.lit("a_x0009_b_x00g1__x00E9__x005F_x000a_"), F.substring("text", 1, 0))
    return t.documents.select("doc_id", S.unescape_ctl(S.escape_ctl(F.col("text"))).alias("back"), S.unescape_ctl(made).alias("fixed"))


@query(
    "b17_safe_string",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, printf('%.16g', l_extendedprice) AS price, printf('%.16g', l_extendedprice / 7) AS seventh, printf('%.16g', l_quantity) AS quantity, printf('%.16g', l_discount / 300) AS small,
       CASE WHEN l_linenumber = 1 THEN 'none' WHEN l_linenumber = 2 THEN '' ELSE printf('%.16g', l_tax) END AS odd FROM lineitem""",
)
def _(t):
    odd = F.when(F.col("l_linenumber") == 1, F.lit(None)).when(F.col("l_linenumber") == 2, F.lit(float("nan"))).otherwise(F.col("l_tax"))
    shown = {"price": F.col("l_extendedprice"), "seventh": F.col("l_extendedprice") / 7, "quantity": F.col("l_quantity"), "small": F.col("l_discount") / 300, "odd": odd}
    read = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "l_tax")
    return S.safe_strings(read, shown).select("l_orderkey", "l_linenumber", "l_extendedprice", *shown)


@query(
    "b18_flatten_runs",
    "SELECT conv_id, turn, role || ': ' || text || coalesce(CASE WHEN turn % 2 = 0 THEN role END, '') AS flat FROM conversations",
)
def _(t):
    run = lambda f, x: F.struct(F.lit(f).alias("font"), x.alias("text"))
    runs = F.array(run("bold", F.col("role")), run(None, F.lit(": ")), run("body", F.col("text")), run("bold", F.when(F.col("turn") % 2 == 0, F.col("role"))))
    return t.conversations.select("conv_id", "turn", S.flatten_runs(runs).alias("flat"))


@query(
    "b19_merge_runs",
    """WITH f AS (SELECT *, CASE WHEN role = 'system' THEN 'user' ELSE role END AS font FROM conversations WHERE text <> ''),
       l AS (SELECT *, lag(font) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM f),
       g AS (SELECT *, sum(CASE WHEN font IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS g FROM l)
       SELECT conv_id, g::BIGINT AS run, font, count(*) AS pieces, string_agg(text, '' ORDER BY turn) AS text FROM g GROUP BY conv_id, g, font""",
)
def _(t):
    runs = t.conversations.select("conv_id", "turn", F.when(F.col("role") == "system", "user").otherwise(F.col("role")).alias("font"), "text")
    return T.merge_runs(runs, ["conv_id"], "turn", block_of("turn", 4096)).drop("part")


@query(
    "b20_profile",
    """SELECT 'value' AS field, count_if(value IS NULL) > 0 AS blank, false AS string, count_if(value IS NOT NULL) > 0 AS number, count_if(value = floor(value)) = count(value) AS integer, false AS date,
         round(min(value), 2) AS min_num, round(max(value), 2) AS max_num, NULL::VARCHAR AS min_date, NULL::VARCHAR AS max_date, false AS long_text, false AS mixed FROM events
       UNION ALL SELECT 'ts', count_if(ts IS NULL) > 0, false, false, false, true, NULL, NULL, strftime(min(ts), '%Y-%m-%d'), strftime(max(ts), '%Y-%m-%d'), false, false FROM events
       UNION ALL SELECT 'event_type', false, true, false, false, false, NULL, NULL, NULL, NULL, count_if(length(event_type) > 255) > 0, false FROM events
       UNION ALL SELECT 'text', count_if(text IS NULL) > 0, true, false, false, false, NULL, NULL, NULL, NULL, count_if(length(text) > 255) > 0, false FROM documents
       UNION ALL SELECT 'n_chars', false, false, true, true, false, min(n_chars)::DOUBLE, max(n_chars)::DOUBLE, NULL, NULL, false, false FROM documents""",
)
def _(t):
    return T.profile(t.events, ["value", "ts", "event_type"]).unionByName(T.profile(t.documents, ["text", "n_chars"]))


@query(
    "b21_display_unit",
    """SELECT l_returnflag, round(sum(l_extendedprice / 1000), 2) AS thousands, round(sum(l_extendedprice / 1e6), 4) AS millions, round(sum(l_extendedprice / 12), 2) AS dozens FROM lineitem GROUP BY 1""",
)
def _(t):
    p = F.col("l_extendedprice")
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum(S.display_unit(p, "thousands")), 2).alias("thousands"),
        F.round(F.sum(S.display_unit(p, "millions")), 4).alias("millions"), F.round(F.sum(S.display_unit(p, 12)), 2).alias("dozens"))


@query(
    "b22_normalise",
    """SELECT o_orderkey, replace(replace(trim(replace(o_orderpriority, '-', ' – ')), '–', '-'), ' - ', '-') AS label FROM orders""",
)
def _(t):
    shown = F.concat(F.lit("  "), F.replace("o_orderpriority", F.lit("-"), F.lit(" – ")), F.lit(" "))
    return t.orders.select("o_orderkey", S.normalise(shown).alias("label"))


@query("b23_sanitise_id", "SELECT p_partkey, replace(p_name, ' ', '_') || '_' || p_size AS id FROM part")
def _(t):
    return t.part.select("p_partkey", S.sanitise_id(F.concat("p_name", F.lit(" ("), F.col("p_size"), F.lit(")"))).alias("id"))


@query(
    "b24_dedupe_names",
    """WITH a AS (SELECT p_brand AS book, p_partkey, CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN p_name || '2' ELSE p_name END AS name FROM part),
       b AS (SELECT *, regexp_extract(lower(name), '([0-9]{0,15})$', 1) AS d, row_number() OVER (PARTITION BY book, lower(name) ORDER BY p_partkey) AS n FROM a),
       c AS (SELECT *, left(name, length(name) - length(d)) AS stem FROM b),
       e AS (SELECT *, max(coalesce(try_cast(d AS BIGINT), 0)) OVER (PARTITION BY book, lower(stem)) AS high, sum((n > 1)::INT) OVER (PARTITION BY book, lower(stem) ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS k FROM c)
       SELECT book, p_partkey, CASE WHEN n > 1 THEN stem || (high + k)::BIGINT ELSE name END AS title FROM e""",
)
def _(t):
    k = F.col("p_partkey") % 4
    mixed = F.when(k == 0, F.upper("p_name")).when(k == 1, F.concat("p_name", F.lit("2"))).otherwise(F.col("p_name"))
    named = t.part.select(F.col("p_brand").alias("book"), "p_partkey", mixed.alias("name"))
    return T.dedupe_names(named, ["book"], "name", ["p_partkey"], block_of("p_partkey")).select("book", "p_partkey", "title")
