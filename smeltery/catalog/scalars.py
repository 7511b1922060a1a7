"""Queries over scalar functions: coercion, cleaning, dates, durations, keys, JSON paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.catalog.frames import CENTS, clock, event_pages
from smeltery.catalog.registry import Tables, query
from smeltery.functions import coerce, documents, keys
from smeltery.sources.registry import SOURCE

# Spellings of a number, as JSON, and what each is worth to the three scalar types.
_SPELLINGS = """CASE event_id % 16
    WHEN 0 THEN '"' || event_id || '"' WHEN 1 THEN '" ' || event_id || ' "'
    WHEN 2 THEN '"+' || event_id || '"' WHEN 3 THEN '"00' || event_id || '"'
    WHEN 4 THEN '"' || event_id || '.00"' WHEN 5 THEN '"' || event_id || '_0"'
    WHEN 6 THEN '"' || event_id || '.5"' WHEN 7 THEN event_id || ''
    WHEN 8 THEN event_id || '.0' WHEN 9 THEN event_id || '.5'
    WHEN 10 THEN 'true' WHEN 11 THEN '"true"' WHEN 12 THEN '"' || event_id || 'e3"'
    WHEN 13 THEN '""' WHEN 14 THEN '"' || event_id || 'd"' ELSE 'null' END"""


def _spelled(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.parse_json(F.expr(_SPELLINGS)).alias("v"))


@query("""
SELECT event_id, CAST(CASE WHEN event_id % 16 IN (0,1,2,3,4,7,8) THEN event_id
  WHEN event_id % 16 = 5 THEN event_id * 10 WHEN event_id % 16 = 10 THEN 1 END AS BIGINT) AS as_int
FROM events""")
def lax_int(t: Tables) -> DataFrame:
    return _spelled(t).select("event_id", F.expr(coerce.lax_int("v")).alias("as_int"))


@query("""
SELECT event_id, CAST(CASE WHEN event_id % 16 IN (0,1,2,3,4,7,8) THEN event_id
  WHEN event_id % 16 = 5 THEN event_id * 10 WHEN event_id % 16 IN (6, 9) THEN event_id + 0.5
  WHEN event_id % 16 = 10 THEN 1 WHEN event_id % 16 = 12 THEN event_id * 1000 END AS DOUBLE) AS as_float
FROM events""")
def lax_float(t: Tables) -> DataFrame:
    return _spelled(t).select("event_id", F.expr(coerce.lax_float("v")).alias("as_float"))


@query(f"""
SELECT event_id, CASE WHEN event_id % 16 IN (7,8,9,10,15) THEN NULL ELSE trim(j, '"') END AS as_str
FROM (SELECT event_id, {_SPELLINGS} AS j FROM events)""")
def strict_str(t: Tables) -> DataFrame:
    return _spelled(t).select("event_id", F.expr(coerce.strict_str("v")).alias("as_str"))


_NAMES = """CASE p_partkey % 6 WHEN 0 THEN upper(p_name) WHEN 1 THEN '  ' || replace(p_name, ' ', '-') || ' '
    WHEN 2 THEN replace(p_name, ' ', '''') WHEN 3 THEN 'côte ' || p_name || ' 3rd' WHEN 4 THEN '' ELSE p_name END"""


@query(f"""
SELECT p_partkey, CASE WHEN raw = '' THEN '' ELSE trim(list_aggregate(list_transform(
    regexp_extract_all(raw, '([\\p{{L}}]+|[^\\p{{L}}]+)'), lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', ''))
  END AS name
FROM (SELECT p_partkey, {_NAMES} AS raw FROM part)""")
def clean_str(t: Tables) -> DataFrame:
    raw = t.part.select("p_partkey", F.expr(_NAMES.replace("''''", "\"'\"")).alias("raw"))
    return raw.select("p_partkey", F.expr(coerce.clean_str("raw")).alias("name"))


@query("""
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS seen_at FROM events""")
def best_effort_ts(t: Tables) -> DataFrame:
    spelled = t.events.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("raw"),
    )
    seen = coerce.best_effort_timestamp(F.col("raw"), strict=True)
    return spelled.select("event_id", F.date_format(seen, "yyyy-MM-dd HH:mm:ss").alias("seen_at"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL
  ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) % (CASE o_orderkey % 5 WHEN 0 THEN 60000
    ELSE 360000000 END) END AS ms
FROM orders""")
def duration_ms(t: Tables) -> DataFrame:
    total = (F.col("o_totalprice").cast(CENTS) * 100).cast("long")
    kind = F.col("o_orderkey") % 5
    ms = total % F.when(kind == 0, 60000).otherwise(360000000)
    hours = F.format_string(
        "%d:%02d:%02d.%03d",
        (ms / 3600000).cast("long"),
        (ms % 3600000 / 60000).cast("long"),
        (ms % 60000 / 1000).cast("long"),
        ms % 1000,
    )
    seconds = F.format_string("%d.%03d", (ms / 1000).cast("long"), ms % 1000)
    raw = F.when(kind == 0, seconds).when(kind == 1, hours).when(kind == 4, "+1 Lap").otherwise(clock(ms))
    return t.orders.select("o_orderkey", coerce.duration_ms(raw).alias("ms"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 THEN NULL
  ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ordered_on,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS priority
FROM orders""")
def typed_dates(t: Tables) -> DataFrame:
    raw = (
        F.when(F.expr("o_orderkey % 7 = 0"), "  ")
        .when(F.expr("o_orderkey % 11 = 0"), "2024-02-31")
        .when(F.expr("o_orderkey % 13 = 0"), "not a date")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    blank = F.when(F.expr("o_orderkey % 7 = 0"), " ").otherwise(F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey",
        coerce.iso_date(coerce.null_if_blank(raw)).cast("string").alias("ordered_on"),
        coerce.null_if_blank(blank).alias("priority"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  sha256(l_orderkey || '|' || l_linenumber || '|' || l_partkey) AS line_id
FROM lineitem""")
def surrogate_key(t: Tables) -> DataFrame:
    named = keys.surrogate_key(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", named.alias("line_id"))


@query(f"""
SELECT event_id, '{SOURCE}/endpoint=' || event_type || '/season=' || year(ts) ||
    CASE WHEN event_id % 2 = 0 THEN '/round=' || lpad(day(ts)::VARCHAR, 2, '0') ELSE '' END ||
    '/batch_id=b1/page_' || lpad((event_id % 997)::VARCHAR, 3, '0') || '.parquet' AS key,
  year(ts) || '/' || CASE WHEN event_id % 2 = 0 THEN day(ts)::VARCHAR ELSE '' END || '/results.json' AS path
FROM events""")
def object_keys(t: Tables) -> DataFrame:
    round_ = F.when(F.col("event_id") % 2 == 0, F.dayofmonth("ts"))
    key = keys.object_key(
        SOURCE, F.col("event_type"), F.lit("b1"), F.year("ts"), round_, F.col("event_id") % 997
    )
    return t.events.select(
        "event_id",
        keys.parquet_key(key).alias("key"),
        keys.request_path(F.lit("{season}/{round}/results.json"), F.year("ts"), round_).alias("path"),
    )


@query("""SELECT doc_id, to_base64(unhex(md5(text))) AS digest FROM documents""")
def content_digest(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", keys.content_digest(F.col("text")).alias("digest"))


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
WHERE json_extract_string(props, '$.k') <> ''""")
def json_extract_props(t: Tables) -> DataFrame:
    value = documents.json_string(F.col("props"), "k")
    return t.events.where(value != "").select("event_id", value.cast("long").alias("k"))


@query("""
SELECT event_id, user_id, event_type FROM events""")
def json_array_raw(t: Tables) -> DataFrame:
    pages = event_pages(t.events, dirty=False)
    raw = pages.select(documents.json_raw(F.col("value"), "data", "MRData").alias("response"))
    items = raw.select(
        F.explode(documents.json_array(F.col("response"), "EventTable", "Events")).alias("item")
    )
    return items.select(
        documents.json_string(F.col("item"), "eventId").cast("long").alias("event_id"),
        documents.json_string(F.col("item"), "userId").cast("long").alias("user_id"),
        documents.json_string(F.col("item"), "eventType").alias("event_type"),
    )


