"""Queries over validation, verdicts, audits and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.catalog.frames import (
    BAD_VALUE,
    EVENTS,
    IS_BAD,
    NO_PROPS,
    NO_USER,
    NUMBER_TYPE,
    event_pages,
)
from smeltery.catalog.registry import Tables, query
from smeltery.operators import audit, quality
from smeltery.operators.validate import (
    error_samples as first_errors,
    judge_pages,
    page_verdicts,
    quarantined_records,
    too_bad,
)
from smeltery.sources.silver import silver_rows

_PAGE = "(event_id // 500 + 1)::INT"
_ERRORS = f"""concat_ws('; ', CASE WHEN {NO_USER} THEN 'user_id: missing' END,
    CASE WHEN {NUMBER_TYPE} THEN 'event_type: not str' END, CASE WHEN {BAD_VALUE} THEN 'value: not float' END)"""
# Verdict per event type and page; the threshold is filled in.
_VERDICTS = f"""(SELECT event_type, {_PAGE} AS page, count(*) AS total,
    count(*) FILTER ({IS_BAD}) AS bad,
    CASE WHEN bad * 1.0 / total > {{0}} OR (total < 5 AND bad > 0) THEN 'rejected'
      WHEN bad = total THEN 'no_rows' ELSE 'ok' END AS verdict
  FROM events GROUP BY event_type, {_PAGE})"""


def _judged(t: Tables, threshold: float = 0.20) -> DataFrame:
    return judge_pages(event_pages(t.events), EVENTS, threshold)


@query(f"""
SELECT event_id, user_id, event_type, value, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS seen_at,
  CASE WHEN NOT {NO_PROPS} THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS props_k
FROM events JOIN {_VERDICTS.format(0.2)} v USING (event_type)
WHERE v.page = {_PAGE} AND verdict = 'ok' AND NOT {IS_BAD}""")
def validate_valid(t: Tables) -> DataFrame:
    rows = silver_rows(_judged(t), EVENTS)
    return rows.select("event_id", "user_id", "event_type", "value", "seen_at", "props_k")


@query(f"""
SELECT event_type, {_PAGE} AS page,
  CAST(row_number() OVER (PARTITION BY event_type, {_PAGE} ORDER BY event_id) - 1 AS INT) AS record_index,
  {_ERRORS} AS errors
FROM events QUALIFY {IS_BAD}""")
def validate_quarantine(t: Tables) -> DataFrame:
    bad = quarantined_records(_judged(t))
    return bad.select(
        F.col("kind").alias("event_type"), "page", "record_index", F.array_join("errors", "; ").alias("errors")
    )


@query(f"""
SELECT event_type, page, total, bad, bad * 1.0 / total AS error_rate, verdict,
  CASE WHEN bad * 1.0 / total > 0.15 OR (total < 5 AND bad > 0) THEN 'rejected' ELSE 'ok' END AS strict_verdict
FROM {_VERDICTS.format(0.2)}""".replace("bad * 1.0 / total AS error_rate", "CAST(bad AS DOUBLE) / total AS error_rate"))
def threshold_verdict(t: Tables) -> DataFrame:
    """The stricter verdict follows from the counts of the same pass."""
    normal = page_verdicts(_judged(t))
    total, bad = F.col("total"), F.col("bad")
    strict = F.when(too_bad(total, bad, 0.15), "rejected").when(bad == total, "no_rows").otherwise("ok")
    return normal.select(
        F.col("kind").alias("event_type"), "page", "total", "bad", "error_rate", "verdict", strict.alias("strict_verdict")
    )


@query(f"""
SELECT event_type, page, record_index, errors FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, page ORDER BY record_index) AS nth FROM (
    SELECT event_type, {_PAGE} AS page, {_ERRORS} AS errors,
      CAST(row_number() OVER (PARTITION BY event_type, {_PAGE} ORDER BY event_id) - 1 AS INT) AS record_index
    FROM events QUALIFY {IS_BAD})) WHERE nth <= 3""")
def error_samples(t: Tables) -> DataFrame:
    return first_errors(_judged(t)).select(
        F.col("kind").alias("event_type"), "page", "record_index", F.array_join("errors", "; ").alias("errors")
    )


def _mixed_pages(t: Tables) -> DataFrame:
    """Pages of all fates: by page number some are cut off mid-text, some lost their records."""
    pages = event_pages(t.events)
    cut = F.expr("left(value, length(value) - 3)")
    emptied = F.regexp_replace("value", r'"Events":\[.*\]', '"Events":[]')
    moved = F.replace(F.col("value"), F.lit('"Events":'), F.lit('"Other":'))
    page = F.col("page")
    value = F.when(page % 7 == 0, cut).when(page % 5 == 0, emptied).when(page % 4 == 0, moved)
    return pages.withColumn("value", F.coalesce(value, F.col("value")))


_FATES = """CASE WHEN page % 7 = 0 THEN 'invalid_json' WHEN page % 5 = 0 OR page % 4 = 0 THEN 'empty'
    ELSE verdict END"""


@query(f"""
SELECT event_type, page, {_FATES} AS verdict FROM {_VERDICTS.format(0.2)}""")
def malformed_json(t: Tables) -> DataFrame:
    judged = page_verdicts(judge_pages(_mixed_pages(t), EVENTS))
    return judged.select(F.col("kind").alias("event_type"), "page", "verdict")


@query(f"""
SELECT event_type, page, total AS reported,
  CASE WHEN page % 5 = 0 OR page % 4 = 0 THEN 0 ELSE total END AS items,
  CASE WHEN page % 5 = 0 THEN 'corrupt' WHEN page % 4 = 0 THEN 'incomplete' ELSE 'ok' END AS severity
FROM {_VERDICTS.format(0.2)} WHERE page % 7 <> 0""")
def corruption_check(t: Tables) -> DataFrame:
    readable = _mixed_pages(t).where(F.try_parse_json("value").isNotNull())
    payloads = quality.page_payloads(readable, EVENTS)
    return payloads.select(F.col("kind").alias("event_type"), "page", "reported", "items", "severity")


@query("""
WITH p AS (SELECT event_type, event_id // 500 + 1 AS page, count(*) AS n FROM events GROUP BY ALL),
k AS (SELECT event_type, sum(n) AS reported FROM p GROUP BY ALL)
SELECT event_type, CAST(reported AS BIGINT) AS reported, CAST(sum(n) AS BIGINT) AS items, count(*) AS pages,
  CAST(greatest(ceil(reported / 500.0), 1) AS BIGINT) AS expected_pages
FROM p JOIN k USING (event_type) WHERE (page + ascii(event_type)) % 6 <> 0
GROUP BY event_type, reported HAVING sum(n) <> reported""")
def reconcile_pages(t: Tables) -> DataFrame:
    """Event types whose landed pages, some of them dropped, fall short of the reported total."""
    totals = t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("type_total"))
    pages = event_pages(t.events.join(totals, "event_type").drop("type_total"))
    # The API reports the whole item's total on each of its pages.
    reported = pages.join(totals.withColumnRenamed("event_type", "kind"), "kind").withColumn(
        "value",
        F.regexp_replace("value", F.lit(r'"total":"\d+"'), F.concat(F.lit('"total":"'), "type_total", F.lit('"'))),
    )
    landed = reported.where((F.col("page") + F.ascii("kind")) % 6 != 0)
    gaps = quality.reconcile(quality.page_payloads(landed, EVENTS), ["kind"], limit=500)
    return gaps.withColumnRenamed("kind", "event_type")


@query("""
SELECT event_type || CAST(user_id % 9 AS VARCHAR) AS source, strftime(max(ts) FILTER (keep), '%Y-%m-%d %H:%M') AS newest,
  CASE WHEN max(ts) FILTER (keep) IS NULL THEN 'error'
    WHEN TIMESTAMP '2024-02-05' - max(ts) FILTER (keep) > INTERVAL 14 DAY THEN 'error'
    WHEN TIMESTAMP '2024-02-05' - max(ts) FILTER (keep) > INTERVAL 7 DAY THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT *, day(ts) <= 12 + 2 * (user_id % 9) AS keep FROM events) GROUP BY ALL""")
def freshness(t: Tables) -> DataFrame:
    """Sources that stopped loading on different days, judged as of a fixed moment."""
    source = F.concat("event_type", (F.col("user_id") % 9).cast("string"))
    loaded = F.when(F.dayofmonth("ts") <= 12 + 2 * (F.col("user_id") % 9), F.col("ts"))
    table = t.events.select(source.alias("source"), loaded.alias("loaded_at"))
    judged = quality.freshness(table, "loaded_at", F.lit("2024-02-05"), ["source"])
    return judged.select("source", F.date_format("newest", "yyyy-MM-dd HH:mm").alias("newest"), "status")


@query("""
SELECT "check", target, failures, failures = 0 AS passed FROM (
  SELECT 'unique' AS "check", 'o_orderkey' AS target,
    (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS failures
  UNION ALL SELECT 'unique', 'l_orderkey,l_linenumber', (SELECT count(*) FROM
    (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
  UNION ALL SELECT 'not_null', 'o_custkey', (SELECT count(*) FROM orders WHERE o_custkey IS NULL)
  UNION ALL SELECT 'not_null', 'priority', (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW')
  UNION ALL SELECT 'references', 'l_orderkey', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN
    (SELECT o_orderkey FROM orders))
  UNION ALL SELECT 'references', 'l_partkey', (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN
    (SELECT p_partkey FROM part WHERE p_size > 3)))""")
def table_tests(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return quality.all_findings(
        quality.unique_key(orders, ["o_orderkey"]),
        quality.unique_key(t.lineitem, ["l_orderkey", "l_linenumber"]),
        quality.not_null(orders, ["o_custkey", "priority"]),
        quality.references(t.lineitem, "l_orderkey", orders, "o_orderkey"),
        quality.references(t.lineitem, "l_partkey", t.part.where("p_size > 3"), "p_partkey"),
    )


@query(f"""
WITH v AS (SELECT event_type, {_FATES} AS verdict,
    CASE WHEN page % 7 = 0 OR page % 5 = 0 OR page % 4 = 0 THEN 0 ELSE total END AS total,
    CASE WHEN page % 7 = 0 OR page % 5 = 0 OR page % 4 = 0 THEN 0 ELSE bad END AS bad FROM {_VERDICTS.format(0.2)})
SELECT event_type AS endpoint, count(*) FILTER (verdict IN ('ok', 'empty')) AS succeeded,
  count(*) FILTER (verdict NOT IN ('ok', 'empty')) AS failed, count(*) FILTER (verdict = 'empty') AS empty,
  CAST(sum(total) AS BIGINT) AS records, CAST(sum(bad) AS BIGINT) AS bad_records,
  CASE WHEN failed = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status
FROM v GROUP BY ROLLUP (event_type)""")
def endpoint_audit(t: Tables) -> DataFrame:
    verdicts = page_verdicts(judge_pages(_mixed_pages(t), EVENTS)).withColumnRenamed("kind", "endpoint")
    return audit.tallies(verdicts)


_LOG = """(SELECT weekofyear(ts) AS week, user_id, CASE WHEN event_type = 'error' AND user_id % 9 = 0 THEN 'error'
    WHEN event_type = 'view' THEN 'skipped' ELSE 'written' END AS outcome,
    CAST(value * 1000 AS BIGINT) AS bytes, CAST(value AS DECIMAL(18,2)) AS seconds FROM events)"""


@query(f"""
SELECT week, count(*) FILTER (outcome = 'written') AS files_written,
  count(*) FILTER (outcome = 'skipped') AS files_skipped, count(*) FILTER (outcome <> 'skipped') AS api_calls_made,
  CAST(coalesce(sum(bytes) FILTER (outcome = 'written'), 0) AS BIGINT) AS bytes_written,
  count(*) FILTER (outcome = 'error') AS errors_encountered,
  CASE WHEN errors_encountered = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS status,
  CAST(sum(seconds) AS DOUBLE) AS duration_seconds, CAST(round(CAST(sum(seconds) AS DECIMAL(18,2)) / 60, 2) AS DOUBLE) AS duration_minutes
FROM {_LOG} GROUP BY week""".replace("value * 1000", "round(value * 1000)"))
def run_counters(t: Tables) -> DataFrame:
    log = _request_log(t)
    counted = audit.run_counters(log, ["week"])
    return counted.withColumns({c: F.col(c).cast("double") for c in ("duration_seconds", "duration_minutes")})


def _request_log(t: Tables) -> DataFrame:
    outcome = (
        F.when(F.expr("event_type = 'error' AND user_id % 9 = 0"), "error")
        .when(F.col("event_type") == "view", "skipped")
        .otherwise("written")
    )
    return t.events.select(
        F.weekofyear("ts").alias("week"),
        "user_id",
        outcome.alias("outcome"),
        F.round(F.col("value") * 1000).cast("long").alias("bytes"),
        F.col("value").cast("decimal(18,2)").alias("seconds"),
    )


@query("""
WITH r AS (SELECT event_type, day(ts) AS season, CASE WHEN max(value) > 250 THEN 'FAILED'
    WHEN max(value) > 150 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status FROM events GROUP BY ALL)
SELECT event_type, count(*) AS total_seasons, count(*) FILTER (status = 'SUCCESS') AS successful_seasons,
  count(*) FILTER (status = 'PARTIAL') AS partial_seasons, count(*) FILTER (status = 'FAILED') AS failed_seasons,
  coalesce(string_agg(season::VARCHAR, ',' ORDER BY season) FILTER (status = 'FAILED'), '') AS failed_season_list
FROM r GROUP BY event_type""")
def backfill_rollup(t: Tables) -> DataFrame:
    peak = F.max("value")
    status = F.when(peak > 250, "FAILED").when(peak > 150, "PARTIAL").otherwise("SUCCESS")
    runs = t.events.groupBy("event_type", F.dayofmonth("ts").alias("season")).agg(status.alias("status"))
    summary = audit.backfill_summary(runs, ["event_type"])
    return summary.withColumn(
        "failed_season_list", F.array_join(F.transform("failed_season_list", lambda s: s.cast("string")), ",")
    )
