"""Queries over work lists: seasons, rounds, datasets, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.catalog.frames import response
from smeltery.catalog.registry import Tables, query
from smeltery.plans import worklist
from smeltery.sources.registry import SOURCE


@query("""
SELECT event_type AS endpoint, user_id, total, page, (page - 1) * 20 AS offset FROM (
  SELECT *, unnest(generate_series(1, CASE WHEN event_type = 'error' THEN 1 ELSE (total + 19) // 20 END)) AS page
  FROM (SELECT event_type, user_id, count(*) AS total FROM events GROUP BY ALL))""")
def page_plan(t: Tables) -> DataFrame:
    totals = t.events.groupBy(F.col("event_type").alias("endpoint"), "user_id").agg(
        F.count(F.lit(1)).alias("total")
    )
    paged = totals.withColumn("paginated", F.col("endpoint") != "error")
    return worklist.with_pages(paged, 20).select("endpoint", "user_id", "total", "page", "offset")


@query("""
SELECT unnest(generate_series((SELECT min(year(o_orderdate)) FROM orders),
  (SELECT max(year(o_orderdate)) FROM orders)))::INT AS season, season = 2001 AS force_refresh""")
def season_range(t: Tables) -> DataFrame:
    """Every season the orders span, the current one flagged for refresh."""
    bounds = t.orders.agg(F.min(F.year("o_orderdate")).alias("start"), F.max(F.year("o_orderdate")).alias("end"))
    return worklist.seasons_between(bounds, "2001-06-30")


def _race_pages(t: Tables) -> DataFrame:
    """Order days as a race calendar: one race per day, numbered in its season; urgent days sprint."""
    days = t.orders.groupBy(
        F.year("o_orderdate").alias("season"), F.dayofyear("o_orderdate").alias("round")
    ).agg((F.min("o_totalprice") < 20000).alias("sprint"))
    record = F.to_json(
        F.struct(
            F.col("season").cast("string").alias("season"),
            F.col("round").cast("string").alias("round"),
            F.when(F.col("sprint"), F.struct(F.lit("2024-01-01").alias("date"))).alias("Sprint"),
        )
    )
    rows = days.select("season", (F.col("round") / 100).cast("int").alias("page"), "round", record.alias("record"))
    return response(rows, ["season", "page"], "round", F.lit('"RaceTable":{"Races":['), "]}}}")


_DAYS = """(SELECT year(o_orderdate) AS season, dayofyear(o_orderdate) AS round, min(o_totalprice) < 20000 AS sprint
    FROM orders GROUP BY ALL)"""
_PER_ROUND = """(VALUES ('results', 'results'), ('qualifying', 'qualifying'), ('laps', 'laps'),
    ('pitstops', 'pitstops'), ('sprint', 'sprint'), ('driverstandings', 'driverStandings'),
    ('constructorstandings', 'constructorStandings')) AS e(endpoint, file)"""


@query(f"""
SELECT 4 AS phase, season::INT AS season, round::INT AS round, endpoint,
  season || '/' || round || '/' || file || '.json' AS request_path, true AS paginated,
  '{SOURCE}/endpoint=' || endpoint || '/season=' || season || '/round=' || CASE WHEN round < 10 THEN '0' ELSE '' END
    || round || '/batch_id=b1/page_001.json' AS object_key
FROM {_DAYS}, {_PER_ROUND} WHERE sprint OR endpoint <> 'sprint'""")
def work_list(t: Tables) -> DataFrame:
    rounds = worklist.calendar(_race_pages(t))
    work = worklist.round_worklist(rounds).withColumn("page", F.lit(1))
    return worklist.with_keys(work, F.lit("b1")).drop("page")


@query("""
WITH s AS (SELECT DISTINCT year(o_orderdate)::INT AS season FROM orders)
SELECT phase, season, endpoint, season || path AS request_path FROM s, (VALUES (1, 'circuits', '/circuits.json'),
  (2, 'constructors', '/constructors.json'), (2, 'drivers', '/drivers.json'), (2, 'races', '.json')) AS e(phase, endpoint, path)
UNION ALL SELECT 1, NULL, unnest(['seasons', 'status']) AS e, e || '.json'""")
def season_work(t: Tables) -> DataFrame:
    seasons = t.orders.select(F.year("o_orderdate").alias("season")).distinct()
    return worklist.season_worklist(seasons).select("phase", "season", "endpoint", "request_path")


@query(f"""
SELECT season::INT AS season, round::INT AS round, sprint AS has_sprint FROM {_DAYS} d
WHERE round > coalesce((SELECT max(month(l_shipdate)) * 20 FROM lineitem WHERE year(l_shipdate) = d.season AND
  year(l_shipdate) % 2 = 1), 0)""")
def incremental_rounds(t: Tables) -> DataFrame:
    rounds = worklist.calendar(_race_pages(t))
    done = t.lineitem.where(F.year("l_shipdate") % 2 == 1).select(
        F.year("l_shipdate").alias("season"), (F.month("l_shipdate") * 20).alias("round")
    )
    return worklist.new_rounds(rounds, done)


@query("""
WITH i AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'results' ELSE 'laps' END AS endpoint,
  year(o_orderdate)::INT AS season, month(o_orderdate)::INT AS round, count(*) AS total FROM orders GROUP BY ALL)
SELECT endpoint, season, round, page, (page - 1) * 10 AS offset
FROM (SELECT endpoint, season, round, unnest(generate_series(1, (total + 9) // 10)) AS page FROM i)
WHERE page <> 1 AND page % 3 <> 0""")
def resume_batch(t: Tables) -> DataFrame:
    """A batch that broke off: the first and every third page landed, and reported the total."""
    totals = t.orders.groupBy(
        F.when(F.col("o_orderstatus") == "F", "results").otherwise("laps").alias("endpoint"),
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("round"),
    ).agg(F.count(F.lit(1)).alias("total"))
    known = totals.withColumns({"batch_id": F.lit("b1"), "paginated": F.lit(True)})
    pages = worklist.with_keys(worklist.with_pages(known, 10), F.col("batch_id"))
    landed = pages.where("page = 1 OR page % 3 = 0").withColumnRenamed("total", "api_response_total")
    return worklist.resume(landed, 10).select("endpoint", "season", "round", "page", "offset")
