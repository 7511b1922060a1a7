"""The thirteen registered datasets, each fed with responses nested from the driver tables.

Every query nests table rows into the API's document shape, then extracts, validates and flattens
them by the registry alone; the SQL is the flat projection the rows started from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.catalog.frames import clock, json_list, order_lines, response
from smeltery.catalog.registry import Tables, query
from smeltery.operators.validate import judge_pages
from smeltery.sources.registry import DATASETS
from smeltery.sources.silver import LINEAGE, silver_rows

ORDERS_PER_PAGE = 4000
# Orders whose pages one task builds, some 64 MB of text; from this many such tasks on orders are dealt before they
# become text, of which they are a small part.
ORDERS_PER_TASK, MANY_TASKS = 100_000, 16
# Datasets whose pages are built from joined orders.
OF_ORDERS = ("results", "qualifying", "sprint", "driverstandings", "constructorstandings")


def words(column: str) -> Column:
    return F.col(column).cast("string")


def driver() -> Column:
    return F.struct(
        F.concat(F.lit("d"), "c_custkey").alias("driverId"),
        F.when(F.expr("c_custkey % 4 <> 0"), F.expr("string(c_custkey % 100)")).alias("permanentNumber"),
        F.substring("c_mktsegment", 1, 3).alias("code"),
        F.col("c_name").alias("givenName"),
        F.col("c_mktsegment").alias("familyName"),
        F.lit("1990-01-01").alias("dateOfBirth"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("nationality"),
        F.concat(F.lit("u"), "c_custkey").alias("url"),
    )


def constructor() -> Column:
    return F.struct(
        F.concat(F.lit("c"), "n_nationkey").alias("constructorId"),
        F.col("n_name").alias("name"),
        F.lower("n_name").alias("nationality"),
        F.concat(F.lit("u"), "n_nationkey").alias("url"),
    )


def circuit(key: str) -> Column:
    return F.struct(
        F.concat(F.lit("s"), key).alias("circuitId"),
        F.concat(F.lit("Circuit "), key).alias("circuitName"),
        F.concat(F.lit("u"), key).alias("url"),
        F.struct(
            F.format_string("%d.5", F.col(key).cast("long")).alias("lat"),
            F.format_string("-%d.25", F.col(key).cast("long")).alias("long"),
            F.concat(F.lit("Town "), key).alias("locality"),
            F.lit("united kingdom").alias("country"),
        ).alias("Location"),
    )


def _driver_sql(prefix: str) -> str:
    return f"""'d' || c_custkey AS {prefix}driver_id, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 100 END AS {prefix}permanent_number,
  left(c_mktsegment, 3) AS {prefix}code, c_name AS {prefix}given_name, c_mktsegment AS {prefix}family_name,
  '1990-01-01' AS {prefix}date_of_birth, left(c_mktsegment, 1) || lower(substr(c_mktsegment, 2)) AS {prefix}nationality,
  'u' || c_custkey AS {prefix}url"""


def _constructor_sql(prefix: str) -> str:
    return f"""'c' || n_nationkey AS {prefix}constructor_id, n_name AS {prefix}name,
  'N' || lower(substr(n_name, 2)) AS {prefix}nationality, 'u' || n_nationkey AS {prefix}url"""


def _circuit_sql(prefix: str, key: str) -> str:
    return f"""'s' || {key} AS {prefix}circuit_id, 'Circuit ' || {key} AS {prefix}name, 'u' || {key} AS {prefix}url,
  {key} + 0.5::DOUBLE AS {prefix}location_lat, -({key} + 0.25::DOUBLE) AS {prefix}location_long,
  'Town ' || {key} AS {prefix}location_locality, 'United Kingdom' AS {prefix}location_country"""


_ROUND = "CAST(year(o_orderdate) AS BIGINT) AS season, CAST(month(o_orderdate) AS BIGINT) AS round"
_ORDERS = "orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
_CLOCK = """CASE WHEN {0} // 60000 >= 0 THEN ({0} // 60000) || ':' || lpad(({0} % 60000 // 1000)::VARCHAR, 2, '0')
    || '.' || lpad(({0} % 1000)::VARCHAR, 3, '0') END"""


def page_tasks(t: Tables) -> int:
    """How many tasks joined orders are dealt to by ranges of season, round and page; 0 if they are few."""
    tasks = t.orders.count() // ORDERS_PER_TASK + 1
    return tasks if tasks >= MANY_TASKS else 0


def _orders(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).join(
        t.nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    keyed = joined.withColumns(
        {
            "season": F.year("o_orderdate"),
            "round": F.month("o_orderdate"),
            "page": (F.col("o_orderkey") / ORDERS_PER_PAGE).cast("int"),
        }
    )
    if tasks := page_tasks(t):
        # A page's orders are in one task then: no record is shuffled as text, and a task has neighbouring folders.
        usual = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
        keyed = keyed.repartitionByRange(max(tasks, usual), "season", "round", "page")
    return keyed.withColumn("ms", F.col("o_orderkey") * 7 + 60000)


def _silver(pages: DataFrame, name: str) -> DataFrame:
    spec = DATASETS[name]
    rows = silver_rows(judge_pages(pages, spec), spec)
    return rows.drop("endpoint", *LINEAGE)


def _per_round(rows: DataFrame, name: str, record: Column, order: str, table: str = '"RaceTable":{"Races":[') -> DataFrame:
    """Pages of a per-round dataset from joined rows with season, round and page."""
    inner = DATASETS[name].levels[1].path
    head = F.concat(
        F.lit(table + '{"season":"'), words("season"), F.lit('","round":"'), words("round"), F.lit(f'","{inner}":[')
    )
    shaped = rows.select("season", "round", "page", order, F.to_json(record).alias("record"))
    return response(shaped, ["season", "round", "page"], order, head, "]}]}}}")


def _list(rows: DataFrame, name: str, record: Column, order: str, path: tuple[str, str]) -> DataFrame:
    keys = [k for k in ("season", "page") if k in rows.columns]
    shaped = rows.select(*keys, F.col(order).alias("_order"), F.to_json(record).alias("record"))
    head = F.lit(f'"{path[0]}":{{"{path[1]}":[')
    return response(shaped, keys, "_order", head, "]}}}")


@query("""SELECT CAST(year(o_orderdate) AS BIGINT) AS season, 'u' || year(o_orderdate) AS url FROM orders GROUP BY ALL""")
def silver_seasons(t: Tables) -> DataFrame:
    return _silver(seasons_pages(t), "seasons")


def seasons_pages(t: Tables) -> DataFrame:
    years = t.orders.select(F.year("o_orderdate").alias("y")).distinct().withColumn("page", F.lit(0))
    record = F.struct(words("y").alias("season"), F.concat(F.lit("u"), "y").alias("url"))
    return _list(years, "seasons", record, "y", ("SeasonTable", "Seasons"))


@query(f"""SELECT {_circuit_sql('', 's_suppkey')}, CAST(2000 + s_suppkey % 3 AS BIGINT) AS season FROM supplier""")
def silver_circuits(t: Tables) -> DataFrame:
    return _silver(circuits_pages(t), "circuits")


def circuits_pages(t: Tables) -> DataFrame:
    rows = t.supplier.selectExpr("*", "2000 + s_suppkey % 3 AS season", "int(s_suppkey / 1000) AS page")
    return _list(rows, "circuits", circuit("s_suppkey"), "s_suppkey", ("CircuitTable", "Circuits"))


@query("""SELECT ascii(o_orderstatus)::BIGINT AS status_id, o_orderstatus AS status, count(*) AS count FROM orders GROUP BY ALL""")
def silver_status(t: Tables) -> DataFrame:
    return _silver(status_pages(t), "status")


def status_pages(t: Tables) -> DataFrame:
    rows = t.orders.groupBy("o_orderstatus").count().withColumn("page", F.lit(0))
    record = F.struct(
        F.ascii("o_orderstatus").cast("string").alias("statusId"),
        F.col("o_orderstatus").alias("status"),
        words("count").alias("count"),
    )
    return _list(rows, "status", record, "o_orderstatus", ("StatusTable", "Status"))


@query(f"""SELECT {_driver_sql('')}, CAST(2000 + c_custkey % 3 AS BIGINT) AS season FROM customer""")
def silver_drivers(t: Tables) -> DataFrame:
    return _silver(drivers_pages(t), "drivers")


def drivers_pages(t: Tables) -> DataFrame:
    rows = t.customer.selectExpr("*", "2000 + c_custkey % 3 AS season", "int(c_custkey / 1000) AS page")
    return _list(rows, "drivers", driver(), "c_custkey", ("DriverTable", "Drivers"))


@query(f"""SELECT {_constructor_sql('')}, CAST(2000 + n_nationkey % 2 AS BIGINT) AS season FROM nation""")
def silver_constructors(t: Tables) -> DataFrame:
    return _silver(constructors_pages(t), "constructors")


def constructors_pages(t: Tables) -> DataFrame:
    rows = t.nation.selectExpr("*", "2000 + n_nationkey % 2 AS season", "int(n_nationkey / 1000) AS page")
    return _list(rows, "constructors", constructor(), "n_nationkey", ("ConstructorTable", "Constructors"))


@query(f"""
SELECT CAST(season AS BIGINT) AS season, CAST(day AS BIGINT) AS round, 'u' || day AS url, 'Race ' || day AS race_name,
  {_circuit_sql('circuit_', 'day')}, date, CASE WHEN day % 3 <> 0 THEN '13:00:00Z' END AS time
FROM (SELECT year(o_orderdate) AS season, dayofyear(o_orderdate) AS day, strftime(o_orderdate, '%Y-%m-%d') AS date
  FROM orders GROUP BY ALL)""")
def silver_races(t: Tables) -> DataFrame:
    return _silver(races_pages(t), "races")


def races_pages(t: Tables) -> DataFrame:
    days = t.orders.select(
        F.year("o_orderdate").alias("season"),
        F.dayofyear("o_orderdate").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.lit(0).alias("page"),
    ).distinct()
    record = F.struct(
        words("season").alias("season"),
        words("day").alias("round"),
        F.concat(F.lit("u"), "day").alias("url"),
        F.concat(F.lit("Race "), "day").alias("raceName"),
        circuit("day").alias("Circuit"),
        F.col("date"),
        F.when(F.expr("day % 3 <> 0"), "13:00:00Z").alias("time"),
    )
    return _list(days, "races", record, "day", ("RaceTable", "Races"))


@query(f"""
SELECT CASE WHEN k % 3 <> 0 THEN k % 100 END AS number, k % 20 + 1 AS position, o_totalprice AS points, k % 22 AS grid,
  k % 70 AS laps, {_driver_sql('driver_')}, {_constructor_sql('constructor_')}, o_orderpriority AS status,
  CASE WHEN k % 2 = 0 THEN {_CLOCK.format('ms')} END AS time_time, CASE WHEN k % 4 = 0 THEN ms END AS time_millis,
  CASE WHEN k % 3 <> 1 THEN k % 20 + 1 END AS fastest_lap_rank, CASE WHEN k % 3 <> 1 THEN k % 70 END AS fastest_lap_lap,
  CASE WHEN k % 3 <> 1 THEN {_CLOCK.format('ms')} END AS fastest_lap_time_time, NULL::BIGINT AS fastest_lap_time_millis,
  CASE WHEN k % 3 <> 1 AND k % 5 <> 0 THEN 'kph' END AS fastest_lap_average_speed_units,
  CASE WHEN k % 3 <> 1 AND k % 5 <> 0 THEN k + 0.5::DOUBLE END AS fastest_lap_average_speed_speed, {_ROUND}
FROM (SELECT *, o_orderkey AS k, o_orderkey * 7 + 60000 AS ms FROM {_ORDERS})""")
def silver_results(t: Tables) -> DataFrame:
    return _silver(results_pages(t), "results")


def results_pages(t: Tables) -> DataFrame:
    rows = _orders(t).withColumn("k", F.col("o_orderkey"))
    speed = F.when(
        F.expr("k % 5 <> 0"), F.struct(F.lit("kph").alias("units"), F.format_string("%d.5", F.col("k")).alias("speed"))
    )
    fastest = F.struct(
        F.expr("string(k % 20 + 1)").alias("rank"),
        F.expr("string(k % 70)").alias("lap"),
        F.struct(clock(F.col("ms")).alias("time")).alias("Time"),
        speed.alias("AverageSpeed"),
    )
    record = F.struct(
        F.when(F.expr("k % 3 <> 0"), F.expr("string(k % 100)")).alias("number"),
        F.expr("string(k % 20 + 1) || '.0'").alias("position"),
        words("o_totalprice").alias("points"),
        F.expr("k % 22").alias("grid"),
        F.expr("' ' || string(k % 70)").alias("laps"),
        driver().alias("Driver"),
        constructor().alias("Constructor"),
        F.col("o_orderpriority").alias("status"),
        F.when(
            F.expr("k % 2 = 0"),
            F.struct(clock(F.col("ms")).alias("time"), F.when(F.expr("k % 4 = 0"), words("ms")).alias("millis")),
        ).alias("Time"),
        F.when(F.expr("k % 3 <> 1"), fastest).alias("FastestLap"),
    )
    return _per_round(rows, "results", record, "o_orderkey")


@query(f"""
SELECT o_orderkey % 100 AS number, o_orderkey % 20 + 1 AS position, {_driver_sql('driver_')}, {_constructor_sql('constructor_')},
  {_CLOCK.format('ms')} AS q1, CASE WHEN o_orderkey % 3 > 0 THEN {_CLOCK.format('(ms + 1)')} END AS q2,
  CASE WHEN o_orderkey % 3 > 1 THEN '' END AS q3, {_ROUND}
FROM (SELECT *, o_orderkey * 7 + 60000 AS ms FROM {_ORDERS})""")
def silver_qualifying(t: Tables) -> DataFrame:
    return _silver(qualifying_pages(t), "qualifying")


def qualifying_pages(t: Tables) -> DataFrame:
    third = F.col("o_orderkey") % 3
    record = F.struct(
        F.expr("string(o_orderkey % 100)").alias("number"),
        F.expr("string(o_orderkey % 20 + 1)").alias("position"),
        driver().alias("Driver"),
        constructor().alias("Constructor"),
        clock(F.col("ms")).alias("Q1"),
        F.when(third > 0, clock(F.col("ms") + 1)).alias("Q2"),
        F.when(third > 1, "").alias("Q3"),
    )
    return _per_round(_orders(t), "qualifying", record, "o_orderkey")


@query(f"""
SELECT o_orderkey % 100 AS number, o_orderkey % 20 + 1 AS position, o_totalprice AS points, o_orderkey % 22 AS grid,
  o_orderkey % 70 AS laps, {_driver_sql('driver_')}, {_constructor_sql('constructor_')}, o_orderpriority AS status,
  NULL::VARCHAR AS time_time, NULL::BIGINT AS time_millis, {_ROUND} FROM {_ORDERS}""")
def silver_sprint(t: Tables) -> DataFrame:
    """Nobody finished: the optional time is absent throughout, and its columns are still there."""
    return _silver(sprint_pages(t), "sprint")


def sprint_pages(t: Tables) -> DataFrame:
    record = F.struct(
        F.expr("string(o_orderkey % 100)").alias("number"),
        F.expr("string(o_orderkey % 20 + 1)").alias("position"),
        words("o_totalprice").alias("points"),
        F.expr("string(o_orderkey % 22)").alias("grid"),
        F.expr("string(o_orderkey % 70)").alias("laps"),
        driver().alias("Driver"),
        constructor().alias("Constructor"),
        F.col("o_orderpriority").alias("status"),
    )
    return _per_round(_orders(t), "sprint", record, "o_orderkey")


_ORDER_LINES = f"""(SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS number, count(*) AS n, {_ROUND}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""


def _lines(t: Tables) -> DataFrame:
    """Line numbers per order, with the order's season, round and page.

    Line numbers are part of the page key too, so a page's lists stay bounded by both ranges.
    """
    joined = order_lines(t).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("round"),
        ((F.col("l_orderkey") / ORDERS_PER_PAGE).cast("int") * 100 + (F.col("l_linenumber") / 100).cast("int")).alias("page"),
        "l_orderkey",
        "l_linenumber",
        "n",
        (F.col("l_orderkey") * 100 + F.col("l_linenumber") % 100).alias("_order"),
    )


@query(f"""
SELECT 'd' || l_orderkey AS driver_id, n AS lap, number AS stop, '15:02:11' AS time, n || '3.456' AS duration, season, round
FROM {_ORDER_LINES}""")
def silver_pitstops(t: Tables) -> DataFrame:
    return _silver(pitstops_pages(t), "pitstops")


def pitstops_pages(t: Tables) -> DataFrame:
    record = F.struct(
        F.concat(F.lit("d"), "l_orderkey").alias("driverId"),
        words("n").alias("lap"),
        words("l_linenumber").alias("stop"),
        F.lit("15:02:11").alias("time"),
        F.concat("n", F.lit("3.456")).alias("duration"),
    )
    return _per_round(_lines(t), "pitstops", record, "_order")


@query(f"""
SELECT number, 'd' || l_orderkey AS timings_driver_id, n AS timings_position, '1:0' || n || '.5' AS timings_time, season, round
FROM {_ORDER_LINES}""")
def silver_laps(t: Tables) -> DataFrame:
    """Lap timings nested in laps nested in races; a lap goes on over several pages."""
    return _silver(laps_pages(t), "laps")


def laps_pages(t: Tables) -> DataFrame:
    timing = F.to_json(
        F.struct(
            F.concat(F.lit("d"), "l_orderkey").alias("driverId"),
            words("n").alias("position"),
            F.concat(F.lit("1:0"), "n", F.lit(".5")).alias("time"),
        )
    )
    laps = _lines(t).groupBy("season", "round", "page", "l_linenumber").agg(
        json_list(F.col("l_orderkey"), timing).alias("timings")
    )
    record = F.concat(F.lit('{"number":"'), words("l_linenumber"), F.lit('","Timings":['), "timings", F.lit("]}"))
    head = F.concat(
        F.lit('"RaceTable":{"Races":[{"season":"'), words("season"), F.lit('","round":"'), words("round"), F.lit('","Laps":[')
    )
    shaped = laps.select("season", "round", "page", "l_linenumber", record.alias("record"))
    pages = response(shaped, ["season", "round", "page"], "l_linenumber", head, "]}]}}}")
    return pages



@query(f"""
SELECT o_orderkey % 20 + 1 AS position, o_totalprice AS points, o_orderkey % 7 AS wins, {_driver_sql('driver_')},
  CASE WHEN e = 0 THEN 'c' || n_nationkey WHEN e = 1 THEN 'x' END AS constructors_constructor_id,
  CASE WHEN e = 0 THEN n_name WHEN e = 1 THEN 'Second' END AS constructors_name,
  CASE WHEN e = 0 THEN 'N' || lower(substr(n_name, 2)) WHEN e = 1 THEN 'Swiss' END AS constructors_nationality,
  CASE WHEN e = 0 THEN 'u' || n_nationkey WHEN e = 1 THEN 'ux' END AS constructors_url, {_ROUND}
FROM {_ORDERS}, (VALUES (0), (1), (2)) AS x(e)
WHERE CASE WHEN o_orderkey % 3 = 2 THEN e = 2 ELSE e <= o_orderkey % 3 END""")
def silver_driverstandings(t: Tables) -> DataFrame:
    """Drivers of one team, of two, and of none at all (who keep a row)."""
    second = F.struct(
        F.lit("x").alias("constructorId"), F.lit("Second").alias("name"), F.lit("swiss").alias("nationality"), F.lit("ux").alias("url")
    )
    third = F.col("o_orderkey") % 3
    teams = F.when(third == 0, F.array(constructor())).when(third == 1, F.array(constructor(), second)).otherwise(
        F.slice(F.array(constructor()), 1, 0)
    )
    record = F.struct(
        F.expr("string(o_orderkey % 20 + 1)").alias("position"),
        words("o_totalprice").alias("points"),
        F.expr("string(o_orderkey % 7)").alias("wins"),
        driver().alias("Driver"),
        teams.alias("Constructors"),
    )
    return _silver(_per_round(_orders(t), "driverstandings", record, "o_orderkey", '"StandingsTable":{"StandingsLists":['), "driverstandings")


@query(f"""
SELECT o_orderkey % 20 + 1 AS position, o_totalprice AS points, o_orderkey % 7 AS wins, {_constructor_sql('constructor_')}, {_ROUND}
FROM {_ORDERS}""")
def silver_constructorstandings(t: Tables) -> DataFrame:
    record = F.struct(
        F.expr("string(o_orderkey % 20 + 1)").alias("position"),
        words("o_totalprice").alias("points"),
        F.expr("string(o_orderkey % 7)").alias("wins"),
        constructor().alias("Constructor"),
    )
    return _silver(_per_round(_orders(t), "constructorstandings", record, "o_orderkey", '"StandingsTable":{"StandingsLists":['), "constructorstandings")
