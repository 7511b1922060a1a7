"""Queries over the Gold models: history, as-of joins, dimensions, facts, aggregates, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from smeltery.catalog.datasets import (
    _ORDER_LINES,
    OF_ORDERS,
    circuits_pages,
    constructors_pages,
    drivers_pages,
    laps_pages,
    page_tasks,
    pitstops_pages,
    qualifying_pages,
    races_pages,
    results_pages,
    status_pages,
)
from smeltery.catalog.frames import CENTS, INGESTED, clock, event_results, order_lines, race_results, races, statuses
from smeltery.catalog.registry import Tables, query
from smeltery.operators.history import apply_snapshot, as_of, as_of_join, history
from smeltery.plans import gold
from smeltery.plans.gold_run import build_gold
from smeltery.plans.side_by_side import side_by_side
from smeltery.plans.silver_run import run_silver
from smeltery.session import scratch_path, shuffles_freed
from smeltery.sources.bronze import envelope, land
from smeltery.sources.registry import DATASETS
from smeltery.sources.tables import remove, written

# --- history ---


@query("""
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
  strftime(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), '%Y-%m-%d %H:%M:%S.%f') AS valid_to
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before IS DISTINCT FROM event_type""")
def scd2_history(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "event_type", "event_id", "ts")
    versions = history(events, ["user_id"], ["event_type"], "ts", F.date_trunc("month", "ts"), tie=["event_id"])
    form = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return versions.withColumns(
        {c: F.date_format(c, form) for c in ("valid_from", "valid_to")}
    )


def _customer_versions(t: Tables) -> DataFrame:
    """Every customer starts in its segment; most move once, some twice, on days of their own."""
    start = F.lit("1995-01-01").cast("timestamp")
    rows = F.expr(
        "array_compact(array(struct(0 AS moved, c_mktsegment AS segment),"
        " if(c_custkey % 4 <> 0, struct(int(400 + c_custkey % 1000) AS moved, concat('NEW ', c_mktsegment) AS segment), null),"
        " if(c_custkey % 4 = 1, struct(int(1500 + c_custkey % 700) AS moved, 'GONE' AS segment), null)))"
    )
    each = t.customer.select("c_custkey", F.explode(rows).alias("v"))
    return each.select(
        F.col("c_custkey").alias("cust_key"),
        F.col("v.segment").alias("segment"),
        F.expr("timestamp'1995-01-01' + make_dt_interval(v.moved)").alias("changed_at"),
    ).where(F.col("changed_at") >= start)


_VERSIONS = """(SELECT cust_key, segment, changed_at, lead(changed_at) OVER (PARTITION BY cust_key ORDER BY changed_at) AS ended_at
  FROM (SELECT c_custkey AS cust_key, c_mktsegment AS segment, TIMESTAMP '1995-01-01' AS changed_at FROM customer
    UNION ALL SELECT c_custkey, 'NEW ' || c_mktsegment, TIMESTAMP '1995-01-01' + to_days((400 + c_custkey % 1000)::INT) FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL SELECT c_custkey, 'GONE', TIMESTAMP '1995-01-01' + to_days((1500 + c_custkey % 700)::INT) FROM customer WHERE c_custkey % 4 = 1))"""


def _customer_dimension(t: Tables) -> DataFrame:
    return history(
        _customer_versions(t), ["cust_key"], ["segment"], "changed_at", F.floor(F.year("changed_at") / 10)
    )


@query(f"""
SELECT o_orderkey, o_custkey, segment FROM orders LEFT JOIN {_VERSIONS} v ON o_custkey = cust_key
  AND o_orderdate >= changed_at AND (ended_at IS NULL OR o_orderdate < ended_at)""")
def as_of_join_orders(t: Tables) -> DataFrame:
    facts = t.orders.select("o_orderkey", F.col("o_custkey").alias("cust_key"), "o_orderdate")
    joined = as_of_join(
        facts, _customer_dimension(t), ["cust_key"], "o_orderdate", ["segment"], "year(_at) div 5"
    )
    return joined.select("o_orderkey", F.col("cust_key").alias("o_custkey"), "segment")


@query(f"""
SELECT cust_key, segment FROM {_VERSIONS} WHERE changed_at <= TIMESTAMP '1999-06-01'
  AND (ended_at IS NULL OR TIMESTAMP '1999-06-01' < ended_at)""")
def time_travel(t: Tables) -> DataFrame:
    return as_of(_customer_dimension(t), F.lit("1999-06-01").cast("timestamp")).select("cust_key", "segment")


@query("""
WITH s AS (SELECT c_custkey AS cust_key, CASE WHEN c_custkey % 3 = 0 THEN 'MOVED' ELSE c_mktsegment END AS segment,
    c_custkey % 5 <> 0 AS was, c_custkey % 7 <> 0 AS is_in, c_mktsegment AS before, c_custkey FROM customer)
SELECT cust_key, before AS segment, '1995-01-01' AS valid_from,
  CASE WHEN is_in AND segment <> before THEN '2000-01-01' END AS valid_to FROM s WHERE was
UNION ALL SELECT cust_key, segment, '2000-01-01', NULL FROM s WHERE is_in AND (NOT was OR segment <> before)
UNION ALL SELECT cust_key, 'OLD', '1990-01-01', '1995-01-01' FROM s WHERE was AND cust_key % 2 = 0""")
def scd2_incremental(t: Tables) -> DataFrame:
    """A second snapshot folded into a dimension: moved, unchanged, new and missing customers."""
    base = t.customer.select(F.col("c_custkey").alias("cust_key"), F.col("c_mktsegment").alias("segment"))
    known = base.where("cust_key % 5 <> 0")
    opened = known.selectExpr("*", "'1995-01-01' AS valid_from", "cast(null AS string) AS valid_to")
    closed = known.where("cust_key % 2 = 0").selectExpr(
        "cust_key", "'OLD' AS segment", "'1990-01-01' AS valid_from", "'1995-01-01' AS valid_to"
    )
    moved = F.when(F.col("cust_key") % 3 == 0, "MOVED").otherwise(F.col("segment"))
    snapshot = base.where("cust_key % 7 <> 0").withColumn("segment", moved)
    return apply_snapshot(opened.unionByName(closed), snapshot, ["cust_key"], ["segment"], F.lit("2000-01-01"))


# --- dimensions ---


@query("""
SELECT sha256(n_nationkey::VARCHAR) AS season_id, CAST(n_nationkey AS BIGINT) AS year, n_name || ' b2' AS url FROM nation
WHERE n_nationkey % 2 = 0 UNION ALL
SELECT sha256(n_nationkey::VARCHAR), CAST(n_nationkey AS BIGINT), n_name || ' b1' FROM nation WHERE n_nationkey % 2 <> 0""")
def dim_seasons(t: Tables) -> DataFrame:
    """Nations as seasons, half of them landed again in a second batch."""
    batches = F.explode(F.expr("array_compact(array('b1', if(n_nationkey % 2 = 0, 'b2', null)))"))
    rows = t.nation.select(
        F.col("n_nationkey").cast("long").alias("season"), "n_name", batches.alias("batch_id"),
        F.lit(1).alias("page"), F.lit(0).alias("_record_index"),
    )
    return gold.dim_seasons(rows.withColumn("url", F.concat_ws(" ", "n_name", "batch_id")).drop("n_name"))


@query("""
SELECT ascii(l_returnflag)::BIGINT AS status_id, l_returnflag || l_returnflag AS status,
  l_returnflag || l_returnflag AS description FROM lineitem GROUP BY l_returnflag""")
def dim_status(t: Tables) -> DataFrame:
    """Return flags as statuses, one record per line landed: the newest of very many replays."""
    rows = t.lineitem.select(
        F.ascii("l_returnflag").cast("long").alias("status_id"),
        F.concat("l_returnflag", F.when(F.col("l_linenumber") == 7, F.col("l_returnflag")).otherwise("")).alias("status"),
        F.col("l_linenumber").cast("string").alias("batch_id"),
        F.lit(1).alias("page"),
        F.lit(0).alias("_record_index"),
    )
    return gold.dim_status(rows)


@query("""
WITH s AS (SELECT c_custkey, c_name, c_mktsegment, c_nationkey, unnest([2000, 2001, 2002]) AS season FROM customer),
v AS (SELECT 'd' || c_custkey AS driver_id, c_name || ' ' || CASE WHEN season = 2002 AND c_custkey % 5 = 0 THEN 'X' ELSE c_mktsegment END AS name,
    'nation ' || c_nationkey AS nationality, '1990-01-02' AS dob,
    'team' || CASE WHEN season >= 2001 AND c_custkey % 3 = 0 THEN 2 ELSE 1 END AS constructor_id, season FROM s)
SELECT driver_id, name, nationality, dob, constructor_id, CAST(season AS BIGINT) AS valid_from,
  CAST(lead(season) OVER (PARTITION BY driver_id ORDER BY season) AS BIGINT) AS valid_to
FROM (SELECT *, lag((name, nationality, constructor_id)) OVER (PARTITION BY driver_id ORDER BY season) AS before FROM v)
WHERE before IS DISTINCT FROM (name, nationality, constructor_id)""")
def dim_drivers(t: Tables) -> DataFrame:
    """Customers as drivers over three seasons: some change name, some their team (from results)."""
    seasons = F.explode(F.array(*(F.lit(y).cast("long") for y in (2000, 2001, 2002)))).alias("season")
    s = t.customer.select("*", seasons)
    family = F.when((F.col("season") == 2002) & (F.col("c_custkey") % 5 == 0), "X").otherwise(F.col("c_mktsegment"))
    drivers = s.select(
        F.concat(F.lit("d"), F.col("c_custkey")).alias("driver_id"),
        F.col("c_name").alias("given_name"),
        family.alias("family_name"),
        F.concat(F.lit("nation "), F.col("c_nationkey")).alias("nationality"),
        F.lit("1990-01-02").alias("date_of_birth"),
        "season",
    )
    team = F.when((F.col("season") >= 2001) & (F.col("c_custkey") % 3 == 0), "team2").otherwise("team1")
    results = s.select(
        F.concat(F.lit("d"), F.col("c_custkey")).alias("driver_driver_id"),
        "season",
        F.explode(F.array(F.struct(F.lit(1).alias("r"), F.lit("team0").alias("c")), F.struct(F.lit(2).alias("r"), team.alias("c")))).alias("x"),
    ).select("driver_driver_id", "season", F.col("x.r").alias("round"), F.col("x.c").alias("constructor_constructor_id"))
    versions = gold.dim_drivers(gold.driver_snapshots(drivers, results), "season", F.floor(F.col("season") / 10))
    return versions.withColumn("dob", F.col("dob").cast("string"))


_TWO = "unnest([1, 2])"


@query(f"""
WITH v AS (SELECT s_suppkey AS id, s_name || CASE WHEN b = 2 AND s_suppkey % 3 = 0 THEN ' II' ELSE '' END AS name,
    s_nationkey, b FROM (SELECT *, {_TWO} AS b FROM supplier))
SELECT 's' || id AS constructor_id, name, 'N' || s_nationkey AS nationality, b AS valid_from, CASE WHEN b = 1 AND id % 3 = 0 THEN 2 END AS valid_to
FROM v WHERE b = 1 OR id % 3 = 0""")
def dim_constructors(t: Tables) -> DataFrame:
    s = t.supplier.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("b"))
    renamed = F.when((F.col("b") == 2) & (F.col("s_suppkey") % 3 == 0), F.concat("s_name", F.lit(" II")))
    snapshots = s.select(
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("constructor_id"),
        F.coalesce(renamed, "s_name").alias("name"),
        F.concat(F.lit("N"), F.col("s_nationkey")).alias("nationality"),
        "b",
    )
    return gold.dim_constructors(snapshots, "b", F.floor(F.col("b") / 10))


@query(f"""
SELECT 'c' || s_suppkey AS circuit_id, s_name AS name, n_name AS location, r_name AS country,
  CASE WHEN b = 2 THEN s_acctbal + 1 ELSE s_acctbal END AS lat, CAST(s_nationkey AS DOUBLE) AS lng,
  b AS valid_from, CASE WHEN b = 1 AND s_suppkey % 2 = 0 THEN 2 END AS valid_to
FROM (SELECT *, {_TWO} AS b FROM supplier) JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE b = 1 OR s_suppkey % 2 = 0""")
def dim_circuits(t: Tables) -> DataFrame:
    s = (
        t.supplier.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("b"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    moved = F.when((F.col("b") == 2) & (F.col("s_suppkey") % 2 == 0), 1).otherwise(0)
    circuits = s.select(
        F.concat(F.lit("c"), F.col("s_suppkey")).alias("circuit_id"),
        F.col("s_name").alias("name"),
        F.col("n_name").alias("location_locality"),
        F.col("r_name").alias("location_country"),
        (F.col("s_acctbal") + moved).alias("location_lat"),
        F.col("s_nationkey").cast("double").alias("location_long"),
        F.col("b").alias("season"),
    )
    return gold.dim_circuits(gold.circuit_snapshots(circuits), "season", F.floor(F.col("season") / 10))


# --- facts ---

_FACT = """(SELECT year(o_orderdate)::INT AS season, month(o_orderdate)::INT AS round, 'd' || o_custkey AS driver_id,
    'c' || c_nationkey AS constructor_id, 'circuit' || month(o_orderdate) AS circuit_id, l_suppkey AS grid_position,
    l_linenumber AS final_position, CAST(l_quantity AS DECIMAL(18,2)) AS points, l_partkey AS laps_completed,
    ascii(l_returnflag)::BIGINT AS status_id, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS fastest_lap_time,
    l_linenumber AS fastest_lap_rank FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def _fact(t: Tables) -> DataFrame:
    return gold.fact_race_results(race_results(t), written(races(t), "races"), written(statuses(t), "statuses"))


@query(f"""
SELECT sha256(season || '|' || round || '|' || driver_id || '|' || final_position) AS result_id, * REPLACE (CAST(points AS DOUBLE) AS points)
FROM {_FACT}""")
def fact_race_results(t: Tables) -> DataFrame:
    return _fact(t).withColumn("points", F.col("points").cast("double"))


@query("""
WITH q AS (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS ms FROM orders)
SELECT sha256(year(o_orderdate) || '|' || month(o_orderdate) || '|d' || o_custkey || '|' || (o_orderkey % 20 + 1)) AS qualifying_id,
  year(o_orderdate)::INT AS season, month(o_orderdate)::INT AS round, 'd' || o_custkey AS driver_id, o_orderstatus AS constructor_id,
  ms AS q1_time, CASE WHEN o_orderkey % 3 > 0 THEN ms - 1000 END AS q2_time,
  CASE WHEN o_orderkey % 3 > 1 THEN ms % 60000 END AS q3_time, o_orderkey % 20 + 1 AS final_position FROM q""")
def fact_qualifying(t: Tables) -> DataFrame:
    ms = (F.col("o_totalprice").cast(CENTS) * 100).cast("long")
    third = F.col("o_orderkey") % 3
    short = F.format_string("%d.%03d", (ms % 60000 / 1000).cast("long"), ms % 1000)
    return gold.fact_qualifying_results(
        t.orders.select(
            F.year("o_orderdate").alias("season"),
            F.month("o_orderdate").alias("round"),
            F.concat(F.lit("d"), F.col("o_custkey")).alias("driver_driver_id"),
            F.col("o_orderstatus").alias("constructor_constructor_id"),
            clock(ms).alias("q1"),
            F.when(third > 0, clock(ms - 1000)).alias("q2"),
            F.when(third > 1, short).otherwise(F.when(third == 0, "")).alias("q3"),
            (F.col("o_orderkey") % 20 + 1).alias("position"),
        )
    )


@query("""
SELECT sha256(l_orderkey % 50 || '|' || l_orderkey % 20 || '|d' || l_orderkey || '|' || l_linenumber) AS lap_id, CAST(l_orderkey % 50 AS BIGINT) AS season,
  CAST(l_orderkey % 20 AS BIGINT) AS round, 'd' || l_orderkey AS driver_id, l_linenumber AS lap_number,
  CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) * 1000 AS BIGINT) AS lap_time_ms
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def fact_laps(t: Tables) -> DataFrame:
    laps = order_lines(t).select(
        (F.col("l_orderkey") % 50).alias("season"),
        (F.col("l_orderkey") % 20).alias("round"),
        F.concat(F.lit("d"), F.col("l_orderkey")).alias("timings_driver_id"),
        F.col("l_linenumber").alias("number"),
        clock((F.col("qty") * 1000).cast("long")).alias("timings_time"),
    )
    return gold.fact_lap_times(laps)


@query("""
SELECT sha256(weekofyear(ts) || '|' || day(ts) || '|u' || user_id || '|' || event_id) AS pitstop_id, weekofyear(ts)::INT AS season,
  day(ts)::INT AS round, 'u' || user_id AS driver_id, user_id AS lap, event_id AS stop_number,
  CASE WHEN event_type = 'error' THEN NULL ELSE CAST(round(value * 1000) AS BIGINT) END AS duration_ms FROM events""")
def fact_stops(t: Tables) -> DataFrame:
    ms = F.round(F.col("value") * 1000).cast("long")
    seconds = F.format_string("%d.%03d", (ms / 1000).cast("long"), ms % 1000)
    return gold.fact_pit_stops(
        t.events.select(
            F.weekofyear("ts").alias("season"),
            F.dayofmonth("ts").alias("round"),
            F.concat(F.lit("u"), F.col("user_id")).alias("driver_id"),
            F.col("user_id").alias("lap"),
            F.col("event_id").alias("stop"),
            F.when(F.col("event_type") == "error", "retired").when(ms % 2 == 0, clock(ms)).otherwise(seconds).alias("duration"),
        )
    )


# --- aggregates ---

_EVENTS = """(SELECT weekofyear(ts)::INT AS season, day(ts)::INT AS round, 'u' || user_id AS driver_id,
    event_type AS constructor_id, event_id % 5 + 1 AS final_position, CAST(value AS DECIMAL(18,2)) AS points,
    event_type <> 'signup' AS race FROM events)"""


@query(f"""
SELECT season, driver_id, CAST(sum(points) AS DOUBLE) AS total_points, count(*) FILTER (race) AS races,
  count(*) FILTER (race AND final_position = 1) AS wins, count(*) FILTER (race AND final_position <= 3) AS podiums,
  count(*) FILTER (race AND final_position = 1 AND round % 2 = 0) AS poles
FROM {_EVENTS} GROUP BY ALL""")
def season_stats(t: Tables) -> DataFrame:
    """Driver totals; signups stand for sprints, even days' winners for pole positions."""
    rows = event_results(t.events)
    race = F.col("constructor_id") != "signup"
    stats = gold.driver_season_stats(rows.where(race), rows.where(race & (F.col("round") % 2 == 0)), rows.where(~race))
    return stats.withColumn("total_points", F.col("total_points").cast("double"))


@query(f"""
SELECT season, constructor_id, CAST(sum(points) AS DOUBLE) AS total_points, count(DISTINCT round) AS races,
  count(*) FILTER (final_position = 1) AS wins, count(*) FILTER (final_position <= 3) AS podiums
FROM {_EVENTS} GROUP BY ALL""")
def team_stats(t: Tables) -> DataFrame:
    stats = gold.constructor_season_stats(event_results(t.events))
    return stats.withColumn("total_points", F.col("total_points").cast("double"))


@query(f"""
SELECT circuit_id, driver_id, fastest_lap_time AS fastest_time, season, round FROM {_FACT}
QUALIFY row_number() OVER (PARTITION BY circuit_id ORDER BY fastest_lap_time, season, round, driver_id) = 1""")
def fastest_by_group(t: Tables) -> DataFrame:
    return gold.fastest_laps_by_circuit(_fact(t))


@query(f"""
WITH r AS (SELECT season, driver_id, round, sum(points) AS points, count(*) FILTER (final_position = 1) AS wins FROM {_EVENTS} GROUP BY ALL),
l AS (SELECT season, unnest(generate_series(1, 31)) AS round FROM (SELECT DISTINCT season FROM r)),
g AS (SELECT l.season, l.round, driver_id, sum(points) AS points, sum(wins) AS wins
  FROM l JOIN r ON l.season = r.season AND r.round <= l.round
  WHERE l.round <= (SELECT max(round) FROM r x WHERE x.season = l.season) GROUP BY ALL)
SELECT season, round::INT AS round, driver_id, CAST(points AS DOUBLE) AS points, CAST(wins AS BIGINT) AS wins,
  rank() OVER (PARTITION BY season, round ORDER BY points DESC, wins DESC) AS position FROM g""")
def cumulative_standings(t: Tables) -> DataFrame:
    table = gold.standings_by_round(event_results(t.events))
    return table.withColumn("points", F.col("points").cast("double"))


@query(f"""
WITH c AS (SELECT season, driver_id, round, sum(sum(points)) OVER (PARTITION BY season, driver_id ORDER BY round) AS points
  FROM {_EVENTS} GROUP BY season, driver_id, round)
SELECT season, round, driver_id, CAST(points AS DOUBLE) AS points, CAST(points + 1 AS DOUBLE) AS published_points
FROM c WHERE round % 4 = 0""")
def standings_check(t: Tables) -> DataFrame:
    """Computed standings against a published table that is one point off on some days."""
    rows = event_results(t.events)
    computed = gold.standings_by_round(rows)
    off = F.when(F.col("round") % 4 == 0, 1).otherwise(0)
    # The published table is summed from the rows themselves, not taken from the computed one.
    so_far = Window.partitionBy("season", "driver_id").orderBy("round")
    scored = rows.groupBy("season", "driver_id", "round").agg(F.sum(F.col("points").cast(CENTS)).alias("won"))
    published = scored.select("season", "round", "driver_id", (F.sum("won").over(so_far) + off).alias("points"))
    own = computed.join(published.select("season", "round", "driver_id"), ["season", "round", "driver_id"], "left_semi")
    wrong = gold.standings_mismatches(own, published)
    return wrong.select(
        "season", "round", "driver_id",
        F.col("points").cast("double").alias("points"), F.col("published_points").cast("double").alias("published_points"),
    )


# --- layout and refresh ---


@query(f"""
SELECT season, round, driver_id, fastest_lap_time FROM {_FACT} WHERE season = 1997 AND round = 5""")
def partitioned_clustered_read(t: Tables) -> DataFrame:
    """A fact written by season and round, sorted inside, one partition read back."""
    path = scratch_path(t.spark, "fact")
    gold.write_fact(_fact(t), path, ["driver_id"])
    part = t.spark.read.parquet(path).where("season = 1997 AND round = 5")
    return part.select("season", "round", "driver_id", "fastest_lap_time")


@query("""
SELECT weekofyear(ts)::INT AS season, day(ts)::INT AS round, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS points FROM events GROUP BY ALL""")
def preaggregate_refresh(t: Tables) -> DataFrame:
    """A daily aggregate built before some events came in, refreshed for their days only."""
    path = scratch_path(t.spark, "aggregate")
    rows = event_results(t.events)

    def daily(fact: DataFrame) -> DataFrame:
        return fact.groupBy("season", "round").agg(
            F.count(F.lit(1)).alias("n"), F.sum("points").cast("double").alias("points")
        )

    late = F.col("constructor_id") == "purchase"
    daily(rows.where(~late)).write.partitionBy("season", "round").parquet(path)
    gold.refresh_aggregate(rows, rows.where(late), ["season", "round"], daily, path)
    return t.spark.read.parquet(path).select("season", "round", "n", "points")


def _refine_pages(t: Tables, silver: str, pages: dict[str, DataFrame]) -> None:
    """Land the pages of some datasets and refine them to Silver; what was landed is removed then.

    Datasets whose orders are dealt, being large, take turns: each fills the cluster by itself, and what one
    lands and shuffles need not lie on disk beside what the next does. The others go side by side.
    """
    large = [n for n in pages if n in OF_ORDERS] if page_tasks(t) else []

    def landed(name: str, base: str) -> None:
        place = [F.col(c) for c in ("_p_season", "_p_round", "batch_id", "page")]
        value = envelope(F.lit(name), *place, F.lit(INGESTED), F.lit(None), F.col("value"))
        keyed = pages[name].withColumn("value", value).withColumnsRenamed({"_p_season": "season", "_p_round": "round"})
        land(keyed, base, DATASETS[name], dealt=name in large)

    def refined(names: list[str]) -> None:
        base = scratch_path(t.spark, "bronze")
        with shuffles_freed(t.spark):
            side_by_side(t.spark, {name: lambda name=name: landed(name, base) for name in names})
        run_silver(t.spark, base, silver, None, names)
        remove(t.spark, base)

    for names in [*([n] for n in large), [n for n in pages if n not in large]]:
        if names:
            refined(names)


_KEPT = """(SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, 'c' || c_nationkey AS constructor_id,
    o_orderkey % 20 + 1 AS place, CAST(o_totalprice AS DECIMAL(18,2)) AS points FROM orders JOIN customer ON o_custkey = c_custkey
  QUALIFY row_number() OVER (PARTITION BY season, round, o_custkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 100 END, place
    ORDER BY o_orderkey DESC) = 1)"""


@query(f"""
SELECT CAST(season AS BIGINT) AS season, constructor_id, CAST(sum(points) AS DOUBLE) AS total_points, count(DISTINCT round) AS races,
  count(*) FILTER (place = 1) AS wins, count(*) FILTER (place <= 3) AS podiums FROM {_KEPT} GROUP BY ALL""")
def gold_build(t: Tables) -> DataFrame:
    """Pages landed, refined to Silver and built to Gold; the season table of the constructors."""
    silver, target = (scratch_path(t.spark, n) for n in ("silver", "gold"))
    _refine_pages(t, silver, {"results": results_pages(t), "races": races_pages(t), "status": status_pages(t)})
    stats = build_gold(t.spark, silver, target)["agg_constructor_season_stats"]
    return stats.withColumn("total_points", F.col("total_points").cast("double"))


@query(f"""
SELECT season, round, 'd' || l_orderkey AS driver_id, number AS lap_number, ((60 + n) * 1000 + 500)::BIGINT AS lap_time_ms FROM {_ORDER_LINES}""")
def gold_laps(t: Tables) -> DataFrame:
    """Lap times from the built Gold: pages landed, refined, timings in milliseconds."""
    silver, target = (scratch_path(t.spark, n) for n in ("silver", "gold"))
    _refine_pages(t, silver, {"laps": laps_pages(t)})
    return build_gold(t.spark, silver, target)["fact_lap_times"].drop("lap_id")


@query(f"""
SELECT season, round, 'd' || l_orderkey AS driver_id, n AS lap, number AS stop_number, (n * 10000 + 3456)::BIGINT AS duration_ms FROM {_ORDER_LINES}""")
def gold_stops(t: Tables) -> DataFrame:
    silver, target = (scratch_path(t.spark, n) for n in ("silver", "gold"))
    _refine_pages(t, silver, {"pitstops": pitstops_pages(t)})
    return build_gold(t.spark, silver, target)["fact_pit_stops"].drop("pitstop_id")


_ENTRIES = """(SELECT year(o_orderdate)::BIGINT AS season, month(o_orderdate)::BIGINT AS round, 'd' || c_custkey AS driver_id,
    o_orderkey % 20 + 1 AS place, o_totalprice::DECIMAL(18,2) AS points FROM orders JOIN customer ON o_custkey = c_custkey
  QUALIFY row_number() OVER (PARTITION BY season, round, o_custkey, {0}, place ORDER BY o_orderkey DESC) = 1)"""


@query(f"""
WITH r AS (SELECT season, driver_id, sum(points)::DOUBLE AS total_points, count(*) AS races, count(*) FILTER (place = 1) AS wins,
    count(*) FILTER (place <= 3) AS podiums FROM {_ENTRIES.format("CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 100 END")} GROUP BY ALL),
p AS (SELECT season, driver_id, count(*) AS poles FROM {_ENTRIES.format("o_orderkey % 100")} WHERE place = 1 GROUP BY ALL)
SELECT r.*, coalesce(poles, 0) AS poles FROM r LEFT JOIN p USING (season, driver_id)""")
def gold_driver_seasons(t: Tables) -> DataFrame:
    """Driver seasons from the built Gold, with pole positions from the built qualifying fact."""
    silver, target = (scratch_path(t.spark, n) for n in ("silver", "gold"))
    pages = {"results": results_pages(t), "races": races_pages(t), "status": status_pages(t), "qualifying": qualifying_pages(t)}
    _refine_pages(t, silver, pages)
    stats = build_gold(t.spark, silver, target, ["agg_driver_season_stats"])["agg_driver_season_stats"]
    return stats.withColumn("total_points", F.col("total_points").cast("double"))


@query("""
SELECT 'driver' AS dimension, 'd' || c_custkey AS id, c_name || ' ' || c_mktsegment AS name,
  left(c_mktsegment, 1) || lower(substr(c_mktsegment, 2)) AS nationality, (2000 + c_custkey % 3)::BIGINT AS valid_from, NULL::BIGINT AS valid_to FROM customer
UNION ALL SELECT 'constructor', 'c' || n_nationkey, n_name, 'N' || lower(substr(n_name, 2)), 2000 + n_nationkey % 2, NULL FROM nation
UNION ALL SELECT 'circuit', 's' || s_suppkey, 'Circuit ' || s_suppkey, 'United Kingdom', 2000 + s_suppkey % 3, NULL FROM supplier""")
def gold_dimensions(t: Tables) -> DataFrame:
    """The three dimensions with history from the built Gold; a circuit's country stands as its nationality."""
    silver, target = (scratch_path(t.spark, n) for n in ("silver", "gold"))
    _refine_pages(t, silver, {"drivers": drivers_pages(t), "constructors": constructors_pages(t), "circuits": circuits_pages(t)})
    built = build_gold(t.spark, silver, target)
    kinds = (("driver", "driver_id", "nationality"), ("constructor", "constructor_id", "nationality"), ("circuit", "circuit_id", "country"))
    parts = [
        built[f"dim_{kind}s"].select(
            F.lit(kind).alias("dimension"), F.col(key).alias("id"), "name", F.col(place).alias("nationality"), "valid_from", "valid_to"
        )
        for kind, key, place in kinds
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""
SELECT weekofyear(ts)::INT AS season, day(ts)::INT AS round, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS points
FROM events WHERE day(ts) % 6 <> 1 GROUP BY ALL""")
def pruned_refresh(t: Tables) -> DataFrame:
    """An aggregate over a stored fact in which late events came in on some days and others lost all
    theirs, refreshed for these days only; the fact is pruned to them while the job runs."""
    fact, path = scratch_path(t.spark, "fact"), scratch_path(t.spark, "aggregate")
    rows = event_results(t.events)
    gone, late = F.col("round") % 6 == 1, (F.col("round") % 4 == 0) & (F.col("constructor_id") == "purchase")

    def daily(frame: DataFrame) -> DataFrame:
        return frame.groupBy("season", "round").agg(F.count(F.lit(1)).alias("n"), F.sum("points").cast("double").alias("points"))

    daily(rows.where(~late)).write.partitionBy("season", "round").parquet(path)
    gold.write_fact(rows.where(~gone), fact, ["driver_id"])
    stored = t.spark.read.schema(rows.schema).parquet(fact)
    gold.refresh_aggregate(stored, rows.where(gone | late), ["season", "round"], daily, path)
    return t.spark.read.parquet(path).select("season", "round", "n", "points")


@query(f"""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY season, round, driver_id, constructor_id ORDER BY points, final_position, race) AS nth FROM {_EVENTS}),
g AS (SELECT season, round, driver_id, min(final_position) AS qualifying_position, max(points) AS best FROM {_EVENTS} WHERE race GROUP BY ALL)
SELECT season, round, driver_id, final_position, points::DOUBLE AS points, qualifying_position, (best * 100)::BIGINT AS q1_time
FROM f LEFT JOIN g USING (season, round, driver_id)""")
def bucketed_join(t: Tables) -> DataFrame:
    """Results with their qualifying, both stored in buckets by season, round and driver: no shuffle."""
    keys = ["season", "round", "driver_id"]
    rows = event_results(t.events)
    best = F.max(F.when(F.col("constructor_id") != "signup", (F.col("points") * 100).cast("long")))
    first = F.min(F.when(F.col("constructor_id") != "signup", F.col("final_position")))
    grid = rows.groupBy(*keys).agg(first.alias("final_position"), best.alias("q1_time")).where("q1_time IS NOT NULL")
    none = {f"q{n}_time": F.lit(None).cast("long") for n in (2, 3)}
    name = scratch_path(t.spark, "bucketed").rsplit("-", 1)[-1]
    stored = [
        gold.bucketed_fact(frame, f"{kind}_{name}", scratch_path(t.spark, kind), keys, buckets=8)
        for kind, frame in (("results", rows), ("qualifying", grid.withColumns(none)))
    ]
    joined = gold.results_with_qualifying(*stored)
    return joined.select(*keys, "final_position", F.col("points").cast("double").alias("points"), "qualifying_position", "q1_time")
