"""Queries over kept versions: Silver batches and pointers, states per round, bucketed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.catalog.frames import CENTS, event_results
from smeltery.catalog.layers import _REPLAYED, RACE_EVENTS, _replayed
from smeltery.catalog.registry import Tables, query
from smeltery.plans import states
from smeltery.plans.dimension import Dimension, fold, read_changes, read_dimension
from smeltery.session import scratch_path
from smeltery.sources.versions import publish, read_version, roll_back


@query(" UNION ALL ".join(f"""
SELECT '{state}' AS state, season::BIGINT AS season, round::BIGINT AS round, event_id, value, 'b' || (b + 1) AS batch_id
FROM (SELECT * FROM {_REPLAYED} WHERE b < {batches} QUALIFY b = max(b) OVER (PARTITION BY season, round))
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY page DESC) = 1"""
    for state, batches in (("as of the first", 1), ("back at the second", 2), ("forward again", 3))))
def silver_rollback(t: Tables) -> DataFrame:
    """Three batches published one by one, read as of the first, then rolled back to the second and
    forward again; no Bronze is read."""
    base, rows = scratch_path(t.spark, "versions"), _replayed(t)
    made = [publish(rows.where(F.col("batch_id") == b), base, RACE_EVENTS) for b in ("b1", "b2", "b3")]
    back = roll_back(t.spark, base, RACE_EVENTS, as_of_batch="b2")
    forward = roll_back(t.spark, base, RACE_EVENTS, version=made[-1])
    shown = {"as of the first": made[0], "back at the second": back, "forward again": forward}
    parts = [
        read_version(t.spark, base, RACE_EVENTS, version).select(
            F.lit(state).alias("state"), "season", "round", "event_id", "value", "batch_id"
        )
        for state, version in shown.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two states of a fact: in the second some days are new, some have other points, some are gone."""
    rows = event_results(t.events).withColumns(
        {
            "circuit_id": F.concat(F.lit("circuit"), F.regexp_extract("driver_id", r"(\d)$", 1)),
            "fastest_lap_time": (F.col("points") * 100).cast("long"),
        }
    )
    day = F.col("round")
    more = F.when(day % 5 == 2, 1).otherwise(0)
    later = rows.withColumn("points", (F.col("points") + more).cast(CENTS))
    return rows.where(day % 4 != 0), later.where(day % 6 != 1)


_SECOND = """(SELECT weekofyear(ts)::BIGINT AS season, day(ts)::BIGINT AS round, 'u' || user_id AS driver_id, event_type AS constructor_id,
    event_id % 5 + 1 AS place, value::DECIMAL(18,2) + CASE WHEN day(ts) % 5 = 2 THEN 1 ELSE 0 END AS points,
    'circuit' || user_id % 10 AS circuit_id, (value::DECIMAL(18,2) * 100)::BIGINT AS lap
  FROM events WHERE day(ts) % 6 <> 1)"""


@query(f"""
SELECT season, driver_id, sum(points)::DOUBLE AS total_points, count(*) AS races, count(*) FILTER (place = 1) AS wins,
  count(*) FILTER (place <= 3) AS podiums, count(*) FILTER (place = 1 AND round % 2 = 0) AS poles
FROM {_SECOND} GROUP BY GROUPING SETS ((season, driver_id), (driver_id))""")
def round_states(t: Tables) -> DataFrame:
    """Driver statistics by season and of all time, merged from states after rounds changed, came and went."""
    path = scratch_path(t.spark, "driver-states")
    for load in _loads(t):
        rows = states.scoring_rows(load, load.where("round % 2 = 0"))
        states.refresh(rows, path, states.DRIVERS)
    found = states.season_and_all_time(t.spark, path, states.DRIVERS)
    return found.withColumn("total_points", F.col("total_points").cast("double"))


@query(f"""
SELECT season, constructor_id, sum(points)::DOUBLE AS total_points, count(DISTINCT (season, round)) AS races,
  count(*) FILTER (place = 1) AS wins, count(*) FILTER (place <= 3) AS podiums
FROM {_SECOND} GROUP BY GROUPING SETS ((season, constructor_id), (constructor_id))""")
def round_team_states(t: Tables) -> DataFrame:
    """Constructor statistics the same way; a race counts once however many cars a team enters."""
    path = scratch_path(t.spark, "team-states")
    for load in _loads(t):
        states.refresh(states.scoring_rows(load), path, states.CONSTRUCTORS)
    found = states.season_and_all_time(t.spark, path, states.CONSTRUCTORS)
    return found.withColumn("total_points", F.col("total_points").cast("double"))


@query(f"""
WITH s AS (SELECT * FROM {_SECOND}), g AS (
  SELECT season, circuit_id, lap, season AS in_season, round, driver_id FROM s
  UNION ALL SELECT NULL, circuit_id, lap, season, round, driver_id FROM s)
SELECT season, circuit_id, driver_id, lap AS fastest_time, in_season, round,
  count(*) OVER (PARTITION BY season, circuit_id) AS timed FROM g
QUALIFY row_number() OVER (PARTITION BY season, circuit_id ORDER BY lap, in_season, round, driver_id) = 1""")
def round_bests(t: Tables) -> DataFrame:
    """The quickest lap of every circuit, by season and of all time, from least structs of rounds."""
    path = scratch_path(t.spark, "circuit-states")
    for load in _loads(t):
        states.refresh(load, path, states.CIRCUITS)
    return states.season_and_all_time(t.spark, path, states.CIRCUITS).select(
        "season",
        "circuit_id",
        F.col("best.driver_id").alias("driver_id"),
        F.col("best.fastest_lap_time").alias("fastest_time"),
        F.col("best.season").cast("long").alias("in_season"),
        F.col("best.round").cast("long").alias("round"),
        "timed",
    )


_KEYS = {"user_id": "bigint", "event_type": "string"}
_CHECK = {"level": "int", "busy": "boolean"}
_PHASE = "CASE WHEN day(ts) <= 10 THEN 10 WHEN day(ts) <= 20 THEN 20 ELSE 30 END"


def _snapshots(t: Tables) -> tuple[Dimension, dict[int, DataFrame]]:
    """How much a user does of what, in each third of a month."""
    level = F.floor(F.max("value") / 40).cast("int").alias("level")
    rows = t.events.where("ts IS NOT NULL").groupBy(F.expr(_PHASE).alias("phase"), *_KEYS).agg(
        level, (F.count(F.lit(1)) > 4).alias("busy")
    )
    dim = Dimension(scratch_path(t.spark, "dimension"), _KEYS, _CHECK, moment="int", buckets=8)
    return dim, {at: rows.where(F.col("phase") == at) for at in (10, 20, 30)}


_OBSERVED = f"""o AS (SELECT {_PHASE} AS moment, user_id, event_type, floor(max(value) / 40)::INT AS level, count(*) > 4 AS busy
  FROM events WHERE ts IS NOT NULL GROUP BY ALL)"""


@query(f"""
WITH {_OBSERVED}, told AS (
  SELECT *, true AS there FROM o
  UNION ALL SELECT 30, user_id, event_type, NULL, NULL, false FROM (SELECT DISTINCT user_id, event_type FROM o) k
  WHERE NOT EXISTS (FROM o WHERE o.moment = 30 AND o.user_id = k.user_id AND o.event_type = k.event_type)
), kept AS (
  SELECT *, lag((there, level, busy)) OVER w AS before FROM told WINDOW w AS (PARTITION BY user_id, event_type ORDER BY moment)
), changed AS (SELECT * FROM kept WHERE before IS NULL OR before IS DISTINCT FROM (there, level, busy)
), ended AS (SELECT *, lead(moment) OVER (PARTITION BY user_id, event_type ORDER BY moment) AS valid_to FROM changed)
SELECT user_id, event_type, level, busy, moment AS valid_from, valid_to FROM ended WHERE there""")
def dimension_folds(t: Tables) -> DataFrame:
    """Three snapshots folded, the last one complete, the middle one late."""
    dim, snapshots = _snapshots(t)
    fold(snapshots[10], dim, 10)
    fold(snapshots[30], dim, 30, complete=True)
    fold(snapshots[20], dim, 20)
    return read_dimension(t.spark, dim)


@query(f"""
WITH {_OBSERVED}, f AS (SELECT * FROM o WHERE moment = 10), l AS (SELECT * FROM o WHERE moment = 30),
b AS (SELECT coalesce(f.user_id, l.user_id) AS user_id, coalesce(f.event_type, l.event_type) AS event_type,
    f.level AS l1, f.busy AS b1, l.level AS l3, l.busy AS b3, f.moment IS NOT NULL AS was, l.moment IS NOT NULL AS iss
  FROM f FULL JOIN l ON f.user_id = l.user_id AND f.event_type = l.event_type),
c AS (SELECT *, CASE WHEN was AND iss THEN 'update' WHEN iss THEN 'insert' ELSE 'delete' END AS reason FROM b
  WHERE NOT (was AND iss AND (l1, b1) IS NOT DISTINCT FROM (l3, b3)))
SELECT 10 AS moment, user_id, event_type, level, busy, 10 AS valid_from, NULL::INT AS valid_to, 'opened' AS change, 'insert' AS reason FROM f
UNION ALL SELECT 30, user_id, event_type, l1, b1, 10, NULL, 'removed', reason FROM c WHERE was
UNION ALL SELECT 30, user_id, event_type, l1, b1, 10, 30, 'opened', reason FROM c WHERE was
UNION ALL SELECT 30, user_id, event_type, l3, b3, 30, NULL, 'opened', reason FROM c WHERE iss""")
def dimension_changes(t: Tables) -> DataFrame:
    """What two folds inserted, updated and deleted, as versions removed and opened."""
    dim, snapshots = _snapshots(t)
    fold(snapshots[10], dim, 10)
    fold(snapshots[30], dim, 30, complete=True)
    done = read_changes(t.spark, dim)
    moment = F.when(F.col("fold") == 1, 10).otherwise(30).alias("moment")
    return done.select(moment, *_KEYS, *_CHECK, "valid_from", "valid_to", "change", "reason")
