"""Silver to Gold: the twelve documented tables, built from the engine's own Silver and written."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.coerce import null_if_blank
from smeltery.plans import gold
from smeltery.plans.side_by_side import AT_ONCE, side_by_side
from smeltery.session import shuffles_freed
from smeltery.sources.bronze import dataset_path
from smeltery.sources.registry import DATASETS
from smeltery.sources.silver import read_silver
from smeltery.sources.tables import exists

# The Silver datasets each table is built from; those behind the bar are taken if they are there.
SOURCES: dict[str, tuple[str, ...]] = {
    "dim_seasons": ("seasons",),
    "dim_status": ("status",),
    "dim_races": ("races",),
    "dim_drivers": ("drivers", "|", "results"),
    "dim_constructors": ("constructors",),
    "dim_circuits": ("circuits",),
    "fact_qualifying_results": ("qualifying",),
    "fact_lap_times": ("laps",),
    "fact_pit_stops": ("pitstops",),
    "fact_sprint_results": ("sprint",),
    "fact_race_results": ("results", "races", "status"),
    "agg_driver_season_stats": ("results", "races", "status", "|", "qualifying", "sprint"),
    "agg_constructor_season_stats": ("results", "races", "status", "|", "sprint"),
    "agg_fastest_laps_by_circuit": ("results", "races", "status"),
}
_ORDER = {
    "fact_race_results": ["driver_id"],
    "fact_sprint_results": ["driver_id"],
    "fact_qualifying_results": ["driver_id"],
    "fact_lap_times": ["driver_id", "lap_number"],
    "fact_pit_stops": ["driver_id", "stop_number"],
}


def _decade() -> Column:
    """Seasons of a key that share a chunk of its history, which one task holds."""
    return F.floor(F.col("season") / 10)


def _stored(frame: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> DataFrame:
    """Write a table and read it back, so what follows knows its size."""
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _fact(frame: DataFrame, path: str, name: str) -> DataFrame:
    gold.write_fact(frame, path, _ORDER[name], gathered=True)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def sprint_results(sprint: DataFrame) -> DataFrame:
    """Sprint results with the columns that scoring needs."""
    return sprint.select(
        "season",
        "round",
        F.col("driver_driver_id").alias("driver_id"),
        F.col("constructor_constructor_id").alias("constructor_id"),
        F.col("position").alias("final_position"),
        F.col("points").cast(gold.POINTS).alias("points"),
    )


def buildable(spark: SparkSession, silver: str) -> list[str]:
    """The tables for which Silver holds what they need."""
    there = {name for name, spec in DATASETS.items() if exists(spark, dataset_path(silver, spec))}
    needed = {t: s[: s.index("|")] if "|" in s else s for t, s in SOURCES.items()}
    return [table for table, sources in needed.items() if set(sources) <= there]


def build_gold(
    spark: SparkSession, silver: str, target: str, tables: Iterable[str] | None = None, at_once: int = AT_ONCE
) -> dict[str, DataFrame]:
    """Build Gold tables below ``target`` and return them by name; by default all that can be built.

    Dimensions keep their versions by season, ``valid_from`` being the first season of each. Facts lie by
    season and round; of these, partitions present in Silver are replaced. Tables that do not need each
    other are built side by side: first those from Silver alone, then the race results, whose look-ups
    are then tables of known size, then what is summed up from facts.
    """
    with shuffles_freed(spark):
        return _built(spark, silver, target, tables, at_once)


def _built(
    spark: SparkSession, silver: str, target: str, tables: Iterable[str] | None, at_once: int
) -> dict[str, DataFrame]:
    can = buildable(spark, silver)
    wanted = list(tables or can)
    missing = [t for t in wanted if t not in can]
    if missing:
        raise ValueError(f"Silver lacks what these need: {', '.join(missing)}")
    # Facts and look-ups that a wanted table is made from are built as well.
    below = {
        "fact_race_results": ("dim_races", "dim_status"),
        "agg_driver_season_stats": ("fact_race_results", "dim_races", "dim_status", "fact_qualifying_results", "fact_sprint_results"),
        "agg_constructor_season_stats": ("fact_race_results", "dim_races", "dim_status", "fact_sprint_results"),
        "agg_fastest_laps_by_circuit": ("fact_race_results", "dim_races", "dim_status"),
    }
    names = set(wanted) | {b for t in wanted for b in below.get(t, ()) if b in can}

    def of(name: str) -> DataFrame:
        return read_silver(spark, silver, DATASETS[name])

    def gathered(name: str) -> DataFrame:
        """Rows gathered as their fact will lie: without its surrogate keys, which are most of it."""
        return of(name).hint("rebalance", "season", "round")

    def path(name: str) -> str:
        return f"{target}/{name}"

    def drivers() -> DataFrame:
        has_results = exists(spark, dataset_path(silver, DATASETS["results"]))
        snapshots = gold.driver_snapshots(of("drivers"), of("results") if has_results else None)
        return gold.dim_drivers(snapshots, "season", _decade())

    def constructors() -> DataFrame:
        named = of("constructors").select("constructor_id", "name", null_if_blank(F.col("nationality")).alias("nationality"), "season")
        return gold.dim_constructors(named, "season", _decade())

    races = ["season", "round", "race_name", "date", "circuit_circuit_id"]
    first: dict[str, Callable[[], DataFrame]] = {
        "dim_seasons": lambda: _stored(gold.dim_seasons(of("seasons")), path("dim_seasons")),
        "dim_status": lambda: _stored(gold.dim_status(of("status")), path("dim_status")),
        "dim_races": lambda: _stored(of("races").select(*races), path("dim_races"), ("season",)),
        "dim_drivers": lambda: _stored(drivers(), path("dim_drivers")),
        "dim_constructors": lambda: _stored(constructors(), path("dim_constructors")),
        "dim_circuits": lambda: _stored(gold.dim_circuits(gold.circuit_snapshots(of("circuits")), "season", _decade()), path("dim_circuits")),
        "fact_qualifying_results": lambda: _fact(
            gold.fact_qualifying_results(gathered("qualifying")), path("fact_qualifying_results"), "fact_qualifying_results"
        ),
        "fact_lap_times": lambda: _fact(gold.fact_lap_times(gathered("laps")), path("fact_lap_times"), "fact_lap_times"),
        "fact_pit_stops": lambda: _fact(gold.fact_pit_stops(gathered("pitstops")), path("fact_pit_stops"), "fact_pit_stops"),
        "fact_sprint_results": lambda: _fact(sprint_results(gathered("sprint")), path("fact_sprint_results"), "fact_sprint_results"),
    }
    done = side_by_side(spark, {n: job for n, job in first.items() if n in names}, at_once)
    if "fact_race_results" not in names:
        return done
    fact = gold.fact_race_results(gathered("results"), done["dim_races"], done["dim_status"])
    done["fact_race_results"] = facts = _fact(fact, path("fact_race_results"), "fact_race_results")
    sprints = done.get("fact_sprint_results")
    qualifying = done.get("fact_qualifying_results")
    if qualifying is None:
        qualifying = facts.limit(0)
    last: dict[str, Callable[[], DataFrame]] = {
        "agg_driver_season_stats": lambda: _stored(
            gold.driver_season_stats(facts, qualifying, sprints), path("agg_driver_season_stats"), ("season",)
        ),
        "agg_constructor_season_stats": lambda: _stored(
            gold.constructor_season_stats(facts, sprints), path("agg_constructor_season_stats"), ("season",)
        ),
        "agg_fastest_laps_by_circuit": lambda: _stored(
            gold.fastest_laps_by_circuit(facts), path("agg_fastest_laps_by_circuit")
        ),
    }
    jobs = {n: job for n, job in last.items() if n in names}
    return done | (side_by_side(spark, jobs, at_once) if jobs else {})
