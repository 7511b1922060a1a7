"""Gold: dimensions, facts and aggregates over the Silver tables.

Silver frames carry ``season`` and ``round`` next to their own columns. Joins name no strategy:
dimension tables stay under the planner's broadcast threshold or are shuffled like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.functions.coerce import duration_ms, iso_date, null_if_blank
from smeltery.functions.keys import surrogate_key
from smeltery.operators.dedupe import latest_by_key
from smeltery.operators.history import history
from smeltery.operators.ordered import descending_rank
from smeltery.sources.tables import remove, written

POINTS = "decimal(18,2)"


# --- dimensions ---


def driver_snapshots(drivers: DataFrame, teams: DataFrame | None = None) -> DataFrame:
    """Snapshot columns of a driver; the team, which driver records lack, from results if given."""
    named = drivers.select(
        "driver_id",
        F.concat_ws(" ", "given_name", "family_name").alias("name"),
        null_if_blank(F.col("nationality")).alias("nationality"),
        iso_date(F.col("date_of_birth")).alias("dob"),
        "season",
        *[c for c in ("snapshot_at",) if c in drivers.columns],
    )
    if teams is None:
        return named
    last = F.max_by("constructor_constructor_id", F.struct("round", "constructor_constructor_id"))
    # Texts are aggregated by sorting: dealt by key first, no task sorts all of a file it reads. A key's rows
    # are bounded by the calendar, and what follows needs the same distribution.
    dealt = teams.withColumn("driver_id", F.col("driver_driver_id")).repartition("driver_id", "season")
    team = dealt.groupBy("driver_id", "season").agg(last.alias("constructor_id"))
    return named.join(team, ["driver_id", "season"], "left")


def dim_drivers(snapshots: DataFrame, at: str, chunk: Column, tie: list[str] | None = None) -> DataFrame:
    check = [c for c in ("name", "nationality", "constructor_id") if c in snapshots.columns]
    return history(snapshots, ["driver_id"], check, at, chunk, tie)


def dim_constructors(snapshots: DataFrame, at: str, chunk: Column, tie: list[str] | None = None) -> DataFrame:
    return history(snapshots, ["constructor_id"], ["name", "nationality"], at, chunk, tie)


def circuit_snapshots(circuits: DataFrame) -> DataFrame:
    return circuits.select(
        "circuit_id",
        "name",
        F.col("location_locality").alias("location"),
        F.col("location_country").alias("country"),
        F.col("location_lat").alias("lat"),
        F.col("location_long").alias("lng"),
        *[c for c in ("season", "snapshot_at") if c in circuits.columns],
    )


def dim_circuits(snapshots: DataFrame, at: str, chunk: Column, tie: list[str] | None = None) -> DataFrame:
    check = ["name", "location", "country", "lat", "lng"]
    return history(snapshots, ["circuit_id"], check, at, chunk, tie)


def dim_seasons(seasons: DataFrame) -> DataFrame:
    latest = latest_by_key(seasons, ["season"], ["batch_id", "page", "_record_index"])
    return latest.select(
        surrogate_key(F.col("season")).alias("season_id"), F.col("season").alias("year"), "url"
    )


def dim_status(status: DataFrame) -> DataFrame:
    latest = latest_by_key(status, ["status_id"], ["batch_id", "page", "_record_index"])
    return latest.select("status_id", "status", F.col("status").alias("description"))


# --- facts ---


def _entry_key(results: DataFrame) -> Column:
    """A driver may hold two results of one race, in shared cars: number and position tell them apart."""
    own = [c for c in ("number", "position") if c in results.columns]
    return surrogate_key(*(F.col(c) for c in ("season", "round", "driver_driver_id", *own)))


def fact_race_results(results: DataFrame, races: DataFrame, status: DataFrame) -> DataFrame:
    """Results carry the status as text and no circuit, so both keys come from look-ups.

    Hand in look-ups that are tables of their own, read from files: their size is then known, and the
    planner broadcasts them, if small, instead of shuffling the results on a few keys.
    """
    circuits = races.select("season", "round", F.col("circuit_circuit_id").alias("circuit_id"))
    codes = status.select("status", "status_id")
    joined = results.join(circuits, ["season", "round"], "left").join(codes, "status", "left")
    return joined.select(
        _entry_key(results).alias("result_id"),
        "season",
        "round",
        F.col("driver_driver_id").alias("driver_id"),
        F.col("constructor_constructor_id").alias("constructor_id"),
        "circuit_id",
        F.col("grid").alias("grid_position"),
        F.col("position").alias("final_position"),
        F.col("points").cast(POINTS).alias("points"),
        F.col("laps").alias("laps_completed"),
        "status_id",
        duration_ms(F.col("fastest_lap_time_time")).alias("fastest_lap_time"),
        F.col("fastest_lap_rank").alias("fastest_lap_rank"),
    )


def fact_qualifying_results(qualifying: DataFrame) -> DataFrame:
    return qualifying.select(
        _entry_key(qualifying).alias("qualifying_id"),
        "season",
        "round",
        F.col("driver_driver_id").alias("driver_id"),
        F.col("constructor_constructor_id").alias("constructor_id"),
        *(duration_ms(F.col(q)).alias(f"{q}_time") for q in ("q1", "q2", "q3")),
        F.col("position").alias("final_position"),
    )


def fact_lap_times(laps: DataFrame) -> DataFrame:
    timed = laps.where(F.col("timings_driver_id").isNotNull())
    return timed.select(
        surrogate_key(
            F.col("season"), F.col("round"), F.col("timings_driver_id"), F.col("number")
        ).alias("lap_id"),
        "season",
        "round",
        F.col("timings_driver_id").alias("driver_id"),
        F.col("number").alias("lap_number"),
        duration_ms(F.col("timings_time")).alias("lap_time_ms"),
    )


def fact_pit_stops(stops: DataFrame) -> DataFrame:
    return stops.select(
        surrogate_key(F.col("season"), F.col("round"), F.col("driver_id"), F.col("stop")).alias("pitstop_id"),
        "season",
        "round",
        "driver_id",
        "lap",
        F.col("stop").alias("stop_number"),
        duration_ms(F.col("duration")).alias("duration_ms"),
    )


# --- aggregates ---


def _scores(results: DataFrame, sprints: DataFrame | None, entity: str) -> DataFrame:
    """Totals per season and entity; sprint points count when sprint results are given."""
    rows = results.select(
        "season", "round", entity, F.col("final_position").alias("place"), "points", F.lit(True).alias("_race")
    )
    if sprints is not None:
        extra = sprints.select(
            "season", "round", entity, F.col("final_position").alias("place"), "points", F.lit(False).alias("_race")
        )
        rows = rows.unionByName(extra)
    race = F.col("_race")
    # First per round: what is left per season and entity is bounded by the calendar, which keeps
    # the distinct count of rounds cheap and a hot entity harmless.
    per_round = rows.groupBy("season", entity, "round").agg(
        F.sum(F.col("points").cast(POINTS)).alias("points"),
        F.count_if(race).alias("starts"),
        F.count_if(race & (F.col("place") == 1)).alias("wins"),
        F.count_if(race & (F.col("place") <= 3)).alias("podiums"),
    )
    return per_round.groupBy("season", entity).agg(
        F.coalesce(F.sum("points"), F.lit(0)).cast("decimal(38,2)").alias("total_points"),
        F.sum("starts").alias("starts"),
        F.count_if(F.col("starts") > 0).alias("rounds"),
        F.sum("wins").alias("wins"),
        F.sum("podiums").alias("podiums"),
    )


def driver_season_stats(
    results: DataFrame, qualifying: DataFrame, sprints: DataFrame | None = None
) -> DataFrame:
    """Points, races, wins, podiums and poles of every driver and season."""
    poles = (
        qualifying.where(F.col("final_position") == 1)
        .groupBy("season", "driver_id")
        .agg(F.count(F.lit(1)).alias("poles"))
    )
    scored = _scores(results, sprints, "driver_id").join(poles, ["season", "driver_id"], "left")
    return scored.select(
        "season",
        "driver_id",
        "total_points",
        F.col("starts").alias("races"),
        "wins",
        "podiums",
        F.coalesce("poles", F.lit(0)).alias("poles"),
    )


def constructor_season_stats(results: DataFrame, sprints: DataFrame | None = None) -> DataFrame:
    """As for drivers, but a race counts once however many cars a team enters."""
    return _scores(results, sprints, "constructor_id").select(
        "season", "constructor_id", "total_points", F.col("rounds").alias("races"), "wins", "podiums"
    )


def fastest_laps_by_circuit(results: DataFrame) -> DataFrame:
    """The quickest lap ever on each circuit; ties go to the earliest, then the driver's name."""
    rank = F.struct("fastest_lap_time", "season", "round", "driver_id")
    # No filter on the time: where it is computed it would be computed once more for the filter.
    timed = F.min(F.when(F.col("fastest_lap_time").isNotNull(), rank))
    best = results.where(F.col("circuit_id").isNotNull()).groupBy("circuit_id").agg(timed.alias("_best"))
    return best.where(F.col("_best").isNotNull()).select(
        "circuit_id",
        F.col("_best.driver_id").alias("driver_id"),
        F.col("_best.fastest_lap_time").alias("fastest_time"),
        F.col("_best.season").alias("season"),
        F.col("_best.round").alias("round"),
    )


def standings_by_round(
    results: DataFrame, entity: str = "driver_id"
) -> DataFrame:
    """Points, wins and rank of every entity after every round, from its first one on.

    A round an entity sat out repeats its last totals.
    """
    per_round = results.groupBy("season", entity, "round").agg(
        F.sum(F.col("points").cast(POINTS)).alias("points"),
        F.count_if(F.col("final_position") == 1).alias("wins"),
    )
    # Rows per season and entity are bounded by the calendar here, so plain windows are safe.
    so_far = Window.partitionBy("season", entity).orderBy("round")
    last = results.groupBy("season").agg(F.max("round").alias("_last"))
    totals = per_round.select(
        "season",
        entity,
        "round",
        F.sum("points").over(so_far).alias("points"),
        F.sum("wins").over(so_far).alias("wins"),
        F.lead("round").over(so_far).alias("_next"),
    )
    spread = totals.join(last, "season").select(
        "season",
        entity,
        F.explode(F.sequence("round", F.coalesce(F.col("_next") - 1, F.col("_last")))).alias("round"),
        "points",
        "wins",
    )
    return descending_rank(spread, ["season", "round"], ["points", "wins"], "position")


def standings_mismatches(computed: DataFrame, published: DataFrame, entity: str = "driver_id") -> DataFrame:
    """Entities whose computed points after a round differ from the published table."""
    theirs = published.select(
        "season", "round", F.col(entity), F.col("points").cast(POINTS).alias("published_points")
    )
    both = computed.join(theirs, ["season", "round", entity], "full_outer")
    return both.where(~F.col("points").cast(POINTS).eqNullSafe(F.col("published_points")))


# --- layout and refresh ---


def write_fact(fact: DataFrame, path: str, order: list[str], gathered: bool = False) -> None:
    """Partition by season and round, sorted inside for tight row-group statistics.

    A fact made from rows that are ``gathered`` by season and round is written by the tasks that have it.
    """
    keys = ["season", "round"]
    frame = (fact if gathered else fact.hint("rebalance", *keys)).sortWithinPartitions(*keys, *order)
    # Most of a fact are surrogate keys in hexadecimal digits, which this packs to half.
    writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy(*keys).parquet(path)


def refresh_aggregate(fact: DataFrame, changed: DataFrame, keys: list[str], aggregate, path: str) -> None:
    """Recompute an aggregate for the changed partitions only and overwrite just those.

    A fact stored by ``keys`` is pruned to the changed partitions while the job runs. A changed partition
    in which the fact has no rows any more loses its folder. ``keys`` may not be null.
    """
    spark = fact.sparkSession
    # Written, so that its size is known; the comparison is what makes the planner prune by it.
    marked = written(changed.select(*keys).distinct().withColumn("_changed", F.lit(1)), "changed").where("_changed > 0")
    touched = fact.join(marked.select(*keys), keys, "left_semi")
    writer = aggregate(touched).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)
    emptied = marked.select(*keys).join(touched.select(*keys).distinct(), keys, "left_anti")
    for row in emptied.collect():  # at most the changed partitions
        remove(spark, "/".join([path, *(f"{k}={row[k]}" for k in keys)]))


def bucketed_fact(fact: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A fact as a catalog table at a path of its own, bucketed and sorted by its join keys.

    Tables of as many buckets on the same keys join without a shuffle. Each bucket is one file, as the
    rows are dealt to buckets before they are written.
    """
    dealt = fact.repartition(buckets, *keys)
    writer = dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    return fact.sparkSession.table(name)


def results_with_qualifying(results: DataFrame, qualifying: DataFrame) -> DataFrame:
    """Every result with the driver's qualifying of the race, if there was one."""
    keys = ["season", "round", "driver_id"]
    grid = qualifying.select(*keys, F.col("final_position").alias("qualifying_position"), *(f"q{n}_time" for n in (1, 2, 3)))
    return results.join(grid, keys, "left")
