"""What to request: seasons, rounds, datasets and pages, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.keys import object_key, page_count, request_path
from smeltery.operators.extract import list_at, response_root
from smeltery.sources.registry import DATASETS, DEFAULT_LIMIT, FIRST_SEASON, RACES, SOURCE, catalog

SPRINT = "sprint"


def season_range(
    spark: SparkSession, as_of: str, start: int = FIRST_SEASON, end: int | None = None
) -> DataFrame:
    """Seasons to fill, flagged for refresh when they are the current one at ``as_of``.

    Without an end the last finished season closes the range.
    """
    current = int(as_of[:4])
    end = current - 1 if end is None else end
    if start > end:
        raise ValueError(f"start season {start} is after end season {end}")
    return spark.range(start, end + 1).select(
        F.col("id").cast("int").alias("season"), needs_refresh(F.col("id"), F.lit(current)).alias("force_refresh")
    )


def seasons_between(bounds: DataFrame, as_of: str) -> DataFrame:
    """As ``season_range``, with ``start`` and ``end`` taken from a one-row table."""
    each = bounds.select(F.explode(F.sequence(F.col("start").cast("int"), F.col("end").cast("int"))).alias("season"))
    return each.select("season", needs_refresh(F.col("season"), F.lit(int(as_of[:4]))).alias("force_refresh"))


def needs_refresh(season: Column, current: Column) -> Column:
    return season == current


def calendar(race_pages: DataFrame, body: str = "value") -> DataFrame:
    """Season, round and sprint flag of every race on the calendar pages."""
    parsed = race_pages.select(F.try_parse_json(body).alias("_document"))
    races = list_at(response_root("_document"), RACES)
    each = parsed.select(F.explode(F.expr(races)).alias("race"))
    return each.select(
        F.try_variant_get("race", "$.season", "int").alias("season"),
        F.try_variant_get("race", "$.round", "int").alias("round"),
        F.try_variant_get("race", "$.Sprint", "variant").isNotNull().alias("has_sprint"),
    )


def _described(work: DataFrame) -> DataFrame:
    # The registry is a fixed table of thirteen rows.
    known = F.broadcast(catalog(work.sparkSession))
    path = request_path(F.col("url_pattern"), F.col("season"), F.col("round"))
    return work.join(known, "endpoint").select(
        "phase", "season", "round", "endpoint", path.alias("request_path"), "paginated"
    )


def season_worklist(seasons: DataFrame) -> DataFrame:
    """Phases one and two: the datasets requested once per season, or once at all."""
    per_season = [d.name for d in DATASETS.values() if d.has_season and not d.has_round]
    once = [d.name for d in DATASETS.values() if not d.has_season]
    each = seasons.select("season", F.explode(F.array(*map(F.lit, per_season))).alias("endpoint"))
    single = seasons.sparkSession.createDataFrame([(n,) for n in once], "endpoint string")
    none = F.lit(None).cast("int")
    items = each.withColumn("round", none).unionByName(
        single.select(none.alias("season"), "endpoint", none.alias("round"))
    )
    return _described(items)


def round_worklist(rounds: DataFrame) -> DataFrame:
    """Phase four: every per-round dataset of every round, sprints only where one is held.

    The datasets are unfolded from a fixed list in each row, so no join pairs rounds with them.
    """
    names = [d.name for d in DATASETS.values() if d.has_round]
    wanted = F.array_compact(
        F.array(*(F.when(F.col("has_sprint"), F.lit(n)) if n == SPRINT else F.lit(n) for n in names))
    )
    return _described(rounds.select("season", "round", F.explode(wanted).alias("endpoint")))


def with_pages(work: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """One row per page to request, given ``total`` and ``paginated``: page number and offset."""
    pages = F.when(F.col("paginated"), page_count(F.col("total"), limit)).otherwise(F.lit(1).cast("long"))
    each = work.withColumn("page", F.explode(F.sequence(F.lit(1).cast("long"), pages)))
    return each.withColumn("offset", (F.col("page") - 1) * limit)


def with_keys(pages: DataFrame, batch_id: Column) -> DataFrame:
    key = object_key(
        SOURCE, F.col("endpoint"), batch_id, F.col("season"), F.col("round"), F.col("page")
    )
    return pages.withColumn("object_key", key)


def still_missing(pages: DataFrame, landed: DataFrame) -> DataFrame:
    """Pages not landed yet, plus the landed ones flagged ``force_refresh``."""
    done = landed.select("object_key").distinct()
    if "force_refresh" not in pages.columns:
        return pages.join(done, "object_key", "left_anti")
    forced = pages.where(F.col("force_refresh"))
    return forced.unionByName(pages.where(~F.col("force_refresh")).join(done, "object_key", "left_anti"))


def resume(landed: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Pages a broken-off batch still lacks, from the totals its landed pages reported."""
    item = ["endpoint", "season", "round", "batch_id"]
    totals = landed.groupBy(*item).agg(F.max("api_response_total").alias("total"))
    known = F.broadcast(catalog(landed.sparkSession).select("endpoint", "paginated"))
    wanted = with_keys(with_pages(totals.join(known, "endpoint"), limit), F.col("batch_id"))
    return still_missing(wanted, landed)


def new_rounds(rounds: DataFrame, processed: DataFrame) -> DataFrame:
    """Rounds after the last one processed in their season."""
    last = processed.groupBy("season").agg(F.max("round").alias("_last"))
    return (
        rounds.join(last, "season", "left")
        .where(F.col("round") > F.coalesce("_last", F.lit(0)))
        .drop("_last")
    )
