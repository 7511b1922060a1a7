"""Counters, tallies and run statuses, as aggregates over page and run tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOOD = ("ok", "empty")


def failed(verdict: Column) -> Column:
    return ~verdict.isin(*GOOD)


def tallies(verdicts: DataFrame, by: Sequence[str] = ("endpoint",)) -> DataFrame:
    """Pages and records that passed or failed, per group and in total (group NULL)."""
    bad = failed(F.col("verdict"))
    return verdicts.rollup(*by).agg(
        F.count_if(~bad).alias("succeeded"),
        F.count_if(bad).alias("failed"),
        F.count_if(F.col("verdict") == "empty").alias("empty"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("records"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_records"),
        run_status(F.count_if(bad)).alias("status"),
    )


def run_status(errors: Column, raised: Column | None = None) -> Column:
    status = F.when(errors == 0, "SUCCESS").otherwise("PARTIAL")
    return status if raised is None else F.when(raised, "FAILED").otherwise(status)


def run_counters(requests: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counters of a fetch log with ``outcome`` (written, skipped, error), ``bytes``, ``seconds``."""
    outcome = F.col("outcome")
    errors = F.count_if(outcome == "error")
    seconds = F.sum("seconds")
    return requests.groupBy(*by).agg(
        F.count_if(outcome == "written").alias("files_written"),
        F.count_if(outcome == "skipped").alias("files_skipped"),
        F.count_if(outcome != "skipped").alias("api_calls_made"),
        F.coalesce(F.sum(F.when(outcome == "written", F.col("bytes"))), F.lit(0)).alias("bytes_written"),
        errors.alias("errors_encountered"),
        run_status(errors).alias("status"),
        F.round(seconds, 2).alias("duration_seconds"),
        F.round(seconds / 60, 2).alias("duration_minutes"),
    )


def backfill_summary(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Seasons by outcome, and the list of those that failed (one entry per season)."""
    status = F.col("status")
    bad = F.collect_set(F.when(status == "FAILED", F.col("season")))
    return runs.groupBy(*by).agg(
        F.count_distinct("season").alias("total_seasons"),
        F.count_if(status == "SUCCESS").alias("successful_seasons"),
        F.count_if(status == "PARTIAL").alias("partial_seasons"),
        F.count_if(status == "FAILED").alias("failed_seasons"),
        F.sort_array(bad).alias("failed_season_list"),
    )
