"""Checks over landed pages and finished tables, each giving a table of findings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions.documents import has_items
from smeltery.operators.extract import leaf_items
from smeltery.operators.validate import reported_total, response_text
from smeltery.sources.models import Dataset
from smeltery.sources.registry import DEFAULT_LIMIT

WARN_AFTER_DAYS = 7
ERROR_AFTER_DAYS = 14


class CorruptPagesError(RuntimeError):
    """Pages that report records but carry none; never skipped, whatever the error mode."""


def page_payloads(pages: DataFrame, spec: Dataset, body: str = "value") -> DataFrame:
    """Add ``reported`` (total the API claims), ``items`` (records present) and ``severity``.

    ``corrupt``: records reported, but no list of the response holds anything. ``incomplete``: some
    list does, yet none at the dataset's own path.
    """
    measured = pages.withColumn("_document", F.try_parse_json(body)).select(
        *[c for c in pages.columns if c != body],
        reported_total(body).alias("reported"),
        F.expr(leaf_items("_document", spec)).cast("long").alias("items"),
        # The text is only searched for other lists where the record list is empty.
        response_text(body).alias("_response"),
    )
    severity = (
        F.when((F.col("reported") <= 0) | (F.col("items") > 0), "ok")
        .when(has_items(F.col("_response")), "incomplete")
        .otherwise("corrupt")
    )
    return measured.withColumn("severity", severity).drop("_response")


def require_no_corruption(payloads: DataFrame) -> None:
    found = payloads.where(F.col("severity") == "corrupt").limit(3).collect()
    if found:
        raise CorruptPagesError(f"pages report records but hold none, e.g. {found}")


def reconcile(payloads: DataFrame, item: Sequence[str], limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Work items whose landed records do not add up to the total the API reported."""
    sums = payloads.groupBy(*item).agg(
        F.max("reported").alias("reported"),
        F.sum("items").alias("items"),
        F.count_distinct("page").alias("pages"),
    )
    expected = F.greatest(F.ceil(F.col("reported") / limit), F.lit(1)).cast("long")
    return sums.withColumn("expected_pages", expected).where(F.col("reported") != F.col("items"))


def freshness(
    table: DataFrame,
    loaded_at: str,
    as_of: Column,
    by: Sequence[str] = (),
    warn_days: int = WARN_AFTER_DAYS,
    error_days: int = ERROR_AFTER_DAYS,
) -> DataFrame:
    """Age of the newest row, judged: ``pass``, ``warn`` or ``error``."""
    newest = table.groupBy(*by).agg(F.max(loaded_at).alias("newest"))
    age = (as_of.cast("timestamp").cast("double") - F.col("newest").cast("double")) / 86400
    status = F.when(age > error_days, "error").when(age > warn_days, "warn").otherwise("pass")
    return newest.select(*by, "newest", F.coalesce(status, F.lit("error")).alias("status"))


def _finding(name: str, column: str, failures: DataFrame) -> DataFrame:
    return failures.select(
        F.lit(name).alias("check"), F.lit(column).alias("target"), F.col("failures").cast("long")
    )


def unique_key(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    repeated = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _finding("unique", ",".join(keys), repeated.agg(F.count(F.lit(1)).alias("failures")))


def not_null(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass over the table for all columns."""
    counts = table.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    each = counts.select(F.explode(F.create_map(*(p for c in columns for p in (F.lit(c), F.col(c))))))
    return each.select(
        F.lit("not_null").alias("check"), F.col("key").alias("target"), F.col("value").alias("failures")
    )


def references(table: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key has no parent; NULL refers to nothing and passes."""
    used = table.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    orphans = used.join(parent.select(F.col(key).alias(column)), column, "left_anti")
    return _finding("references", column, orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures")))


def all_findings(*findings: DataFrame) -> DataFrame:
    """One table of every check; a check passes with no failures."""
    table = reduce(DataFrame.unionByName, findings)
    return table.withColumn("passed", F.col("failures") == 0)
