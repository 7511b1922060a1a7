"""Staging view of the season list, straight from the Bronze pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.functions.coerce import best_effort_timestamp
from smeltery.functions.documents import json_array, json_raw, json_string


def staged(
    pages: DataFrame, list_path: tuple[str, ...], columns: dict[str, str], required: str
) -> DataFrame:
    """Envelope metadata and one row per listed object, projected to text columns by JSON name.

    Objects of an empty list vanish, as do those whose ``required`` column is missing or empty.
    """
    parsed = pages.select(
        json_string(F.col("value"), "metadata", "batch_id").alias("batch_id"),
        best_effort_timestamp(
            json_string(F.col("value"), "metadata", "ingestion_timestamp"), strict=True
        ).alias("ingestion_timestamp"),
        F.col("_file_path").alias("file_path"),
        json_raw(F.col("value"), "data", "MRData").alias("_response"),
    )
    each = parsed.select(
        "batch_id", "ingestion_timestamp", "file_path", F.explode(json_array(F.col("_response"), *list_path)).alias("_item")
    )
    named = each.select(
        *(json_string(F.col("_item"), source).alias(name) for name, source in columns.items()),
        "batch_id",
        "ingestion_timestamp",
        "file_path",
    )
    return named.where(F.col(required) != "")


def season_view(pages: DataFrame) -> DataFrame:
    return staged(
        pages, ("SeasonTable", "Seasons"), {"season_year": "season", "season_url": "url"}, "season_year"
    )
