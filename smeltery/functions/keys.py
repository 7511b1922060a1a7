"""Keys, object names and other small derived texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def padded(number: Column, width: int) -> Column:
    return F.when(number.isNotNull(), F.format_string(f"%0{width}d", number.cast("long")))


def page_count(total: Column, limit: int) -> Column:
    """Pages needed for ``total`` records; an empty result still has one page."""
    pages = F.floor((total.cast("long") + F.lit(limit - 1)) / F.lit(limit)).cast("long")
    return F.when(F.coalesce(total, F.lit(0)) <= 0, F.lit(1).cast("long")).otherwise(pages)


def object_key(
    source: str, endpoint: Column, batch_id: Column, season: Column, round_: Column, page: Column
) -> Column:
    """Hive-style name of one page; season and round are left out where they are NULL."""
    return F.concat_ws(
        "/",
        F.lit(source),
        F.concat(F.lit("endpoint="), endpoint),
        F.concat(F.lit("season="), season.cast("string")),
        F.concat(F.lit("round="), padded(round_, 2)),
        F.concat(F.lit("batch_id="), batch_id),
        F.concat(F.lit("page_"), padded(page, 3), F.lit(".json")),
    )


def parquet_key(key: Column) -> Column:
    return F.replace(key, F.lit(".json"), F.lit(".parquet"))


def request_path(pattern: Column, season: Column, round_: Column) -> Column:
    """Fill ``{season}`` and ``{round}`` in a URL pattern; NULL becomes the empty text."""
    filled = F.replace(pattern, F.lit("{season}"), F.coalesce(season.cast("string"), F.lit("")))
    return F.replace(filled, F.lit("{round}"), F.coalesce(round_.cast("string"), F.lit("")))


def surrogate_key(*columns: Column) -> Column:
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def content_digest(text: Column) -> Column:
    return F.base64(F.unhex(F.md5(text)))


def seconds_to_minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60), 2)
