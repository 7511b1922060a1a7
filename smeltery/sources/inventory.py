"""What has landed, object by object, and how two inventories of it differ.

An object is a page. Its inventory row holds the name, the file it lies in with that file's size and
time, the size and checksum of its content, and its tags. Files whose size and time are those of an
earlier inventory are not read again: their rows are taken over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.sources.bronze import dataset_path, manifest, read_pages
from smeltery.sources.models import Dataset
from smeltery.sources.tables import written

TAGS = ("batch_id", "endpoint", "ingestion_timestamp", "season", "round", "page")
_FILE = ("file_path", "file_size", "modified_at")


def landed_files(spark: SparkSession, base: str, spec: Dataset, season: int | None = None) -> DataFrame:
    """Path, size and time of the landed files, from the listing; no content is read."""
    raw = (
        spark.read.format("binaryFile")
        .option("basePath", dataset_path(base, spec))
        .option("recursiveFileLookup", "false")
        .load(dataset_path(base, spec, season))
    )
    places = {"file_path": "file_path", "file_size": "file_size", "modified_at": "file_modification_time"}
    return raw.select(*(F.col(f"_metadata.{source}").alias(name) for name, source in places.items()))


def object_inventory(
    spark: SparkSession,
    base: str,
    spec: Dataset,
    season: int | None = None,
    known: DataFrame | None = None,
    whole_files: bool = False,
) -> DataFrame:
    """One row per landed page: ``object_key, size, digest, etag, tags`` and its file's path, size and time.

    ``known`` is an earlier inventory: rows of files with the size and time they had then are taken over,
    and files older than every other file are not opened. ``etag`` is the checksum in hexadecimal, ``digest``
    the same in base 64; tags without a value are left out.
    """
    files = written(landed_files(spark, base, spec, season), "files")
    fresh, since = files, None
    if known is not None:
        fresh = written(files.join(known.select(*_FILE).distinct(), list(_FILE), "left_anti"), "fresh-files")
        since = fresh.agg(F.min("modified_at")).first()[0]
    listed = manifest(read_pages(spark, base, spec, season, whole_files, since), spec)
    named = [x for t in TAGS for x in (F.lit(t), F.col(t).cast("string"))]
    rows = listed.select(
        "object_key",
        "size",
        "digest",
        F.lower(F.hex(F.unbase64("digest"))).alias("etag"),
        F.map_filter(F.create_map(*named), lambda _, v: v.isNotNull()).alias("tags"),
        F.col("_file_path").alias("file_path"),
    ).join(fresh, "file_path")
    if known is None:
        return rows
    kept = known.join(files, list(_FILE), "left_semi").select(*rows.columns)
    return kept if since is None else kept.unionByName(rows)


def inventory_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Every object of two inventories: ``object_key, change`` (added, lost, altered or same) and sizes.

    Altered are objects whose content has another checksum, wherever it lies; an object landed twice
    under one name is compared in the order of its checksums.
    """
    def numbered(inventory: DataFrame) -> DataFrame:
        nth = F.expr("row_number() OVER (PARTITION BY object_key ORDER BY digest)").alias("nth")
        return inventory.select("object_key", nth, "size", "digest")

    b, a = numbered(before).alias("b"), numbered(after).alias("a")
    match = (F.col("b.object_key") == F.col("a.object_key")) & (F.col("b.nth") == F.col("a.nth"))
    change = (
        F.when(F.col("b.digest").isNull(), "added")
        .when(F.col("a.digest").isNull(), "lost")
        .when(F.col("b.digest") != F.col("a.digest"), "altered")
        .otherwise("same")
    )
    return b.join(a, match, "full_outer").select(
        F.coalesce("a.object_key", "b.object_key").alias("object_key"),
        change.alias("change"),
        F.col("b.size").alias("size_before"),
        F.col("a.size").alias("size_after"),
    )


def existing(inventory: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (with ``object_key``) and whether each object ``exists``."""
    held = inventory.select("object_key", F.lit(True).alias("_held")).distinct()
    return wanted.join(held, "object_key", "left").withColumn("exists", F.col("_held").isNotNull()).drop("_held")
