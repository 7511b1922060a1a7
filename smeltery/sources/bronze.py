"""Bronze: enveloped JSON pages in a Hive-style layout, written and read as text.

A page is one line of a gzip text file (several pages may share a file, which keeps file counts
sane at scale) or, as single-page landings leave it, a whole file; the reader takes both.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.functions.keys import content_digest, object_key, padded
from smeltery.sources.models import Dataset
from smeltery.sources.registry import SOURCE
from smeltery.sources.tables import exists

FILE_VERSION = "1.0"
PAGES_PER_FILE = 20000


def envelope(
    endpoint: Column,
    season: Column,
    round_: Column,
    batch_id: Column,
    page: Column,
    ingested_at: Column,
    total: Column,
    body: Column,
    source_url: Column | None = None,
    force_refresh: Column | None = None,
) -> Column:
    """One-line JSON text of ``{"metadata": ..., "data": <body>}``."""
    metadata = F.struct(
        ingested_at.cast("string").alias("ingestion_timestamp"),
        batch_id.alias("batch_id"),
        endpoint.alias("endpoint"),
        season.cast("int").alias("season"),
        round_.cast("int").alias("round"),
        page.cast("int").alias("page"),
        (F.lit("") if source_url is None else source_url).alias("source_url"),
        total.cast("long").alias("api_response_total"),
        F.lit(FILE_VERSION).alias("file_version"),
        (F.lit(False) if force_refresh is None else force_refresh).alias("force_refresh"),
    )
    text = F.to_json(metadata, {"ignoreNullFields": "false"})
    # A raw line break can only be blank space between JSON tokens.
    return F.concat(
        F.lit('{"metadata":'), text, F.lit(',"data":'), F.regexp_replace(body, r"[\r\n]+", " "), F.lit("}")
    )


def dataset_path(base: str, spec: Dataset, season: int | None = None) -> str:
    path = f"{base.rstrip('/')}/{SOURCE}/endpoint={spec.name}"
    return f"{path}/season={season}" if season is not None and spec.has_season else path


def season_paths(spark: SparkSession, base: str, spec: Dataset, season: int | Sequence[int] | None) -> list[str]:
    """The folders of some seasons; of several, those that exist (at least one is named)."""
    if season is None or isinstance(season, int) or not spec.has_season:
        return [dataset_path(base, spec, season if isinstance(season, int) else None)]
    named = [dataset_path(base, spec, s) for s in season]
    return [p for p in named if exists(spark, p)] or named[:1]


def land(
    pages: DataFrame,
    base: str,
    spec: Dataset,
    mode: str = "append",
    pages_per_file: int = PAGES_PER_FILE,
    dealt: bool = False,
) -> None:
    """Write ``season, round, batch_id, value`` rows of one dataset below its partition folders.

    ``mode='overwrite'`` replaces just the partitions present in ``pages``. Pages that are ``dealt`` by ranges of
    their folder are written by the tasks that have them.
    """
    outputs = {
        "season": F.col("season").cast("string").alias("season"),
        "round": padded(F.col("round"), 2).alias("round"),
    }
    keys = [*spec.partitions, "batch_id"]
    frame = pages.select("value", *(outputs[k] for k in spec.partitions), "batch_id")
    # Rebalancing gathers a folder's pages into few files but still splits a folder that is large. With a file
    # for every page there is nothing to gather: the tasks that have the pages share the files out.
    gathered = frame if dealt or pages_per_file == 1 else frame.hint("rebalance", *keys)
    writer = gathered.write.mode(mode).partitionBy(*keys)
    writer = writer.option("compression", "gzip").option("maxRecordsPerFile", pages_per_file)
    writer.option("partitionOverwriteMode", "dynamic").text(dataset_path(base, spec))


def read_pages(
    spark: SparkSession,
    base: str,
    spec: Dataset,
    season: int | Sequence[int] | None = None,
    whole_files: bool = False,
    since: datetime | None = None,
) -> DataFrame:
    """Pages of one dataset: path keys, page number, file path and the JSON text ``value``.

    Only the folders of the season, or of those seasons that have one, are listed; of these, with
    ``since``, only files changed at that moment or later are opened. Path keys are declared as text, so a batch of digits or a
    zero-padded round is not guessed to be a number.
    """
    declared = ", ".join(f"{c} string" for c in ("value", *spec.partitions, "batch_id"))
    raw = (
        spark.read.schema(declared)
        .option("basePath", dataset_path(base, spec))
        .option("recursiveFileLookup", "false")
        .text(season_paths(spark, base, spec, season), wholetext=whole_files)
    )
    if since is not None:
        raw = raw.where(F.col("_metadata.file_modification_time") >= F.lit(since))
    path = F.col("_metadata.file_path")
    in_name = F.regexp_extract(path, r"page_(\d+)\.json", 1).try_cast("int")
    in_text = F.get_json_object("value", "$.metadata.page").try_cast("int")
    keys = [
        F.col(k).try_cast("int").alias(f"_p_{k}") if k in spec.partitions else F.lit(None).cast("int").alias(f"_p_{k}")
        for k in ("season", "round")
    ]
    page = F.coalesce(in_name, in_text, F.lit(1)).alias("page")
    return raw.select(*keys, "batch_id", page, path.alias("_file_path"), "value")


def manifest(pages: DataFrame, spec: Dataset) -> DataFrame:
    """One row per landed page: object name, tags, size, checksum and the total it reported."""
    key = object_key(
        SOURCE, F.lit(spec.name), F.col("batch_id"), F.col("_p_season"), F.col("_p_round"), F.col("page")
    )
    return pages.select(
        key.alias("object_key"),
        F.lit(spec.name).alias("endpoint"),
        F.col("_p_season").alias("season"),
        F.col("_p_round").alias("round"),
        "batch_id",
        "page",
        F.get_json_object("value", "$.metadata.ingestion_timestamp").alias("ingestion_timestamp"),
        F.octet_length("value").cast("long").alias("size"),
        content_digest(F.col("value")).alias("digest"),
        F.get_json_object("value", "$.metadata.api_response_total").try_cast("long").alias("api_response_total"),
        "_file_path",
    )


def list_keys(listed: DataFrame, prefix: str = "", max_keys: int | None = None) -> DataFrame:
    """Object names below a prefix, in name order; at most ``max_keys`` if given."""
    found = listed.select("object_key").where(F.col("object_key").startswith(prefix))
    return found if max_keys is None else found.orderBy("object_key").limit(max_keys)
