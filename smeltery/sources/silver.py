"""Silver: flat typed Parquet, one folder per dataset, partitioned by season and round."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltery.operators.flatten import flatten
from smeltery.operators.validate import valid_records
from smeltery.sources.bronze import dataset_path
from smeltery.sources.models import Dataset
from smeltery.sources.tables import exists

LINEAGE = ("batch_id", "page", "_record_index", "_file_path")


def silver_rows(judged: DataFrame, spec: Dataset) -> DataFrame:
    """Flat rows of the pages that passed: the declared columns, then path keys and lineage.

    ``season`` and ``round`` come from the record where its model has them, else from the object
    above it, else from the path.
    """
    flat = flatten(valid_records(judged, spec))
    hidden = {"_p_season", "_p_round", "_above_season", "_above_round", *LINEAGE}
    data = [c for c in flat.columns if c not in hidden]
    keys = []
    for name in ("season", "round"):
        if name in data:
            continue
        sources = [c for c in (f"_above_{name}", f"_p_{name}") if c in flat.columns]
        if sources and name in spec.partitions:
            keys.append(F.coalesce(*(F.col(c).cast("long") for c in sources)).alias(name))
    lineage = [c for c in LINEAGE if c in flat.columns]
    return flat.select(*data, *keys, F.lit(spec.name).alias("endpoint"), *lineage)


def counted_rows(frame: DataFrame, seen: Observation | None) -> DataFrame:
    """Count the rows a task writes; to be the last step, so that a task run again counts once."""
    return frame if seen is None else frame.observe(seen, F.count(F.lit(1)).alias("rows_written"))


def write_silver(
    rows: DataFrame,
    base: str,
    spec: Dataset,
    mode: str = "overwrite",
    seen: Observation | None = None,
    dealt: bool = False,
) -> bool:
    """Consolidate pages into one sorted dataset per partition; overwrite only what is present.

    An unpartitioned dataset is never replaced by no rows: then False is returned. ``seen`` gets the
    ``rows_written``. Rows that are ``dealt`` by ranges of partition and key are written by the tasks that have them.
    """
    keys = list(spec.partitions)
    order = [c for c in spec.natural_key if c not in keys]
    if not keys and not rows.head(1):
        return False
    frame = rows if dealt else rows.hint("rebalance", *keys)
    writer = counted_rows(frame.sortWithinPartitions(*keys, *order), seen).write.mode(mode)
    if keys:
        writer = writer.partitionBy(*keys).option("partitionOverwriteMode", "dynamic")
    writer.parquet(dataset_path(base, spec))
    return True


def present_partitions(spark: SparkSession, base: str, spec: Dataset) -> DataFrame | None:
    """The partitions Silver holds of a dataset (one row if it has none to name); None without data."""
    if not exists(spark, dataset_path(base, spec)):
        return None
    try:
        found = spark.read.parquet(dataset_path(base, spec))
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return found.select(*(F.col(k).cast("long").alias(f"_p_{k}") for k in spec.partitions)).distinct()


def read_parquet_as(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """External table over Parquet files under a declared schema; absent columns are NULL."""
    return spark.read.schema(schema).parquet(path)


def read_silver(spark: SparkSession, base: str, spec: Dataset, season: int | None = None) -> DataFrame:
    root = dataset_path(base, spec)
    frame = spark.read.parquet(root)
    for key in spec.partitions:
        frame = frame.withColumn(key, F.col(key).cast("long"))
    if season is not None and "season" in frame.columns:
        frame = frame.where(F.col("season") == season)
    return frame
