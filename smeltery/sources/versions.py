"""Silver with its batches side by side: publishing, reading as of a version, rolling back.

Rows lie in a folder per partition and batch that is never written again once committed. Which batch
of a partition counts is said by pointers, rows of numbered commits; a read joins the stored rows with
the pointers of a version, which prunes the folders of all other batches. Publishing and rolling
back only add a commit, so every earlier version can be read, and gone back to, at any time.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smeltery.operators.dedupe import latest_by_key
from smeltery.sources.bronze import dataset_path
from smeltery.sources.commits import commit, commits, next_number, read_commits
from smeltery.sources.models import Dataset
from smeltery.sources.silver import counted_rows
from smeltery.sources.tables import written

# Names the folder of one batch of one partition, so that a read can be pruned by this column alone.
_FOLDER = "_batch"


def _rows_path(base: str, spec: Dataset) -> str:
    return f"{dataset_path(base, spec)}/rows"


def _commits_path(base: str, spec: Dataset) -> str:
    return f"{dataset_path(base, spec)}/commits"


def _folder(keys: list[str]) -> Column:
    """A name that no reader takes for a number, whatever the batch is called."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("none")) for k in keys]
    return F.concat_ws("-", F.lit("b"), *parts, F.col("batch_id"))


def _matching(left: str, right: str, columns: list[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns))


def versions(spark: SparkSession, base: str, spec: Dataset) -> list[int]:
    return commits(spark, _commits_path(base, spec))


def _said(spark: SparkSession, base: str, spec: Dataset, version: int | None = None) -> DataFrame:
    """All rows of the commits up to a version: ``<partitions>, batch_id, pointed, operation, commit``."""
    path = _commits_path(base, spec)
    schema = ", ".join([*(f"{k} long" for k in spec.partitions), "batch_id string", "pointed boolean", "operation string"])
    return read_commits(spark, path, schema, commits(spark, path, version))


def pointers(spark: SparkSession, base: str, spec: Dataset, version: int | None = None) -> DataFrame:
    """The batch that counts in every partition (``<partitions>, batch_id``) at a version, or now."""
    moved = _said(spark, base, spec, version).where("pointed")
    last = F.max_by(F.struct("batch_id"), "commit")["batch_id"].alias("batch_id")
    return moved.groupBy(*spec.partitions).agg(last).where("batch_id IS NOT NULL")


def stored_batches(spark: SparkSession, base: str, spec: Dataset) -> DataFrame:
    """Every batch that was published of every partition, whether it counts or not."""
    return _said(spark, base, spec).where("batch_id IS NOT NULL").select(*spec.partitions, "batch_id").distinct()


def history(spark: SparkSession, base: str, spec: Dataset) -> DataFrame:
    """One row per version: what made it, the partitions it moved or emptied, the batches it stored."""
    return _said(spark, base, spec).groupBy(F.col("commit").alias("version"), "operation").agg(
        F.count_if(F.col("pointed") & F.col("batch_id").isNotNull()).alias("moved"),
        F.count_if(F.col("pointed") & F.col("batch_id").isNull()).alias("emptied"),
        F.count_if(~F.col("pointed")).alias("stored"),
    )


def publish(rows: DataFrame, base: str, spec: Dataset, seen: Observation | None = None) -> int | None:
    """Store the batches that ``rows`` hold and point each partition to its newest; the new version.

    Within a batch the newest record per natural key counts. A batch that was published before stays as
    it is, so the same rows twice change nothing (and give no version). ``seen`` gets the ``rows_written``. A batch older than one the
    partition already has is stored but not pointed to.
    """
    spark, keys = rows.sparkSession, list(spec.partitions)
    known = written(stored_batches(spark, base, spec), "known-batches")
    cast = rows.withColumns({k: F.col(k).cast("long") for k in keys})
    fresh = cast.alias("r").join(known.alias("k"), _matching("r", "k", [*keys, "batch_id"]), "left_anti")
    natural = [k for k in spec.natural_key if k not in keys]
    newest = latest_by_key(fresh, [*keys, "batch_id", *natural], ["page", "_record_index"])
    folders = [*keys, _FOLDER]
    table = newest.withColumn(_FOLDER, _folder(keys)).hint("rebalance", *folders)
    # Folders of a publication that never committed are replaced; committed ones are not among them.
    writer = counted_rows(table.sortWithinPartitions(*folders, *natural), seen).write.mode("overwrite").partitionBy(*folders)
    writer.option("partitionOverwriteMode", "dynamic").parquet(_rows_path(base, spec))
    found = written(fresh.select(*keys, "batch_id").distinct(), "fresh-batches")
    if not found.head(1):
        return None
    seen = known.groupBy(*keys).agg(F.max("batch_id").alias("_last"))
    best = found.groupBy(*keys).agg(F.max("batch_id").alias("batch_id"))
    if keys:
        ahead = best.alias("b").join(seen.alias("s"), _matching("b", "s", keys), "left")
    else:
        ahead = best.withColumn("_last", F.lit(_one(seen, "_last")))
    moved = ahead.where("_last IS NULL OR batch_id > _last").select(*(f"b.{k}" for k in keys), "batch_id")
    return _commit(found, moved, base, spec, "publish")


def _one(frame: DataFrame, column: str) -> str | None:
    row = frame.first()
    return row[column] if row else None


def _commit(stored: DataFrame | None, moved: DataFrame, base: str, spec: Dataset, operation: str) -> int:
    spark, path = moved.sparkSession, _commits_path(base, spec)
    said = moved.withColumn("pointed", F.lit(True))
    if stored is not None:
        said = stored.withColumn("pointed", F.lit(False)).unionByName(said)
    # One small file: a row per partition that changed.
    table = said.withColumn("operation", F.lit(operation)).coalesce(1)
    return commit(table, path, next_number(spark, path))


def roll_back(
    spark: SparkSession,
    base: str,
    spec: Dataset,
    version: int | None = None,
    as_of_batch: str | None = None,
    only: Column | None = None,
) -> int:
    """Point partitions back (or forward) and return the new version; nothing stored is touched.

    The goal is a ``version``, or in each partition its newest batch up to ``as_of_batch``. Partitions
    that had no batch then are emptied. ``only`` is a condition on the partition keys.
    """
    if (version is None) == (as_of_batch is None):
        raise ValueError("name a version or a batch, and not both")
    keys = list(spec.partitions)
    if version is not None:
        if version not in versions(spark, base, spec):
            raise ValueError(f"there is no version {version}")
        goal = pointers(spark, base, spec, version)
    else:
        early = stored_batches(spark, base, spec).where(F.col("batch_id") <= as_of_batch)
        goal = early.groupBy(*keys).agg(F.max("batch_id").alias("batch_id")).where("batch_id IS NOT NULL")
    now = pointers(spark, base, spec)
    match = _matching("n", "g", keys) if keys else F.lit(True)
    both = now.withColumn("_now", F.lit(True)).alias("n").join(goal.withColumn("_goal", F.lit(True)).alias("g"), match, "full_outer")
    moved = both.where(~F.col("n.batch_id").eqNullSafe(F.col("g.batch_id"))).select(
        *(F.when(F.col("g._goal"), F.col(f"g.{k}")).otherwise(F.col(f"n.{k}")).alias(k) for k in keys),
        F.col("g.batch_id").alias("batch_id"),
    )
    target = f"version {version}" if version is not None else f"batch {as_of_batch}"
    return _commit(None, moved if only is None else moved.where(only), base, spec, f"roll back to {target}")


def read_version(spark: SparkSession, base: str, spec: Dataset, version: int | None = None) -> DataFrame:
    """The rows that count at a version, or now; only folders that pointers name are read."""
    if version is not None and version not in versions(spark, base, spec):
        raise ValueError(f"there is no version {version}")
    keys = list(spec.partitions)
    stored = spark.read.parquet(_rows_path(base, spec))
    stored = stored.withColumns({k: F.col(k).cast("long") for k in keys})
    chosen = written(pointers(spark, base, spec, version).withColumn(_FOLDER, _folder(keys)), "pointers")
    # The condition on the folder lets the planner prune by the pointers while the job runs.
    named = chosen.select(_FOLDER).where(F.col(_FOLDER) > "b")
    return stored.join(named, _FOLDER, "left_semi").drop(_FOLDER)
