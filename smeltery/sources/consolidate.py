"""Consolidation of a partitioned table: few files of a useful size, one layout, partition by partition.

What needs it is read off the listing, from the number and the sizes of files; only such partitions
are read and written. Layouts that differ in columns are joined by name, absent columns being null.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.session import scratch_path
from smeltery.sources.tables import exists, remove, written, written_at

FILE_BYTES = 128 << 20


@contextmanager
def keys_as_text(spark: SparkSession) -> Iterator[None]:
    """Partition keys come as the text of their folders, so that they are written to the same ones."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def file_sizes(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """``<keys>, file_path, file_size`` of the Parquet files below a path, None if it holds no partition; no
    content is read.
    """
    if not exists(spark, path):
        return None
    with keys_as_text(spark):
        listed = spark.read.format("binaryFile").option("basePath", path).option("pathGlobFilter", "*.parquet").load(path)
    if not set(keys) <= set(listed.columns):
        return None
    return listed.select(*keys, F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("file_size"))


def to_consolidate(
    spark: SparkSession, paths: Sequence[str], keys: Sequence[str], file_bytes: int = FILE_BYTES
) -> DataFrame:
    """``<keys>, files, bytes, wanted`` of the partitions with more files than their bytes call for, or
    with files in more than one layout (path).
    """
    found = [(i, file_sizes(spark, p, keys)) for i, p in enumerate(paths)]
    sizes = [files.withColumn("_layout", F.lit(i)) for i, files in found if files is not None]
    if not sizes:
        raise ValueError("none of the paths holds a partition")
    total = reduce(DataFrame.unionByName, sizes).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"), F.count_distinct("_layout").alias("layouts")
    )
    wanted = F.greatest(F.lit(1), F.ceil(F.col("bytes") / file_bytes)).cast("int").alias("wanted")
    return total.select("*", wanted).where("files > wanted OR layouts > 1").drop("layouts")


def consolidate(
    spark: SparkSession,
    paths: Sequence[str],
    target: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Rewrite the partitions that need it into ``target`` and return them, as ``to_consolidate`` does.

    ``paths`` are layouts of one table, each with columns of its own; ``target`` may be one of them. A
    partition is dealt to as many files as its bytes call for, so a large one is split over tasks, and
    sorted by ``order`` inside. Rows are written aside first and then swapped in partition by partition,
    so a job that breaks off leaves every partition as it was or as it shall be; in the other paths the
    partition is emptied only after that. Partitions of other paths that need nothing are copied too;
    those with a null key stay where they are.
    """
    keys = list(keys)
    chosen = written(to_consolidate(spark, paths, keys, file_bytes), "chosen")
    listed = {p: file_sizes(spark, p, keys) for p in paths}
    there = [p for p, files in listed.items() if files is not None]
    # Partitions that lie outside the target alone move into it as they are, but for their files.
    outside = [listed[p].groupBy(*keys).agg(F.sum("file_size").alias("_bytes")) for p in there if p != target]
    if outside:
        size = F.greatest(F.lit(1), F.ceil(F.sum("_bytes") / file_bytes)).cast("int").alias("wanted")
        moved = reduce(DataFrame.unionByName, outside).groupBy(*keys).agg(size)
        rest = moved.join(chosen.select(*keys), keys, "left_anti")
        plan = written(chosen.select(*keys, "wanted").unionByName(rest), "plan")
    else:
        plan = chosen.select(*keys, "wanted")
    with keys_as_text(spark):
        layouts = [spark.read.option("basePath", p).parquet(p) for p in there]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layouts)
    rows = whole.join(plan.where("wanted > 0"), keys)
    dealt = rows.withColumn("_file", F.pmod(F.xxhash64(*[c for c in whole.columns if c not in keys]), F.col("wanted")).cast("int"))
    aside = scratch_path(spark, "consolidated")
    kept = written_at(dealt.drop("wanted"), aside)
    tasks = plan.agg(F.sum("wanted")).first()[0] or 1
    swapped = kept.repartition(int(tasks), *keys, "_file").sortWithinPartitions(*keys, "_file", *order).drop("_file")
    writer = swapped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(target)
    for path in there:
        if path != target:
            for row in plan.select(*keys).collect():  # one folder per partition that moved
                remove(spark, "/".join([path, *(f"{k}={row[k]}" for k in keys)]))
    remove(spark, aside)
    return chosen
