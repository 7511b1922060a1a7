"""Intermediate tables in the shared scratch folder, and views over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from smeltery.session import scratch_path


def written(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back.

    Cuts the lineage in storage that outlives an executor, and gives the planner the table's true
    size, so a join broadcasts it only if it is below the session's threshold.
    """
    return written_at(frame, scratch_path(frame.sparkSession, label))


def written_at(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table, in whatever store it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = place(old).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.rename(place(old), place(new)):
        raise OSError(f"{old} cannot be renamed")


def as_view(frame: DataFrame, name: str) -> DataFrame:
    frame.createOrReplaceTempView(name)
    return frame.sparkSession.table(name)


def as_table(frame: DataFrame, name: str, path: str) -> DataFrame:
    """Materialise a frame as a catalog table at a path of its own, replacing what it held."""
    frame.write.mode("overwrite").option("path", path).saveAsTable(name)
    return frame.sparkSession.table(name)
