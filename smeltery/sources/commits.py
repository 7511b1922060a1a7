"""Numbered commits: small tables that say which files of a larger one count.

A commit is a folder that is written once and never changed; it counts from the moment its job has
ended. Two writers that pick the same number cannot both succeed, as the second finds the folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "commit="


def _folders(spark: SparkSession, path: str) -> dict[int, bool]:
    """The numbers of all commits below a path, and whether each is whole."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(place):
        return {}
    found = {}
    for status in store.listStatus(place):
        folder = status.getPath()
        if folder.getName().startswith(_FOLDER):
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
            found[int(folder.getName().removeprefix(_FOLDER))] = bool(store.exists(done))
    return found


def commits(spark: SparkSession, path: str, until: int | None = None) -> list[int]:
    """The numbers of the whole commits, at most ``until``, in order."""
    return sorted(n for n, whole in _folders(spark, path).items() if whole and (until is None or n <= until))


def next_number(spark: SparkSession, path: str) -> int:
    """A number no commit has, not even one that never ended."""
    return max(_folders(spark, path), default=0) + 1


def commit(frame: DataFrame, path: str, number: int) -> int:
    frame.write.mode("errorifexists").parquet(f"{path}/{_FOLDER}{number:08d}")
    return number


def read_commits(spark: SparkSession, path: str, schema: str, numbers: list[int]) -> DataFrame:
    """The rows of some commits under a declared schema, with the number of each as ``commit``."""
    if not numbers:
        return spark.createDataFrame([], f"{schema}, commit int")
    folders = [f"{path}/{_FOLDER}{n:08d}" for n in numbers]
    return spark.read.schema(f"{schema}, commit int").option("basePath", path).parquet(*folders)
