"""What the operators of this package share: cutting lineage, block sizes, Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltery.session import configure, scratch_path

# Rows of one Arrow batch handed to Python. Documents may hold megabytes, so batches are small.
BATCH_ROWS = 512


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Hand the package to the executors, once per application, as they need not share its folder."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as bundle:
        for path in sorted(package.rglob("*.py")):
            bundle.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def prepared(spark: SparkSession) -> SparkSession:
    """The session settings the operators need; Python batches are only ever made smaller."""
    configure(spark)
    _ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def cut(frame: DataFrame) -> DataFrame:
    """Checkpoint a frame in the shared folder, so that lost executors lose none of it."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(frame.sparkSession, "cut"))
    return frame.checkpoint(eager=True)


def row_number_key() -> Column:
    """A number for every row, the same on each run over the same files."""
    return F.monotonically_increasing_id()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch with one column as Python strings, null as the empty string."""
    for batch in batches:
        yield batch, [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def lowered_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, letters, letters.lower())


def mix64(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads the bits of 64-bit integers (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
