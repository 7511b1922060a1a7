"""Latest batch per partition and latest record per natural key.

Both are aggregates, not windows: a key replayed very often is reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.sources.tables import written


def latest_by_key(frame: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the greatest by ``order`` (which must be total within a key)."""
    rest = [c for c in frame.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    best = frame.groupBy(*keys).agg(newest)
    values = {c: F.col(f"_newest.`{c}`").alias(c) for c in rest}
    return best.select(*(values.get(c, F.col(c)) for c in frame.columns))


def latest_batches(
    frame: DataFrame, partitions: list[str], as_of_batch: str | None = None
) -> DataFrame:
    """The newest batch of every partition, optionally as things stood at an earlier batch."""
    seen = frame if as_of_batch is None else frame.where(F.col("batch_id") <= as_of_batch)
    return seen.groupBy(*partitions).agg(F.max("batch_id").alias("batch_id"))


def keep_latest_batches(
    frame: DataFrame, partitions: list[str], as_of_batch: str | None = None
) -> DataFrame:
    newest = written(latest_batches(frame, partitions, as_of_batch), "batches")
    match = F.col("f.batch_id") == F.col("b.batch_id")
    for p in partitions:
        match = match & F.col(f"f.{p}").eqNullSafe(F.col(f"b.{p}"))
    return frame.alias("f").join(newest.alias("b"), match, "left_semi")
