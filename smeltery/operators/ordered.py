"""Ordered computations over groups that may be huge.

A plain window sorts a whole group in one task. Here a group is cut into chunks by an expression
that grows with the order (a day of a timestamp, say): the window runs per chunk, and what a chunk
needs from the ones before it comes from a summary holding one row per group and chunk. Keys, order
and chunk must not be NULL: plain equality lets the join reuse the window's partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"


def _same(left: str, right: str, columns: list[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition = condition & (F.col(f"{left}.{c}") == F.col(f"{right}.{c}"))
    return condition


def _with_carry(local: DataFrame, summary: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    on = [*keys, CHUNK]
    joined = local.alias("l").join(summary.alias("s"), _same("l", "s", on), "left")
    return joined.select("l.*", *(F.col(f"s.{c}") for c in carried))


def neighbours(
    frame: DataFrame,
    keys: list[str],
    order: list[str],
    chunk: Column,
    values: list[str],
    prefix: str,
    forward: bool = False,
) -> DataFrame:
    """Add ``<prefix><value>`` of the previous row (or the next one, ``forward``) of the group.

    ``<prefix>exists`` tells a missing neighbour from one holding NULLs. ``order`` must be total.
    """
    direction = F.desc if forward else F.asc
    # Dealt before anything is summed up: texts are aggregated by sorting, and no task is to sort all of a file
    # it reads. The window needs the same distribution.
    cut = frame.withColumn(CHUNK, chunk).repartition(*keys, CHUNK)
    packed = F.struct(*(F.col(v).alias(v) for v in values))
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*(direction(c) for c in order))
    local = cut.withColumn("_local", F.lag(packed).over(inside))
    edge = F.min_by if forward else F.max_by
    ordering = F.struct(*order)
    edges = cut.groupBy(*keys, CHUNK).agg(edge(packed, ordering).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy(direction(CHUNK))
    summary = edges.select(*keys, CHUNK, F.lag("_edge").over(across).alias("_carry"))
    found = F.coalesce("_local", "_carry")
    full = _with_carry(local, summary, keys, ["_carry"]).withColumn("_found", found)
    return full.select(
        *frame.columns,
        F.col("_found").isNotNull().alias(f"{prefix}exists"),
        *(F.col(f"_found.{v}").alias(f"{prefix}{v}") for v in values),
    )


def carried_forward(
    frame: DataFrame, keys: list[str], order: list[str], chunk: Column, value: str, output: str
) -> DataFrame:
    """Add the last non-NULL ``value`` at or before each row of the group."""
    cut = frame.withColumn(CHUNK, chunk)
    inside = (
        Window.partitionBy(*keys, CHUNK)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = cut.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    newest = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order)))
    edges = cut.groupBy(*keys, CHUNK).agg(newest.alias("_edge"))
    across = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    summary = edges.select(
        *keys, CHUNK, F.last("_edge", ignorenulls=True).over(across).alias("_carry")
    )
    full = _with_carry(local, summary, keys, ["_carry"])
    return full.select(*frame.columns, F.coalesce("_local", "_carry").alias(output))


def descending_rank(frame: DataFrame, keys: list[str], measures: list[str], output: str) -> DataFrame:
    """Add the SQL ``rank()`` by ``measures`` descending, without sorting the rows of a group.

    Rows are counted per distinct measures first; a rank is one more than the rows counted above it.
    However many rows tie, they are one row of the ranking.
    """
    counts = frame.groupBy(*keys, *measures).agg(F.count(F.lit(1)).alias("_rows"))
    above = (
        Window.partitionBy(*keys).orderBy(*(F.desc(m) for m in measures)).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = counts.select(*keys, *measures, (F.coalesce(F.sum("_rows").over(above), F.lit(0)) + 1).alias(output))
    match = F.lit(True)
    for c in (*keys, *measures):
        match = match & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return frame.alias("l").join(ranks.alias("r"), match).select("l.*", F.col(f"r.{output}"))
