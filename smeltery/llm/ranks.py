"""Places of rows in a sorted table, found without one task or the driver seeing all of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import cut
from smeltery.sources.tables import written


def numbered(frame: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The rows with their ``place`` (from 0) in the order of their group and the rows ``of`` the group.

    Rows are dealt by ranges of (group, order), so a group of any size is spread over tasks as long
    as the order tells its rows apart. What is summed across tasks is a row per task and group;
    groups lie in a row, so these are no more than tasks and groups together. The group must not be
    null; nulls of the order come first.
    """
    at = F.monotonically_increasing_id()
    dealt = cut(frame.orderBy(group, *order).withColumn("_at", at).withColumn("_part", F.shiftrightunsigned("_at", 33)))
    parts = dealt.groupBy(group, "_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    so_far = F.expr(f"sum(_rows) OVER (PARTITION BY {group} ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    every = F.expr(f"sum(_rows) OVER (PARTITION BY {group})").alias("of")
    # Written, so that the planner knows the size and broadcasts it only below its threshold.
    starts = written(parts.select(group, "_part", "_first", (so_far - F.col("_rows")).alias("_before"), every), "places")
    place = (F.col("_before") + F.col("_at") - F.col("_first")).alias("place")
    return dealt.join(starts, [group, "_part"]).select(*frame.columns, place, "of")
