"""Slowly changing dimensions (check strategy), time travel and as-of joins."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.operators.ordered import carried_forward, neighbours
from smeltery.sources.tables import written

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def _differs(columns: list[str], prefix: str) -> Column:
    return reduce(or_, (~F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns))


def history(
    snapshots: DataFrame, keys: list[str], check: list[str], at: str, chunk: Column, tie: list[str] | None = None
) -> DataFrame:
    """Versions of every key: a new one whenever a checked column differs from the row before.

    ``at`` orders the snapshots (``tie`` makes the order total) and becomes ``valid_from``; the
    current version has no ``valid_to``. The changes, few against the snapshots, are written once
    in between: the second pass then does not run the first one again.
    """
    order = [at, *(tie or [])]
    seen = neighbours(snapshots, keys, order, chunk, check, "_before_")
    changes = seen.where(~F.col("_before_exists") | _differs(check, "_before_"))
    kept = written(changes.select(*snapshots.columns), "changes")
    ended = neighbours(kept, keys, order, chunk, [at], "_after_", forward=True)
    others = [c for c in snapshots.columns if c not in (*keys, at)]
    return ended.select(
        *keys, *others, F.col(at).alias(VALID_FROM), F.col(f"_after_{at}").alias(VALID_TO)
    )


def apply_snapshot(
    dimension: DataFrame, snapshot: DataFrame, keys: list[str], check: list[str], at: Column
) -> DataFrame:
    """Fold one snapshot into a dimension: close changed versions, open new ones.

    Keys missing from the snapshot stay open. ``snapshot`` has one row per key and the dimension's
    columns but for validity.
    """
    attributes = [c for c in dimension.columns if c not in (VALID_FROM, VALID_TO)]
    closed = dimension.where(F.col(VALID_TO).isNotNull())
    opened = dimension.where(F.col(VALID_TO).isNull()).alias("o")
    match = F.lit(True)
    for k in keys:
        match = match & (F.col(f"o.{k}") == F.col(f"s.{k}"))
    both = opened.join(
        snapshot.select(*attributes, F.lit(True).alias("_in")).alias("s"), match, "full_outer"
    )
    is_open, is_in = F.col(f"o.{VALID_FROM}").isNotNull(), F.col("s._in").isNotNull()
    differs = reduce(or_, (~F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}")) for c in check))
    moved = is_open & is_in & differs
    start = dimension.schema[VALID_FROM].dataType
    old = F.struct(
        *(F.col(f"o.{c}").alias(c) for c in attributes),
        F.col(f"o.{VALID_FROM}").alias(VALID_FROM),
        F.when(moved, at.cast(start)).alias(VALID_TO),
    )
    new = F.struct(
        *(F.col(f"s.{c}").alias(c) for c in attributes),
        at.cast(start).alias(VALID_FROM),
        F.lit(None).cast(start).alias(VALID_TO),
    )
    rows = F.array_compact(F.array(F.when(is_open, old), F.when(is_in & (~is_open | moved), new)))
    current = both.select(F.explode(rows).alias("_v")).select("_v.*")
    return closed.select(*dimension.columns).unionByName(current)


def as_of(dimension: DataFrame, moment: Column) -> DataFrame:
    """The versions valid at one moment."""
    open_end = F.col(VALID_TO).isNull() | (moment < F.col(VALID_TO))
    return dimension.where((F.col(VALID_FROM) <= moment) & open_end)


def as_of_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    at: str,
    attributes: list[str],
    chunk: str,
) -> DataFrame:
    """Give every fact the dimension version valid at its time; unmatched facts keep NULLs.

    Facts and versions are merged and the last version start is carried forward, so the work is
    linear in both: no pairs of a key's facts and versions are formed. ``chunk`` is the SQL
    expression, over a column ``_at``, that cuts long histories into pieces.
    """
    version = F.struct(F.col(VALID_TO).alias(VALID_TO), *(F.col(a).alias(a) for a in attributes))
    kind = f"struct<{VALID_TO}:{dimension.schema[VALID_TO].dataType.simpleString()}," + ",".join(
        f"{a}:{dimension.schema[a].dataType.simpleString()}" for a in attributes
    ) + ">"
    whole = F.struct(*facts.columns)
    left = facts.select(
        *keys,
        F.col(at).alias("_at"),
        F.lit(1).alias("_side"),
        whole.alias("_fact"),
        F.lit(None).cast(kind).alias("_version"),
    )
    right = dimension.select(
        *keys,
        F.col(VALID_FROM).alias("_at"),
        F.lit(0).alias("_side"),
        F.lit(None).cast(facts.select(whole.alias("x")).schema["x"].dataType).alias("_fact"),
        version.alias("_version"),
    )
    merged = left.unionByName(right)
    filled = carried_forward(merged, keys, ["_at", "_side"], F.expr(chunk), "_version", "_valid")
    live = F.col(f"_valid.{VALID_TO}").isNull() | (F.col("_at") < F.col(f"_valid.{VALID_TO}"))
    return filled.where(F.col("_side") == 1).select(
        "_fact.*", *(F.when(live, F.col(f"_valid.{a}")).alias(a) for a in attributes)
    )
