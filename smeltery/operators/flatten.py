"""Schema-driven flattening: explode lists, then unnest structs with a prefix, until neither is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _named(frame: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [f.name for f in frame.schema.fields if isinstance(f.dataType, kind)]


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def explode_lists(frame: DataFrame, columns: list[str], keep_empty: bool = True) -> DataFrame:
    """Explode list columns in lock-step; an empty or NULL list keeps one row of NULLs.

    Lists of one row must have equal lengths: zipping would pad the shorter ones silently.
    """
    explode = F.explode_outer if keep_empty else F.explode
    if len(columns) == 1:
        name = columns[0]
        return frame.select(
            *(explode(_quoted(c)).alias(c) if c == name else _quoted(c) for c in frame.columns)
        )
    sizes = [F.coalesce(F.size(_quoted(c)), F.lit(0)) for c in columns]
    equal = sizes[0] == sizes[1]
    for size in sizes[2:]:
        equal = equal & (sizes[0] == size)
    zipped = F.arrays_zip(*(_quoted(c) for c in columns))
    guarded = F.when(equal, zipped).otherwise(
        F.raise_error(F.lit(f"lists of unequal length: {', '.join(columns)}"))
    )
    rest = [_quoted(c) for c in frame.columns if c not in columns]
    wide = frame.select(*rest, explode(guarded).alias("_zipped"))
    return wide.select(
        *(F.col("_zipped").getField(c).alias(c) if c in columns else _quoted(c) for c in frame.columns)
    )


def unnest_structs(frame: DataFrame) -> DataFrame:
    """Replace every struct column, in place, by its fields named ``column_field``."""
    outputs: list[Column] = []
    for f in frame.schema.fields:
        if isinstance(f.dataType, T.StructType):
            outputs += [
                _quoted(f.name).getField(inner.name).alias(f"{f.name}_{inner.name}")
                for inner in f.dataType.fields
            ]
        else:
            outputs.append(_quoted(f.name))
    return frame.select(*outputs)


def flatten(frame: DataFrame) -> DataFrame:
    """Repeat both steps until the schema is flat; only the schema is looked at while planning."""
    while True:
        lists = _named(frame, T.ArrayType)
        if lists:
            frame = explode_lists(frame, lists)
        elif _named(frame, T.StructType):
            frame = unnest_structs(frame)
        else:
            return frame
