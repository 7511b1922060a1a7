"""Reading JSON documents: paths in text, the response root, list discovery."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_string(document: Column, *path: str) -> Column:
    """Text at a path; a missing key is NULL."""
    return F.get_json_object(document, ".".join(("$", *path)))


json_raw = json_string


def json_array(document: Column, *path: str) -> Column:
    """Elements of the list at a path, each kept as raw JSON text."""
    return F.from_json(json_string(document, *path), "array<string>")


# Braces and list openings of a JSON text whose strings were blanked; a list opening only counts
# when something follows it, and keeps what follows out of the match.
# Possessive, so that a string of any length is matched in a loop, not by recursion.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_OPENINGS = r"[{}]|\[(?=\s*[^\]\s])"


def has_items(document: Column, max_depth: int = 20) -> Column:
    """Whether the JSON text holds a non-empty list at most ``max_depth`` objects deep."""
    marks = F.regexp_extract_all(F.regexp_replace(document, _STRING, '""'), F.lit(_OPENINGS), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("found"))

    def step(state: Column, mark: Column) -> Column:
        depth = state["depth"] + F.when(mark == "{", 1).when(mark == "}", -1).otherwise(0)
        found = state["found"] | ((mark == "[") & (state["depth"] <= max_depth))
        return F.struct(depth.alias("depth"), found.alias("found"))

    return F.coalesce(F.aggregate(marks, start, step, lambda state: state["found"]), F.lit(False))


def first_record_list(document: Column) -> Column:
    """JSON text of the outermost list, in document order, whose first element is an object.

    For payloads without a declared record path. Lists that start with anything else are skipped
    whole, as are the lists inside them.
    """
    tokens = F.regexp_extract_all(
        document, F.lit(rf'{_STRING}|[{{}}\]]|\[\s*|[^\[\]{{}}"]+'), F.lit(0)
    )
    start = F.struct(
        F.lit(0).alias("position"),
        F.lit(0).alias("lists"),
        F.lit(None).cast("int").alias("opened"),
        F.lit(0).alias("pending"),
        F.lit(None).cast("int").alias("closed"),
    )

    def step(state: Column, token: Column) -> Column:
        position = state["position"] + 1
        opens, closes = token.startswith("["), token == "]"
        lists = state["lists"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        # An outermost list is a candidate until its first token shows what it holds.
        pending = F.when(opens & (state["lists"] == 0), position).otherwise(F.lit(0))
        opened = F.coalesce(
            state["opened"], F.when((state["pending"] > 0) & (token == "{"), state["pending"])
        )
        closed = F.coalesce(
            state["closed"],
            F.when(state["opened"].isNotNull() & closes & (state["lists"] == 1), position),
        )
        return F.struct(
            position.alias("position"),
            lists.alias("lists"),
            opened.alias("opened"),
            pending.alias("pending"),
            closed.alias("closed"),
        )

    def cut(state: Column) -> Column:
        return F.when(
            state["closed"].isNotNull(),
            F.struct(state["opened"].alias("opened"), state["closed"].alias("closed")),
        )

    span = F.aggregate(tokens, start, step, cut)
    return F.array_join(
        F.slice(tokens, span["opened"], span["closed"] - span["opened"] + F.lit(1)), ""
    )
