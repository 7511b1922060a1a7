"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines are hashed to 128 bits. A window that occurs more than once anywhere
stays where it occurs first; the lines that its later occurrences cover, overlaps merged, go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import prepared

WINDOW = 3


def _fresh(frame: DataFrame, name: str) -> str:
    """A column name the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _windows(lines: Column) -> Column:
    """(position, two hashes) of each window that holds anything but blanks."""
    last = F.size(lines) - (WINDOW - 1)
    each = F.transform(
        F.sequence(F.lit(0), last - 1),
        lambda i: F.struct(i.alias("at"), F.slice(lines, i + 1, F.lit(WINDOW)).alias("of")),
    )
    return F.when(last >= 1, F.filter(each, lambda w: F.exists(w["of"], lambda x: F.trim(x) != "")))


def repeated_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, print, covered``: for each document that loses lines, the positions that go."""
    source = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("print"),
        F.split(text_col, "\n", -1).alias("lines"),
    )
    hashed = source.select(
        "id", "print", F.explode(_windows(F.col("lines"))).alias("w")
    ).select(
        "id",
        "print",
        F.col("w.at").alias("at"),
        F.xxhash64("w.of").alias("key"),
        F.xxhash64(F.reverse("w.of"), F.lit(WINDOW)).alias("key2"),
    )
    # Order of occurrence: id (null last), text, position.
    place = F.struct(F.col("id").isNull().alias("no"), F.col("id"), F.col("print"), F.col("at"))
    repeated = (
        hashed.groupBy("key", "key2")
        .agg(F.min(place).alias("first"), F.max(place).alias("last"))
        .where("first != last")
        .select("key", "key2", "first")
    )
    later = hashed.join(repeated, ["key", "key2"]).where(place != F.col("first"))
    return (
        later.groupBy("id", "print")
        .agg(F.collect_set("at").alias("starts"))
        .select(
            "id",
            "print",
            F.array_distinct(
                F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (WINDOW - 1))))
            ).alias("covered"),
        )
    )


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns kept, with the lines of later occurrences removed from the text.

    Two columns are added: ``n_lines`` (before) and ``n_removed``; where the input has columns of
    these names, the new ones take underscores at their end.

    Lines end at ``\\n`` and are compared as they are. A text of fewer than three lines has no window
    and stays; windows of three blank lines do not count. The first occurrence is the one with the
    smallest id (null last), then text hash, then position, inside one text or across texts. Where
    occurrences overlap (``A A A A``) the lines of the later one go, so a run shrinks to its start.

    Nulls: a null text stays null with 0 lines; null ids are ordinary documents, last in order.
    Repeated rows (one id, one text) are one document stored twice and get one and the same result.
    Empty texts and empty tables stay as they are. Texts of any length are read whole.
    """
    prepared(docs.sparkSession)
    covered = repeated_lines(docs, id_col, text_col)
    gone, print_, id_ = (_fresh(docs, n) for n in ("covered", "print", "key_id"))
    joined = docs.join(
        covered.select(
            F.col("id").alias(id_), F.col("print").alias(print_), F.col("covered").alias(gone)
        ).hint("shuffle_hash"),
        F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(text_col) == F.col(print_)),
        "left",
    )
    lines, total, removed = (_fresh(docs, n) for n in ("lines", "n_lines", "n_removed"))
    # The lines are a column of their own, as the function over positions would split per line.
    split = joined.withColumn(lines, F.split(text_col, "\n", -1))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    shorter = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.col(lines)[i]), "\n")
    )
    return split.select(
        *[shorter.alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.when(F.col(lines).isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias(total),
        F.when(F.col(gone).isNull(), F.lit(0)).otherwise(F.size(gone)).cast("long").alias(removed),
    )
