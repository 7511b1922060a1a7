"""Bounded samples of labelled texts to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import cut, prepared

_PARTS = 1 << 20


def share_of(label: str, counts: dict, sample: int) -> Column:
    """The share of each label's rows that gives about ``sample`` of them."""
    share = F.lit(1.0)
    for value, count in counts.items():
        share = F.when(F.col(label) == value, F.lit(min(1.0, sample / count))).otherwise(share)
    return share


def hashed_below(key: str, share: Column) -> Column:
    """A fixed choice of so large a share of the rows, by a hash of a column."""
    return F.pmod(F.xxhash64(key), F.lit(_PARTS)) < share * _PARTS


def weighed_texts(
    docs: DataFrame, labels: DataFrame, sample: int
) -> tuple[DataFrame, dict[int, int], dict[int, float]]:
    """``label, text`` of about ``sample`` documents per label, how often each label occurs, and how
    many labelled ids each picked one of a label stands for.

    ``docs`` has ``id, text``, ``labels`` has ``id, label``; rows with a null do not count, nor do
    repeated labels of an id. The labels are picked first, by a hash of the id, so that the texts of
    the picked ids alone travel; of documents that share an id the smallest text is taken.
    """
    prepared(docs.sparkSession)
    known = labels.where("id IS NOT NULL AND label IS NOT NULL").select("id", F.col("label").cast("int")).distinct()
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = cut(known.where(hashed_below("id", share_of("label", counts, sample))))
    # The pick is bounded in expectation; its size is known before it is sent to every task.
    taken = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    small = sum(taken.values()) <= 4 * sample * max(1, len(counts))
    texts = docs.where("text IS NOT NULL").join(F.broadcast(chosen) if small else chosen, "id")
    picked = texts.groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text")
    return picked, counts, {label: counts[label] / n for label, n in taken.items()}
