"""Quality: ordinal cumulative-link regression on graded ratings.

One score per text, a linear function of its hashed tokens and of the shape of the text, is shared by
all grades; ordered thresholds cut it into grades: P(grade <= k) = logistic(threshold_k - score).
The expected grade ranks texts, the probability of a grade of at least ``select_from`` selects them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import prepared, texts
from smeltery.llm.fit import Rows, minimise
from smeltery.llm.grams import word_hashes
from smeltery.llm.sample import weighed_texts
from smeltery.llm.toxicity import held_out

BITS = 18
# The documented bound of the training sample: so many rated texts of each grade are expected.
SAMPLE = 3000
PENALTY = 1e-4
STEPS = 80
# Tokens count by their share of the text, times this.
TOKENS = 8.0
# Each measure of a text's shape falls into one of so many buckets.
BUCKETS, MEASURES = 12, 6
WIDTH = (1 << BITS) + BUCKETS * MEASURES


def shape(text: str, words: list[str]) -> np.ndarray:
    """The bucket of each measure: variety, repeats in a row, capitals, signs, word and text length."""
    count = max(1, len(words))
    sizes = max(1, len(text))
    measures = (
        len(set(words)) / count,
        sum(map(str.__eq__, words, words[1:])) / count,
        sum(map(str.isupper, words)) / count,
        1 - sum(map(len, text.translate(_SIGNS).split())) / max(1, sum(map(len, words))),
        min(1.0, sizes / count / 24),
        min(1.0, np.log2(sizes) / 20),
    )
    buckets = [min(BUCKETS - 1, int(m * BUCKETS)) for m in measures]
    return np.array([(1 << BITS) + i * BUCKETS + b for i, b in enumerate(buckets)], np.int64)


# ASCII signs, taken out to measure their share.
_SIGNS = str.maketrans("", "", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789")


def tokens(text: str) -> tuple[list[str], np.ndarray]:
    words = text.split()
    return words, word_hashes([w.lower() for w in words], BITS)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, text: str) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        words, hashed = tokens(text)
        score = self.weights[shape(text, words)].sum(dtype=np.float64)
        if len(hashed):
            score += TOKENS * self.weights[hashed].mean(dtype=np.float64)
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -40, 40)))


def _ordered(free: np.ndarray) -> np.ndarray:
    """Rising thresholds from free numbers: the first, and the logs of the steps to the next."""
    return np.cumsum(np.concatenate((free[:1], np.exp(np.clip(free[1:], -20, 20)))))


def fit(table: Rows, grades: np.ndarray, weights: np.ndarray, levels: int) -> Model:
    """Weighted maximum likelihood with an L2 penalty on the text weights."""
    cuts = levels - 1
    share = weights / weights.sum()

    def sigmoid(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, free = x[:WIDTH], x[WIDTH:]
        at = _ordered(free)
        score = table.times(w)
        bounds = np.concatenate(([-np.inf], at, [np.inf]))
        high, low = sigmoid(bounds[grades + 1] - score), sigmoid(bounds[grades] - score)
        high, low = np.where(grades == cuts, 1.0, high), np.where(grades == 0, 0.0, low)
        chance = np.maximum(high - low, 1e-12)
        up, down = high * (1 - high), low * (1 - low)
        per_score = share * (up - down) / chance
        slope_at = np.zeros(cuts)
        np.add.at(slope_at, np.minimum(grades, cuts - 1), np.where(grades < cuts, -share * up / chance, 0))
        np.add.at(slope_at, np.maximum(grades - 1, 0), np.where(grades > 0, share * down / chance, 0))
        later = np.cumsum(slope_at[::-1])[::-1]
        slope_free = later * np.concatenate(([1.0], np.exp(np.clip(free[1:], -20, 20))))
        slope = table.transposed_times(per_score, WIDTH) + PENALTY * w
        return float(-(share * np.log(chance)).sum() + PENALTY / 2 * w @ w), np.concatenate((slope, slope_free))

    found = minimise(loss, np.zeros(WIDTH + cuts), STEPS)
    return Model(found[:WIDTH].astype(np.float32), _ordered(found[WIDTH:]))


def train(docs: DataFrame, ratings: DataFrame, levels: int, sample: int = SAMPLE) -> Model:
    """Fit on ``docs`` (id, text) and ``ratings`` (id, label), labels being grades below ``levels``.

    About ``sample`` texts of each grade are used, picked by a hash of the id and weighed so that the
    grades keep their shares. Without ratings every text is alike.
    """
    known = ratings.where(F.col("label").between(0, levels - 1))
    picked, _, stands_for = weighed_texts(docs, known, sample)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words, hashed = tokens(text)
                columns, n = np.unique(hashed, return_counts=True)
                of = np.concatenate((columns.astype(np.int64), shape(text, words)))
                values = np.concatenate((TOKENS * n / max(1, len(hashed)), np.ones(MEASURES)))
                rows.append((of.astype("<u4").tobytes(), values.astype("<f4").tobytes()))
            yield pd.DataFrame(
                {"grade": batch["label"], "columns": [r[0] for r in rows], "values": [r[1] for r in rows]}
            )

    found = picked.mapInPandas(extract, "grade int, columns binary, values binary").toPandas()
    if found.empty:
        return Model(np.zeros(WIDTH, np.float32), np.zeros(levels - 1))
    # The order in which tasks end must not change the sums.
    found = found.sort_values(["grade", "columns", "values"], ignore_index=True)
    grades = found["grade"].to_numpy().astype(np.int64)
    table = Rows(
        [np.frombuffer(c, "<u4").astype(np.int64) for c in found["columns"]],
        [np.frombuffer(v, "<f4").astype(float) for v in found["values"]],
    )
    weights = np.array([stands_for.get(g, 0.0) for g in range(levels)])
    return fit(table, grades, weights[grades], levels)


def graded(
    docs: DataFrame, model: Model, select_from: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, expected_grade, tail, selected`` of every row, from its whole text alone."""
    spark = prepared(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS weights, whatever the corpus

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, whole in texts(batches, "text"):
            tails = np.array([shared.value.tails(t) for t in whole]).reshape(len(whole), -1)
            tail = tails[:, select_from - 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(1)), pa.array(tail), pa.array(tail >= 0.5)],
                names=["doc_id", "expected_grade", "tail", "selected"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(judge, f"doc_id {kind}, expected_grade double, tail double, selected boolean")


def quality(
    docs: DataFrame,
    ratings: DataFrame,
    grade: Column,
    levels: int,
    select_from: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id, held_out, expected_grade, tail, selected`` of every document.

    ``grade`` is an expression over ``ratings``, from 0 (worst) to ``levels - 1``; ratings are joined by
    id and learned only from rows not held out (crc32 of the id as text modulo 5 is not 0).
    ``expected_grade`` lies between 0 and ``levels - 1``, ``tail`` is the probability of a grade of at
    least ``select_from``, and a document is selected from 0.5 on.

    A null text counts as empty, and empty texts are graded by their shape. A null id has no rating and
    is not held out. Repeated rows are graded alike; repeated ratings are learned once.
    Without ratings each tail is one half or follows the text's shape only. An empty table gives no
    rows. Only the named columns are read; texts of any length are read whole.
    """
    marks = ratings.where(~held_out(id_col)).select(F.col(id_col).alias("id"), grade.alias("label"))
    model = train(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), marks, levels, sample)
    return graded(docs, model, select_from, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "expected_grade", "tail", "selected"
    )
