"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed character n-grams. From labelled texts each n-gram gets the log of
the ratio of its smoothed frequencies in toxic and other texts; logistic regression is then fitted to
the n-grams scaled by these ratios. Ratios and weights fold into one weight per n-gram.
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
from smeltery.llm.grams import codes, gram_hashes
from smeltery.llm.sample import weighed_texts

SIZES = (4, 5)
BITS = 18
# The documented bound of the training sample: so many labelled rows of each class are expected.
SAMPLE = 3000
SMOOTH = 1.0
PENALTY = 1e-3
STEPS = 60
# N-grams of fewer sample texts, or with a smaller ratio, get no weight.
LEAST_TEXTS = 3
LEAST_RATIO = 0.5


def features(text: str) -> np.ndarray:
    """The distinct n-grams of a whole text."""
    points = codes(text)
    return np.unique(np.concatenate([gram_hashes(points, n, BITS) for n in SIZES]))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        points, total = codes(text), self.bias
        weighed = []
        for n in SIZES:
            grams = gram_hashes(points, n, BITS)
            weighed.append(grams[self.weights[grams] != 0])
        total += float(self.weights[np.unique(np.concatenate(weighed))].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(rows: list[np.ndarray], toxic: np.ndarray, weighed: np.ndarray | None = None) -> Model:
    """The model of sample texts given by their n-grams, each counting once or by its weight; without
    both classes all texts score 0.
    """
    weights = np.zeros(1 << BITS, np.float32)
    if not len(toxic) or toxic.all() or not toxic.any():
        return Model(weights, -30.0)
    width = 1 << BITS
    bad, good = np.zeros(width), np.zeros(width)
    for row, is_toxic in zip(rows, toxic, strict=True):
        (bad if is_toxic else good)[row] += 1
    ratio = np.log((bad + SMOOTH) / (toxic.sum() + 2 * SMOOTH)) - np.log(
        (good + SMOOTH) / ((~toxic).sum() + 2 * SMOOTH)
    )
    used = (bad + good >= LEAST_TEXTS) & (np.abs(ratio) >= LEAST_RATIO)
    number = np.cumsum(used) - 1
    kept = [number[r[used[r]]] for r in rows]
    scale = ratio[used]
    table, size = Rows(kept), int(used.sum())
    sign = np.where(toxic, 1.0, -1.0)
    each = np.ones(len(sign)) if weighed is None else weighed
    share = each / each.sum()

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        margin = sign * (table.times(x[:-1] * scale) + x[-1])
        pull = -share * sign / (1 + np.exp(np.clip(margin, -50, 50)))
        slope = np.append(table.transposed_times(pull, size) * scale + PENALTY * x[:-1], pull.sum())
        return float(share @ np.logaddexp(0, -margin) + PENALTY / 2 * x[:-1] @ x[:-1]), slope

    found = minimise(loss, np.zeros(size + 1), STEPS)
    weights[used] = found[:-1] * scale
    return Model(weights, float(found[-1]))


def held_out(id_col: str | Column, folds: int = 5) -> Column:
    """Rows whose label is never learned: crc32 of the id as text is divisible by ``folds``."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on ``docs`` (id, text) and ``labels`` (id, label 0 or 1), of which ``sample`` rows of each
    class are used, picked by a hash of the id and weighed so that the classes keep their shares; a
    class with fewer rows is used whole.
    """
    picked, _, weights = weighed_texts(docs, labels.where("label IN (0, 1)"), sample)

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"label": batch["label"], "grams": [features(t).astype("<u4").tobytes() for t in batch["text"]]}
            )

    found = picked.mapInPandas(extract, "label int, grams binary").toPandas()
    # The order in which tasks end must not change the sums.
    found = found.sort_values(["label", "grams"], ignore_index=True)
    weighed = found["label"].map(weights).to_numpy(float)
    return fit([np.frombuffer(g, "<u4") for g in found["grams"]], found["label"].to_numpy() == 1, weighed)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row, from its whole text alone."""
    spark = prepared(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS weights, whatever the corpus

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, whole in texts(batches, "text"):
            scores = np.array([shared.value.score(t) for t in whole], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(judge, f"doc_id {kind}, score double, predicted int")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Labels are joined by id and learned only from rows that are not held out (crc32 of the id as
    text modulo 5 is not 0); no score uses a label, language, source or id. ``predicted`` is 1 from a
    score of 0.5 on.

    A null text counts as empty; an empty text scores by the bias alone. A null id has no label and
    counts as not held out. Repeated rows are scored alike; repeated labels are learned once. Without
    labels of both classes every score is 0. An empty table gives no rows. Only the named columns are
    read. Texts of any length are scored whole.
    """
    model = _learned(docs, labels, id_col, text_col, label_col, sample)
    return scored(docs, model, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted"
    )


def _learned(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int) -> Model:
    """The model of the labels that may be learned."""
    marks = labels.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    return train(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), marks, sample)


def without_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """The documents, all columns kept, that are not predicted toxic.

    Learning, nulls and empty texts are as in ``toxicity``. Repeated rows stay or go alike; without labels
    of both classes all stay; an empty table gives no rows. Texts of any length are scored whole.
    """
    spark = prepared(docs.sparkSession)
    model = _learned(docs, labels, id_col, text_col, label_col, SAMPLE)
    shared = spark.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(place).to_pylist()
            yield batch.filter(pa.array([shared.value.score(t or "") < 0.5 for t in whole], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
