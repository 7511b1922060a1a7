"""Language identification by a multilingual mixture.

Each learned language is a smoothed distribution over hashed character n-grams. A document is a
mixture of languages: expectation-maximisation estimates the proportions from its n-gram counts. The
set of languages is selected by penalised likelihood: a further language must raise the log-likelihood
by more than the penalty, and the selected set's proportions are the answer.
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
from smeltery.llm.grams import gram_hashes
from smeltery.llm.sample import hashed_below
from smeltery.sources.tables import written

SIZE = 3
BITS = 16
# The documented bound of the training sample: so many texts of each language are expected.
SAMPLE = 4000
SMOOTH = 0.5
# Rounds of expectation-maximisation.
ROUNDS = 12
# Log-likelihood that each further language must be worth, times the log of the n-gram count.
PENALTY = 3.0
# Characters of the documents estimated together, times the languages.
CHUNK = 1 << 22
# Languages whose counts a task holds at once.
HELD = 64
UNKNOWN = "und"


class _Letters:
    """Tables over all code points: whether it is a letter, and its lower-case form."""

    def __init__(self) -> None:
        every = [chr(i) for i in range(0x110000)]
        lower = [c.lower() for c in every]
        self.is_letter = np.array([c.isalpha() for c in every])
        self.lower = np.array([ord(x) if len(x) == 1 else i for i, x in enumerate(lower)], np.uint32)


_TABLES: list[_Letters] = []


def letters(text: str) -> np.ndarray:
    """Code points of a text in lower case, each run of other characters than letters one blank."""
    if not _TABLES:
        _TABLES.append(_Letters())
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _TABLES[0].is_letter[points]
    points = np.where(letter, _TABLES[0].lower[points], 32)
    # Of a run of other characters only the first after a letter is kept.
    kept = points[letter | np.concatenate(([False], letter))[:-1]]
    if len(kept) and kept[-1] == 32:
        kept = kept[:-1]
    return np.concatenate(([32], kept, [32])).astype(np.uint32)


def grams(text: str) -> np.ndarray:
    return gram_hashes(letters(text), SIZE, BITS)


@dataclass(frozen=True)
class Model:
    """Probabilities of the n-grams, a column per language."""

    languages: tuple[str, ...]
    chances: np.ndarray

    def mixtures(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        """The proportions of the selected languages of each document (n-grams, counts)."""
        width = len(self.languages)
        sizes = np.array([len(g) for g, _ in counts], np.int64)
        if not width or not len(sizes):
            return [np.zeros(width) for _ in counts]
        p = self.chances[np.concatenate([g for g, _ in counts])]
        n = np.concatenate([c for _, c in counts]).astype(np.float32)
        logs = np.log(p)
        starts = np.cumsum(sizes) - sizes
        alone = np.add.reduceat(logs * n[:, None], starts, axis=0)
        single = alone.argmax(1)
        shares = np.eye(width)[single]
        if width == 1:
            return list(shares)
        likelihood = alone.max(1)
        totals = np.add.reduceat(n, starts)
        penalty = PENALTY * np.log1p(totals)
        # The mixture of all languages bounds what any set can reach, so most documents end here.
        free, reached = self._estimate(p, n, starts, sizes, np.full((len(sizes), width), 1.0 / width))
        best = likelihood.copy()
        open_ = np.flatnonzero(reached - likelihood > penalty)
        ranked = np.argsort(-free, axis=1, kind="stable")
        for count in range(2, width + 1):
            if not len(open_):
                break
            # Proportions that start at zero stay there: the set is fixed by its starting point.
            start = np.zeros((len(open_), width))
            np.put_along_axis(start, ranked[open_, :count], 1.0 / count, axis=1)
            part = np.concatenate([np.arange(a, a + b) for a, b in zip(starts[open_], sizes[open_], strict=True)])
            own = np.cumsum(sizes[open_]) - sizes[open_]
            found, value = self._estimate(p[part], n[part], own, sizes[open_], start)
            gained = value - (count - 1) * penalty[open_]
            better = gained > best[open_]
            best[open_[better]] = gained[better]
            shares[open_[better]] = found[better]
            # What no larger set can win back needs no further look.
            open_ = open_[reached[open_] - count * penalty[open_] > best[open_]]
        return list(shares)

    @staticmethod
    def _estimate(
        p: np.ndarray, n: np.ndarray, starts: np.ndarray, sizes: np.ndarray, shares: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Proportions by expectation-maximisation, and the log-likelihood they reach."""
        totals = np.add.reduceat(n, starts)[:, None]
        shares = shares.astype(np.float32)
        for _ in range(ROUNDS):
            mixed = np.einsum("ij,ij->i", p, np.repeat(shares, sizes, axis=0))
            shares = shares * np.add.reduceat(p * (n / mixed)[:, None], starts, axis=0) / totals
        mixed = np.einsum("ij,ij->i", p, np.repeat(shares, sizes, axis=0))
        return shares, np.add.reduceat(np.log(mixed) * n, starts)


def held_out(id_col: str | Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text modulo 3 is 1."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(labelled: DataFrame, text_col: str, lang_col: str, sample: int = SAMPLE) -> Model:
    """Learn from rows of a text and its language; rows without either are left out.

    About ``sample`` distinct texts of each language are used, picked by a hash of the text, all if there
    are no more; each counts once. The n-gram counts of a language are added up by Spark, and what reaches the driver has ``2 ** BITS`` counts for each.
    """
    prepared(labelled.sparkSession)
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )
    distinct = known.select("lang", F.xxhash64("text").alias("text")).distinct()
    # Written, so that the planner knows how many languages there are and sends them to the texts if few.
    shares = written(distinct.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(sample) / F.count("*")).alias("share")), "languages")
    picked = known.join(shares, "lang").where(hashed_below("text", F.col("share")))
    picked = picked.select("lang", "text").distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                held = totals.setdefault(lang, np.zeros(1 << BITS, np.int64))
                for text in part["text"]:
                    found, n = np.unique(grams(text), return_counts=True)
                    held[found] += n
                if len(totals) >= HELD:
                    yield from drained(totals)
        yield from drained(totals)

    def drained(totals: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for lang, held in totals.items():
            some = np.flatnonzero(held)
            yield pd.DataFrame({"lang": lang, "gram": some, "n": held[some]})
        totals.clear()

    counted = (
        picked.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    found = counted.toPandas()
    languages = tuple(sorted(found["lang"].unique()))
    chances = np.empty((1 << BITS, len(languages)), np.float32)
    of = dict(iter(found.groupby("lang")))
    for i, lang in enumerate(languages):
        held = np.full(1 << BITS, SMOOTH)
        held[of[lang]["gram"]] += of[lang]["n"]
        chances[:, i] = held / held.sum()
    return Model(languages, chances)


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, languages`` of every row, from its whole text alone."""
    spark = prepared(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(model)  # 2 ** BITS chances per language, whatever the corpus

    def mixtures(whole: list[str]) -> Iterator[np.ndarray | None]:
        waiting: list[tuple[np.ndarray, np.ndarray] | None] = []
        size = 0

        def done() -> Iterator[np.ndarray | None]:
            found = iter(shared.value.mixtures([w for w in waiting if w is not None]))
            yield from [None if w is None else next(found) for w in waiting]
            waiting.clear()

        for text in whole:
            found = grams(text)
            # A text without letters is blanks alone, which make no n-gram.
            waiting.append(np.unique(found, return_counts=True) if len(found) else None)
            size += len(found)
            if size * max(1, len(shared.value.languages)) >= CHUNK:
                yield from done()
                size = 0
        yield from done()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = shared.value.languages
        for batch, whole in texts(batches, "text"):
            names, scores, sets = [], [], []
            for shares in mixtures(whole):
                if shares is None or not languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    sets.append([])
                    continue
                order = np.argsort(-shares, kind="stable")
                names.append(languages[order[0]])
                scores.append(float(min(1.0, shares[order[0]])))
                sets.append([languages[i] for i in order if shares[i] > 0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string()))],
                names=["doc_id", "lang_pred", "score", "languages"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(judge, f"doc_id {kind}, lang_pred string, score double, languages array<string>")


def language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages`` of every document.

    Learned from text and language of the rows that are not held out (crc32 of the id as text modulo 3
    is not 1). ``lang_pred`` is the language of the largest proportion, ``score`` that proportion,
    ``languages`` the selected set, largest first; a tie goes to the first in the alphabet.

    A text that is null or has no letter is ``und`` with score 0 and no languages, as is every text
    if nothing could be learned. A null id is not held out. Repeated texts of a language are learned
    once, repeated rows are judged like others. An empty table gives no rows. Only the named columns are
    read; texts are read whole.
    """
    model = train(docs.where(~held_out(id_col)), text_col, lang_col, sample)
    return identified(docs, model, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "languages"
    )
