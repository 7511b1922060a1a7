"""Exact top-k search: term-at-a-time accumulation over an inverted index.

Candidates are dealt to blocks. In a block they become postings: for each term the candidates that
hold it, with their weights. Queries are sparse rows; for each term of theirs the weighted postings
are scattered into dense score arrays. The best k of every score array are found by partition
selection, and the k of all blocks are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import partitions, prepared, row_number_key

# Candidates and queries of one block; a task holds one block of each, and scores of some queries. Every
# block of one kind travels once per block of the other, so blocks are as large as a task can hold.
CANDIDATES, QUERIES = 1 << 16, 1 << 16
SCORES = 1 << 21


class Postings:
    """An inverted index of one block: per term the candidates that hold it and their weights."""

    def __init__(self, vectors: list[np.ndarray]) -> None:
        sizes = np.array([len(v) for v in vectors], np.int64)
        row = np.repeat(np.arange(len(vectors)), sizes)
        weight = np.concatenate(vectors) if vectors else np.zeros(0, np.int64)
        term = np.arange(len(weight)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        some = weight != 0
        order = np.argsort(term[some], kind="stable")
        self.rows, self.weights, terms = row[some][order], weight[some][order], term[some][order]
        self.size = len(vectors)
        self.starts = np.searchsorted(terms, np.arange(int(sizes.max(initial=0)) + 1))

    def scores(self, queries: list[np.ndarray]) -> np.ndarray:
        """Inner products, a row per candidate and a column per query."""
        found = np.zeros((self.size, len(queries)), np.int64)
        for term in range(len(self.starts) - 1):
            rows = slice(self.starts[term], self.starts[term + 1])
            asked = np.array([q[term] if term < len(q) else 0 for q in queries], np.int64)
            held = np.flatnonzero(asked)
            if rows.start == rows.stop or not len(held):
                continue
            added = self.weights[rows, None] * asked[None, held]
            if len(held) == len(queries):
                found[self.rows[rows]] += added
            else:
                found[np.ix_(self.rows[rows], held)] += added
        return found


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the earlier place, best first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        places = np.concatenate((above, np.flatnonzero(scores == least)[: k - len(above)]))
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((places, -scores[places]))]


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component as a long; null if one is null, infinite or not a number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * 256)))


def _block(n: int) -> Column:
    return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")


def top_k(vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "vector") -> DataFrame:
    """``query_id, rank, <id>, score`` for the k best other rows of each row that ``is_query`` marks.

    ``vector_col`` is an array of integers, a weight per term; missing terms at its end weigh nothing.
    The score is the inner product, in 64-bit integers; ties go to the smaller id. Every row but those
    with the query's own id is a candidate.

    Rows with a null id or vector take no part; a null in a vector is not allowed. Empty vectors score
    0 with all. Identical rows are separate candidates, but a query id that repeats is asked once, with
    the smallest of its vectors. With fewer than k candidates all are returned, with none no row.
    Columns beyond those named are not read. Queries and candidates meet block by block.
    """
    spark = prepared(vectors.sparkSession)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        row_number_key().alias("row"), F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asked")
    )
    asked = rows.where("asked").groupBy("id").agg(F.min("row").alias("row"), F.min("vector").alias("vector"))
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if("asked").alias("asked")).first()
    # At least as many blocks as tasks can run, so that small tables use the cluster as well.
    across = max(-(-sizes["rows"] // CANDIDATES), partitions(spark))
    down = max(1, -(-sizes["asked"] // QUERIES))

    def dealt(side: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return side.select(
            _block(n).alias(own), F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other), "id", "vector"
        )

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        queries = queries.sort_values("id", ignore_index=True)
        candidates = candidates.sort_values("id", kind="stable", ignore_index=True)
        index = Postings([np.asarray(v, np.int64) for v in candidates["vector"]])
        sought = [np.asarray(v, np.int64) for v in queries["vector"]]
        names, others = queries["id"].to_numpy(), candidates["id"].to_numpy()
        step = max(1, SCORES // max(1, len(others)))
        out: dict[str, list] = {"query_id": [], "id": [], "score": []}
        for at in range(0, len(sought), step):
            scores = index.scores(sought[at : at + step])
            for j in range(scores.shape[1]):
                mine = np.flatnonzero(others != names[at + j])
                places = mine[best(scores[mine, j], k)]
                out["query_id"] += [names[at + j]] * len(places)
                out["id"] += others[places].tolist()
                out["score"] += scores[places, j].tolist()
        return pd.DataFrame(out)

    left = dealt(asked, "down", down, "across", across).groupBy("across", "down")
    right = dealt(rows, "across", across, "down", down).groupBy("across", "down")
    kind = rows.schema["id"].dataType.simpleString()
    found = left.cogroup(right).applyInPandas(search, f"query_id {kind}, id {kind}, score long")
    merged = found.select(
        "*",
        F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)").alias("rank"),
    )
    return merged.where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")


def nearest(embeddings: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``top_k`` of float vectors, quantised; vectors null or not finite in a component take no part."""
    return top_k(
        embeddings.select(id_col, is_query.alias("asked"), quantised(F.col(vector_col)).alias("vector")),
        F.coalesce("asked", F.lit(False)),
        k,
        id_col,
    )
