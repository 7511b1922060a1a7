"""Near-duplicate self-join on word shingles with Bayesian pruning of candidates.

Texts are sets of hashed five-word shingles; equal sets are one class, of which one text goes on.
MinHash bands bring candidates together in buckets. A candidate pair compares its MinHash values step
by step and is dropped as soon as the posterior probability that its Jaccard similarity reaches the
threshold falls below a tolerance; what is left is verified on the exact sets. A pair is taken up in
the first bucket both share, so it counts once.

No pair ever becomes a row: a bucket is compared inside a task, block against block, and gives per
text the number of its links and one edge to the root of its neighbours. Rows stay linear in the
texts even for a group of copies that are all linked to each other.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import cut, mix64, partitions, prepared, row_number_key, texts

WORDS = 5
THRESHOLD = 0.8
# 32 bands of 5 values, at 0.8 and above: a pair at 0.8 shares no bucket with a probability of 3 in a million.
BANDS, ROWS = 32, 5
# What a pair at any threshold may miss by; lower thresholds take fewer values in each band.
MISSED = (1 - THRESHOLD**ROWS) ** BANDS
STEP = 32
TOLERANCE = 1e-8
# Texts of one block of a bucket, and candidate pairs compared at once.
BLOCK = 2048
PAIRS = 1 << 17
# Bits of the table of shared shingles that one block may take; beyond it pairs are intersected singly.
TABLE_BITS = 1 << 30

_WORD = re.compile(r"\w+")
_COUNT = BANDS * ROWS
_SEED = mix64(np.arange(1, 2 * _COUNT + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_TIMES, _PLUS = _SEED[:_COUNT] | np.uint64(1), _SEED[_COUNT:]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """The distinct hashed shingles of a whole text, sorted; a shorter text is one shingle."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    # Each word with the blank behind it, the last one too, so that a word hashes alike anywhere.
    flat = np.frombuffer((" ".join(words) + " ").encode(), np.uint8).astype(np.uint64)
    starts = np.concatenate(([0], np.flatnonzero(flat == 32)[:-1] + 1))
    place = np.arange(len(flat), dtype=np.uint64) - np.repeat(starts, np.diff(np.append(starts, len(flat)))).astype(np.uint64)
    spread = mix64(flat * np.uint64(0x9E3779B97F4A7C15) + place * np.uint64(0xD6E8FEB86659FD93))
    hashed = mix64(np.add.reduceat(spread, starts))
    size = min(size, len(hashed))
    count = len(hashed) - size + 1
    total = np.full(count, np.uint64(size), np.uint64)
    for i in range(size):
        total = total * np.uint64(0xA0761D6478BD642F) + hashed[i : i + count]
    return np.unique(mix64(total))


def signature(found: np.ndarray) -> np.ndarray:
    """MinHash values of a shingle set, 16 bits each."""
    least = np.full(_COUNT, np.uint64(2**64 - 1), np.uint64)
    for at in range(0, len(found), 1024):
        part = found[None, at : at + 1024]
        np.minimum(least, (_TIMES[:, None] * part + _PLUS[:, None]).min(1), out=least)
    return (mix64(least) & np.uint64(0xFFFF)).astype(np.uint16)


def bands_of(threshold: float) -> tuple[int, int]:
    """Bands and values of each: the longest with which a pair at the threshold is missed no more often."""
    for rows in range(ROWS, 0, -1):
        if (1 - threshold**rows) ** (_COUNT // rows) <= MISSED:
            return _COUNT // rows, rows
    raise ValueError(f"no bands find pairs at a threshold of {threshold}; the lowest is {1 - MISSED ** (1 / _COUNT):.3f}")


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A bucket key for each band of a signature."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in values[: bands * rows].reshape(bands, rows).T:
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
    return key.view(np.int64)


def least_matches(compared: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """The fewest equal values of ``compared`` with which a pair stays.

    With a uniform prior the similarity given m equal values is Beta(m + 1, compared - m + 1), and the
    probability that it reaches the threshold is that of at most m successes in compared + 1 trials.
    """
    total = 0.0
    for m in range(compared + 1):
        n = compared + 1
        total += math.comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if total >= tolerance:
            return m
    return compared


def survivors(values: np.ndarray, left: np.ndarray, right: np.ndarray, band: np.ndarray, threshold: float, tolerance: float) -> np.ndarray:
    """Which pairs of rows of ``values`` stay, and meet in this band for the first time."""
    kept = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for at in range(0, _COUNT, STEP):
        part = slice(at, at + STEP)
        matches = matches + (values[left[kept], part] == values[right[kept], part]).sum(1)
        good = matches >= least_matches(min(at + STEP, _COUNT), threshold, tolerance)
        kept, matches = kept[good], matches[good]
    bands, rows = bands_of(threshold)
    equal = values[left[kept], : bands * rows] == values[right[kept], : bands * rows]
    shared = equal.reshape(-1, bands, rows).all(2)
    return kept[shared.argmax(1) == band[kept]]


def similar(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, exactly."""
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    distinct, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    width = -(-int(shared.sum()) // 8)
    if width * 8 * len(sets) > TABLE_BITS:
        common = np.array(
            [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right, strict=True)]
        )
    else:
        table = np.zeros((len(sets), width), np.uint8)
        held = shared[number]
        at = column[number[held]]
        np.bitwise_or.at(table, (owner[held], at >> 3), (1 << (at & 7)).astype(np.uint8))
        common = np.concatenate(
            [
                np.bitwise_count(table[left[i : i + step]] & table[right[i : i + step]]).sum(1, dtype=np.int64)
                for step in [max(1, (1 << 26) // max(width, 1))]
                for i in range(0, len(left), step)
            ]
        )
    union = sizes[left] + sizes[right] - common
    return common >= threshold * union - 1e-9


def roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``count`` texts the first one it is connected to."""
    root = np.arange(count)
    while True:
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of whole runs of sorted rows: a run cut by the end of a batch waits for the next one."""
    held: pd.DataFrame | None = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = held[key].iloc[-1]
        open_ = (held[key] == last).all(axis=1).to_numpy()
        done = int(np.argmax(open_))
        if done:
            yield held.iloc[:done].reset_index(drop=True)
            held = held.iloc[done:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _pairs(side: np.ndarray, start: int, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of one run: all of a block, or those across two blocks."""
    first, second = start + np.flatnonzero(side[start:end] == 0), start + np.flatnonzero(side[start:end] == 1)
    one = len(second) == 0
    width = max(1, PAIRS // max(1, len(first if one else second)))
    for at in range(0, len(first), width):
        a, b = first[at : at + width], first if one else second
        left, right = np.repeat(a, len(b)), np.tile(b, len(a))
        if one:
            keep = left < right
            left, right = left[keep], right[keep]
        yield left, right


_UNIT = ["key", "low", "high"]


def _compare(threshold: float, tolerance: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _runs(batches, _UNIT):
            values = np.frombuffer(b"".join(rows["sig"]), np.uint16).reshape(-1, _COUNT)
            side, band = rows["side"].to_numpy(), rows["band"].to_numpy()
            units = rows[_UNIT].to_numpy()
            starts = np.concatenate(([0], np.flatnonzero((units[1:] != units[:-1]).any(1)) + 1))
            lefts, rights, waiting = [], [], []

            def flush() -> None:
                if waiting:
                    left, right = (np.concatenate([w[i] for w in waiting]) for i in (0, 1))
                    kept = survivors(values, left, right, band[left], threshold, tolerance)
                    lefts.append(left[kept])
                    rights.append(right[kept])
                    waiting.clear()

            size = 0
            for start, end in zip(starts, [*starts[1:], len(rows)], strict=True):
                for pair in _pairs(side, start, end):
                    waiting.append(pair)
                    size += len(pair[0])
                    if size >= PAIRS:
                        flush()
                        size = 0
            flush()
            if lefts:
                left, right = np.concatenate(lefts), np.concatenate(rights)
                # The partners of a text, as places in its unit, go with it to the verification.
                order = np.argsort(left, kind="stable")
                left, right = left[order], right[order]
                used = np.unique(np.concatenate((left, right)))
                bounds = np.searchsorted(left, [used, used + 1])
                other = rows["text_key"].to_numpy()[right]
                found = rows.iloc[used]
                yield pd.DataFrame(
                    {
                        "key": found["key"],
                        "low": found["low"],
                        "high": found["high"],
                        "text_key": found["text_key"],
                        "copies": found["copies"],
                        "partners": [other[a:b].astype("<i8").tobytes() for a, b in bounds.T],
                    }
                )

    return run


def _verify(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _runs(batches, _UNIT):
            for _, unit in rows.groupby(_UNIT, sort=False):
                keys, copies = unit["text_key"].to_numpy(), unit["copies"].to_numpy()
                order = np.argsort(keys, kind="stable")
                partners = [np.frombuffer(p, "<i8") for p in unit["partners"]]
                left = np.repeat(np.arange(len(unit)), [len(p) for p in partners])
                right = order[np.searchsorted(keys[order], np.concatenate(partners))]
                good = similar([shingles(t) for t in unit["text"]], left, right, threshold)
                left, right = left[good], right[good]
                if len(left):
                    both, other = np.concatenate((left, right)), np.concatenate((right, left))
                    linked = np.bincount(both, minlength=len(unit))
                    some = linked > 0
                    yield pd.DataFrame(
                        {
                            "text_key": keys[some],
                            "sets": linked[some],
                            "docs": np.bincount(both, copies[other], len(unit)).astype(np.int64)[some],
                            "root": keys[roots(len(unit), left, right)][some],
                        }
                    )

    return run


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node each node of the edges (``node, root``) is connected to.

    Labels spread along edges and jump to the label of their label, so rounds are few even for long
    chains. Neighbours are reduced to their least label before they travel.
    """
    both = cut(
        edges.where("node != root")
        .select("node", F.col("root").alias("other"))
        .unionByName(edges.where("node != root").select(F.col("root").alias("node"), F.col("node").alias("other")))
        .distinct()
    )
    labels = cut(both.groupBy("node").agg(F.min("other").alias("label")).select("node", F.least("node", "label").alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .groupBy("node")
            .agg(F.min("label").alias("near"))
        )
        spread = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = cut(
            spread.join(jump, "label", "left").select(
                "node", "old", F.least("label", F.coalesce("further", "label")).alias("label")
            )
        )
        if not new.where("label != old").head(1):
            return new.select("node", "label")
        labels = new.select("node", "label")


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(row_number_key().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def _signed(source: DataFrame, threshold: float) -> DataFrame:
    """``row, id, set (digest), sig, keys`` of every row; the last three null without words."""
    bands, rows = bands_of(threshold)
    kind = source.schema["id"].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, whole in texts(batches, "text"):
            digests, signatures, keys = [], [], []
            for text in whole:
                found = shingles(text)
                values = signature(found) if len(found) else None
                digests.append(hashlib.md5(found.tobytes()).digest() if len(found) else None)
                signatures.append(None if values is None else values.tobytes())
                keys.append(None if values is None else band_keys(values, bands, rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(digests, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["row", "id", "set", "sig", "keys"],
            )

    return source.mapInArrow(sign, f"row long, id {kind}, set binary, sig binary, keys array<long>")


def _memberships(
    docs: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float
) -> DataFrame:
    """``row, id, class (smallest (id, row) of it), n_links, n_sets`` of every row."""
    spark = prepared(docs.sparkSession)
    source = _source(docs, id_col, text_col)
    signed = cut(_signed(source, threshold))
    place = F.struct(F.col("id").isNull().alias("no"), F.col("id"), F.col("row"))
    sets = cut(
        signed.where("set IS NOT NULL")
        .groupBy("set")
        .agg(
            F.min(place).alias("first"),
            F.min("row").alias("text_key"),
            F.count("*").alias("copies"),
            F.first("sig").alias("sig"),
            F.first("keys").alias("keys"),
        )
    )
    banded = sets.select("text_key", F.posexplode("keys").alias("band", "key"))
    buckets = banded.groupBy("key", "band").agg(F.count("*").alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    own = F.pmod(F.xxhash64("text_key"), "blocks")
    # A member of a large bucket meets each of its blocks once: unit (low, high) holds two of them.
    members = (
        banded.join(buckets, ["key", "band"])
        .select("key", "band", "text_key", blocks.alias("blocks"))
        .select("key", "band", "text_key", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(
            "key",
            "band",
            "text_key",
            F.least("own", "other").alias("low"),
            F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    # In a unit of two blocks the block ``high`` is side 1; in a unit of one block all are side 0.
    parts = max(partitions(spark), 1)
    candidates = cut(
        members.join(sets.select("text_key", "sig", "copies"), "text_key")
        .repartition(parts, *_UNIT)
        .sortWithinPartitions(*_UNIT)
        .mapInPandas(
            _compare(threshold, tolerance),
            "key long, low long, high long, text_key long, copies long, partners binary",
        )
    )
    linked = cut(
        source.select(F.col("row").alias("text_key"), "text")
        .join(candidates.hint("shuffle_hash"), "text_key")
        .repartition(parts, *_UNIT)
        .sortWithinPartitions(*_UNIT)
        .mapInPandas(_verify(threshold), "text_key long, sets long, docs long, root long")
    )
    counts = linked.groupBy("text_key").agg(F.sum("sets").alias("n_sets"), F.sum("docs").alias("n_docs"))
    labels = components(linked.select(F.col("text_key").alias("node"), "root").distinct())
    classes = cut(
        sets.select("set", "first", "text_key", "copies")
        .join(counts, "text_key", "left")
        .join(labels.withColumnRenamed("node", "text_key"), "text_key", "left")
        .select(
            "set",
            "first",
            "copies",
            F.coalesce("label", "text_key").alias("label"),
            F.coalesce("n_sets", F.lit(0)).alias("n_sets"),
            (F.coalesce("n_docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    firsts = classes.groupBy("label").agg(F.min("first").alias("class"))
    of_set = classes.join(firsts, "label").select("set", "class", "n_links", "n_sets")
    alone = F.col("class").isNull()
    return signed.join(of_set, "set", "left").select(
        "row",
        "id",
        F.when(alone, place).otherwise(F.col("class")).alias("class"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("n_sets", F.lit(0).cast("long")).alias("n_sets"),
    )


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: ``doc_id, class_id, n_links, n_sets``.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles (words are
    runs of letters, digits and underscores, lower-cased) is at least ``threshold``. ``n_links`` counts
    the other documents a document is linked to, copies included, ``n_sets`` the other shingle sets;
    ``class_id`` is the smallest id among all documents connected by links.

    A text of one to four words is a single shingle of them all. Null, empty and wordless texts have
    no shingles, are linked to nothing and form classes of their own. A null id sorts last, so it is a
    class's id only if the class has no other. Repeated rows count as further copies. A threshold for
    which no bands find pairs as surely as at 0.8 is an error (below 0.077). Empty table: no rows. Only
    the two named columns are read. The frame must give its rows in the same order each time it is
    read, as files do; checkpoint any other first.
    """
    return _memberships(docs, id_col, text_col, threshold, tolerance).select(
        F.col("id").alias("doc_id"), F.col("class.id").alias("class_id"), "n_links", "n_sets"
    )


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The documents, all columns kept, one of each class: the one with the smallest id.

    Classes are those of ``jaccard_classes``. Null, empty and wordless texts are linked to nothing and all
    stay. Of equal ids in a class the first row stays, so repeated rows are reduced to one; a null id
    stays only where its class has no other. An empty table gives no rows. Only the two named columns are
    judged by, so further columns, of whatever name, change nothing. Texts of any length are read
    whole. The frame must repeat its row order, as files do.
    """
    found = _memberships(docs, id_col, text_col, threshold, TOLERANCE)
    gone = cut(found.where(F.col("class.row") != F.col("row")).select(F.col("row").alias("gone")))
    name = "place"
    while name in docs.columns:
        name += "_"
    numbered = docs.withColumn(name, row_number_key())
    kept = numbered.join(gone.hint("shuffle_hash"), numbered[name] == gone["gone"], "left_anti")
    return kept.select(*docs.columns)
