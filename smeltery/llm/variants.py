"""Spelling variants: words one edit apart, found by dense comparison of prefixes and suffixes.

Two words are one insertion, deletion or replacement apart exactly if their common prefix and common
suffix together reach the length of the longer one, less one. The words of a tile are laid out as two
matrices of code points, padded behind and in front; blocks of their rows are compared all at once.

Which words meet in a tile: for either length the longer word of a pair may have, its positions are
cut into windows, and a tile holds the words that agree on everything in front of and behind a window.
The edit lies at the end of the common prefix, which is in one window, so a pair is counted in that
tile alone. Windows are narrow: one of two positions bounds its tile by the square of the alphabet.
A long word first has wider windows, and only tiles with too many words are cut further.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import cut, lowered_ascii, prepared

# A word is cut into at most so many windows at once, none narrower than two positions.
WINDOWS, NARROWEST = 16, 2
# Tiles of more words are cut into narrower windows.
TILE = 8192
# Cells of one comparison, and rows of one block.
CELLS, ROWS = 1 << 22, 64
WORD = "[A-Za-zÀ-ÿ]+"

_TILE_KEYS = ("longer", "low", "high", "outside")


def _matrix(words: list[np.ndarray], width: int, behind: bool) -> np.ndarray:
    """Code points, a row per word, padded with zeros behind or in front."""
    sizes = np.array([len(w) for w in words])
    at = np.arange(width)
    filled = at < sizes[:, None] if behind else at >= width - sizes[:, None]
    out = np.zeros((len(words), width), np.uint32)
    out[filled] = np.concatenate(words)
    return out


def _run(left: np.ndarray, right: np.ndarray, backwards: bool) -> np.ndarray:
    """How many cells agree from the start (or end) of each pair of rows of two stacks of blocks."""
    same = left[:, :, None, :] == right[:, None, :, :]
    if backwards:
        same = same[..., ::-1]
    stops = np.argmin(same, axis=-1)
    return np.where(same.all(-1), left.shape[-1], stops)


class Tiles:
    """Some tiles with words of like length: their words, and where each tile starts."""

    def __init__(self, tiles: list[dict]) -> None:
        self.starts = np.cumsum([0, *(len(t["words"]) for t in tiles)])
        self.tile = np.repeat(np.arange(len(tiles)), np.diff(self.starts))
        self.longer, self.low, self.high = (np.array([t[k] for t in tiles]) for k in ("longer", "low", "high"))
        self.words = [w for t in tiles for w in t["words"]]
        self.counts = np.concatenate([t["counts"] for t in tiles])
        points = [np.frombuffer(w.encode("utf-32-le"), np.uint32) for w in self.words]
        self.sizes = np.array([len(p) for p in points])
        width = int(self.longer.max())
        self.ahead, self.back = _matrix(points, width, True), _matrix(points, width, False)

    def _pairs(self, rows: int) -> np.ndarray:
        """``tile, start of one block, start of the other`` for all pairs of blocks of each tile."""
        found = []
        for tile, (start, end) in enumerate(zip(self.starts, self.starts[1:], strict=False)):
            blocks = np.arange(start, end, rows)
            one, other = np.meshgrid(blocks, blocks, indexing="ij")
            found.append(np.stack((np.full(one.size, tile), one.ravel(), other.ravel()), 1))
        return np.concatenate(found)

    def near(self, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Per word how many words of its tile are one edit away, and the first of them (or -1)."""
        width = self.ahead.shape[1]
        number, first = np.zeros(len(self.words), np.int64), np.full(len(self.words), len(self.words))
        step = max(1, CELLS // (rows * rows * width))
        pairs = self._pairs(rows)
        for at in range(0, len(pairs), step):
            tile, one, other = pairs[at : at + step].T
            end = self.starts[tile + 1]
            a, b = (s[:, None] + np.arange(rows) for s in (one, other))
            inside = (a < end[:, None])[:, :, None] & (b < end[:, None])[:, None, :] & (a[:, :, None] != b[:, None, :])
            a, b = np.minimum(a, len(self.words) - 1), np.minimum(b, len(self.words) - 1)
            sizes = self.sizes[a][:, :, None], self.sizes[b][:, None, :]
            short, long = np.minimum(*sizes), np.maximum(*sizes)
            prefix = np.minimum(_run(self.ahead[a], self.ahead[b], False), short)
            suffix = np.minimum(_run(self.back[a], self.back[b], True), short)
            longer, low, high = (x[tile][:, None, None] for x in (self.longer, self.low, self.high))
            hit = inside & (long == longer) & (prefix + suffix >= longer - 1) & (low <= prefix) & (prefix < high)
            np.add.at(number, a, hit.sum(2))
            best = np.where(hit.any(2), np.take_along_axis(b, hit.argmax(2), 1), len(self.words))
            np.minimum.at(first, a, best)
        return number, np.where(number > 0, first, -1)


def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``word, n_near, near_n, near_word`` of the words with near ones, from tiles of sorted words."""
    for batch in batches:
        groups: dict[tuple[int, int], list[dict]] = {}
        for row in batch.itertuples(index=False):
            members = sorted(row.members, key=lambda m: (-m["n"], m["word"]))
            tile = {
                "longer": row.longer,
                "low": row.low,
                "high": row.high,
                "words": [m["word"] for m in members],
                "counts": np.array([m["n"] for m in members], np.int64),
            }
            most = max(1, min(ROWS, isqrt(CELLS // row.longer)))
            rows = min(most, 1 << (len(members) - 1).bit_length())
            groups.setdefault((rows, row.longer.bit_length()), []).append(tile)
        for (rows, _), tiles in sorted(groups.items()):
            whole = Tiles(tiles)
            number, first = whole.near(rows)
            some = np.flatnonzero(number)
            if not len(some):
                continue
            yield pd.DataFrame(
                {
                    "word": [whole.words[i] for i in some],
                    "n_near": number[some],
                    "near_n": whole.counts[first[some]],
                    "near_word": [whole.words[i] for i in first[some]],
                }
            )


def _windowed(words: DataFrame) -> DataFrame:
    """Cut each row's range of positions (``low, high``) into windows; a row per window."""
    wide = F.greatest(F.lit(NARROWEST), F.ceil((F.col("high") - F.col("low")) / WINDOWS).cast("int"))
    cuts = words.withColumn("_wide", wide).withColumn("_at", F.explode(F.expr("sequence(low, high - 1, _wide)")))
    return cuts.select(
        "word", "n", "longer", F.col("_at").alias("low"), F.least(F.col("_at") + F.col("_wide"), "high").alias("high")
    )


def _tiled(windows: DataFrame) -> DataFrame:
    """The hash of what lies outside each window; a collision only adds words to compare."""
    outside = F.xxhash64(F.left("word", F.col("low")), F.right("word", F.col("longer") - F.col("high")))
    return windows.withColumn("outside", outside)


def tiles(words: DataFrame) -> DataFrame:
    """Tiles (``longer, low, high, members``) of at least two words in which every near pair meets once.

    ``words`` has ``word, n``. Tiles with more than ``TILE`` words are cut again while their windows are
    wider than the narrowest; those are bounded by the alphabet.
    """
    size = F.char_length("word")
    both = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("longer")).where("longer > 0")
    rows = _tiled(_windowed(both.select("*", F.lit(0).alias("low"), F.col("longer").alias("high"))))
    members = F.collect_list(F.struct("word", "n")).alias("members")
    # Without a word of the longer length a tile holds no pair.
    complete = (F.max(F.char_length("word")) == F.col("longer")).alias("_complete")
    found = None
    while True:
        counted = rows.groupBy(*_TILE_KEYS).agg(F.count("*").alias("_size"))
        large = cut(counted.where((F.col("_size") > TILE) & (F.col("high") - F.col("low") > NARROWEST)).select(*_TILE_KEYS))
        some = bool(large.head(1))
        small = rows.join(large, list(_TILE_KEYS), "left_anti") if some else rows
        done = small.groupBy(*_TILE_KEYS).agg(members, complete).where(F.col("_complete") & (F.size("members") > 1))
        done = done.select("longer", "low", "high", "members")
        found = done if found is None else found.unionByName(done)
        if not some:
            return found
        rows = cut(_tiled(_windowed(rows.join(large, list(_TILE_KEYS), "left_semi"))))


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, near_n, near_word``: of each word with near ones their number and the one with the
    largest n, ties to the smallest in code-point order.
    """
    parts = tiles(words).mapInPandas(compared, "word string, n_near long, near_n long, near_word string")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("word")))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", (-F.col("_best.less")).alias("near_n"), F.col("_best.word").alias("near_word")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form (``word, form``): the end of the chain of forms.

    Each round every chain is followed twice as far. Forms lead to ever more frequent words, so
    chains end, and their length is bounded by the logarithm of the largest count.
    """
    ends = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = ends.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        followed = cut(ends.join(on, "root", "left").select("word", "root", "_next"))
        if not followed.where("_next IS NOT NULL").head(1):
            return ends
        ends = cut(followed.select("word", F.coalesce("_next", "root").alias("root")))


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts (``word, n``).

    Two words are near if they differ by exactly one inserted, deleted or replaced code point. A word's
    form is its near word of largest n, ties to the smallest in code-point order, if that n is at least
    ``ratio`` (over 1) times the word's own; else null. ``root`` follows the forms to the last.

    Words of one code point and empty words may be given; null words and counts may not. An empty table
    gives no rows. Words must be distinct; other columns are not read.
    """
    prepared(words.sparkSession)
    if ratio <= 1:
        raise ValueError("a ratio of 1 or less lets chains of forms run in circles")
    words = cut(words.select("word", F.col("n").cast("long").alias("n")))
    near = near_words(words)
    kept = F.col("near_n") >= ratio * F.col("n")
    judged = cut(
        words.join(near, "word", "left").select(
            "word",
            F.when(kept, F.col("near_word")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(kept, F.col("near_n")).alias("form_n"),
        )
    )
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame,
    spelled: Column,
    least_size: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    text_col: str = "text",
) -> DataFrame:
    """``variant_groups`` of the words of whole texts: runs of letters, A-Z lower-cased.

    ``spelled`` is an expression over the columns of ``docs`` and ``run`` that gives the word to count
    for a run (``F.col("run")`` for the run itself). Words of at least ``least_size`` code points that
    occur ``least_count`` times take part.

    A null text has no words, nor has an empty one; a null that ``spelled`` gives is not counted. Repeated
    rows count each. An empty table gives no rows. Texts and words of any length are taken whole. A column
    ``run`` of ``docs`` is hidden from ``spelled``; other columns, of whatever name, change nothing.
    """
    prepared(docs.sparkSession)
    found = F.regexp_extract_all(lowered_ascii(F.col(text_col)), F.lit(WORD), 0)
    runs = docs.withColumn("run", F.explode(found))
    words = runs.select(spelled.alias("word")).where(F.char_length("word") >= least_size)
    counted = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
    return variant_groups(counted, ratio)

