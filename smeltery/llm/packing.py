"""Packing token sequences by minimum bin slack.

A text becomes token ids, cut at multiples of the window. Full pieces are sequences of their own;
the rests are dealt to groups, and in each group every window takes the largest rest that remains
and then the multiset of remaining lengths that fills what is left best. That multiset is found by
subset sums held as the bits of one integer, length by length, and backtracked to a count per length.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections import ChainMap, defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from smeltery.llm.bpe import PairTable, by_width, merge_rows
from smeltery.llm.common import cut, prepared, texts

WINDOW = 4096
END_ID = 2
# Rests of one group, packed by one task; a group leaves one window unfilled, two at most.
GROUP_ROWS = 4096
# Words whose ids a worker remembers, and the bytes of a word that is merged here.
MEMORY = 1_500_000
LONGEST = 40
# Control characters that Python and the tokenizer's pattern do not both take as white space.
_ODD_SPACE = frozenset("\x1c\x1d\x1e\x1f\u180e")


class WordEncoder:
    """A tokenizer whose words are encoded once each, many at a time.

    The tokenizer drops white space and never joins across it, so the ids of a text are those of its
    words in a row. In plain Latin-1 texts they are merged here, by the tokenizer's own table; other
    texts, those that hold a special token and very long words go to the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        # Strings that the tokenizer takes as one special token wherever they stand.
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        model = json.loads(self.tokenizer.to_str())["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = np.array([[vocabulary[a], vocabulary[b], vocabulary[a + b]] for a, b in merges], np.int64)
        self.table = PairTable(ids[:, 0], ids[:, 1], np.arange(len(ids)), ids[:, 2])
        # The letter that stands for each byte: printable ones for themselves, the rest from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in plain} | {
            b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)
        }
        self.inner = np.array([vocabulary[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocabulary[letters[b] + suffix] for b in range(256)], np.int32)
        self.units = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _merged(self, units: list[str]) -> dict[str, bytes]:
        raw = [u.encode() for u in units]
        lengths = np.array([len(r) for r in raw], np.int64)
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(raw), np.uint8)
        found: dict[str, bytes] = {}
        for width, which in by_width(lengths):
            rows = flat[starts[which][:, None] + np.arange(width)]
            symbols = self.inner[rows]
            symbols[:, -1] = self.last[rows[:, -1]]
            out, alive = merge_rows(symbols, self.table)
            whole = out[alive].astype("<u4").tobytes()
            ends = (4 * np.cumsum(alive.sum(1))).tolist()
            for i, a, b in zip(which.tolist(), [0, *ends], ends, strict=False):
                found[units[i]] = whole[a:b]
        return found

    def _units(self, word: str) -> tuple[str, ...]:
        """The runs the tokenizer cuts a lower-case word into; most are letters and one sign."""
        if word.isalpha():
            return (word,)
        if not word[-1].isalnum() and word[:-1].isalpha():
            return (word[:-1], word[-1])
        return tuple(self.units.findall(word))

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """The ids of lower-case Latin-1 words not seen before."""
        out = {w: self.library(w) for w in words if len(w) > LONGEST}
        parts = {w: self._units(w) for w in words if len(w) <= LONGEST}
        merged = self._merged(list({u for us in parts.values() for u in us}.difference(self.known)))
        find = ChainMap(merged, self.known).__getitem__
        for word, us in parts.items():
            out[word] = merged[word] if word in merged else b"".join(map(find, us))
        return out

    def __call__(self, texts_: list[str]) -> list[bytes]:
        """The ids of whole texts as little-endian 32-bit integers."""
        # Lower-casing first brings the forms of a word together; it is the tokenizer's own where
        # each character has one lower-case form, as in Latin-1.
        ours = [(t.isascii() or max(t) <= "\xff") and _ODD_SPACE.isdisjoint(t) for t in texts_]
        lower = [t.lower() if own else "" for t, own in zip(texts_, ours, strict=True)]
        ours = [own and not any(s in t for s in self.special) for t, own in zip(lower, ours, strict=True)]
        split = [t.split() if own else [] for t, own in zip(lower, ours, strict=True)]
        new = set().union(*split).difference(self.known)
        ids = self.learn(new) if new else {}
        if len(self.known) + len(ids) <= MEMORY:
            self.known.update(ids)
            find = self.known.__getitem__
        else:
            find = ChainMap(ids, self.known).__getitem__
        return [
            b"".join(map(find, words)) if own else self.library(text)
            for own, words, text in zip(ours, split, texts_, strict=True)
        ]


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def pieces_of(ids: bytes, window: int) -> list[tuple[int, int, int]]:
    """(start, length, checksum) of the pieces of a text, cut at multiples of the window."""
    step = 4 * window
    return [
        (at // 4, min(step, len(ids) - at) // 4, zlib.crc32(memoryview(ids)[at : at + step]))
        for at in range(0, len(ids), step)
    ]


def best_fill(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length (rising, with counts) fill ``room`` best: the largest sum not above it."""
    reach, steps, full = 1, [], 1 << room
    keep = (full << 1) - 1
    for i in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[i]
        left, take = counts[length], 1
        while left > 0:
            take = min(take, left)
            if length * take > room:
                break
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & keep
            left -= take
            take *= 2
        if reach & full:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = defaultdict(int)
    for length, take, before in reversed(steps):
        if not (before >> total) & 1:
            chosen[length] += take
            total -= length * take
    return dict(chosen)


def pack(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each length, by minimum bin slack."""
    waiting: dict[int, list[int]] = defaultdict(list)
    for i in range(len(lengths) - 1, -1, -1):
        waiting[lengths[i]].append(i)
    rising = sorted(waiting)
    counts = {k: len(v) for k, v in waiting.items()}
    place: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    sequence = 0
    while rising:
        largest = rising[-1]
        counts[largest] -= 1
        fill = best_fill(rising, counts, window - largest)
        counts[largest] += 1
        fill[largest] = fill.get(largest, 0) + 1
        offset = 0
        for length in sorted(fill, reverse=True):
            for _ in range(fill[length]):
                place[waiting[length].pop()] = (sequence, offset)
                offset += length
            counts[length] -= fill[length]
            if not counts[length]:
                rising.remove(length)
        sequence += 1
    return place


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = END_ID,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its tokenizer's ids, no special ones added, and then ``end_id``; each id lies in
    exactly one piece. Sequences hold up to ``window`` ids and have no gaps. Sequence ids are unique,
    not consecutive.

    A null or empty text is the single end id. Null ids and repeated rows are documents like others;
    rows are dealt to groups by their place, so copies spread. An empty table gives no rows. Only the
    two named columns are read. Texts are encoded whole, of any length; only lengths and checksums
    leave the task that reads a text.
    """
    spark = prepared(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, whole in texts(batches, "text"):
            rows, starts, lengths, sums, totals = [], [], [], [], []
            for i, ids in enumerate(encoder(tokenizer_path)(whole)):
                ids += end
                for start, length, checksum in pieces_of(ids, window):
                    rows.append(i)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(checksum)
                    totals.append(len(ids) // 4)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    *[pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)],
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    columns = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    # Written once: the place of a row below is then the same whenever a task runs again.
    pieces = cut(
        source.mapInArrow(tokenise, columns).withColumn("place", F.monotonically_increasing_id())
    )
    rests = pieces.where(F.col("length") < window)
    groups = max(1, -(-rests.count() // group_rows))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", ignore_index=True)
        at = pack(group["length"].tolist(), window)
        # A group holds fewer sequences than places, so numbers from one of its places stay unique.
        firsts = group["place"].to_numpy()
        return group.assign(
            sequence_id=[int(firsts[s]) * 2 + 1 for s, _ in at], offset=[o for _, o in at]
        ).drop(columns=["place", "group"])

    result = f"{columns}, sequence_id long, offset long"
    dealt = rests.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups)))
    full = pieces.where(F.col("length") == window).select(
        *[c for c in pieces.columns if c != "place"],
        (F.col("place") * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return dealt.groupBy("group").applyInPandas(fill, result).unionByName(full)
