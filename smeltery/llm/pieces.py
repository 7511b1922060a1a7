"""SentencePiece encoding by seeded merge-dropout, and decoding.

The pieces and scores are those of a SentencePiece BPE model. Merging works off an agenda of candidate
merges, best score first, leftmost among equals; a candidate is skipped if a hash of the seed, the
document, the word and its span says so. The choice depends on nothing else, so a document has one
segmentation per seed, whatever the batch or task it is in, and every one decodes to the same text.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from smeltery.llm.bpe import NONE, PairTable, by_width, merge_rows
from smeltery.llm.common import mix64, prepared

DROPOUT = 0.1
BLANK = "▁"
# Symbols of a word that is merged together with others; longer ones go through an agenda of their own.
LONGEST = 40
# Words merged at once.
CHUNK = 1 << 16
_K = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
# No piece has a blank behind another character, so no merge crosses from a word to the next blank.
_WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")


def _keeps(seeds: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the candidate merge of a span is kept."""
    hashed = mix64(
        seeds + start.astype(np.uint64) * _K[0] + mid.astype(np.uint64) * _K[1] + end.astype(np.uint64) * _K[2]
    )
    return (hashed >> np.uint64(11)).astype(np.float64) >= dropout * 2.0**53


class Encoder:
    """A SentencePiece BPE model as tables."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        plain = [
            i
            for i in range(count)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        names = {model.id_to_piece(i): i for i in plain}
        if any(BLANK in name.lstrip(BLANK) for name in names):
            raise ValueError("a piece of this model spans words")
        self.bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.symbols = np.full(0x110000, -1, np.int32)
        for name, i in names.items():
            if len(name) == 1:
                self.symbols[ord(name)] = i
        pairs = [
            (names[name[:i]], names[name[i:]], i_)
            for name, i_ in names.items()
            for i in range(1, len(name))
            if name[:i] in names and name[i:] in names
        ]
        table = np.array(pairs, np.int64)
        scores = np.array([model.get_score(i) for i in range(count)])
        order = np.argsort(np.argsort(-scores, kind="stable"), kind="stable")
        self.table = PairTable(table[:, 0], table[:, 1], order[table[:, 2]], table[:, 2])
        raw = [b""] * count
        for name, i in names.items():
            raw[i] = name.replace(BLANK, " ").encode()
        for b, i in enumerate(self.bytes):
            raw[i] = bytes([b])
        # The bytes of all pieces in a row, and where each piece's begin and how many they are.
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def _agenda(self, symbols: np.ndarray, seed: np.uint64, dropout: float) -> np.ndarray:
        """The merges of one long word, from a heap of candidates."""
        out = symbols.tolist()
        size = len(out)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(at: list[int]) -> None:
            mids = [after[i] for i in at]
            left, right = np.array([out[i] for i in at], np.int64), np.array([out[m] for m in mids], np.int64)
            ranks, merged = self.table.find(left, right)
            start, mid, end = np.array(at), np.array(mids), np.array([after[m] for m in mids])
            kept = (ranks != NONE) & _keeps(np.full(len(at), seed), start, mid, end, dropout)
            for k in np.flatnonzero(kept):
                heapq.heappush(heap, (int(ranks[k]), at[k], mids[k], int(end[k]), int(merged[k])))

        offer(list(range(size - 1)))
        while heap:
            _, at, mid, end, merged = heapq.heappop(heap)
            if out[at] < 0 or after[at] != mid or mid >= size or after[mid] != end:
                continue
            out[at], out[mid], after[at] = merged, -1, end
            if end < size:
                before[end] = at
            near = [i for i in (before[at], at) if i >= 0 and after[i] < size]
            if near:
                offer(near)
        return np.array([x for x in out if x >= 0], np.int32)

    def _merged(self, words: list[str], owners: np.ndarray, dropout: float) -> list[bytes]:
        """The ids of each word of a document whose hash is given."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = self.symbols[points]
        width = np.ones(len(points), np.int64)
        odd = np.flatnonzero(symbols < 0)
        raw = [(BLANK if p == _MARK else chr(p)).encode() for p in points[odd].tolist()]
        width[odd] = [len(r) for r in raw]
        starts = np.cumsum(sizes) - sizes
        hashes = np.add.reduceat(
            mix64(points.astype(np.uint64) * _K[3] + (np.arange(len(points)) - np.repeat(starts, sizes)).astype(np.uint64)), starts
        )
        seeds = mix64(hashes ^ owners)
        flat = np.repeat(symbols, width)
        if len(odd):
            flat[flat < 0] = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        lengths = np.add.reduceat(width, starts)
        first = np.cumsum(lengths) - lengths
        found: list[bytes] = [b""] * len(words)
        for n, which in by_width(lengths):
            if n > LONGEST:
                for i in which.tolist():
                    found[i] = self._agenda(flat[first[i] : first[i] + n], seeds[i], dropout).astype("<i4").tobytes()
                continue
            rows = flat[first[which][:, None] + np.arange(n)]
            own = seeds[which]
            keep = (lambda r, s, m, e, own=own: _keeps(own[r], s, m, e, dropout)) if dropout else None
            out, alive = merge_rows(rows, self.table, keep)
            whole = out[alive].astype("<i4").tobytes()
            ends = (4 * np.cumsum(alive.sum(1))).tolist()
            for i, a, b in zip(which.tolist(), [0, *ends], ends, strict=False):
                found[i] = whole[a:b]
        return found

    def encode(self, texts: list[str | None], owners: list[int], dropout: float) -> list[bytes | None]:
        """The ids of whole texts, each as 32-bit integers; the owner is the hash of seed and document."""
        split = [_words(t) if t else [] for t in texts]
        tables: list[dict[str, bytes]] = [{} for _ in texts]
        words: list[str] = []
        homes: list[int] = []

        def flush() -> None:
            if words:
                keys = np.array([owners[h] for h in homes], np.int64).view(np.uint64)
                for word, home, ids in zip(words, homes, self._merged(words, keys, dropout), strict=True):
                    tables[home][word] = ids
                words.clear()
                homes.clear()

        for i, parts in enumerate(split):
            own = list(dict.fromkeys(parts))
            words += own
            homes += [i] * len(own)
            if len(words) >= CHUNK:
                flush()
        flush()
        return [
            None if t is None else b"".join(map(table.__getitem__, parts))
            for t, parts, table in zip(texts, split, tables, strict=True)
        ]

    def decode(self, ids: np.ndarray) -> str:
        """The text of one document's ids."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return ""
        places = np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(ends[-1])
        text = self.blob[places].tobytes().decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


# Stands for a blank of the text itself, which must not come back as a space: it becomes bytes. No
# text holds a lone surrogate.
_MARK = 0xD800


def _words(text: str) -> list[str]:
    marked = BLANK + text.replace(BLANK, chr(_MARK)).replace(" ", BLANK)
    return _WORDS.findall(marked)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(
    docs: DataFrame,
    model_path: str,
    seed: int,
    dropout: float = DROPOUT,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids_col: str = "piece_ids",
) -> DataFrame:
    """The documents, all columns kept, with ``piece_ids``, an array of piece ids per text.

    With ``dropout`` 0 the ids are those of the model's own encoding. The seed and the id choose the
    segmentation; rows with a null id share that of one document. A null text has null ids, an empty
    text none; repeated rows get equal ids; an empty table gives no rows. An input column named like the
    result is replaced. Texts of any length are encoded whole; characters the model lacks become bytes.
    """
    prepared(docs.sparkSession)
    name = "owner"
    while name in docs.columns:
        name += "_"
    source = docs.drop(ids_col).withColumn(name, F.xxhash64(F.col(id_col).cast("string"), F.lit(seed)))
    text_at, owner_at = source.columns.index(text_col), source.columns.index(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(model_path)
        for batch in batches:
            found = model.encode(batch.column(text_at).to_pylist(), batch.column(owner_at).to_pylist(), dropout)
            sizes = np.array([0 if f is None else len(f) // 4 for f in found], np.int64)
            values = pa.array(np.frombuffer(b"".join(f or b"" for f in found), "<i4"), pa.int32())
            offsets = pa.array(
                np.concatenate(([0], np.cumsum(sizes))).astype(np.int32),
                mask=np.array([*[f is None for f in found], False]),
            )
            kept = [c for i, c in enumerate(batch.columns) if i != owner_at]
            names = [n for i, n in enumerate(batch.schema.names) if i != owner_at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.ListArray.from_arrays(offsets, values)], names=[*names, ids_col]
            )

    columns = docs.drop(ids_col).schema.add(ids_col, ArrayType(IntegerType()))
    return source.mapInArrow(run, columns)


def decoded(docs: DataFrame, model_path: str, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """The rows, all columns kept, with the text of their piece ids; null ids give a null text.

    Ids of control pieces decode to nothing, empty lists to an empty text. Repeated rows decode alike; an
    empty table gives no rows. An input column named like the result is replaced, all others stay.
    """
    prepared(docs.sparkSession)
    source = docs.drop(text_col)
    at = source.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(model_path)
        for batch in batches:
            lists = batch.column(at)
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
            known = lists.is_valid().to_pylist()
            found = [
                model.decode(flat[a:b]) if own else None
                for own, a, b in zip(known, [0, *ends.tolist()], ends.tolist(), strict=False)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, text_col]
            )

    return source.mapInArrow(run, docs.drop(text_col).schema.add(text_col, StringType()))
