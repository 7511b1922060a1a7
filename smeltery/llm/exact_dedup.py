"""Exact deduplication: counting quotient filters, merged losslessly, then bytes compared.

Every partition puts the 64-bit fingerprints of its normalised texts into a counting quotient filter.
The filters are cut by leading bits and merged in levels, each level a few filters at a time and a few
bits deeper; a merge walks the runs of both filters by their sorted remainders and adds counts, so the
last filters are those a single pass would have built. What they count more than once, as a map of
bounded size, decides which rows may have a copy. Only these rows are grouped and only their texts
travel, reduced by every task first, to be compared byte for byte; every other row is alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import cut, prepared, row_number_key
from smeltery.sources.tables import written

# Fingerprints a partition filters before it hands the filter on, and those of one last slice.
FILTER_ROWS = 1 << 20
SLICE_ROWS = 1 << 18
# Bits a level cuts by, and filters of one slice that meet in one merge but the last.
LEVEL_BITS, LEVEL_FAN = 6, 32
# Bits of the map for each fingerprint counted more than once, and at most (32 MB).
MAP_SHARE, MAP_BITS = 16, 28
PRINT_BITS = 64


def normal_bytes(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased and every other character as it is; null is empty."""
    return (text or "").encode().lower()


def fingerprint(digest: bytes, bits: int = PRINT_BITS) -> int:
    """The first 64 bits of a digest as a signed integer, all but the leading ``bits`` zero."""
    low = PRINT_BITS - bits
    return int.from_bytes(digest[:8], "little", signed=True) >> low << low


def _leading(prints: np.ndarray, bits: int) -> np.ndarray:
    return prints >> np.uint64(PRINT_BITS - bits) if bits else np.zeros(len(prints), np.uint64)


class CountingQuotientFilter:
    """Slots of remainders with three bits each, and counters of those that occur more than once.

    All fingerprints share ``depth`` leading bits, ``prefix``. The next ``width`` bits are the quotient, the
    slot a fingerprint would like; the rest is the remainder it stores. Remainders of one quotient form
    a run, sorted, as near their own slot as the runs before allow. ``occupied`` marks quotients that
    have a run, ``continuation`` slots that are not the first of theirs, ``shifted`` slots away from
    their quotient; together they give every fingerprint back.
    """

    def __init__(
        self, prefix: int, depth: int, width: int, remainders: np.ndarray, bits: np.ndarray, counters: np.ndarray
    ) -> None:
        self.prefix, self.depth, self.width = prefix, depth, width
        self.remainders, self.counters = remainders, counters
        self.occupied, self.continuation, self.shifted, self.counted = bits

    @classmethod
    def of(cls, fingerprints: np.ndarray) -> CountingQuotientFilter:
        prints, counts = np.unique(fingerprints.astype(np.int64).view(np.uint64), return_counts=True)
        return cls.of_sorted(prints, counts.astype(np.int64), 0, 0)

    @classmethod
    def of_sorted(cls, prints: np.ndarray, counts: np.ndarray, prefix: int, depth: int) -> CountingQuotientFilter:
        """Lay out distinct fingerprints, in order, at most three slots in four taken."""
        width = min(PRINT_BITS - depth - 1, max(1, (len(prints) * 4 // 3).bit_length()))
        low = np.uint64(PRINT_BITS - depth - width)
        quotients = ((prints >> low) & np.uint64((1 << width) - 1)).astype(np.int64)
        number = np.arange(len(prints))
        # A slot is the quotient's own or the one behind the entry before; entries never wrap around.
        slots = number + np.maximum.accumulate(quotients - number) if len(prints) else number
        size = max(1 << width, int(slots[-1]) + 1 if len(slots) else 0)
        remainders, bits = np.zeros(size, np.uint64), np.zeros((4, size), bool)
        remainders[slots] = prints & ((np.uint64(1) << low) - np.uint64(1))
        bits[0, quotients] = True
        bits[1, slots] = np.concatenate(([False], quotients[1:] == quotients[:-1])) if len(prints) else False
        bits[2, slots] = slots != quotients
        bits[3, slots] = counts > 1
        return cls(prefix, depth, width, remainders, bits, counts[counts > 1])

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct fingerprints in order, run by run, and their counts."""
        used = np.flatnonzero(self.occupied | self.continuation | self.shifted)
        # An occupied quotient's own slot may hold another run or, past the runs, nothing shifted.
        starts = ~self.continuation[used]
        quotients = np.flatnonzero(self.occupied)[np.cumsum(starts) - 1] if len(used) else used
        low = np.uint64(PRINT_BITS - self.depth - self.width)
        prints = (quotients.astype(np.uint64) << low) | self.remainders[used]
        if self.depth:
            prints |= np.uint64(self.prefix) << np.uint64(PRINT_BITS - self.depth)
        counts = np.ones(len(used), np.int64)
        counts[self.counted[used]] = self.counters
        return prints, counts

    def merged_with(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both filters walked by sorted remainders: equal entries add their counts, others interleave."""
        (a, m), (b, n) = self.entries(), other.entries()
        at = np.searchsorted(a, b)
        held = at < len(a)
        held[held] = a[at[held]] == b[held]
        m = m.copy()
        m[at[held]] += n[held]
        new = ~held
        prints, counts = np.insert(a, at[new], b[new]), np.insert(m, at[new], n[new])
        return self.of_sorted(prints, counts, self.prefix, self.depth)

    @staticmethod
    def merged(filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Merge in pairs of like size; nothing is lost."""
        while len(filters) > 1:
            pairs = [f[0] if len(f) == 1 else f[0].merged_with(f[1]) for f in (filters[i : i + 2] for i in range(0, len(filters), 2))]
            filters = pairs
        return filters[0]

    def slices(self, bits: int) -> Iterator[tuple[int, CountingQuotientFilter]]:
        """Filters of the entries that share the next ``bits`` bits, by their prefix."""
        prints, counts = self.entries()
        if not len(prints):
            return
        depth = self.depth + bits
        prefix = _leading(prints, depth)
        edges = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
        for a, b in zip(edges, [*edges[1:], len(prints)], strict=True):
            yield int(prefix[a]), self.of_sorted(prints[a:b], counts[a:b], int(prefix[a]), depth)

    def packed(self) -> bytes:
        """Header, four bits a slot, remainders at as many bytes as they need, and the counters."""
        wide = -(-(PRINT_BITS - self.depth - self.width) // 8)
        head = np.array([self.prefix, self.depth, self.width, len(self.remainders)], "<u8").tobytes()
        bits = np.packbits(np.stack((self.occupied, self.continuation, self.shifted, self.counted)).ravel()).tobytes()
        rest = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].tobytes()
        return head + bits + rest + self.counters.astype("<i8").tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> CountingQuotientFilter:
        prefix, depth, width, size = (int(x) for x in np.frombuffer(data, "<u8", 4))
        wide, flags = -(-(PRINT_BITS - depth - width) // 8), -(-4 * size // 8)
        bits = np.unpackbits(np.frombuffer(data, np.uint8, flags, 32), count=4 * size).astype(bool).reshape(4, size)
        remainders = np.zeros((size, 8), np.uint8)
        remainders[:, :wide] = np.frombuffer(data, np.uint8, wide * size, 32 + flags).reshape(size, wide)
        counters = np.frombuffer(data, "<i8", offset=32 + flags + wide * size)
        return cls(prefix, depth, width, remainders.reshape(-1).view("<u8"), bits, counters)


_FILTER = "part long, slice long, filter binary"


def _sliced(part: int, found: CountingQuotientFilter) -> pd.DataFrame:
    rows = [(part, slice_, piece.packed()) for slice_, piece in found.slices(LEVEL_BITS)]
    return pd.DataFrame(rows, columns=["part", "slice", "filter"])


def _merged(filters: pd.Series) -> CountingQuotientFilter:
    return CountingQuotientFilter.merged([CountingQuotientFilter.unpacked(f) for f in filters])


def repeated_fingerprints(prints: DataFrame, rows: int) -> DataFrame:
    """The fingerprints (column ``print``) that the merged filters count more than once, with the count."""
    levels = max(1, -(-max(1, rows // SLICE_ROWS).bit_length() // LEVEL_BITS))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = TaskContext.get().partitionId(), []
        for batch in batches:
            held.append(batch["print"].to_numpy())
            if sum(map(len, held)) >= FILTER_ROWS:
                yield _sliced(part, CountingQuotientFilter.of(np.concatenate(held)))
                held = []
        if held:
            yield _sliced(part, CountingQuotientFilter.of(np.concatenate(held)))

    def deeper(parts: pd.DataFrame) -> pd.DataFrame:
        return _sliced(int(parts["part"].iloc[0]) // LEVEL_FAN, _merged(parts["filter"]))

    def repeated(parts: pd.DataFrame) -> pd.DataFrame:
        found, counts = _merged(parts["filter"]).entries()
        many = counts > 1
        return pd.DataFrame({"print": found[many].view(np.int64), "count": counts[many]})

    filters = prints.select("print").mapInPandas(build, _FILTER)
    for _ in range(levels - 1):
        few = F.floor(F.col("part") / LEVEL_FAN).alias("few")
        filters = filters.groupBy(few, "slice").applyInPandas(deeper, _FILTER)
    return filters.groupBy("slice").applyInPandas(repeated, "print long, count long")


class Marks:
    """A bit for every prefix that some fingerprint counted more than once has; at most 32 MB."""

    def __init__(self, bits: int, pieces: dict[int, bytes]) -> None:
        self.bits, self.map = bits, np.zeros(1 << (bits - 3), np.uint8)
        for piece, data in pieces.items():
            self.map[piece * len(data) : (piece + 1) * len(data)] = np.frombuffer(data, np.uint8)

    def of(self, prints: np.ndarray) -> np.ndarray:
        place = _leading(prints.astype(np.int64).view(np.uint64), self.bits)
        return (self.map[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def marks_of(repeated: DataFrame) -> Marks:
    """The map, made in pieces by tasks. Its size is bounded, so it passes the driver to every task."""
    bits = min(MAP_BITS, max(12, (MAP_SHARE * repeated.count()).bit_length()))
    pieces = min(6, bits - 3)

    def piece(rows: pd.DataFrame) -> pd.DataFrame:
        place = _leading(rows["print"].to_numpy().view(np.uint64), bits) & np.uint64((1 << (bits - pieces)) - 1)
        found = np.zeros(1 << (bits - pieces), bool)
        found[place.astype(np.int64)] = True
        return pd.DataFrame({"piece": rows["piece"].iloc[:1], "map": [np.packbits(found, bitorder="little").tobytes()]})

    at = F.shiftrightunsigned("print", PRINT_BITS - pieces).alias("piece")
    made = repeated.select("print", at).groupBy("piece").applyInPandas(piece, "piece long, map binary").collect()
    return Marks(bits, {r["piece"]: bytes(r["map"]) for r in made})


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", print_bits: int = PRINT_BITS
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z only. Of equal texts the row with the
    largest id stays; exactly one row of a group has ``kept``. Fewer ``print_bits`` make fingerprints of
    different texts collide, which costs time and changes no result.

    Nulls: a null text counts as empty, so null and empty texts form one group. A null id never
    stays while its group has another id; ``keep_id`` is null only if all ids of the group are.
    Repeated rows: rows with one id and equal texts are separate rows of their group, and one of
    them stays. Empty table: no rows. Only the two named columns are read, so further columns, of
    whatever name, change nothing. Texts of any length are read whole.
    """
    spark = prepared(docs.sparkSession)
    source = docs.select(row_number_key().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashlib.sha256(normal_bytes(t)).digest() for t in batch.column(2).to_pylist()]
            prints = pa.array([fingerprint(d, print_bits) for d in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), prints, pa.array(found, pa.binary())], names=["row", "id", "print", "sha"]
            )

    rows = cut(source.mapInArrow(digests, f"row long, id {kind}, print long, sha binary"))
    marks = spark.sparkContext.broadcast(marks_of(cut(repeated_fingerprints(rows, rows.count()))))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("marked", pa.array(marks.value.of(batch.column(2).to_numpy())))

    def suspected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            normal = [normal_bytes(t) for t in batch.column(2).to_pylist()]
            prints = np.array([fingerprint(hashlib.sha256(b).digest(), print_bits) for b in normal], np.int64)
            some = np.flatnonzero(marks.value.of(prints))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(some)),
                    batch.column(1).take(pa.array(some)),
                    pa.array(prints[some], pa.int64()),
                    pa.array([normal[i] for i in some], pa.binary()),
                ],
                names=["row", "id", "print", "normal"],
            )

    told = rows.mapInArrow(marked, f"row long, id {kind}, print long, sha binary, marked boolean")
    # Byte verification: the grouping key is the text itself, reduced by every task before it travels,
    # so a group of copies is one row of each task.
    groups = (
        source.mapInArrow(suspected, f"row long, id {kind}, print long, normal binary")
        .groupBy("print", "normal")
        .agg(F.max(F.struct("id", "row")).alias("stay"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("print", F.unhex(F.sha2("normal", 256)).alias("sha"), "stay", "copies")
    )
    # Written, so that the planner knows its size: a small table goes to the rows, not the rows to it.
    groups = written(groups, "copies")
    grouped = told.where("marked").join(groups, ["print", "sha"], "left").select("id", "row", "sha", "stay", "copies")
    nobody = F.lit(None).cast(f"struct<id:{kind},row:bigint>")
    alone = told.where("NOT marked").select("id", "row", "sha", nobody.alias("stay"), F.lit(None).cast("long").alias("copies"))
    single = F.col("stay").isNull()
    return grouped.unionByName(alone).select(
        F.col("id").alias("doc_id"),
        F.when(single, F.col("id")).otherwise(F.col("stay.id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).alias("group_size"),
        (single | (F.col("stay.row") == F.col("row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
