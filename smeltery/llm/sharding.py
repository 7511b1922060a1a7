"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``NODES`` virtual nodes on a ring of 64-bit hashes; a document belongs to the first
node clockwise of the hash of its id. The arcs between nodes are counted, and the loads are bounded:
a shard takes at most its even part of all rows, and what overflows a full shard continues clockwise,
node by node, to a shard with room. That walk sees counts of arcs only, of which there are
``NODES`` per shard, whatever the data. Each arc's rows, in ring order, are then dealt to the
shards the walk found for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.common import cut, prepared, row_number_key
from smeltery.llm.ranks import numbered

NODES = 64
# Bytes a row takes besides its text.
OVERHEAD = 16
_PIECE = "struct<start:bigint,shard:int,slot:bigint>"


def ring(shards: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places of all virtual nodes in ring order, and the shard of each."""
    names = [(s, f"{s}:{n}") for s in range(shards) for n in range(nodes)]
    places = np.array([int.from_bytes(hashlib.sha256(n.encode()).digest()[:8], "little", signed=True) for _, n in names])
    owners = np.array([s for s, _ in names])
    order = np.lexsort((owners, places))
    return places[order], owners[order]


def arc_of(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The number of the first node at or clockwise of each key."""
    return np.searchsorted(places, keys, side="left") % len(places)


def capacities(rows: int, shards: int) -> list[int]:
    """Even parts of all rows; the first shards take one more each if there is a remainder."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def bounded(counts: dict[int, int], owners: list[int], room: list[int]) -> dict[int, list[tuple[int, int, int]]]:
    """``(start, shard, slot)`` pieces of every arc: its rows from ``start`` on go to slots from ``slot``.

    First every arc fills its own shard, in ring order; what overflows moves to the next node, all
    arcs one node at a time, until everything lies somewhere. The parts that are full stay full, so
    nobody is driven out by a later row.
    """
    left, used = dict(counts), [0] * len(room)
    pieces: dict[int, list[tuple[int, int, int]]] = {arc: [] for arc in counts}
    waiting = sorted(left)
    for hop in range(len(owners)):
        waiting = [arc for arc in waiting if left[arc]]
        for arc in waiting:
            shard = owners[(arc + hop) % len(owners)]
            taken = min(left[arc], room[shard] - used[shard])
            if taken:
                pieces[arc].append((counts[arc] - left[arc], shard, used[shard]))
                left[arc] -= taken
                used[shard] += taken
    return pieces


def placed(
    docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", nodes: int = NODES
) -> DataFrame:
    """``row, doc_id, size, text_crc32, shard, slot`` of every row.

    Shards hold numbers of rows at most one apart, with slots gapless from 0. ``row`` is the number
    ``row_number_key`` gives the row. ``size`` is the UTF-8 bytes of the text and 16, ``text_crc32`` the
    checksum of these bytes.

    Nulls: a null text has no bytes; a null id has a hash as any other. Ties: rows of one hash are
    ordered by id, size, checksum and row number, so a repeated id, of however many rows, is dealt
    like others and overflows its shard alike. Empty texts have size 16. An empty table gives no
    rows; with fewer rows than shards some shards are empty. Other columns are not read. Frames must
    repeat their row order, as files do.
    """
    spark = prepared(docs.sparkSession)
    where, owners = ring(shards, nodes)
    held = spark.sparkContext.broadcast(where)  # 8 bytes per virtual node

    def arcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("key")
            found = arc_of(held.value, batch.column(at).to_numpy())
            yield batch.append_column("arc", pa.array(found, pa.int32()))

    bytes_ = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        row_number_key().alias("row"),
        F.col(id_col).alias("doc_id"),
        (F.octet_length(bytes_) + OVERHEAD).cast("long").alias("size"),
        F.crc32(bytes_).alias("text_crc32"),
        F.xxhash64(id_col).alias("key"),
    )
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    rows = cut(rows.mapInArrow(arcs, f"{schema}, arc int"))
    counts = {r["arc"]: r["count"] for r in rows.groupBy("arc").count().collect()}  # a row per virtual node
    found = bounded(counts, owners.tolist(), capacities(sum(counts.values()), shards))
    # At most a piece per arc and shard: a table of proven size.
    table = F.broadcast(
        spark.createDataFrame([(a, p) for a, p in found.items()], f"arc int, pieces array<{_PIECE}>")
    )
    # Inside an arc rows come in order of their hashes; the later ones are those that go on.
    ranked = numbered(rows, "arc", ["key", "doc_id", "size", "text_crc32", "row"]).join(table, "arc")
    piece = F.element_at(F.filter("pieces", lambda p: p["start"] <= F.col("place")), -1)
    slot = piece["slot"] + F.col("place") - piece["start"]
    return ranked.select("row", "doc_id", "size", "text_crc32", piece["shard"].alias("shard"), slot.alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows, all columns kept, to a folder per shard, in order of their slots.

    Two columns are added, ``shard`` and ``slot``, or these names with ``_`` behind them where a column
    of the documents has them. Nulls, ties, repeated rows and empty tables are as in ``placed``.
    """
    names = [n if n not in docs.columns else f"{n}_" for n in ("shard", "slot")]
    where = placed(docs, shards, id_col, text_col).select(
        F.col("row").alias("_row"), *(F.col(c).alias(n) for c, n in zip(("shard", "slot"), names, strict=True))
    )
    whole = docs.withColumn("_row", row_number_key()).join(where, "_row").drop("_row")
    whole.hint("rebalance", names[0]).sortWithinPartitions(*names).write.mode("overwrite").partitionBy(names[0]).parquet(path)
