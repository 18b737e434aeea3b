"""Packing documents into token windows: best fit decreasing per shard.

Documents are tokenised once, on the map side. A document longer than a window
is first cut into full windows, which are sequences of their own; only its last
piece is packed. These pieces are dealt evenly over shards of about
``SHARD_ROWS`` pieces, so a shard fits one task whatever the input, and every
shard packs its pieces from the longest to the shortest, each into the tightest
open window that still takes it, found in a segment tree over remaining
capacity. Only piece bounds and checksums travel, never ids or text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialise, worker_state
from marketflow.llm.tokens import IdEncoder, default_path

SHARD_ROWS = 16_384
_PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_PACKED = _PIECES + ", sequence_id bigint, offset bigint"
_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


class CapacityTree:
    """A segment tree over remaining capacities; a node tells whether its range has an open window."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.open = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(most + 1)]

    def push(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        node = self.size + capacity
        while node:
            self.open[node] += 1
            node >>= 1

    def pop_tightest(self, length: int) -> tuple[int, int] | None:
        """The (capacity, window) with the least capacity of at least ``length``, taken out."""
        node = self.size + length
        if not self.open[node]:
            # Climb until a right sibling has something, then walk down to its leftmost leaf.
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        capacity = node - self.size
        while node:
            self.open[node] -= 1
            node >>= 1
        return capacity, self.windows[capacity].pop()


def best_fit(lengths, window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of each length; the lengths come in decreasing order."""
    tree, numbers, offsets, opened = CapacityTree(window), [], [], 0
    for length in lengths:
        found = tree.pop_tightest(length)
        if found is None:
            found = (window, opened)
            opened += 1
        capacity, number = found
        numbers.append(number)
        offsets.append(window - capacity)
        if capacity > length:
            tree.push(capacity - length, number)
    return numbers, offsets


def cut_documents(docs: DataFrame, id_col: str, text_col: str, window: int, end_id: int,
                  path: str) -> DataFrame:
    """One row per piece of each document's ids: full windows, then the rest."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        ids = worker_state(("ids", path), lambda: IdEncoder(path))
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(ids.encode(text.as_py() or "") + end)
                total = len(data) // 4
                for start in range(0, total, window):
                    piece = data[4 * start:4 * (start + window)]
                    for column, value in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), total)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], _NAMES)

    return rows.mapInArrow(run, _PIECES)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 1024,
         end_id: int = 0, tokenizer_path: str | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every document's ids end in ``end_id``, so a null or empty text is one id.
    Each id lies in exactly one piece, no piece crosses a window, and offsets in a
    sequence have no gaps; a sequence shorter than the window is padded at its
    end. Rows that repeat an id are packed as documents of their own; null ids
    stay null; further columns are ignored; an empty table gives no rows.
    """
    cut = cut_documents(docs, id_col, text_col, window, end_id, tokenizer_path or default_path())
    pieces = materialise(cut, "pack-pieces").withColumn("row", F.monotonically_increasing_id())
    # Odd sequence ids are full windows, even ones come from the shards.
    full = pieces.where(F.col("length") == window).select(
        *_NAMES,
        (F.col("row") * 2 + 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = pieces.where(F.col("length") < window)
    shards = max(1, -(-rest.count() // shard_rows))

    def pack_shard(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("ids_crc32", "ascending")])
        numbers, offsets = best_fit(table.column("length").to_pylist(), window)
        shard = table.column("shard")[0].as_py()
        ids = (np.array(numbers, np.int64) + (shard << 32)) * 2
        return (table.drop_columns(["shard"]).append_column("sequence_id", pa.array(ids, pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())))

    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).drop("row")
    return full.union(dealt.groupBy("shard").applyInArrow(pack_shard, _PACKED))
