"""SimHash near-duplicates: exact search of all fingerprint pairs within a radius, tile by tile.

Equal fingerprints are folded first. Two of the rest differ in at most
``radius`` bits only if at least two of ``radius + 2`` blocks of bits are equal,
so every fingerprint is dealt to one cell per pair of blocks, and all linked
pairs meet in a cell: the search stays exact. Cells of one fingerprint are
dropped before any Python runs.

A cell is compared in tiles: ``numpy`` exclusive-or and bit counts over a tile
pair, and tile pairs whose population counts differ by more than the radius are
skipped, as such fingerprints cannot be linked. A cell with more than ``TILE``
fingerprints is refined by blocks of its remaining bits; one that is still as large
is split into tiles by population count and hash, and its tile
pairs are dealt out as tasks of their own. A tile pair returns a spanning forest
of its links, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import LOWER, UPPER, materialise, shuffle_partitions
from marketflow.llm.components import component_roots, smallest_member, spanning_forest

TILE = 1024
_SLICE = 256  # rows of one in-memory comparison
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_BITS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """The SimHash of a text: a bit is set if it is in over half of its shingles' XXH64."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    starts = ends - size
    k = min(shingle, len(words))
    bounds = list(zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist()))
    digest = xxhash.xxh64_digest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(bounds), _BITS_AT_ONCE):
        raw = b"".join([digest(joined[s:e], seed) for s, e in bounds[at:at + _BITS_AT_ONCE]])
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(bounds))
    return int.from_bytes(bits.tobytes(), "big")


def _fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
                       F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "text_key", "fp"])

    return rows.mapInArrow(run, "doc_id bigint, text_key bigint, fp bigint")


def _cut(bits: int, parts: int) -> list[tuple[int, int]]:
    """The lowest bit and the width of ``parts`` blocks of about equal width."""
    edges = [bits * i // parts for i in range(parts + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def _bits(value: Column, lo: int, width: int) -> Column:
    return F.shiftrightunsigned(value, lo).bitwiseAND(F.lit((1 << width) - 1))


def _block_pairs(fp: Column, radius: int, bits: int = 64) -> list[Column]:
    """One key per pair of blocks: the pair's number and the bits of both blocks."""
    blocks = [_bits(fp, lo, width) for lo, width in _cut(bits, radius + 2)]
    return [F.struct(F.lit(n).alias("pair"), blocks[i].alias("x"), blocks[j].alias("y"))
            for n, (i, j) in enumerate(combinations(range(radius + 2), 2))]


def _rest(fp: Column, pair: Column, radius: int) -> tuple[Column, int]:
    """The bits outside a pair of blocks, moved together, and the least number of them in any pair."""
    cut, rests, least = _cut(64, radius + 2), [], 64
    for i, j in combinations(range(radius + 2), 2):
        value, at = F.lit(0).cast("bigint"), 0
        for k, (lo, width) in enumerate(cut):
            if k not in (i, j):
                value = value.bitwiseOR(F.shiftleft(_bits(fp, lo, width), at))
                at += width
        rests.append(value)
        least = min(least, at)
    return F.element_at(F.array(*rests), pair + 1), least


_CELL = ["pair", "x", "y"]


def _cells(prints: DataFrame, radius: int) -> DataFrame:
    """Rows ``pair, x, y, lo, hi, fp, pop`` of the fingerprints to compare in each cell or tile pair.

    A cell of more than ``TILE`` fingerprints is first refined: its members differ, if
    linked, in at most ``radius`` of the bits outside its two blocks, so these bits
    are cut into blocks again and the members dealt to one cell per pair of them. What
    stays too large after that is split into tiles.
    """
    keyed = (prints.select("fp", F.bit_count("fp").alias("pop"), F.explode(F.array(*_block_pairs(F.col("fp"), radius))).alias("k"))
             .select("k.*", "fp", "pop"))
    sizes = materialise(keyed.groupBy(*_CELL).agg(F.count("*").alias("n")).where("n > 1"), "simhash-cells")
    rows = keyed.join(sizes, _CELL)
    rest, bits = _rest(F.col("fp"), F.col("pair"), radius)
    if bits >= radius + 2:
        small = rows.where(F.col("n") <= TILE)
        pairs = (radius + 2) * (radius + 1) // 2
        width = -(-bits // (radius + 2))
        fine = (rows.where(F.col("n") > TILE).withColumn("k", F.explode(F.array(*_block_pairs(rest, radius, bits))))
                .select((F.col("pair") * pairs + F.col("k.pair") + pairs).alias("pair"),
                        F.shiftleft("x", width).bitwiseOR(F.col("k.x")).alias("x"),
                        F.shiftleft("y", width).bitwiseOR(F.col("k.y")).alias("y"), "fp", "pop"))
        counts = materialise(fine.groupBy(*_CELL).agg(F.count("*").alias("n")).where("n > 1"), "simhash-fine")
        rows = small.unionByName(fine.join(counts, _CELL))
    rows = rows.withColumn("parts", F.ceil(F.col("n") / TILE))
    # A cell that is still large: tile = (population count, part); partners are the tiles within the radius.
    part = F.pmod(F.xxhash64("fp"), F.col("parts"))
    tile = F.col("pop") * F.col("parts") + part
    near = F.sequence(F.greatest(F.lit(0), F.col("pop") - radius) * F.col("parts"),
                      (F.col("pop") + radius + 1) * F.col("parts") - 1)
    rows = rows.withColumn("tile", F.when(F.col("parts") > 1, tile).otherwise(0).cast("bigint"))
    rows = rows.withColumn("other", F.explode(F.when(F.col("parts") > 1, near).otherwise(F.array(F.lit(0).cast("bigint")))))
    return rows.select(*_CELL, F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"), "fp", "pop")


def spanning_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the fingerprints, as two arrays."""
    pops = np.bitwise_count(fps)
    order = np.argsort(pops, kind="stable")
    fps, pops = fps[order], pops[order].astype(np.int64)
    left, right = [], []
    for a in range(0, len(fps), _SLICE):
        for b in range(a, len(fps), _SLICE):
            if pops[b] - pops[min(a + _SLICE, len(fps)) - 1] > radius:
                break  # population counts rise from here on
            i, j = np.nonzero(np.bitwise_count(fps[a:a + _SLICE, None] ^ fps[None, b:b + _SLICE]) <= radius)
            left.append(i + a)
            right.append(j + b)
    i, j = np.concatenate(left), np.concatenate(right)
    child, parent = spanning_forest(i, j, len(fps))
    return fps[child], fps[parent]


def _links(cells: DataFrame, radius: int) -> DataFrame:
    key = ["pair", "x", "y", "lo", "hi"]
    spark = cells.sparkSession
    dealt = cells.select(*key, "fp").repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key)

    def run(batches):
        held = None
        for batch in batches:
            table = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)])
            held = table if held is None else np.concatenate([held, table], axis=1)
            change = np.nonzero((held[:5, 1:] != held[:5, :-1]).any(axis=0))[0] + 1
            if len(change):
                yield from _compare(held[:, :change[-1]], change[:-1], radius)
                held = held[:, change[-1]:]
        if held is not None and held.shape[1]:
            yield from _compare(held, np.array([], np.int64), radius)

    return dealt.mapInArrow(run, "a bigint, b bigint")


def _compare(table: np.ndarray, cuts: np.ndarray, radius: int):
    a, b = [], []
    for fps in np.split(table[5], cuts):
        if len(fps) > 1:
            x, y = spanning_links(fps.view(np.uint64), radius)
            a.append(x)
            b.append(y)
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    prints = materialise(_fingerprints(docs, id_col, text_col, shingle), "simhash-prints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-distinct")
    roots = component_roots(_links(_cells(distinct, radius), radius))
    linked = smallest_member(roots, distinct.select(F.col("fp").alias("node"), "id"))
    found = (distinct.join(linked.select(F.col("node").alias("fp"), "component"), "fp", "left")
             .select("fp", F.coalesce("component", "id").alias("component_id")))
    return prints.join(materialise(found, "simhash-found"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, fingerprint`` (16 lowercase hex digits), ``component_id``.

    Texts are lower-cased (A-Z) and cut into words at ``[\\x20\\x09-\\x0D]``; a
    text of fewer words than a shingle is one shingle; a null text, or one
    without words, has fingerprint zero, linked like any other. ``component_id``
    is the smallest id reachable over links of at most ``radius`` bits; null ids
    are never chosen unless a component has no other. Rows that repeat an id are
    kept apart. An empty table gives no rows; further columns are ignored.
    """
    return _grouped(docs, id_col, text_col, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents whose id is their component's, with all their columns."""
    kept = (_grouped(docs, id_col, text_col, shingle, radius)
            .where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key")).distinct())
    same = (F.col(id_col).cast("bigint").eqNullSafe(F.col("__llm_id"))
            & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__llm_key")))
    return docs.join(materialise(kept, "simhash-kept"), same, "left_semi")
