"""Line de-duplication by range-partitioned, secondarily sorted line hashes.

Every document is split into lines on the map side and gives one small row per
distinct line key: a 128-bit hash, the document and the line's positions in it.
No text moves. The rows are range-partitioned and sorted by (hash, document), so
a key that occurs everywhere spreads over as many partitions as it needs. Each
partition is streamed once: a run of equal hashes counts its first occurrences
per document, holds back at most ``min_docs - 1`` rows until the run is known to
be common, and returns the positions to drop. Runs cut by a partition's border
are settled by a second step over the border rows, a few per partition. What
comes back per document is a compressed bitmap of the lines it keeps.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import LOWER, UPPER, WS, materialise, shuffle_partitions

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_WS = WS.encode()
_DOC = "doc_id bigint, text_key bigint"
_ROWS = f"hash binary, {_DOC}, n_lines bigint, positions binary"
_MARKS = f"{_ROWS}, docs bigint, kind string"
_KINDS = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string()]
_MARK_NAMES = ["hash", "doc_id", "text_key", "n_lines", "positions", "docs", "kind"]


def keep_bitmap(n_lines: int, drop: np.ndarray) -> bytes:
    """A compressed bitmap with a one for every line that stays."""
    keep = np.ones(n_lines, np.uint8)
    keep[drop] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def kept_lines(bitmap: bytes, lines: list) -> list:
    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=len(lines))
    return [line for line, stays in zip(lines, keep.tolist()) if stays]


def line_key(line: bytes) -> bytes:
    return line.strip(_WS).translate(_LOWER)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                       text.alias("text"))


def _line_rows(keyed: DataFrame, min_chars: int) -> DataFrame:
    """One row per document and distinct line key of at least ``min_chars`` code points."""

    def run(batches):
        for batch in batches:
            out = [[], [], [], [], []]
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                lines = text.as_py().encode().split(b"\n")
                where: dict[bytes, list[int]] = {}
                for i, line in enumerate(lines):
                    where.setdefault(line_key(line), []).append(i)
                for line, positions in where.items():
                    if len(line) >= min_chars and (len(line) >= 4 * min_chars or len(line.decode()) >= min_chars):
                        for column, value in zip(out, (xxhash.xxh3_128_digest(line), doc, key, len(lines),
                                                       array("I", positions).tobytes())):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _KINDS)], _MARK_NAMES[:5])

    return keyed.mapInArrow(run, _ROWS)


class Runs:
    """Walks one sorted partition and marks rows ``drop``, ``open`` (for the border step) or ``count``."""

    def __init__(self, min_docs: int):
        self.min_docs, self.hash, self.first = min_docs, None, True
        self.marks: list[tuple] = []

    def close(self, last: bool) -> None:
        """Ends the current run. Only a partition's first and last run can go on in another one."""
        if self.hash is not None:
            if self.first or last:
                self.marks.append((self.hash, None, None, None, None, self.docs, "count"))
                self.marks.extend((*row, None, "open") for row in self.held)
            self.first = False

    def add(self, row: tuple) -> None:
        if row[0] != self.hash:
            self.close(False)
            self.hash, self.docs, self.last, self.held = row[0], 0, None, []
        if row[1:3] == self.last:
            return  # the same document once more
        self.last = row[1:3]
        self.docs += 1
        if self.docs < self.min_docs:
            self.held.append(row)
        else:
            self.marks.extend((*r, None, "drop") for r in self.held)
            self.marks.append((*row, None, "drop"))
            self.held = []

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.marks)) or [()] * len(_KINDS)
        self.marks = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KINDS)], _MARK_NAMES)


def _bitmaps(batches):
    for batch in batches:
        lines, drops = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        gone = [np.frombuffer(b"".join(d), np.uint32) for d in drops]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array([len(g) for g in gone], pa.int64()),
             pa.array([keep_bitmap(n, g) for n, g in zip(lines, gone)], pa.binary())],
            ["doc_id", "text_key", "n_lines", "n_dropped", "keep_bitmap"])


def common_line_bitmaps(keyed: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``doc_id, text_key, n_lines, n_dropped, keep_bitmap`` of the documents that lose lines."""
    order = ["hash", "doc_id", "text_key"]
    dealt = (_line_rows(keyed, min_chars)
             .repartitionByRange(shuffle_partitions(keyed.sparkSession), *order).sortWithinPartitions(*order))

    def run(batches):
        runs = Runs(min_docs)
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                runs.add(row)
            yield runs.take()
        runs.close(True)
        yield runs.take()

    marks = materialise(dealt.mapInArrow(run, _MARKS), "line-marks")
    row = ["doc_id", "text_key", "n_lines", "positions"]
    common = (marks.where("kind = 'count'").groupBy("hash").agg(F.sum("docs").alias("docs"))
              .where(F.col("docs") >= min_docs))
    settled = marks.where("kind = 'open'").select("hash", *row).join(common, "hash", "left_semi")
    dropped = marks.where("kind = 'drop'").select(*row).union(settled.select(*row))
    grouped = dropped.groupBy("doc_id", "text_key").agg(F.max("n_lines").alias("n_lines"),
                                                        F.collect_list("positions").alias("positions"))
    return grouped.select("doc_id", "text_key", "n_lines", "positions").mapInArrow(
        _bitmaps, f"{_DOC}, n_lines bigint, n_dropped bigint, keep_bitmap binary")


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, kept_sha256, kept_text, keep_bitmap``.

    A text is split at newlines (null or empty: one empty line). A line's key is
    the line without ``[\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased. Keys
    of at least ``min_chars`` code points found in at least ``min_docs`` documents
    lose all their lines everywhere; the others stay, joined by newlines. Rows
    that repeat both id and text are one document (all of them lose the lines);
    rows that share only an id, or have none, are documents of their own. The
    bitmap is null where nothing is dropped. An empty table gives no rows;
    further columns are ignored.
    """
    keyed = _keyed(docs, id_col, text_col)
    bitmaps = materialise(common_line_bitmaps(keyed, min_docs, min_chars), "line-bitmaps")
    right = bitmaps.select(F.col("doc_id").alias("id"), F.col("text_key").alias("tk"), "n_dropped", "keep_bitmap")
    joined = keyed.join(right, (F.col("text_key") == F.col("tk")) & F.col("doc_id").eqNullSafe(F.col("id")), "left")

    def rebuild(batches):
        for batch in batches:
            n_lines, kept = [], []
            for text, bitmap in zip(batch.column(1), batch.column(3).to_pylist()):
                lines = text.as_py().split("\n")
                n_lines.append(len(lines))
                kept.append("\n".join(lines if bitmap is None else kept_lines(bitmap, lines)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), batch.column(2),
                 pa.array([hashlib.sha256(k.encode()).hexdigest() for k in kept], pa.string()),
                 pa.array(kept, pa.string()), batch.column(3)],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text", "keep_bitmap"])

    return (joined.select("doc_id", "text", F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"), "keep_bitmap")
            .mapInArrow(rebuild, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string, "
                                 "kept_text string, keep_bitmap binary"))
