"""Periodic runs of words by recompression.

A block of documents becomes one sequence of word numbers with a number of its own
between documents. Alternate rounds of block compression (a stretch of one symbol
becomes one symbol) and pair compression (symbols are split in two classes; every
pair first class, second class becomes one symbol) give a run-length grammar whose
levels parse equal stretches alike, but for their borders. How far two places agree
(their LCE) is then found by climbing the levels while both places start a symbol
of the level above, and coming down again where the symbols differ. For every period
``p`` the places ``0, p, 2p, ...`` are candidates: each run of that period, being at
least two periods long, covers such a place and the next. Extending the pair to the
right and to the left gives the run exactly. All candidates of a block are handled
together in numpy, a bounded number at a time.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 18  # words from which on a block of documents is closed
AT_ONCE = 1 << 20  # candidates looked at together
TOP = 4  # the grammar ends when no document has more symbols than that
_RUN = "struct<start:bigint,length:bigint,period:bigint>"
_OUT = f"doc_id bigint, n_words bigint, runs array<{_RUN}>, collapsed binary"
_RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Level:
    """One level of the grammar, read in one direction.

    ``up``: the place, one level above, of the symbol that holds a place; ``down``:
    the first place, one level below, of each symbol (and one entry for the end);
    ``blocks``: whether the step to the level above was a block compression.
    """

    __slots__ = ("symbols", "up", "down", "blocks")

    def __init__(self, symbols, down=None):
        self.symbols, self.down, self.up, self.blocks = symbols, down, None, False


def _names(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Equal pairs get equal numbers from 0."""
    wide = first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second
    return np.unique(wide, return_inverse=True)[1]


def _mix(symbols: np.ndarray, level: int) -> np.ndarray:
    """A class, 0 or 1, for each symbol, other ones at every level."""
    x = (symbols.astype(np.uint64) + np.uint64(level * 2 + 1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(63)).astype(np.int8)


def grammar(sequence: np.ndarray, borders: np.ndarray) -> list[Level]:
    """The levels over ``sequence``, whose places ``borders`` hold symbols found nowhere else."""
    levels, at, fresh = [Level(sequence)], borders, int(sequence.max()) + 1
    while np.diff(at).max(initial=0) > TOP + 1:
        low = levels[-1]
        s = low.symbols
        same = s[1:] == s[:-1]
        low.blocks = bool(same.any()) and not (len(levels) > 1 and levels[-2].blocks)
        if low.blocks:
            begins = np.concatenate([[True], ~same])
        else:
            kind = _mix(s, len(levels))
            kind[at] = 2
            begins = np.ones(len(s), bool)
            begins[1:] = ~((kind[:-1] == 0) & (kind[1:] == 1))
        down = np.append(np.flatnonzero(begins), len(s)).astype(np.int32)
        size = np.diff(down)
        symbols = s[down[:-1]].copy()
        joined = np.flatnonzero(size > 1)
        if len(joined):
            second = size[joined] if low.blocks else s[down[joined] + 1]
            names = _names(symbols[joined], second)
            symbols[joined] = fresh + names
            fresh += int(names.max()) + 1
        low.up = np.cumsum(begins, dtype=np.int32) - 1
        levels.append(Level(symbols, down))
        at = low.up[at]
    return levels


def mirrored(levels: list[Level]) -> list[Level]:
    """The same grammar read from the right."""
    out = []
    for k, level in enumerate(levels):
        m = len(level.symbols)
        down = None
        if level.down is not None:
            down = len(levels[k - 1].symbols) - level.down[::-1]
        turned = Level(level.symbols[::-1], down)
        turned.blocks = level.blocks
        if level.up is not None:
            turned.up = len(levels[k + 1].symbols) - 1 - level.up[::-1]
        assert down is None or len(down) == m + 1
        out.append(turned)
    return out


def _steps(levels: list[Level], k: int, a: np.ndarray, b: np.ndarray) -> np.ndarray | int:
    """How many equal symbols a comparison at level ``k`` that came out equal covers."""
    if k + 1 == len(levels) or not levels[k].blocks:
        return 1
    up, down = levels[k].up, levels[k + 1].down
    return np.minimum(down[up[a] + 1] - a, down[up[b] + 1] - b)


def extend(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from the places ``a`` and ``b`` (never the same place) on agree, pair by pair."""
    stopped = [[] for _ in levels]  # by level: which pairs, and where their symbols differ
    which, x, y = np.arange(len(a)), a, b
    for k, level in enumerate(levels):
        climbing = []
        while len(which):
            equal = level.symbols[x] == level.symbols[y]
            if not equal.all():
                stopped[k].append((which[~equal], x[~equal], y[~equal]))
                which, x, y = which[equal], x[equal], y[equal]
            if k + 1 < len(levels) and len(which):
                up, down = level.up, levels[k + 1].down
                both = (down[up[x]] == x) & (down[up[y]] == y)
                climbing.append((which[both], up[x[both]], up[y[both]]))
                which, x, y = which[~both], x[~both], y[~both]
            step = _steps(levels, k, x, y)
            x, y = x + step, y + step
        if not climbing:
            break
        which, x, y = (np.concatenate(c) for c in zip(*climbing))
    out = np.zeros(len(a), np.int64)
    which, x, y = (np.zeros(0, np.int64) for _ in range(3))
    for k in range(len(levels) - 1, -1, -1):
        if len(which):
            x, y = levels[k + 1].down[x], levels[k + 1].down[y]
            open_ = np.arange(len(which))
            while len(open_):
                open_ = open_[levels[k].symbols[x[open_]] == levels[k].symbols[y[open_]]]
                step = _steps(levels, k, x[open_], y[open_])
                x[open_] += step
                y[open_] += step
        for w, p, q in stopped[k]:
            which, x, y = np.concatenate([which, w]), np.concatenate([x, p]), np.concatenate([y, q])
    out[which] = x - a[which]
    return out


def _grid(starts: np.ndarray, lengths: np.ndarray):
    """``place, period`` of the candidates of all documents, in chunks, by document and period."""
    for begin, n in zip(*_spans(lengths)):
        doc = np.repeat(np.arange(begin, n), lengths[begin:n] // 2)
        period = np.arange(len(doc)) - np.repeat(np.cumsum(lengths[begin:n] // 2) - lengths[begin:n] // 2, lengths[begin:n] // 2) + 1
        count = (lengths[doc] - 1) // period
        ends = np.cumsum(count)
        lo = 0
        while lo < len(doc):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + AT_ONCE, "right")))
            each = count[lo:hi]
            p = np.repeat(period[lo:hi], each)
            nth = np.arange(len(p)) - np.repeat(np.cumsum(each) - each, each)
            yield np.repeat(starts[doc[lo:hi]], each) + nth * p, p
            lo = hi


def _spans(lengths: np.ndarray) -> tuple[list[int], list[int]]:
    """Stretches of documents with about ``AT_ONCE`` periods in all."""
    ends = np.cumsum(lengths // 2)
    cuts = [0]
    while cuts[-1] < len(lengths):
        done = ends[cuts[-1] - 1] if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + AT_ONCE, "right"))))
    return cuts[:-1], cuts[1:]


def runs_of(sequence: np.ndarray, starts: np.ndarray, lengths: np.ndarray, min_length: int) -> np.ndarray:
    """Rows ``start, end, period`` of all maximal runs, by start, then period.

    Document ``i`` lies at ``starts[i]`` and has ``lengths[i]`` words; before and
    behind each document stands a symbol found nowhere else.
    """
    borders = np.append(starts - 1, len(sequence) - 1)
    levels = grammar(sequence, borders)
    back = mirrored(levels)
    found = [np.zeros((0, 3), np.int64)]
    for place, p in _grid(starts, lengths):
        # One place of every run agrees with the next at its first word, and on one more side if more is needed.
        some = sequence[place] == sequence[place + p]
        place, p = place[some], p[some]
        some = ((sequence[place + 1] == sequence[place + p + 1]) | (sequence[place - 1] == sequence[place + p - 1])
                | (np.maximum(p, min_length - p) < 2))
        place, p = place[some], p[some]
        if not len(place):
            continue
        right = extend(levels, place, place + p)
        last = len(sequence) - 1
        left = extend(back, last - place + 1, last - (place + p) + 1)
        begin, end = place - left, place + p + right
        long = end - begin >= np.maximum(min_length, 2 * p)
        if long.any():
            found.append(_smallest(np.stack([begin[long], end[long], p[long]], 1)))
    all_ = _smallest(np.concatenate(found))
    return all_[np.lexsort((all_[:, 2], all_[:, 0]))]


def _smallest(rows: np.ndarray) -> np.ndarray:
    """One row per stretch, the one of its smallest period: all others are its multiples."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)
    return rows[new]


def _block(ids: list, texts: list[list[bytes]], min_length: int) -> pa.RecordBatch:
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    sequence = np.empty(int(lengths.sum()) + len(texts) + 1, np.int32)
    number: dict = defaultdict()
    number.default_factory = number.__len__
    for begin, words in zip(starts.tolist(), texts):
        sequence[begin:begin + len(words)] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
    borders = np.append(starts - 1, len(sequence) - 1)
    sequence[borders] = len(number) + np.arange(len(borders))
    runs = runs_of(sequence, starts, lengths, min_length)
    doc = np.searchsorted(starts, runs[:, 0], "right") - 1
    change = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change) == 0
    touched = set(doc.tolist())
    collapsed = [b" ".join(compress(words, kept[begin:begin + len(words)].tolist()) if i in touched else words)
                 for i, (begin, words) in enumerate(zip(starts.tolist(), texts))]
    listed = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(doc, np.arange(len(texts) + 1)), pa.int32()),
        pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (
            runs[:, 0] - starts[doc], runs[:, 1] - runs[:, 0], runs[:, 2])], fields=list(_RUN_TYPE)))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), listed, pa.array(collapsed, pa.binary())],
        ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text", min_length: int = 12) -> DataFrame:
    """One row per input row: ``doc_id, n_words, runs, collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``. ``runs`` holds every maximal stretch of at
    least ``min_length`` words, and at least two periods, with its smallest period,
    ordered by start, then period; words are numbered from 0. ``collapsed`` is the
    text without the words that a run repeats (those behind its first period),
    joined by one space. A null text counts as empty: no words, no runs, an empty
    text. Rows that repeat an id or text, or have no id, each give their row; an
    empty table gives none; further columns are ignored. Documents are worked on in
    blocks of ``BLOCK`` words, a longer one by itself: memory follows the longest
    document, time its words times the logarithm of their number.
    """
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(text.cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().split()  # bytes split at exactly these six signs
                ids.append(doc)
                texts.append(words)
                size += len(words) + 1
                if size >= BLOCK:
                    yield _block(ids, texts, min_length)
                    ids, texts, size = [], [], 0
        if ids:
            yield _block(ids, texts, min_length)

    return rows.mapInArrow(run, _OUT).withColumn("collapsed", F.col("collapsed").cast("string"))
