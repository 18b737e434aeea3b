"""Spelling variants by permuterm rotations.

Every word gets a terminator, and all rotations of the marked word are made. Two
words that differ in one replaced character share the rotation that starts right
behind it, but for its last sign; a word with one character less *is* that shared
part. So a rotation is filed under its prefix that skips the edited character,
and, for the shorter word, under the whole of itself. Sorted by that key, all words
one edit apart stand next to each other in a group that holds at most one shorter
word and one word per letter, however many words there are. A scan of the sorted
rows gives each member the number of its neighbours in the group and the most
frequent of them; no pair is ever written out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketflow.llm.common import materialise

END = "$"  # the terminator; no word may hold it
LONG = 64  # signs of the longest key that is kept as text
_KEYS = "key string, edited int, id bigint, n bigint"
# A prime of 122 bits and a base below it, for hashes of long keys.
_PRIME, _BASE = (1 << 122) - 3, 0x1F3A5C7E9B2D4F60718293A4B5C6D7
_NEAR = "id bigint, n_near bigint, best_n bigint, best_id bigint"


def letter_runs(text: Column, letters: str, min_chars: int = 1) -> Column:
    """The maximal runs of at least ``min_chars`` signs of a character class, as an array (null: empty)."""
    return F.regexp_extract_all(F.coalesce(text.cast("string"), F.lit("")),
                                F.lit(f"[{letters}]{{{min_chars},}}"), F.lit(0))


def rotations(words: DataFrame) -> DataFrame:
    """``key, edited, id, n``: every rotation whole (``edited`` 0), and without its last sign (its code point).

    The code point is negative if the sign repeats the one before it. Keys of over
    ``LONG`` signs are written as 122-bit rolling hashes, all of a word in one pass
    over it, so a very long word costs its length and not the square of it.
    """
    marked = words.where(F.length("word") <= LONG).select("id", "n", F.concat("word", F.lit(END)).alias("m"))
    turned = marked.select("id", "n", "m", F.explode(F.sequence(F.lit(0), F.length("m") - 1)).alias("i"))
    turned = turned.select("id", "n", "m", "i", F.concat(F.expr("substring(m, i + 1)"), F.expr("left(m, i)")).alias("r"))
    sign = F.ascii(F.expr("right(r, 1)"))
    doubled = (F.col("i") > 1) & F.expr("substring(m, i, 1) = substring(m, i - 1, 1)")
    whole = F.struct(F.col("r").alias("key"), F.lit(0).alias("edited"))
    less = F.struct(F.expr("left(r, length(r) - 1)").alias("key"), F.when(doubled, -sign).otherwise(sign).alias("edited"))
    both = F.when(F.col("i") == 0, F.array(whole)).otherwise(F.array(whole, less))
    short = turned.select(F.explode(both).alias("f"), "id", "n").where(F.length("f.key") <= LONG)
    long = words.where(F.length("word") >= LONG).select("id", "n", "word").mapInArrow(_hashed, _KEYS)
    return short.select("f.key", "f.edited", "id", "n").unionByName(long)


def hashed_rotations(word: str) -> list[tuple[str, int]]:
    """``key, edited`` of all rotations of the marked word, and of those without their last sign, over ``LONG`` signs."""
    codes = [*map(ord, word)]
    size, before, power = len(codes), [0], [1]
    for c in codes:
        before.append((before[-1] * _BASE + c) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    out = []
    for i in range(size + 1):  # word[i:] + END + word[:i]
        behind = ((before[size] - before[i] * power[size - i]) * _BASE + ord(END)) % _PRIME
        if size + 1 > LONG:
            out.append((f"{(behind * power[i] + before[i]) % _PRIME:031x}", 0))
        if i and size > LONG:
            sign = -codes[i - 1] if i > 1 and codes[i - 1] == codes[i - 2] else codes[i - 1]
            out.append((f"{(behind * power[i - 1] + before[i - 1]) % _PRIME:031x}", sign))
    return out


def _hashed(batches):
    for batch in batches:
        for word_id, n, word in zip(*(c.to_pylist() for c in batch.columns)):
            keys, edited = zip(*hashed_rotations(word))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(edited, pa.int32()), pa.array([word_id] * len(keys), pa.int64()),
                 pa.array([n] * len(keys), pa.int64())], ["key", "edited", "id", "n"])


def _first_of(group: np.ndarray, n: np.ndarray, ids: np.ndarray, groups: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Per group the ``n`` and id of its most frequent member (smallest id first), or of the one after it; -1: none."""
    best_n, best_id = np.full(groups, -1, np.int64), np.full(groups, -1, np.int64)
    order = np.lexsort((ids, -n, group))
    at = np.arange(len(order)) - np.searchsorted(group[order], group[order])
    pick = order[at == skip]
    best_n[group[pick]], best_id[group[pick]] = n[pick], ids[pick]
    return best_n, best_id


def _better(a: tuple, b: tuple) -> tuple:
    take = (b[0] > a[0]) | ((b[0] == a[0]) & (b[1] < a[1]))
    return np.where(take, b[0], a[0]), np.where(take, b[1], a[1])


def group_neighbours(group: np.ndarray, edited: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of groups numbered from 0: its neighbours there, and the ``n`` and id of the most frequent one.

    Rows with a skipped character are one replacement apart from each other. The
    whole rotation (at most one a group) is one deletion apart from those rows
    whose skipped character does not repeat the one before it (``edited`` > 0):
    deleting any of a stretch of equal characters gives the same word, which
    counts once.
    """
    groups = int(group[-1]) + 1
    cut, once = edited != 0, edited > 0
    n_cut, n_once = (np.bincount(group[m], minlength=groups) for m in (cut, once))
    whole = _first_of(group[~cut], n[~cut], ids[~cut], groups)
    first = _first_of(group[cut], n[cut], ids[cut], groups)
    second = _first_of(group[cut], n[cut], ids[cut], groups, skip=1)
    only = _first_of(group[once], n[once], ids[once], groups)
    near = np.where(cut, n_cut[group] - 1 + (once & (whole[1][group] >= 0)), n_once[group])
    own = first[1][group] == ids
    other = tuple(np.where(own, s[group], f[group]) for f, s in zip(first, second))
    shorter = tuple(np.where(once, w[group], -1) for w in whole)
    best = _better(other, (shorter[0], np.where(shorter[0] < 0, np.iinfo(np.int64).max, shorter[1])))
    best = tuple(np.where(cut, b, o[group]) for b, o in zip(best, only))
    return near, best[0], best[1]


def _scan(batches):
    """The sorted rows, group by group; a batch's last group waits for the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if held is not None:
            table = pa.concat_tables([held, table])
        if table.num_rows == 0:
            continue
        table = table.combine_chunks()
        keys = table.column("key").chunk(0)
        new = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], np.flatnonzero(new) + 1])
        yield from _emit(table.slice(0, start[-1]), start[:-1])
        held = table.slice(start[-1])
    if held is not None:
        yield from _emit(held, np.array([0]))


def _emit(table: pa.Table, start: np.ndarray):
    sizes = np.diff(np.append(start, table.num_rows))
    rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
    if not len(rows):
        return
    some = table.take(pa.array(rows)).combine_chunks()
    group = np.repeat(np.arange(int((sizes > 1).sum())), sizes[sizes > 1])
    edited, ids, n = (some.column(c).to_numpy() for c in ("edited", "id", "n"))
    near, best_n, best_id = group_neighbours(group, edited, ids, n)
    keep = near > 0
    yield pa.RecordBatch.from_arrays([pa.array(c[keep], pa.int64()) for c in (ids, near, best_n, best_id)],
                                     ["id", "n_near", "best_n", "best_id"])


def spelling_variants(words: DataFrame, ratio: float = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for a table ``word, n``.

    Two words are near if one inserted, deleted or replaced code point turns one
    into the other; ``n_near`` counts them. ``form`` is the near word of largest
    ``n`` (ties: the smallest in code-point order) if that is at least ``ratio``
    times the word's own, ``form_n`` its ``n``, else both are null; ``root`` is
    where following the forms ends, the word itself if it has none. Words that are
    null, empty or hold the terminator ``$`` are left out, rows repeating a word
    count together, a null ``n`` as 0 and one word. ``ratio`` must be above 1, so
    that every step of the way to a root raises ``n``. An empty table gives no rows;
    further columns are ignored.
    """
    if ratio <= 1:
        raise ValueError("ratio must be above 1")
    clean = words.select(F.col("word").cast("string").alias("word"), F.coalesce(F.col("n").cast("bigint"), F.lit(0)).alias("n"))
    clean = clean.where((F.length("word") > 0) & ~F.contains("word", F.lit(END))).groupBy("word").agg(F.sum("n").alias("n"))
    # Sorted ranges in order: the ids follow the words' code-point order.
    table = materialise(clean.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "variants-words")
    found = rotations(table).repartition("key").sortWithinPartitions("key").mapInArrow(_scan, _NEAR)
    # Best first by n, then by the smallest id.
    best = F.max(F.struct(F.col("best_n"), (-F.col("best_id")).alias("minus")))
    near = materialise(found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best.alias("best")), "variants-near")
    joined = table.join(near, "id", "left")
    up = F.when((F.col("best.best_n") > 0) & (F.col("best.best_n") >= ratio * F.col("n")), -F.col("best.minus"))
    joined = materialise(joined.select("id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                                       up.alias("form_id")), "variants-forms")
    roots = _roots(joined.where("form_id is not null").select("id", F.col("form_id").alias("root_id")), joined, ratio)
    named = joined.select(F.col("id").alias("of"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    last = joined.select(F.col("id").alias("end"), F.col("word").alias("last"))
    linked = (joined.where("form_id is not null").join(roots, "id")
              .join(named, F.col("form_id") == F.col("of")).join(last, F.col("root_id") == F.col("end")))
    alone = joined.where("form_id is null")
    return linked.select("word", "n", "n_near", "form", "form_n", F.col("last").alias("root")).unionByName(
        alone.select("word", "n", "n_near", F.lit(None).cast("string").alias("form"),
                     F.lit(None).cast("bigint").alias("form_n"), F.col("word").alias("root")))


def _roots(links: DataFrame, table: DataFrame, ratio: float) -> DataFrame:
    """``id, root_id``: the ends of the ways along ``links``, each round doubling the steps taken.

    Every step multiplies ``n`` by at least ``ratio`` (from 0: reaches at least 1),
    so the longest way, and with it the number of rounds, is known beforehand.
    """
    bounds = table.agg(F.max("n").alias("high"), F.min("n").alias("low")).first()
    steps = 0 if not bounds["high"] else 2 + math.floor(math.log(bounds["high"] / max(bounds["low"], 1)) / math.log(ratio))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        further = links.select(F.col("id").alias("at"), F.col("root_id").alias("next"))
        links = links.join(further, F.col("root_id") == F.col("at"), "left").select(
            "id", F.coalesce("next", "root_id").alias("root_id"))
        links = materialise(links, "variants-roots")
    return links
