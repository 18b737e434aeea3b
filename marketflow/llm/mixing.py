"""Mixing overlapping sources to target weights by min-cost flow, then seeded document choice.

Documents are aggregated by membership pattern (the set of sources they belong
to), so the flow network has one node per pattern and source, however many
documents there are. Words flow from a pattern's copies to the quotas of its
sources; the first copy of a pattern costs nothing and every further one more
than the last, so nothing is repeated while fresh words are left. What a pattern
sends is then met by whole documents: all of them for every full copy, and for the
rest, in a seeded order, each that still fits (or, from the end of the order, each
that fits into the surplus is left out; whichever leaves the smaller gap). Where the
next document does not fit is found by histograms of the order's digits, level by
level, so no source, however large, is ever sorted or gathered; only a stretch of at
most ``REGION`` documents around that place is walked. The search then goes on behind
the stretch with the documents that fit into what is left, until none does, so the
result does not depend on ``REGION``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketflow.llm.common import materialise

MAX_PATTERNS = 1 << 18  # the driver solves a network of this size; more patterns raise an error
REGION = 1024  # documents walked at a time
_BITS, _LEVELS = 12, 5  # digits per hash
_HALF = _BITS * _LEVELS  # an order's place has so many bits of the seeded hash, then of the row's number, for equal rows
_END = 1 << 2 * _HALF
_SPAN = "struct<u0:bigint,v0:bigint,u1:bigint,v1:bigint,room:bigint>"


@dataclass(frozen=True)
class Source:
    size: int
    target: float


def water_fill(sizes: list[int], weights: list[float], total: float, cap: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``cap`` times its size, the excess reshared."""
    target = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    left = total
    while free:
        whole = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / whole > cap * sizes[i]]
        if not over:
            for i in free:
                target[i] = left * weights[i] / whole
            break
        for i in over:
            target[i] = float(cap * sizes[i])
        left -= sum(target[i] for i in over)
        free -= set(over)
    return target


def min_cost_flow(sizes: list[int], members: list[list[int]], quotas: list[int], copies: int) -> list[int]:
    """Words each pattern sends: as much of the quotas as can be met, at the least repetition cost.

    The network is start -> pattern -> source -> end. What a pattern sends beyond its
    k-th copy costs more than all before, and the same for every pattern. The amounts
    that patterns can send together form a polymatroid (no augmenting path ever
    takes words back from a pattern), so the cheapest flow is found by cost levels: as
    much as possible with one copy of each pattern, then with two, and so on,
    each level a maximum flow by blocking flows.
    """
    n = len(sizes) + len(quotas) + 2
    start, end = n - 2, n - 1
    to, room, arcs = [], [], [[] for _ in range(n)]  # an arc and its reverse have numbers that differ in the last bit

    def arc(a, b, capacity):
        for x, y, c in ((a, b, capacity), (b, a, 0)):
            arcs[x].append(len(to))
            to.append(y)
            room.append(c)

    for p, size in enumerate(sizes):
        arc(start, p, 0)
        for s in members[p]:
            arc(p, len(sizes) + s, copies * size)
    for s, quota in enumerate(quotas):
        arc(len(sizes) + s, end, quota)
    for _ in range(copies):
        for i, size in zip(arcs[start], sizes):
            room[i] += size
        while (far := _distances(arcs, to, room, start, end)) is not None:
            _blocking_flow(arcs, to, room, far, start, end)
    return [room[i ^ 1] for i in arcs[start]]


def _distances(arcs, to, room, start: int, end: int) -> list[int] | None:
    far = [-1] * len(arcs)
    far[start], layer = 0, [start]
    while layer and far[end] < 0:
        after = []
        for a in layer:
            for i in arcs[a]:
                if room[i] and far[to[i]] < 0:
                    far[to[i]] = far[a] + 1
                    after.append(to[i])
        layer = after
    return far if far[end] >= 0 else None


def _blocking_flow(arcs, to, room, far, start: int, end: int) -> None:
    """Shortest paths are filled until each holds a full arc."""
    at, path = [0] * len(arcs), []
    while True:
        a = to[path[-1]] if path else start
        if a == end:
            push = min(room[i] for i in path)
            for i in path:
                room[i] -= push
                room[i ^ 1] += push
            full = next(k for k, i in enumerate(path) if not room[i])
            del path[full:]
            continue
        while at[a] < len(arcs[a]) and not (room[arcs[a][at[a]]] and far[to[arcs[a][at[a]]]] == far[a] + 1):
            at[a] += 1
        if at[a] < len(arcs[a]):
            path.append(arcs[a][at[a]])
        elif path:
            path.pop()
            at[to[path[-1]] if path else start] += 1
        else:
            return


@dataclass
class _Search:
    """Documents in one order, each taken that fits into the room left: how far that has got."""

    room: int
    start: int = 0  # the place where it goes on
    path: tuple[int, ...] = ()  # digits of the stretch with the next document that does not fit
    rest: int = 0  # the room left at the stretch

    def __post_init__(self):
        self.whole: list[tuple] = []  # spans all of whose fitting documents are taken
        self.walked: list[tuple] = []  # stretches whose documents were walked

    def span(self, start: int, end: int) -> tuple:
        low = (1 << _HALF) - 1
        return start >> _HALF, start & low, end >> _HALF, end & low, self.room

    def stretch(self) -> tuple[int, int]:
        at = 0
        for digit in self.path:
            at = at << _BITS | digit
        free = 2 * _HALF - _BITS * len(self.path)
        return max(self.start, at << free), (at + 1) << free


def _within(u: Column, v: Column, size: Column, span: Column) -> Column:
    """Whether a document lies in a span and fits into its room."""
    after = (u > span["u0"]) | ((u == span["u0"]) & (v >= span["v0"]))
    before = (u < span["u1"]) | ((u == span["u1"]) & (v < span["v1"]))
    return after & before & (size > 0) & (size <= span["room"])


def _mirror(column: str, backward: Column) -> Column:
    """A half of the place in the order, or in the order from its end."""
    return F.when(backward, F.lit((1 << _HALF) - 1) - F.col(column)).otherwise(F.col(column))


def _live(rows: DataFrame, spans: dict[tuple[str, bool], tuple], **extra: dict) -> DataFrame:
    """The documents in each search's span, placed in its order, with further values by search."""
    schema = f"__llm_pattern string, backward boolean, span {_SPAN}" + "".join(f", {k} bigint" for k in extra)
    table = rows.sparkSession.createDataFrame([(*k, v, *(x[k] for x in extra.values())) for k, v in spans.items()], schema)
    return (rows.join(F.broadcast(table), "__llm_pattern")
            .withColumn("u", _mirror("__llm_u", F.col("backward"))).withColumn("v", _mirror("__llm_v", F.col("backward")))
            .where(_within(F.col("u"), F.col("v"), F.col("__llm_size"), F.col("span"))))


def _digit(level: int) -> Column:
    column, at = ("u", level) if level < _LEVELS else ("v", level - _LEVELS)
    return F.shiftright(column, _HALF - _BITS * (at + 1)).bitwiseAND(F.lit((1 << _BITS) - 1))


def _walk(table: pa.Table) -> pa.Table:
    """The documents of one stretch, in order, that fit into the room left."""
    table = table.sort_by([("u", "ascending"), ("v", "ascending")])
    taken, room = [], table.column("rest")[0].as_py()
    for size in table.column("__llm_size").to_pylist():
        taken.append(size <= room)
        room -= size * taken[-1]
    return table.filter(pa.array(taken, pa.bool_())).select(["__llm_pattern", "backward", "__llm_u", "__llm_v", "__llm_size"])


def _first_fit(rows: DataFrame, rooms: dict[tuple[str, bool], int]) -> tuple[dict[tuple[str, bool], _Search], DataFrame]:
    """The searches by (pattern, backward) at their end, and the documents that the walks took."""
    searches = {k: _Search(room) for k, room in rooms.items()}
    schema = "__llm_pattern string, backward boolean, __llm_u bigint, __llm_v bigint, __llm_size bigint"
    walks = [rows.sparkSession.createDataFrame([], schema)]
    going = {k for k, s in searches.items() if s.room > 0}
    while going:
        wide, found = set(going), set()
        for k in going:
            searches[k].path, searches[k].rest = (), searches[k].room
        for level in range(2 * _LEVELS):
            if not wide:
                break
            live = _live(rows, {k: searches[k].span(*(searches[k].stretch() if level else (searches[k].start, _END))) for k in wide},
                         rest={k: searches[k].rest for k in wide})
            bars = (live.groupBy("__llm_pattern", "backward", "rest", _digit(level).alias("digit"))
                    .agg(F.sum("__llm_size").alias("words"), F.count("*").alias("n")))
            each = Window.partitionBy("__llm_pattern", "backward")
            bars = (bars.withColumn("upto", F.sum("words").over(each.orderBy("digit")))
                    .withColumn("all", F.sum("words").over(each)).withColumn("before", F.col("upto") - F.col("words")))
            crossed = bars.where(((F.col("before") <= F.col("rest")) & (F.col("upto") > F.col("rest")))
                                 | ((F.col("all") <= F.col("rest")) & (F.col("upto") == F.col("all"))))
            left = set(wide)
            for r in crossed.collect():  # one row per search
                k = (r["__llm_pattern"], r["backward"])
                s = searches[k]
                left.discard(k)
                if r["all"] <= s.rest:  # everything that is left fits
                    s.whole.append(s.span(s.start, _END))
                    s.room -= r["all"]
                    wide.discard(k)
                    going.discard(k)
                    continue
                s.path, s.rest = (*s.path, r["digit"]), s.rest - r["before"]
                found.add(k)
                if r["n"] <= REGION:
                    wide.discard(k)
            wide -= left  # nothing that is left fits
            going -= left
        if not found:
            break
        spans = {k: searches[k].span(*searches[k].stretch()) for k in found}
        stretch = _live(rows, spans, rest={k: searches[k].rest for k in found})
        picked = stretch.select("__llm_pattern", "backward", "u", "v", "__llm_u", "__llm_v", "__llm_size", "rest")
        walks.append(materialise(picked.groupBy("__llm_pattern", "backward").applyInArrow(_walk, schema), "mix-walked"))
        took = {(r[0], r[1]): r[2] for r in walks[-1].groupBy("__llm_pattern", "backward").agg(F.sum("__llm_size")).collect()}
        for k in found:
            s = searches[k]
            at, end = s.stretch()
            s.whole.append(s.span(s.start, at))
            s.walked.append(spans[k])
            s.start, s.room = end, s.rest - took.get(k, 0)
            if s.room == 0 or end == _END:
                going.discard(k)
    return searches, reduce(DataFrame.unionAll, walks)


def mix(docs: DataFrame, sources: Column, weights=(3, 1, 2), ratio: float = 1.5, cap: int = 2,
        seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
        keep: list[str] | None = None) -> tuple[DataFrame, dict]:
    """The documents with ``__llm_size`` (words), ``__llm_copies`` and ``__llm_pattern``, and the sources.

    ``keep`` names the columns to keep (None: all).
    ``sources`` gives an array of source names per document (a null name is a
    source; a null or empty array belongs to no source and is never taken).
    Sources by code point, null last, have the weights in turn and share
    ``ratio`` times all words; no target is above ``cap`` times its source's
    words, and no document is taken more than ``cap`` times. A null text has no
    words. Equal rows give equal results, however they are split over files: the
    seeded order follows id, text, size and sources, and only rows alike in all of
    these, which are interchangeable, are told apart by their place in the table, which is
    written once. An empty table gives no rows and no sources. More than ``MAX_PATTERNS``
    different sets of sources are an error.
    """
    words = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    names = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    columns = docs.columns if keep is None else keep
    seeded = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col), F.col("__llm_size"), F.col("__llm_pattern"))
    keyed = (docs.withColumn("__llm_size", words.cast("bigint"))
             .withColumn("__llm_pattern", F.to_json(names))
             .withColumn("__llm_u", F.shiftrightunsigned(seeded, 64 - _HALF))
             .withColumn("__llm_v", F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - _HALF)))
    keyed = materialise(keyed.select(*columns, "__llm_size", "__llm_pattern", "__llm_u", "__llm_v"), "mix-documents")
    rows = keyed.select("__llm_size", "__llm_pattern", "__llm_u", "__llm_v")
    found = (rows.groupBy("__llm_pattern").agg(F.sum("__llm_size").alias("size"), F.count("*").alias("n"))
             .limit(MAX_PATTERNS + 1).collect())
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; merge rare sources first")
    patterns = sorted((r[0], r[1], r[2]) for r in found)
    member_names = [json.loads(p) for p, _, _ in patterns]
    order = sorted({s for names in member_names for s in names}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(order)}
    members = [[at[s] for s in names] for names in member_names]
    sizes = [sum(p[1] for p, m in zip(patterns, members) if i in m) for i in range(len(order))]
    targets = water_fill(sizes, [weights[i % len(weights)] for i in range(len(order))],
                         ratio * sum(p[1] for p in patterns), cap)
    flow = min_cost_flow([p[1] for p in patterns], members, [round(t) for t in targets], cap)
    cuts = {p: (words // size, words % size) for (p, size, _), words in zip(patterns, flow) if size}
    rooms = {(p, back): size - cuts[p][1] if back else cuts[p][1] for p, size, _ in patterns if size and cuts[p][1] for back in (False, True)}
    searches, walks = _first_fit(rows, rooms)

    spark = docs.sparkSession
    table = []
    for p, _, _ in patterns:
        base, rest = cuts.get(p, (0, 0))
        back = rest > 0 and searches[p, True].room < searches[p, False].room
        best = searches[p, back] if rest else _Search(0)
        table.append((p, base, rest > 0, back, best.whole, best.walked))
    schema = (f"__llm_pattern string, __llm_base bigint, __llm_some boolean, __llm_back boolean, "
              f"__llm_whole array<{_SPAN}>, __llm_walked array<{_SPAN}>")
    table = spark.createDataFrame(table, schema)
    u, v = _mirror("__llm_u", F.col("__llm_back")), _mirror("__llm_v", F.col("__llm_back"))
    lies = lambda spans: F.exists(spans, lambda span: _within(u, v, F.col("__llm_size"), span))
    placed = keyed.join(F.broadcast(table), "__llm_pattern").withColumn("__llm_open", lies("__llm_walked"))
    # What a search took is put in once more, or all but that if the search went backward.
    extra = lambda took: (F.col("__llm_some") & (F.col("__llm_size") > 0) & (took != F.col("__llm_back"))).cast("bigint")
    chosen = walks.join(F.broadcast(table.select("__llm_pattern", F.col("__llm_back").alias("backward"))), ["__llm_pattern", "backward"])
    chosen = chosen.select("__llm_pattern", "__llm_u", "__llm_v", F.lit(True).alias("__llm_took"))
    out = [*columns, "__llm_size", "__llm_pattern", "__llm_copies"]
    sure = placed.where(~F.col("__llm_open")).withColumn("__llm_copies", F.col("__llm_base") + extra(lies("__llm_whole")))
    stretch = (placed.where("__llm_open")
               .join(chosen, ["__llm_pattern", "__llm_u", "__llm_v"], "left")
               .withColumn("__llm_copies", F.col("__llm_base") + extra(F.coalesce("__llm_took", F.lit(False)))))
    return sure.select(*out).union(stretch.select(*out)), {s: Source(sizes[i], targets[i]) for s, i in at.items()}
