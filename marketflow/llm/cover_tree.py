"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

Equal vectors of a label are folded into one class with a weight. The classes of
a label form regions around centres of their own, a region that is more than one block
forms regions inside it, and so on; every block builds
one cover tree: nested levels whose covering radii halve, every node knowing the
largest distance to what it covers. Two nodes can hold a linked pair only if
their centres are no further apart than both covering radii and the threshold's
chord together; all other node pairs are pruned, first between regions, level by level of
the regions, then between blocks, then level by level inside a block pair. What survives is
compared exactly, in double precision. Blocks of one region travel as a team, so a block
near several of them is sent to the team once. A block returns link counts and a spanning
forest, never all pairs, so a large group of near copies costs no more rows than it has members.
"""

from __future__ import annotations

import pickle
from functools import reduce
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketflow.llm.common import materialise, shuffle_partitions
from marketflow.llm.components import component_roots, smallest_member, spanning_forest

BLOCK_BYTES = 2 << 20  # vectors of a block
FAN = 1024  # regions a region is split into at most; they shape blocks, not results
DEPTH = 4  # levels of regions; a region of the last level is cut into blocks by hash
TEAM = 16  # blocks that travel together
BALLS = 16  # balls that outline a block
PARTNERS = 64  # about as many blocks are compared with a team in one task
LEAF = 32
_AT_ONCE = 1024
_BITS, _CHUNK_BITS = 10, 20  # of a region's number among its siblings (``FAN``), of a block's number in its region
_KEY = ["label", "dim", "region"]
_MARGIN = 1e-6  # for rounding in distances; survivors are checked exactly


def node(centres: np.ndarray, radii: np.ndarray, kids: list | None) -> SimpleNamespace:
    """Children of a node: their centres (rows), covering radii, and subtrees (None: the centre alone)."""
    return SimpleNamespace(centres=centres, radii=radii, kids=kids)


def build_tree(unit: np.ndarray) -> SimpleNamespace:
    """The cover tree of unit vectors."""
    rows = np.arange(len(unit))
    far = _chord(unit[rows] @ unit[0]) if len(rows) else np.zeros(0)
    return _cover(unit, rows, float(far.max(initial=0.0)))


def _chord(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def _cover(unit: np.ndarray, rows: np.ndarray, radius: float) -> SimpleNamespace:
    """Covers ``rows`` (all within ``radius`` of the first) by children of half that radius."""
    if len(rows) <= LEAF or radius <= _MARGIN:
        return node(rows, np.zeros(len(rows)), None)
    points = unit[rows]
    free = np.ones(len(rows), bool)
    centres, radii, kids = [], [], []
    at = 0
    while at < len(rows):  # the node's own centre comes first, so levels are nested
        far = _chord(points @ points[at])
        mine = free & (far <= radius / 2)
        mine[at] = True
        free &= ~mine
        own = np.nonzero(mine)[0]
        own = np.concatenate([[at], own[own != at]])
        centres.append(rows[at])
        radii.append(far[own].max())
        kids.append(_cover(unit, rows[own], radius / 2) if len(own) > 1 else None)
        rest = np.nonzero(free[at:])[0]
        at = at + int(rest[0]) if len(rest) else len(rows)
    return node(np.array(centres), np.array(radii), kids)


def _single(row: int) -> SimpleNamespace:
    return node(np.array([row]), np.zeros(1), None)


def candidate_pairs(a: SimpleNamespace, b: SimpleNamespace, unit_a: np.ndarray, unit_b: np.ndarray, chord: float):
    """Row pairs that pruning leaves, in batches; one tree against itself gives each pair once."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        same = x is y
        for at in range(0, len(x.centres), _AT_ONCE):
            some = slice(at, at + _AT_ONCE)
            far = _chord(unit_a[x.centres[some]] @ unit_b[y.centres].T)
            p, q = np.nonzero(far <= x.radii[some, None] + y.radii[None, :] + chord + _MARGIN)
            p += at
            if same:
                p, q = p[p <= q], q[p <= q]
            if x.kids is None and y.kids is None:
                keep = p < q if same else slice(None)
                yield x.centres[p[keep]], y.centres[q[keep]]
                continue
            deep_x = np.array([x.kids is not None and x.kids[k] is not None for k in range(len(x.centres))], bool)
            deep_y = np.array([y.kids is not None and y.kids[k] is not None for k in range(len(y.centres))], bool)
            flat = ~(deep_x[p] | deep_y[q])
            keep = flat & ((p != q) | (not same))
            yield x.centres[p[keep]], y.centres[q[keep]]
            for i, j in zip(p[~flat].tolist(), q[~flat].tolist()):
                left = x.kids[i] if deep_x[i] else _single(x.centres[i])
                right = left if same and i == j else y.kids[j] if deep_y[j] else _single(y.centres[j])
                todo.append((left, right))


def block_links(a: dict, b: dict, threshold: float):
    """Weighted link counts of both blocks' classes and a spanning forest of their links."""
    same = a["block"] == b["block"]
    chord = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
    unit_a = a["vectors"] / a["norms"][:, None]
    unit_b = unit_a if same else b["vectors"] / b["norms"][:, None]
    n = len(a["ids"])
    links_a, links_b = np.zeros(n, np.int64), np.zeros(len(b["ids"]), np.int64)
    left, right, held = [], [], 0
    for i, j in candidate_pairs(a["tree"], a["tree"] if same else b["tree"], unit_a, unit_b, chord):
        for at in range(0, len(i), 1 << 16):
            p, q = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
            cosine = np.einsum("ij,ij->i", a["vectors"][p], b["vectors"][q]) / (a["norms"][p] * b["norms"][q])
            p, q = p[cosine >= threshold], q[cosine >= threshold]
            np.add.at(links_a, p, b["weights"][q])
            np.add.at(links_a if same else links_b, q, a["weights"][p])
            left.append(p)
            right.append(q if same else q + n)
            held += len(p)
        if held > 1 << 20:
            x, y = spanning_forest(np.concatenate(left), np.concatenate(right), n + len(b["ids"]))
            left, right, held = [x], [y], 0
    ids = a["ids"] if same else np.concatenate([a["ids"], b["ids"]])
    links = links_a if same else np.concatenate([links_a, links_b])
    x, y = spanning_forest(np.concatenate(left), np.concatenate(right), n + len(b["ids"])) if left else (ids[:0], ids[:0])
    return ids, links, ids[x], ids[y]


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _classes(rows: DataFrame) -> DataFrame:
    folded = rows.groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    numbered = folded.withColumn("class_id", F.monotonically_increasing_id()).withColumn("dim", F.size("vector"))
    return materialise(numbered, "cover-classes")


def _centres(table: pa.Table) -> pa.Table:
    """The first of a region's sampled vectors, then each time one drawn by its squared distance to those taken."""
    table = table.sort_by("class_id")
    first = {k: table.column(k)[0] for k in (*_KEY, "wanted")}
    unit = _units(_matrix(table.column("vector").combine_chunks()))
    wanted = min(first["wanted"].as_py(), len(unit))
    rng, taken = np.random.default_rng(first["region"].as_py()), [0]
    apart = np.maximum(0.0, 1.0 - unit @ unit[0])
    while len(taken) < wanted and apart.sum() > _MARGIN:
        taken.append(int(rng.choice(len(unit), p=apart / apart.sum())))
        apart = np.minimum(apart, np.maximum(0.0, 1.0 - unit @ unit[taken[-1]]))
    some = table.take(pa.array(taken))
    return pa.table({**{k: some.column(k) for k in _KEY}, "class_id": pa.array(range(len(taken)), pa.int64()),
                     "vector": pa.array(unit[taken].tolist(), pa.list_(pa.float64()))})


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """The rows of a list column, all of one length."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _placed(batches):
    """Sorted rows, a region's centres before its vectors; the vectors with the number of their new region."""
    centres: list = []
    for batch in batches:
        names = batch.schema.names
        role, index = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("role", "class_id"))
        begins = np.flatnonzero((role == 0) & (index == 0))  # every region has a centre 0, which comes first
        turns = np.flatnonzero(np.diff(role)) + 1
        cuts = np.unique(np.concatenate([[0], begins, turns, [len(role)]]))
        for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            part = batch.slice(start, end - start)
            vectors = _matrix(part.column(names.index("vector")))
            if role[start] == 0:
                centres = [vectors] if index[start] == 0 else [*centres, vectors]
                continue
            centres = [np.concatenate(centres)]
            inside = (vectors @ centres[0].T).argmax(1)
            region = part.column(names.index("region")).to_numpy() << _BITS | inside
            yield pa.RecordBatch.from_arrays(
                [part.column(names.index(c)) for c in ("class_id", "label", "dim", "vector", "weight")] + [pa.array(region, pa.int64())],
                ["class_id", "label", "dim", "vector", "weight", "region"])


def _held() -> Column:
    """Vectors of a block."""
    return F.greatest(F.lit(LEAF), F.floor(F.lit(BLOCK_BYTES) / (F.col("dim") * 8)))


def _regions(classes: DataFrame) -> tuple[DataFrame, int]:
    """The classes with a ``region`` and the levels of regions there are.

    The root is 1; the regions inside ``r`` are numbered from ``r << 10`` on. A region
    of more than one block is split around centres drawn from a sample of its vectors
    (at most some ``4 * FAN``, by hash). Its vectors meet the centres in sorted streams,
    many to a region, so the size of a region bounds nothing.
    """
    kind = dict(classes.dtypes)["label"]
    columns = ["class_id", "label", "dim", "vector", "weight", "region"]
    schema = f"class_id bigint, label {kind}, dim int, vector array<double>, weight bigint, region bigint"
    open_ = classes.withColumn("region", F.lit(1).cast("bigint")).select(*columns)
    closed, depth = [], 0
    while depth < DEPTH:
        sizes = open_.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min("class_id").alias("least"))
        sizes = materialise(sizes.where(F.col("n") > _held()), "cover-sizes")
        if sizes.isEmpty():
            break
        depth += 1
        split = open_.join(sizes, _KEY)
        wanted = F.least(F.lit(FAN), F.ceil(2 * F.col("n") / _held())).cast("bigint")
        drawn = F.pmod(F.xxhash64("class_id", F.lit(depth)), F.col("n")) < 4 * wanted
        sample = split.where(drawn | (F.col("class_id") == F.col("least"))).select("class_id", *_KEY, "vector", wanted.alias("wanted"))
        centres = materialise(sample.groupBy(*_KEY).applyInArrow(
            _centres, f"label {kind}, dim int, region bigint, class_id bigint, vector array<double>"), "cover-centres")
        parts = F.ceil(F.col("n") / (16 * _held()))
        rows = split.select(*columns, F.lit(1).alias("role"), F.pmod(F.xxhash64("class_id", F.lit(-depth)), parts).alias("part"))
        copies = centres.join(sizes, _KEY).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
        both = rows.unionByName(copies.select("class_id", "label", "dim", "vector", F.lit(0).cast("bigint").alias("weight"), "region",
                                              F.lit(0).alias("role"), "part"))
        key = [*_KEY, "part"]
        streams = both.repartition(*key).sortWithinPartitions(*key, "role", "class_id")
        closed.append(open_.join(sizes.select(*_KEY), _KEY, "left_anti").select(*columns))
        open_ = materialise(streams.mapInArrow(_placed, schema), "cover-placed")
    return reduce(DataFrame.unionByName, closed, open_), depth


def _blocks(classes: DataFrame) -> tuple[DataFrame, int]:
    """One row per block with its cover tree, and the levels of regions."""
    kind = dict(classes.dtypes)["label"]
    placed, depth = _regions(classes)
    placed = materialise(placed, "cover-regions")
    sizes = placed.groupBy(*_KEY).agg(F.count("*").alias("n"))
    chunked = placed.join(sizes, _KEY).withColumn("chunk", F.pmod(F.xxhash64("class_id"), F.ceil(F.col("n") / _held())))

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("class_id")
        first = {k: table.column(k)[0].as_py() for k in (*_KEY, "chunk")}
        vectors = _matrix(table.column("vector").combine_chunks())
        norms = _norms(vectors)
        unit = vectors / norms[:, None]
        block = {"block": first["region"] << _CHUNK_BITS | first["chunk"], "ids": table.column("class_id").to_numpy(),
                 "weights": table.column("weight").to_numpy(), "vectors": vectors, "norms": norms, "tree": build_tree(unit)}
        balls, radii = outline(unit)
        middle = unit.mean(0)
        middle = _units(middle[None])[0] if np.linalg.norm(middle) > _MARGIN else unit[0]
        kinds = table.schema.field("label").type
        return pa.table({"label": pa.array([first["label"]], kinds), "dim": pa.array([first["dim"]], pa.int32()),
                         "region": pa.array([first["region"]], pa.int64()), "block": pa.array([block["block"]], pa.int64()),
                         "centre": [middle.tolist()], "radius": [float(_chord(unit @ middle).max())],
                         "balls": [balls.ravel().tolist()], "radii": [radii.tolist()],
                         "tree": pa.array([pickle.dumps(block, 5)], pa.binary())})

    grouped = chunked.select("class_id", *_KEY, "chunk", "vector", "weight").groupBy(*_KEY, "chunk")
    return materialise(grouped.applyInArrow(
        build, f"label {kind}, dim int, region bigint, block bigint, centre array<double>, radius double, "
               "balls array<double>, radii array<double>, tree binary"), "cover-blocks"), depth


def outline(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and radii of at most ``BALLS`` balls that hold all rows: each further centre is the row farthest from those before."""
    rows = [0]
    apart = _chord(unit @ unit[0])
    mine = np.zeros(len(unit), np.int64)
    while len(rows) < BALLS and apart.max() > _MARGIN:
        rows.append(int(apart.argmax()))
        far = _chord(unit @ unit[rows[-1]])
        mine[far < apart] = len(rows) - 1
        apart = np.minimum(apart, far)
    radii = np.zeros(len(rows))
    np.maximum.at(radii, mine, apart)
    return unit[rows], radii


def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / _norms(vectors)[:, None]


def _apart(a: str, b: str) -> Column:
    """The chord between two unit vectors."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), 2.0 - 2.0 * dot))


def _ancestor(level: int) -> Column:
    """The region of a level, 0 the root, that holds ``region``; ``region`` itself if it lies no deeper."""
    out = F.col("region")
    for deeper in range(level + 1, DEPTH + 1):
        out = F.when(F.col("region") >= 1 << _BITS * deeper, F.shiftright("region", _BITS * (deeper - level))).otherwise(out)
    return out


def _near_regions(shape: DataFrame, chord: float, depth: int) -> DataFrame:
    """``label, dim, region, region2``: pairs of regions whose covering radii, around one of their blocks' centres, can meet.

    Pairs of a level are formed inside near pairs of the level above, from the root down.
    """
    pairs = None
    for level in range(depth + 1):
        inside = shape.withColumn("up", _ancestor(max(level - 1, 0))).withColumn("node", _ancestor(level))
        key = ["label", "dim", "node"]
        first = inside.groupBy(*key).agg(F.min(F.struct("block", "centre")).alias("first")).select(*key, F.col("first.centre").alias("middle"))
        reach = materialise(inside.join(first, key).groupBy(*key, "up").agg(
            F.max(_apart("middle", "centre") + F.col("radius")).alias("reach"), F.first("middle").alias("middle")), "cover-reach")
        if pairs is None:  # the root meets itself
            pairs = reach.select("label", "dim", F.col("node").alias("region"), F.col("node").alias("region2"))
            continue
        other = reach.toDF("label", "dim", "node2", "region2", "reach2", "middle2")
        near = (F.col("node") <= F.col("node2")) | (F.col("region") != F.col("region2"))
        near &= _apart("middle", "middle2") <= F.col("reach") + F.col("reach2") + chord + 2 * _MARGIN
        pairs = (pairs.join(reach.withColumnRenamed("up", "region"), ["label", "dim", "region"]).join(other, ["label", "dim", "region2"])
                 .where(near).select("label", "dim", F.col("node").alias("region"), F.col("node2").alias("region2")))
        pairs = materialise(pairs, "cover-near")
    return pairs


def _near_blocks(shape: DataFrame, chord: float, depth: int) -> DataFrame:
    """``label, dim, region, block, other``: pairs of blocks whose balls can meet, formed only where their regions' can."""
    light = shape.drop("balls", "radii")
    other = light.toDF("label", "dim", "region2", "other", "centre2", "radius2")
    once = (F.col("block") <= F.col("other")) | (F.col("region") != F.col("region2"))
    pairs = (_near_regions(light, chord, depth).join(light, _KEY).join(other, ["label", "dim", "region2"])
             .where(once & (_apart("centre", "centre2") <= F.col("radius") + F.col("radius2") + chord + _MARGIN))
             .select(*_KEY, "block", "other"))
    same = F.col("block") == F.col("other")
    pairs = materialise(pairs, "cover-close")
    balls = shape.select("label", "dim", "block", "balls", "radii")
    outlined = (pairs.where(~same).join(balls, ["label", "dim", "block"])
                .join(balls.toDF("label", "dim", "other", "balls2", "radii2"), ["label", "dim", "other"])
                .select(*_KEY, "block", "other", "balls", "radii", "balls2", "radii2"))

    def meet(batches):
        for batch in batches:
            dims, *parts = (batch.column(batch.schema.names.index(c)) for c in ("dim", "balls", "radii", "balls2", "radii2"))
            keep = []
            for dim, x, r, y, q in zip(dims.to_pylist(), *parts):
                x, r, y, q = (a.values.to_numpy() for a in (x, r, y, q))
                far = _chord(x.reshape(-1, dim) @ y.reshape(-1, dim).T)
                keep.append(bool((far <= r[:, None] + q + chord + _MARGIN).any()))
            yield batch.select([*_KEY, "block", "other"]).filter(pa.array(keep, pa.bool_()))

    met = outlined.mapInArrow(meet, pairs.schema)
    return pairs.where(same).unionByName(met)


def _teams(pairs: DataFrame) -> DataFrame:
    """``label, dim, region, team, part, role, block, members``: which blocks a task reads.

    A team is up to ``TEAM`` blocks of sibling regions (role 0). The blocks to compare with
    some of them (role 1, with the members they meet) are dealt to parts of about ``PARTNERS``.
    """
    key = ["label", "dim", "region"]
    pairs = pairs.withColumn("region", F.shiftright("region", _BITS))
    own = pairs.select(*key, "block").distinct()
    place = F.row_number().over(Window.partitionBy(*key).orderBy("block"))
    own = materialise(own.withColumn("team", F.floor((place - 1) / TEAM)), "cover-teams")
    met = pairs.join(own, [*key, "block"]).groupBy(*key, "team", "other").agg(F.collect_list("block").alias("members"))
    met = materialise(met, "cover-partners")
    parts = met.groupBy(*key, "team").agg(F.ceil(F.count("*") / PARTNERS).alias("parts"))
    met = met.join(parts, [*key, "team"]).select(
        *key, "team", F.pmod(F.xxhash64("other"), F.col("parts")).alias("part"), F.lit(1).alias("role"),
        F.col("other").alias("block"), "members")
    mine = (met.select(*key, "team", "part").distinct().join(own, [*key, "team"])
            .select(*key, "team", "part", F.lit(0).alias("role"), "block", F.array().cast("array<bigint>").alias("members")))
    return mine.unionByName(met)


def _found(blocks: DataFrame, depth: int, threshold: float) -> DataFrame:
    """Rows ``a, b, links``: link counts of class ``a`` (``b`` null), or an edge of the spanning forest."""
    chord = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold))) + _MARGIN
    shape = materialise(blocks.drop("tree"), "cover-shape")
    pairs = materialise(_near_blocks(shape, chord, depth), "cover-pairs")
    dealt = _teams(pairs).join(blocks.select("label", "dim", "block", "tree"), ["label", "dim", "block"])
    key = ["label", "dim", "region", "team", "part"]
    dealt = (dealt.repartition(shuffle_partitions(blocks.sparkSession) * 2, *key)
             .sortWithinPartitions(*key, "role").select("role", "members", "tree"))

    def run(batches):
        team: dict = {}
        before = 1
        for batch in batches:
            for role, members, tree in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                block = pickle.loads(tree.as_buffer())
                if role == 0:
                    if before == 1:  # a part always ends with blocks of role 1
                        team = {}
                    team[block["block"]] = block
                before = role
                for member in members if role else ():
                    ids, links, a, b = block_links(team[member], block, threshold)
                    some = links > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([ids[some], a])), pa.array([None] * int(some.sum()) + b.tolist(), pa.int64()),
                         pa.array(np.concatenate([links[some], np.zeros(len(a), np.int64)]))], ["a", "b", "links"])

    return dealt.mapInArrow(run, "a bigint, b bigint, links bigint")


def embedding_links(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors of the same non-null label and length link when their cosine, in
    double precision, reaches ``threshold``. Vectors that are null, empty, zero,
    or hold null or non-finite components link with nothing, and so do rows with
    a null label. ``n_links`` counts the other rows linked directly (a row that
    repeats another is one more), ``component_id`` is the smallest id reachable,
    null only if no member has an id; ``kept`` tells whether it is the row's own.
    An empty table gives no rows; further columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.col("label").isNotNull() & _usable(F.col("vector"))
    classes = _classes(rows.where(usable))
    found = materialise(_found(*_blocks(classes), threshold), "cover-found")
    counts = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = component_roots(found.where("b is not null").select("a", "b"))
    component = smallest_member(roots, classes.select(F.col("class_id").alias("node"), "id"))
    result = (classes.join(counts.withColumnRenamed("a", "class_id"), "class_id", "left")
              .join(component.withColumnRenamed("node", "class_id"), "class_id", "left")
              .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                      F.coalesce("component", "id").alias("component_id")))
    result = materialise(result, "cover-result")
    linked = (rows.where(usable).join(result, ["label", "vector"])
              .select("vec_id", "n_links", "component_id"))
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
