import random
from itertools import combinations

import numpy as np
import xxhash

from marketflow.llm import simhash
from marketflow.llm.components import component_roots
from marketflow.llm.simhash import fingerprint, keep_one_per_group, near_duplicates, spanning_links

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def union(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        up[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def brute(rows, radius=2):
    fps = [slow_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    root = union(distinct, [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= radius])
    low = {}
    for (doc_id, _), fp in zip(rows, fps):
        if doc_id is not None:
            low[root[fp]] = min(low.get(root[fp], doc_id), doc_id)
    return sorted(((d, f"{fp:016x}", low.get(root[fp])) for (d, _), fp in zip(rows, fps)), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert result(near_duplicates(docs)) == brute(rows)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert result(near_duplicates(odd_docs)) == brute(rows)
    assert near_duplicates(odd_docs.limit(0)).count() == 0


def test_keep_one_per_group(spark, odd_docs):
    kept = keep_one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = sorted(r.doc_id for r in keep_one_per_group(docs).select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in near_duplicates(docs).collect() if r.doc_id == r.component_id)


def test_large_cells_are_tiled(spark, monkeypatch):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(5)]
    fps = {b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(6))) & (2 ** 64 - 1) for b in base for _ in range(120)}
    monkeypatch.setattr(simhash, "TILE", 7)
    signed = [(f - 2 ** 64 if f >= 2 ** 63 else f,) for f in fps]
    for radius in (1, 2, 3):
        cells = simhash._cells(spark.createDataFrame(signed, "fp bigint"), radius)
        roots = {x.node: x.root for x in component_roots(simhash._links(cells, radius)).collect()}
        exp = union([f for f, in signed], [(a, b) for (a,), (b,) in combinations(signed, 2)
                                          if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= radius])
        groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
        assert groups({f: roots.get(f, f) for f, in signed}) == groups(exp)


def test_spanning_links_cover_all_links():
    r = np.random.default_rng(4)
    fps = np.unique(np.concatenate([np.uint64(0b1111) ^ (np.uint64(1) << r.integers(0, 60, 700).astype(np.uint64)), r.integers(0, 2 ** 63, 500).astype(np.uint64)]))
    a, b = spanning_links(fps, 2)
    assert len(a) < len(fps)
    assert (np.bitwise_count(a ^ b) >= 1).all()
    got = union(fps.tolist(), zip(a.tolist(), b.tolist()))
    exp = union(fps.tolist(), [(x, y) for x, y in combinations(fps.tolist(), 2) if (x ^ y).bit_count() <= 2])
    assert len(set(got.values())) == len(set(exp.values()))


def test_components_path_star_and_loops(spark):
    path = [(i, i + 1) for i in range(100, 400)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = path + star + [(5, 5), (7, 8), (8, 7), (7, 8), (None, 3), (4, None)]
    got = {r.node: r.root for r in component_roots(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    exp = union({n for e in path + star + [(7, 8)] for n in e}, path + star + [(7, 8)])
    assert set(got) == set(exp)
    assert all((got[a] == got[b]) == (exp[a] == exp[b]) for a in (100, 250, 1000, 1200, 7) for b in got)
    assert component_roots(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_fingerprint_matches_the_definition():
    for text in ("", None, "A b", "one two three", "x " * 50 + "Y\tz\x0bq", "ÀB c d e"):
        assert fingerprint(text, 3) == slow_fingerprint(text)


def skewed_prints(spark, n, seed, flips=2):
    """Fingerprints that share 32 bits, with near copies among them; as a table ``fp`` and an array."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 32, n, dtype=np.uint64) | np.uint64(0xABCD1234 << 32)
    near = base[: n // 10].copy()
    for _ in range(flips):
        near ^= np.uint64(1) << rng.integers(0, 64, len(near)).astype(np.uint64)
    fps = np.unique(np.concatenate([base, near]))
    return spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp bigint"), fps


def test_large_cells_are_refined_exactly(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 64)
    for radius in (1, 2, 3):
        table, fps = skewed_prints(spark, 3000, radius, radius)
        got = {r.node: r.root for r in component_roots(simhash._links(simhash._cells(table, radius), radius)).collect()}
        links = []
        for i in range(0, len(fps), 500):
            a, b = np.nonzero(np.bitwise_count(fps[i:i + 500, None] ^ fps[None, :]) <= radius)
            links += [(int(fps[i + x]), int(fps[y])) for x, y in zip(a, b) if i + x < y]
        expected = union([int(x) for x in fps], links)
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        groups = {}
        for x in fps.tolist():
            groups.setdefault(expected[x], set()).add(signed(x))
        found = {}
        for node, root in got.items():
            found.setdefault(root, set()).add(node)
        assert sorted(map(sorted, found.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1) and len(links) > 50


def test_rows_of_a_large_cell_grow_with_it(spark, monkeypatch):
    """All fingerprints in one cell: rows to compare follow their number, not its square."""
    monkeypatch.setattr(simhash, "TILE", 64)
    sizes = [simhash._cells(skewed_prints(spark, n, 9)[0], 2).count() / n for n in (4000, 16_000, 64_000)]
    assert max(sizes) < 10
