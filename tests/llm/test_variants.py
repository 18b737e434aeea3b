import random

import pytest
from pyspark.sql import functions as F

from marketflow.llm import variants as V
from marketflow.llm.queries import counted_words


def one_edit(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    if len(u) < len(v):
        u, v = v, u
    return any(u[:i] + u[i + 1:] == v for i in range(len(u)))


def brute(words, ratio):
    """By comparing every word with every other one."""
    out, forms = {}, {}
    for u, n in words.items():
        near = [v for v in words if one_edit(u, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        forms[u] = best if best is not None and words[best] >= ratio * n and words[best] > 0 else None
        out[u] = (n, len(near))
    rows = []
    for u, (n, near) in out.items():
        root = u
        while forms[root] is not None:
            root = forms[root]
        rows.append((u, n, near, forms[u], words[forms[u]] if forms[u] is not None else None, root))
    return sorted(rows)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))): 3 ** rng.randrange(8) for _ in range(250)}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert got(V.spelling_variants(table, ratio=3)) == brute(words, 3)


def test_long_chain_of_forms_reaches_its_root(spark):
    words = {"a" * (3 + k): 2 ** k for k in range(40)}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    rows = got(V.spelling_variants(table, ratio=2))
    assert rows == brute(words, 2) and {r[-1] for r in rows} == {"a" * 42}


def test_ties_go_to_the_smallest_word(spark):
    table = spark.createDataFrame([("word", 1), ("ward", 20), ("wörd", 20), ("word😀", 20), ("wordz", 20)], "word string, n bigint")
    assert {r[0]: r[3] for r in got(V.spelling_variants(table))}["word"] == "ward"


def test_long_words_cost_their_length(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("ab") for _ in range(70))
    words = {base[:k]: 1 + k for k in range(60, 70)}
    words.update({base[:64][:i] + "c" + base[:64][i + 1:]: 500 for i in (0, 30, 63)})
    words.update({base[:65][:i] + base[:65][i:i + 1] + base[:65][i:]: 5 for i in (0, 7, 64)})
    huge = "".join(rng.choice("abc") for _ in range(100_000))
    table = spark.createDataFrame([*words.items(), (huge, 3), (huge[:500] + huge[501:], 40)], "word string, n bigint")
    rows = got(V.spelling_variants(table))
    assert [r for r in rows if len(r[0]) < 1000] == brute(words, 10)
    assert [(r[1], r[2], r[4]) for r in rows if len(r[0]) > 1000 and len(r[0]) % 2 == 0] == [(3, 1, 40)]


def test_hashed_keys_follow_the_rotations(monkeypatch):
    monkeypatch.setattr(V, "LONG", 0)
    a, b = ("abcabd", "abcaxd")
    shared = {k for k, e in V.hashed_rotations(a) if e} & {k for k, e in V.hashed_rotations(b) if e}
    assert len(shared) == 1
    assert not {k for k, e in V.hashed_rotations("ab") if not e} & {k for k, e in V.hashed_rotations("ba") if not e}


def test_odd_rows(spark):
    table = spark.createDataFrame([(None, 3, "x"), ("", 1, "x"), ("a$b", 5, None), ("aaa", None, "x"), ("aab", 4, "x"), ("aab", 6, "x")],
                                  "word string, n bigint, id string")
    assert got(V.spelling_variants(table)) == [("aaa", 0, 1, "aab", 10, "aab"), ("aab", 10, 1, None, None, "aab")]
    assert V.spelling_variants(table.limit(0)).count() == 0
    with pytest.raises(ValueError):
        V.spelling_variants(table, ratio=1)


def test_counted_words_of_odd_documents(spark, odd_docs):
    rows = {r["word"]: r["n"] for r in counted_words(odd_docs.select(*odd_docs.columns)).collect()}
    assert rows["thesametexthere"] == 2 and counted_words(odd_docs.limit(0)).count() == 0
    assert V.spelling_variants(counted_words(odd_docs).withColumn("form", F.lit("x"))).count() == len(rows)
