import random

import numpy as np
from pyspark.sql import functions as F

from marketflow.llm import runs as R
from marketflow.llm.queries import with_repeats


def brute(words, least):
    """Every period by itself: stretches on which words ``p`` apart are equal."""
    out = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                out.setdefault((i, j + p), p)
            i = j + 1
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, count=120):
    rng = random.Random(seed)
    for _ in range(count):
        n, letters = rng.choice((0, 1, 2, 7, 25, 80, 200)), rng.choice((1, 2, 3, 6))
        words = [str(rng.randrange(letters)) for _ in range(n)]
        if n > 10 and rng.random() < 0.6:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words


def test_equals_brute_force(spark):
    for least in (2, 12):
        rows = [(i, rng_ws(i).join(w)) for i, w in enumerate(texts(least))]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        for r in R.find_runs(docs, min_length=least).collect():
            words = rows[r["doc_id"]][1].split()
            expected = brute(words, least)
            assert [tuple(x) for x in r["runs"]] == expected
            assert r["collapsed"] == collapse(words, expected) and r["n_words"] == len(words)


def rng_ws(i):
    return (" ", "\n", " \t ", "\x0b\x0c\r ")[i % 4]


def test_grammar_extensions():
    rng = np.random.default_rng(4)
    words = np.concatenate([rng.integers(0, 2, 300), np.zeros(50, int), np.tile(rng.integers(0, 3, 17), 20)])
    sequence = np.concatenate([[100], words, [101]]).astype(np.int32)
    levels = R.grammar(sequence, np.array([0, len(sequence) - 1]))
    assert len(levels) > 5 and len(levels[-1].symbols) <= R.TOP + 2
    assert any(level.blocks for level in levels)
    a, b = (rng.integers(1, len(sequence) - 1, 3000) for _ in range(2))
    a, b = a[a != b], b[a != b]

    def plain(s, i, j):
        n = 0
        while s[i + n] == s[j + n]:
            n += 1
        return n

    assert R.extend(levels, a, b).tolist() == [plain(sequence, i, j) for i, j in zip(a, b)]
    back = sequence[::-1]
    assert R.extend(R.mirrored(levels), a, b).tolist() == [plain(back, i, j) for i, j in zip(a, b)]


def test_blocks_and_chunks_do_not_matter(spark, monkeypatch):
    words = list(texts(9, 60))
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths + 1) - lengths
    sequence = np.full(lengths.sum() + len(words) + 1, -1, np.int32)
    for s, w in zip(starts, words):
        sequence[s:s + len(w)] = list(map(int, w))
    borders = np.append(starts - 1, len(sequence) - 1)
    sequence[borders] = 1000 + np.arange(len(borders))
    expected = R.runs_of(sequence, starts, lengths, 12)
    monkeypatch.setattr(R, "AT_ONCE", 7)
    assert (R.runs_of(sequence, starts, lengths, 12) == expected).all() and len(expected)


def test_long_text(spark):
    rng = random.Random(5)
    head, unit = [f"w{rng.randrange(50)}" for _ in range(30_000)], [f"u{i}" for i in range(4000)]
    text = " ".join(head + unit * 9 + unit[:11])
    row = R.find_runs(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(30_000, 36_011, 4000)]
    assert row["collapsed"] == " ".join(head + unit)


def test_odd_rows(spark, odd_docs):
    found = R.find_runs(odd_docs)
    assert found.count() == odd_docs.count() and R.find_runs(odd_docs.limit(0)).count() == 0
    rows = {r["doc_id"]: r for r in found.where("doc_id in (5, 6, 7)").collect()}
    assert rows[5]["n_words"] == rows[7]["n_words"] == 0 and rows[5]["runs"] == [] and rows[7]["collapsed"] == ""
    assert [tuple(r) for r in rows[6]["runs"]] == [(0, 80_000, 4)] and rows[6]["collapsed"] == "alpha beta gamma delta"


def test_repeats_of_the_query(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i))) for i in range(200)] + [(None, None), (14, "")],
                                 "doc_id bigint, text string")
    import zlib
    rows = with_repeats(docs).where("doc_id is not null and text <> ''").collect()
    for r in rows:
        i, words = r["doc_id"], [f"w{j}" for j in range(r["doc_id"])]
        h, n = zlib.crc32(str(i).encode()), i
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
        assert r["text"].split() == words
    assert len(rows) == 199 and with_repeats(docs).where(F.col("text") == "").count() == 3
