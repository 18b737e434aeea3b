import hashlib

import numpy as np
from pyspark.sql import functions as F

from marketflow.llm.line_dedup import Runs, drop_common_lines, keep_bitmap, kept_lines

WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, min_docs, min_chars=1):
    seen = {}
    for n, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            seen.setdefault(key(line), set()).add((doc_id, text or ""))
    common = {k for k, docs in seen.items() if len(k) >= min_chars and len(docs) >= min_docs}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = "\n".join(x for x in lines if key(x) not in common)
        out.append((doc_id, len(lines), sum(key(x) in common for x in lines), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()), key=repr)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    for least in (1, 2, 3):
        assert result(drop_common_lines(odd_docs, min_docs=least)) == brute(rows, least)
    assert result(drop_common_lines(odd_docs, min_docs=2, min_chars=14)) == brute(rows, 2, 14)
    assert drop_common_lines(odd_docs.limit(0)).count() == 0


def test_runs_cut_by_partition_borders(spark):
    """Hot lines over many partitions, lines just at and below the limit, keys that differ by case and space."""
    texts = [f"own {i}\n Hot Line \nhot line\n{'nine' if i < 9 else 'ten' if i < 19 else 'x%d' % (i % 7)}\n\nÄ{i % 3}" for i in range(300)]
    rows = list(enumerate(texts))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "7", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            out = drop_common_lines(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), min_docs=10)
            assert result(out) == brute(rows, 10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stream_holds_back_few_rows():
    runs = Runs(3)
    for doc in range(1000):
        runs.add((b"h", doc, 0, 1, b"\0\0\0\0"))
        assert len(runs.held) < 3
    runs.close(True)
    marks = runs.take().to_pylist()
    assert sum(m["kind"] == "drop" for m in marks) == 1000
    assert [m["docs"] for m in marks if m["kind"] == "count"] == [1000]


def test_bitmap_round_trip():
    r = np.random.default_rng(5)
    for n in (1, 2, 9, 1000):
        drop = np.nonzero(r.random(n) < 0.3)[0]
        lines = list(range(n))
        assert kept_lines(keep_bitmap(n, drop), lines) == [i for i in lines if i not in set(drop.tolist())]


def test_general_interface_returns_text_and_bitmap(spark):
    df = spark.createDataFrame([(i, f"a\nb{i}\na") for i in range(4)], "doc_id bigint, text string")
    for r in drop_common_lines(df, min_docs=4).collect():
        assert r.kept_text == f"b{r.doc_id}" and r.n_dropped == 2
        assert kept_lines(r.keep_bitmap, ["a", "b", "c"]) == ["b"]
    assert drop_common_lines(df, min_docs=5).where(F.col("keep_bitmap").isNotNull()).count() == 0
