import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketflow.llm.packing import CapacityTree, best_fit, pack
from marketflow.llm.token_counts import count_tokens, frequent_pre_tokens
from marketflow.llm.tokens import LONG_WORD, Counts, Encoder, IdEncoder, default_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_path())


def test_ids_and_counts_equal_the_library(encoder):
    r = random.Random(1)
    signs = [chr(i) for i in range(0x250)] + list("  \n\n\t\x85\xa0\x1c\x1d") * 8 + list("abcdefghij'stre") * 10 + ["<|endoftext|>"] * 5
    ids, counts = IdEncoder(default_path()), Counts({}, default_path(), most=50)
    for i in range(5000):
        text = "".join(r.choice(signs) for _ in range(r.randint(0, 30))) + (r.choice("你😀’—") if i % 10 == 0 else "")
        assert ids.encode(text) == np.array(encoder.ids(text), "<u4").tobytes()
        assert counts.count(text) == len(encoder.ids(text))
    for text in ("ab" * LONG_WORD, "x" * 70 + " " + "é1" * LONG_WORD, "a " * 3 * LONG_WORD):
        assert ids.encode(text) == np.array(encoder.ids(text), "<u4").tobytes()
        assert counts.count(text) == len(encoder.ids(text))


def test_every_script_goes_through_the_lookup(encoder, monkeypatch):
    """Greek, Cyrillic, Hebrew, Devanagari, CJK, Hangul, emoji, spaces and signs of many blocks: no text goes whole through the library."""
    r = random.Random(4)
    blocks = [(0x20, 0x7E), (0xA0, 0x24F), (0x370, 0x52F), (0x590, 0x6FF), (0x900, 0x97F), (0x1680, 0x1680), (0x2000, 0x206F), (0x20A0, 0x218F),
              (0x3000, 0x30FF), (0x4E00, 0x5000), (0xAC00, 0xAD00), (0x1D400, 0x1D7FF), (0x1F300, 0x1F64F), (0x20000, 0x20100)]
    texts = ["", "😀😀", "Ελληνικά και “Русский” 12", "汉字 かな\u3000漢字２３"]
    for _ in range(3000):
        lo, hi = r.choice(blocks)
        texts.append("".join(chr(r.randint(lo, hi)) if r.random() < 0.7 else r.choice(" \n\t a1'") for _ in range(r.randint(1, 25))))
    expected = [encoder.ids(t) for t in texts]
    ids, counts = IdEncoder(default_path()), Counts({}, default_path())
    monkeypatch.setattr(Encoder, "ids", None)
    for text, want in zip(texts, expected):
        assert ids.encode(text) == np.array(want, "<u4").tobytes() and counts.count(text) == len(want)


def test_all_code_points_split_alike(encoder):
    """The merge loop's classes are the library's for every code point."""
    ids = IdEncoder(default_path())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 50):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}{chr(c)}  {chr(c)}!" for c in points[i:i + 50])
        assert ids.encode(text) == np.array(encoder.ids(text), "<u4").tobytes()


@pytest.mark.parametrize("text", ["a" + " " * 5_000_000 + "b", "\t" * 3_000_000 + "b", "x" + " \n\t\r\x0b" * 600_000 + "你", "é" * 1_000_000 + "1" * 1_000_000,
                                  "q" * 5_000_000, "\n" * 2_000_000, "\u3000" * 1_500_000 + "x", "word and\u2028more " * 200_000])
def test_very_long_runs(encoder, text):
    want = encoder.ids(text)
    assert IdEncoder(default_path()).encode(text) == np.array(want, "<u4").tobytes()
    assert Counts({}, default_path()).count(text) == len(want)


def test_pieces_join_to_the_text():
    from marketflow.llm import tokens
    r = random.Random(5)
    text = "".join(r.choice(["word", " ", "\n\n ", "\x1c", "\xa0", "12", "!"]) for _ in range(300_000))
    parts = list(tokens.pieces_of(text))
    assert "".join(parts) == text and len(parts) > 5 and max(map(len, parts)) <= 2 * tokens.PIECE + 10


def test_other_kinds_of_vocabularies_are_refused():
    import public_tokenizers
    with pytest.raises(ValueError, match="byte-level"):
        Encoder(public_tokenizers.path("word_bpe_49k.json"))


def test_count_tokens_whole_table(spark, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in count_tokens(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        n = len(encoder.ids(r.text))
        assert tuple(got[r.doc_id]) == (r.doc_id, len(r.text.encode()), n, n > 1024)


def test_count_tokens_odd_rows(odd_docs, encoder):
    got = sorted((tuple(r) for r in count_tokens(odd_docs).collect()), key=repr)
    exp = []
    for r in odd_docs.select("doc_id", "text").collect():
        n = len(encoder.ids(r.text or ""))
        exp.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
    assert got == sorted(exp, key=repr)
    assert count_tokens(odd_docs.limit(0)).count() == 0


def test_frequent_table_counts(spark):
    df = spark.createDataFrame([("a b b b",)] * 5, "text string").repartition(3)
    top = frequent_pre_tokens(df, default_path())
    assert top[" b"] == 15 and top["a"] == 5 or top[" b"] == 15


def test_best_fit_takes_the_tightest_window():
    r = random.Random(2)
    lengths = sorted((r.randint(1, 100) for _ in range(500)), reverse=True)
    numbers, offsets = best_fit(lengths, 100)
    left: dict[int, int] = {}
    for length, number, offset in zip(lengths, numbers, offsets):
        fits = [c for c in left.values() if c >= length]
        if number in left:
            assert left[number] == min(fits) and offset == 100 - left[number]
        else:
            assert not fits and offset == 0
            left[number] = 100
        left[number] -= length


def test_capacity_tree_empty():
    tree = CapacityTree(7)
    assert tree.pop_tightest(1) is None
    tree.push(3, 0)
    assert tree.pop_tightest(4) is None
    assert tree.pop_tightest(3) == (3, 0)


def check_packing(rows, docs, encoder, window=1024):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
    expected = []
    for doc_id, text in docs:
        ids = encoder.ids(text or "") + [0]
        for s in range(0, len(ids), window):
            part = np.array(ids[s:s + window], "<u4").tobytes()
            expected.append((doc_id, s, len(part) // 4, zlib.crc32(part), len(ids)))
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    tokens = sum(len(encoder.ids(t or "")) + 1 for _, t in docs)
    return tokens / (window * len(by_sequence))


def test_pack_whole_table(spark, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fill = check_packing(pack(docs).collect(), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], encoder)
    assert fill > 0.98


def test_pack_odd_rows_and_small_shards(odd_docs, encoder):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    check_packing(pack(odd_docs).collect(), docs, encoder)
    check_packing(pack(odd_docs, window=16, shard_rows=3).collect(), docs, encoder, 16)
    spaces = odd_docs.limit(1).withColumn("text", F.concat(F.lit("a"), F.repeat(F.lit(" "), 2_000_000), F.lit("b")))
    check_packing(pack(spaces).collect(), [(r.doc_id, r.text) for r in spaces.select("doc_id", "text").collect()], encoder)
    assert pack(odd_docs.limit(0)).count() == 0
