import math
import random
import zlib

from pyspark.sql import functions as F

from marketflow.llm.queries import op3_toxicity
from marketflow.llm.toxicity import (
    EDGE, Lexicon, features, is_quotation, score_toxicity, train_toxicity, words_of,
)

SF = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, up = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(up[j] + 1, row[-1] + 1, up[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    r = random.Random(9)
    words = ["".join(r.choice("abc") for _ in range(r.randint(0, 9))) for _ in range(1500)]
    for term, stem in (("abcab", False), ("cabba", True), ("abc", False), ("bca", True), ("aabbccab", False)):
        lexicon = Lexicon([(term, stem, 1.0)])
        most = Lexicon.edits(term)
        for w in words:
            expected = (min(distance(term, w[:n]) for n in range(len(w) + 1)) if stem else distance(term, w)) <= most
            assert bool(lexicon.match(w)) == expected, (term, stem, w)


def test_best_match_over_many_terms():
    terms = [("idiot", False, 2.0), ("idiotic", False, 3.0), ("scum", False, 1.0), ("wortle", True, 1.5)]
    lexicon = Lexicon(terms)
    assert lexicon.match("idiot") == (2.0, 0)
    assert lexicon.match("id1ot") == (2.0, 1) and lexicon.match("idiots") == (2.0, 1)
    assert lexicon.match("idotic") == (3.0, 1)
    assert lexicon.match("scums") is False  # short terms allow no edit
    assert lexicon.match("wortleling") == (1.5, 0) and lexicon.match("wurtleling") == (1.5, 1)
    assert lexicon.match("") is False


def test_quotation_windows():
    words = 'they said "what an idiot" and left'.split()
    assert is_quotation(words, words.index('idiot"'))
    assert not is_quotation("you are an idiot and more".split(), 3)
    assert not is_quotation('he left "early" you idiot now'.split(), 4)
    match = {w: (1.0, 0) if w == "idiot" else False for w in 'a “idiot” idiot the'.split()}
    assert features(None, match) == features("", match) == features("a the", match) == [0.0] * 7


def test_quotations_score_below_abuse(spark):
    r = random.Random(10)
    plain = lambda: " ".join("".join(r.choice("rstlne") for _ in range(4)) for _ in range(30))
    rows, labels = [], []
    for i in range(400):
        text = plain()
        if i % 4 == 0:
            text += " you idiot " + plain()
        elif i % 4 == 1:
            text += ' he said "idiot" once ' + plain()
        rows.append((i, text))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = train_toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    new = spark.createDataFrame([(1, plain() + " you idiot"), (2, plain() + " you idi0t"), (3, plain() + ' he wrote "idiot" there'),
                                 (4, plain()), (5, ""), (6, None)], "doc_id bigint, text string")
    score = {x.doc_id: x["__llm_toxic"] for x in score_toxicity(new, model).collect()}
    assert score[1] > 0.5 > max(score[3], score[4], score[5], score[6])
    assert score[2] > score[3]


def test_more_than_512_terms_are_learned(spark):
    """700 insults, each in three toxic documents and no clean one: every one is needed, and found again."""
    r = random.Random(12)
    plain = lambda: " ".join(r.choice(["rain", "sun", "tree", "lane", "note", "rest"]) for _ in range(12))
    letters = "bcdfghjkmpqvwxz"
    insults = [letters[i % 15] + letters[i // 15 % 15] + letters[i // 225] + "uo" for i in range(700)]
    rows = [(i, f"{plain()} {insults[i % 700]} {plain()}", 1) for i in range(2100)] + [(i, plain() + plain(), 0) for i in range(2100, 4200)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = train_toxicity(table, table)
    assert len(model["terms"]) >= 600
    new = spark.createDataFrame([(i, f"{plain()} {w}") for i, w in enumerate(insults)] + [(1000 + i, plain()) for i in range(300)], "doc_id bigint, text string")
    score = {x.doc_id: x["__llm_toxic"] for x in score_toxicity(new, model).collect()}
    assert sum(score[i] >= 0.5 for i in range(700)) >= 690 and all(score[1000 + i] < 0.5 for i in range(300))


def test_copies_of_a_labelled_id_do_not_reach_the_driver(spark, monkeypatch):
    from marketflow.llm import toxicity
    monkeypatch.setattr(toxicity, "SAMPLE", 8)
    docs = spark.range(200_000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 3).alias("text"))
    docs = docs.union(spark.range(2, 40).select("id", F.lit("more text")))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    sample, known, picked = toxicity._sample(docs, labels, "doc_id", "text", "toxic", lambda c: F.lit(True))
    assert sample.count() == 16 and known == [20, 20] and picked == [8, 8]
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 12)
    sample, _, picked = toxicity._sample(docs, labels, "doc_id", "text", "toxic", lambda c: F.lit(True))
    assert all(1 <= n <= 3 for n in picked)


def test_scripts_without_spaces(spark):
    r = random.Random(13)
    han = lambda n: "".join(chr(0x4E00 + r.randrange(400)) for _ in range(n))
    bad = "\u9f98\u9f99"
    rows = [(i, han(15) + (bad if i % 2 else "") + han(15) + "\u3002", i % 2) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = train_toxicity(table, table)
    assert any(bad.startswith(t) or t.startswith(bad) or t in bad for t, _, _ in model["terms"])
    new = spark.createDataFrame([(1, han(30) + bad + han(3)), (2, han(40)), (3, bad)], "doc_id bigint, text string")
    score = {x.doc_id: x["__llm_toxic"] for x in score_toxicity(new, model).collect()}
    assert score[1] >= 0.5 > score[2] and score[3] >= 0.5
    assert words_of("Ab \u4e00\u4e01\u4e02 c") == ["ab", "\u4e00\u4e01\u4e02", "\u4e01\u4e02", "c"]


def slow_score(model, text):
    """The score with every word compared with every term by edit distance."""
    if model["weights"] is None:
        return model["share"]

    def look(word):
        word, best = word.strip(EDGE), False
        for term, stem, weight in model["terms"]:
            ends = [word[:n] for n in range(len(word) + 1)] if stem else [word]
            off = min(distance(term, e) for e in ends)
            if off <= Lexicon.edits(term) and (not best or (weight, -off) > (best[0], -best[1])):
                best = (weight, off)
        return best
    x = features(text, {w: look(w) for w in set(words_of(text))})
    z = sum(a * b for a, b in zip(x, model["weights"])) + model["weights"][-1]
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def test_scores_equal_the_slow_way(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = train_toxicity(docs, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    assert model["terms"]
    some = docs.where("length(text) < 600").orderBy(F.xxhash64("doc_id")).limit(60).unionByName(
        docs.join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("toxic = 1"), "doc_id").where("length(text) < 900")
        .select("doc_id", "text").limit(20))
    for r in score_toxicity(some, model).collect():
        assert abs(r["__llm_toxic"] - slow_score(model, r.text)) < 1e-9


def test_held_out_accuracy(spark):
    got = op3_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    rows = got.where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and 0 <= r.score <= 1 for r in rows)
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    # labels of a tenth of the toxic rows have no visible cause (table rows, repeated words)
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in clean) / len(clean) < 0.02
    assert got.count() == spark.read.parquet(f"{SF}/labels.parquet").count()


def test_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7), (8, 0), (999, 1)], "doc_id bigint, toxic int")
    model = train_toxicity(odd_docs, labels)
    out = score_toxicity(odd_docs, model)
    assert out.columns == [*odd_docs.columns, "__llm_toxic"]
    assert out.count() == odd_docs.count() and out.where("`__llm_toxic` < 0 OR `__llm_toxic` > 1 OR `__llm_toxic` IS NULL").count() == 0
    assert score_toxicity(odd_docs.limit(0), model).count() == 0
    none = train_toxicity(odd_docs, labels.limit(0))
    assert [r[0] for r in score_toxicity(odd_docs, none).select("__llm_toxic").distinct().collect()] == [0.0]
    only = train_toxicity(odd_docs, labels.where("toxic = 1"))
    assert score_toxicity(odd_docs, only).where(F.col("__llm_toxic").isNull()).count() == 0
