import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from marketflow.llm import langid
from marketflow.llm.langid import DISCOUNT, ORDER, codes, has_letter, identify, train_languages
from marketflow.llm.queries import op10_language_id

SF = "/root/testdata/sf0.1"
TEXTS = [("aa", "abra cadabra bar"), ("aa", "cab bar abba"), ("bb", "xyz zyx yy zx"), ("bb", "yxz zzy xx")]


def model_of(spark, rows=TEXTS):
    return train_languages(spark.createDataFrame(rows, "lang string, text string"))


def brute_probability(texts, context, char):
    """Interpolated Kneser-Ney from plain counters, by the textbook recursion."""
    full = Counter()
    for text in texts:
        points = [32] * (ORDER - 1) + codes(text).tolist()
        full.update(tuple(points[i - ORDER + 1:i + 1]) for i in range(ORDER, len(points)))
    counts = {ORDER: full}
    for n in range(ORDER - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def p(n, context, char):
        if n == 0:
            return 1 / langid.ALPHABET
        context = context[len(context) - n + 1:]
        own = {g: c for g, c in counts[n].items() if g[:-1] == context}
        lower = p(n - 1, context, char)
        if not own:
            return lower
        total = sum(own.values())
        return max(counts[n][(*context, char)] - DISCOUNT, 0) / total + DISCOUNT * len(own) / total * lower
    return p(ORDER, context, char)


def test_probabilities_equal_the_recursion(spark):
    model = model_of(spark)
    tables = langid.Tables(model["counts"], model["langs"])
    r = random.Random(12)
    for _ in range(200):
        g = tuple(ord(r.choice("abcrdxyz q")) for _ in range(ORDER))
        key = np.array([sum(c << 16 * (ORDER - 1 - i) for i, c in enumerate(g))], np.uint64)
        got = tables.probability(key, ORDER)[0]
        for at, lang in enumerate(model["langs"]):
            assert got[at] == pytest.approx(brute_probability([t for x, t in TEXTS if x == lang], g[:-1], g[-1]), rel=1e-9)


def test_probabilities_sum_to_one(spark):
    model = model_of(spark)
    tables = langid.Tables(model["counts"], model["langs"])
    for context in ("abr", " ca", "qqq"):
        high = sum(ord(c) << 16 * (ORDER - 1 - i) for i, c in enumerate(context))
        keys = np.arange(langid.ALPHABET, dtype=np.uint64) + np.uint64(high)
        assert tables.probability(keys, ORDER).sum(axis=0) == pytest.approx([1.0, 1.0], abs=1e-6)


def test_entropy_is_the_mean_log_loss(spark):
    model = model_of(spark)
    tables = langid.Tables(model["counts"], model["langs"])
    entropy, size = tables.entropies("Bar, xyz? qé")
    points = [32] * (ORDER - 1) + codes("Bar, xyz? qé").tolist()
    for at, lang in enumerate(model["langs"]):
        own = [t for x, t in TEXTS if x == lang]
        loss = [-math.log(brute_probability(own, tuple(points[i - ORDER + 1:i]), points[i])) for i in range(ORDER, len(points))]
        assert size == len(loss) and entropy[at] == pytest.approx(sum(loss) / len(loss), rel=1e-4)


def keys_of(text):
    return np.concatenate([*langid.chunks(text), np.zeros(0, np.uint64)]).tolist()


def test_long_text_in_chunks(monkeypatch):
    texts = ["word " * 50, "", " ", "ab", "a  b\n" * 40, "x" * 200, "𠁡𠁢 ab " * 30, "ΟΔΟΣ ΣΑΣ " * 30, "1 " * 200]
    whole = [keys_of(t) for t in texts]
    for size in (1, 7, 64, 200):
        monkeypatch.setattr(langid, "_AT_ONCE", size)
        assert [keys_of(t) for t in texts] == whole
    for text, keys in zip(texts, whole):
        points = [32] * (ORDER - 1) + codes(text).tolist()
        assert keys == [sum(c << 16 * (ORDER - 1 - i) for i, c in enumerate(points[j - ORDER + 1:j + 1])) for j in range(ORDER, len(points))]


def test_code_points_beyond_16_bits_stay_apart():
    assert "a" not in map(chr, codes("\U00020061").tolist()) and len(codes("\U00020061")) == 4
    assert codes("\U00020061").tolist() != codes("\U00010061").tolist()


def test_a_rare_language_is_calibrated_too(spark):
    """With very many texts of another language, a rare one still has a limit of its own."""
    r = random.Random(8)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 7)))
    rows = [("hot", " ".join(word("etaoinshr") for _ in range(6)))] * 1 + [("hot", " ".join(word("etaoinshr") for _ in range(6))) for _ in range(9000)]
    rows += [("rare", " ".join(word("xyzqw") for _ in range(6))) for _ in range(12)]
    model = model_of(spark, rows)
    assert model["langs"] == ["hot", "rare"] and all(math.isfinite(x) for x in model["limits"])


def test_held_out_accuracy(spark):
    got = op10_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert len(got) == 10_000
    held = [r for r in got if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out and 0 <= r.score <= 1 for r in got)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.99


def test_odd_rows(spark, odd_docs):
    assert not has_letter(None) and not has_letter("12 ²!") and has_letter("é")
    model = train_languages(odd_docs)
    rows = identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id in (4, 5, 7, 10, 1)}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (4, 5, 7, 10))
    assert by_id[1].lang_pred in ("en", "de")
    assert identify(odd_docs.limit(0), model).count() == 0
    none = train_languages(odd_docs.limit(0))
    assert {(r.lang_pred, r.score) for r in identify(odd_docs, none).collect()} == {("und", 0.0)}


def test_rejects_texts_unlike_any_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train_languages(docs)
    new = spark.createDataFrame([(1, "жук сидит под кустом и думает"), (2, "qzx jjq wvx zzkq xxjw qqz")], "doc_id bigint, text string")
    assert all(r.rejected and r.lang_pred in model["langs"] for r in identify(new, model).collect())
    own = identify(docs, model)
    assert own.where("rejected").count() < 0.05 * docs.count()


def test_no_language_loses_n_grams_to_a_hot_one(spark):
    """More n-grams than a broadcast table once held, each of the hot language's seen twice: the small one keeps its own."""
    r = random.Random(5)
    hot = "".join(chr(0x4E00 + r.randrange(3000)) for _ in range(150_000))
    small = ["abra cadabra bar", "cab bar abba"]
    rows = [("hot", hot), ("hot", hot), *[("small", t) for t in small]]
    model = model_of(spark, rows)
    tables = langid.Tables(model["counts"], model["langs"])
    own = {g for t in small for keys in langid.chunks(t) for g in keys.tolist()}
    assert set(model["counts"][-1]["small"][0].tolist()) == own
    entropy, size = tables.entropies("cadabra cab")
    points = [32] * (ORDER - 1) + codes("cadabra cab").tolist()
    loss = [-math.log(brute_probability(small, tuple(points[i - ORDER + 1:i]), points[i])) for i in range(ORDER, len(points))]
    assert entropy[model["langs"].index("small")] == pytest.approx(sum(loss) / size, rel=1e-4)


def counts_of(texts):
    """Counts as a model of one part holds them, from ``(lang, text)``."""
    full = {}
    for lang, text in texts:
        full.setdefault(lang, Counter()).update(k for keys in langid.chunks(text) for k in keys.tolist())
    out = [full]
    for n in range(ORDER - 1, 0, -1):
        out.append({lang: Counter(k & (1 << 16 * n) - 1 for k in own) for lang, own in out[-1].items()})
    column = lambda own, kind, of: np.array([of(k) for k in sorted(own)], kind)
    return [{lang: (column(own, np.uint64, int), column(own, float, own.get)) for lang, own in by_lang.items()} for by_lang in out[::-1]]


def test_size_follows_the_n_grams_of_fifty_languages(monkeypatch):
    """Languages that share letters but no words: what is held grows with their n-grams, not with those times the languages."""
    r = random.Random(50)
    langs = [f"l{i:02}" for i in range(50)]
    lexicon = {lang: ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 8))) for _ in range(40)] for lang in langs}
    texts = [(lang, " ".join(r.choice(lexicon[lang]) for _ in range(120))) for lang in langs]
    counts = counts_of(texts)
    tables = langid.Tables(counts, langs)
    seen = sum(len(keys) for by_lang in counts for keys, _ in by_lang.values())
    assert seen < tables.pairs() <= 2 * seen  # a context is that of one n-gram at least
    assert seen < 0.3 * len(langs) * sum(len({k for keys, _ in by_lang.values() for k in keys.tolist()}) for by_lang in counts)
    tests = [(lang, " ".join(r.choice(lexicon[lang]) for _ in range(30))) for lang in langs]
    whole = [tables.entropies(text)[0] for _, text in tests]
    assert [langs[int(np.argmin(e))] for e in whole] == [lang for lang, _ in tests]
    points = [32] * (ORDER - 1) + codes(tests[7][1]).tolist()
    for at in (0, 7):
        own = [text for lang, text in texts if lang == langs[at]]
        loss = [-math.log(brute_probability(own, tuple(points[i - ORDER + 1:i]), points[i])) for i in range(ORDER, len(points))]
        assert whole[7][at] == pytest.approx(sum(loss) / len(loss), rel=1e-4)
    # Few n-grams held ready, and few rows at a time: the same sums.
    monkeypatch.setattr(langid, "TOP", 50 * 100)
    monkeypatch.setattr(langid, "_HELD", 50 * 7)
    small = langid.Tables(counts, langs)
    assert len(small.frequent) == 100 and small.top.shape == (100, 50)
    for (_, text), entropy in zip(tests, whole):
        assert small.entropies(text)[0] == pytest.approx(entropy, rel=1e-9)


def test_parts_score_as_the_whole(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.union(spark.createDataFrame([(-1, None, "x"), (-2, "12 !", "x"), (-2, "žluťoučký kůň 你好", None)], docs.schema))
    whole = train_languages(docs)
    assert len(whole["parts"]) == 1
    monkeypatch.setattr(langid, "CELLS", 20_000)
    cut = train_languages(docs)
    assert len(cut["parts"]) > 2 and cut["limits"] == pytest.approx(whole["limits"])
    key = lambda r: (r.doc_id, r.lang_pred, r.score)
    one, many = (sorted(identify(docs, m, extra="lang").collect(), key=key) for m in (whole, cut))
    assert len(one) == len(many) == docs.count()
    for a, b in zip(one, many):
        assert (a.doc_id, a.lang, a.lang_pred, a.rejected) == (b.doc_id, b.lang, b.lang_pred, b.rejected)
        assert b.score == pytest.approx(a.score) and (a.entropy is None or b.entropy == pytest.approx(a.entropy))


def test_limits_are_the_quantile_over_all_training_texts(spark):
    """More texts of a language than were once sampled, copies among them, and so few strange ones that a sample misses most."""
    r = random.Random(5)
    word = lambda letters: "".join(r.choice(letters) for _ in range(r.randint(2, 7)))
    common = [" ".join(word("abcdefgh") for _ in range(r.randint(3, 9))) for _ in range(12_000)]
    strange = ["".join(chr(0x3B1 + (7 * i + 3 * j) % 24) for j in range(12)) for i in range(9)]
    texts = [("aa", t) for t in common + common[:3000] + strange] + [("bb", word("xyz")) for _ in range(40)]
    docs = spark.createDataFrame([(i, *x) for i, x in enumerate(texts)], "doc_id long, lang string, text string").repartition(8)
    model = train_languages(docs)
    scored = [r for r in identify(docs, model, extra="lang").collect() if r.lang == r.lang_pred]
    for lang, limit in zip(model["langs"], model["limits"]):
        own = [r.entropy for r in scored if r.lang == lang]
        assert len(own) > (10_000 if lang == "aa" else 10)
        assert limit == pytest.approx(float(np.quantile(own, langid.REJECT)), rel=1e-12)
