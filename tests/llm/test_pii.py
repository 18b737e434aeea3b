import itertools
import random
import re
import time

import numpy as np
import pytest

from marketflow.llm import pii as P
from marketflow.llm.queries import QUERIES

# The patterns as they are stated, for texts short enough for backtracking.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(digits[::-1]):
        total += int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d))))
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


def test_rules_equal_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(rng.choice(("0123456789", "01 -", "a.@-", "+(). 12", "é\n%_"))) for _ in range(rng.randint(0, 60)))
        assert P.rule_spans(text) == plain_spans(text)
    card = "4111 1111-1111 1111"
    text = f"x {card}, 00255.0.0.1 256.1.1.1 a@b@c.d.e +1 (555) 010-0199."
    assert P.rule_spans(text) == plain_spans(text) and {k for k, _, _ in P.rule_spans(text)} == set(P.KINDS)


@pytest.mark.parametrize("text", ["a" * 2_000_000, "1" * 2_000_000, "1." * 1_000_000, "1 " * 1_000_000, "+1" * 1_000_000,
                                  "a@" * 500_000, "a.b" * 700_000 + "@", "@" * 1_000_000, "+" + "1-" * 1_000_000])
def test_rules_are_linear(text):
    began = time.time()
    P.rule_spans(text)
    assert time.time() - began < 20


@pytest.fixture(scope="module")
def field():
    return P.fit_field([P.encode_example(t, s) for t, s in P.example_rows()])


def test_viterbi_finds_the_best_labels(field):
    rng = np.random.default_rng(2)
    k = len(P.LABELS)
    for n in (1, 2, 4):
        scores = rng.normal(size=(3, 4, k))
        got = P.viterbi(scores, np.array([n, n, 4]), field.step.astype(float))

        def worth(row, path):
            return sum(field.step[a, b] + scores[row, t, b] for t, (a, b) in enumerate(zip((0, *path), path)))

        for row in (0, 1):
            best = max(itertools.product(range(k), repeat=n), key=lambda p: worth(row, p))
            assert tuple(got[row, :n]) == best


def test_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(3)
    rows = [P.encode_example(t, s) for t, s in P.example_rows(6)]
    lengths = np.array([min(len(y), 12) for _, y in rows])
    feats, labels = np.zeros((6, 12, rows[0][0].shape[1]), np.int32), np.zeros((6, 12), np.int64)
    for i, (x, y) in enumerate(rows):
        feats[i, :lengths[i]], labels[i, :lengths[i]] = x[:12], y[:12]
    emit = rng.normal(size=(P._HASH, len(P.LABELS))) * 0.1
    step = np.where(P._may_follow(), 0.1, -np.inf)
    _, g_emit, g_step = P._gradient(emit, step, feats, labels, lengths)
    for cell in ((feats[0, 3, 0], 0), (feats[2, 1, 5], 2)):
        up, down = emit.copy(), emit.copy()
        up[cell] += 1e-4
        down[cell] -= 1e-4
        slope = (P._gradient(up, step, feats, labels, lengths)[0] - P._gradient(down, step, feats, labels, lengths)[0]) / 2e-4
        assert abs(slope - g_emit[cell]) < 1e-4 * max(1, abs(slope))
    up, down = step.copy(), step.copy()
    up[0, 1] += 1e-4
    down[0, 1] -= 1e-4
    slope = (P._gradient(emit, up, feats, labels, lengths)[0] - P._gradient(emit, down, feats, labels, lengths)[0]) / 2e-4
    assert abs(slope - g_step[0, 1]) < 1e-4 * max(1, abs(slope))


def test_held_out_rows(field):
    rows = P.example_rows(3000, seed=77)
    found = P.Decoder(field).spans([t for t, _ in rows])
    right = sum(len(set(s) & set(g)) for (_, s), g in zip(rows, found))
    wanted, marked = sum(len(s) for _, s in rows), sum(map(len, found))
    assert right >= 0.9 * wanted and right >= 0.97 * marked
    clean = [t for t, s in rows if not s]
    assert sum(map(len, P.Decoder(field).spans(clean))) <= 0.01 * len(clean)


def test_forms_the_rules_miss(field):
    decode = lambda t: [(k, t[s:e]) for k, s, e in P.Decoder(field).spans([t])[0]]
    assert decode("please write to maria at brightmail dot com about it") == [("email", "maria at brightmail dot com")]
    assert decode("the old host was 10[.]20[.]30[.]40 until then") == [("ip", "10[.]20[.]30[.]40")]
    assert ("phone", "(555) 010-0199") in decode("you may call (555) 010-0199 or come by")
    assert decode("she looked at it. Then he left at 10:30 on 2024-05-01 and paid $5,000") == []


def test_spans_of_the_field_touch_no_rule():
    rules = [("email", 5, 10), ("card", 8, 30), ("ip", 40, 45)]
    added = [("phone", 0, 5), ("phone", 0, 6), ("phone", 29, 33), ("phone", 30, 40), ("ip", 41, 42), ("card", 45, 50)]
    assert P._apart(added, rules) == [("phone", 0, 5), ("phone", 30, 40), ("card", 45, 50)]


def test_long_stretches_are_decoded_whole(field):
    """One word of a million signs with digits in it, and many stretches of unlike lengths at once."""
    rng = random.Random(6)
    long = "".join(rng.choice("ab1") for _ in range(100_000)) + " write to jo at mail dot com please"
    texts = [long, "", *(t for t, _ in P.example_rows(700, seed=8))]
    together = P.Decoder(field).spans(texts)
    assert together[0][-1][0] == "email" and together[1] == []
    assert together[2:] == [P.Decoder(field).spans([t])[0] for t in texts[2:]]


def test_training_table(spark):
    table = P.labelled_table(spark, 40)
    again = table.unionAll(table).unionAll(spark.createDataFrame([(None, None), ("no spans", None)], table.schema))
    field = P.train_pii(again)
    assert np.isfinite(field.emit).all()
    nothing = P.train_pii(table.limit(0))
    assert P.Decoder(nothing).spans(["call (555) 010-0199 at once"]) == [[]]


def test_odd_documents(spark, odd_docs, field):
    found = P.find_pii(odd_docs, field)
    assert found.columns == ["doc_id", "spans"] and found.count() == odd_docs.count()
    assert P.find_pii(odd_docs.limit(0), field).count() == 0
    docs = spark.createDataFrame([(1, "é jo@x.de 😀 1.2.3.4"), (1, "é jo@x.de 😀 1.2.3.4"), (None, "jo (at) mail (dot) com"), (2, None)],
                                 "doc_id bigint, text string")
    rows = sorted(P.find_pii(docs, field).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    assert [tuple(s) for s in rows[0]["spans"]] == [("email", 2, 9, "rule"), ("ip", 12, 19, "rule")]
    assert rows[0] == rows[1] and rows[2]["spans"] == []
    assert [tuple(s) for s in rows[3]["spans"]] == [("email", 0, 22, "field")]


def test_query_equals_brute_force(spark, tmp_path):
    import hashlib
    texts = ["mail jo@x.org, +1 (555) 010-0199", "4111111111111111 and 1.2.3.4 1.2.3.400", None, "", "nothing here"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op12_pii"](spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        spans = plain_spans(text or "")
        listed = [f"{k}:{s}:{e}" for k, s, e in spans]
        assert [rows[i][f"n_{k}"] for k in P.KINDS] == [sum(s[0] == k for s in spans) for k in P.KINDS]
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(rows[i]["spans"].split(",")) | {""}
