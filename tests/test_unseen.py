"""New rows of a load: compared on all columns, nulls equal."""

import datetime as dt
import decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marketflow.operators.incremental import unseen

SCHEMA = "a string, b string, x double, d decimal(10,2), t timestamp, y binary, n long"
NAN = float("nan")
T0 = dt.datetime(2024, 3, 1, 12, 0, 0, 5)
ROWS = [
    ("a", None, 0.0, None, T0, b"\xff", 1), (None, "a", -0.0, None, T0, b"\xff", 1), ("a", None, -0.0, None, T0, b"\xff", 1),
    ("1:a", "", NAN, decimal.Decimal("1.10"), None, b"\xfe", None), ("1:a", "-", NAN, decimal.Decimal("1.10"), None, b"\xfe", None),
    ("1:a", None, NAN, decimal.Decimal("1.10"), None, b"\xff\xfe", None), ("", "1:a", None, None, None, None, None),
    ("", None, None, None, T0.replace(microsecond=6), None, None), ("-", "", None, None, T0.replace(microsecond=6), None, None),
    ("ä", "😀", 0.1, None, None, b"", 2), ("ä😀", "", 0.1, None, None, b"", 2), (None,) * 7, (None,) * 7,
]


def _by_columns(rows, seen):
    """All columns grouped, as SQL's EXCEPT does."""
    for frame in seen:
        rows = rows.subtract(frame)
    return rows.distinct()


def _texts(df):
    return sorted(map(repr, df.collect()))


def test_equals_a_comparison_of_all_columns(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    for seen in ([], ROWS[:1], ROWS[3:4], ROWS[1:6], ROWS[8:], ROWS):
        frames = [spark.createDataFrame(seen, SCHEMA)]
        assert _texts(unseen(rows, frames)) == _texts(_by_columns(rows, frames))
    halves = [spark.createDataFrame(ROWS[:4], SCHEMA), spark.createDataFrame(ROWS[7:], SCHEMA)]
    assert _texts(unseen(rows, halves)) == _texts(_by_columns(rows, halves))
    assert _texts(unseen(rows, [])) == _texts(rows.distinct())
    assert unseen(rows.limit(0), frames).count() == 0


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.none() | st.text(alphabet="-:1a0", max_size=4)] * 3), max_size=25), st.integers(0, 25))
def test_texts_with_marks(spark, texts, cut):
    schema = "a string, b string, c string"
    rows, seen = spark.createDataFrame(texts, schema), spark.createDataFrame(texts[:cut], schema)
    assert sorted(map(tuple, unseen(rows, [seen]).collect()), key=repr) == sorted(set(texts) - set(texts[:cut]), key=repr)


def test_columns_are_matched_by_name_and_widened(spark):
    rows = spark.createDataFrame([(1, "a", 2), (2, "b", 3)], "k int, `s.t` string, _row int")
    seen = spark.createDataFrame([("x", 2, 2 ** 40, "b"), ("a", 2, 1, "a")], "extra string, _row int, k long, `s.t` string")
    assert [tuple(r) for r in unseen(rows, [seen]).collect()] == [(2, "b", 3)]


def test_nested_columns_are_compared_too(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (1, ["a,b"]), (1, None)], "k int, l array<string>")
    seen = spark.createDataFrame([(1, ["a", "b"])], "k int, l array<string>")
    assert sorted(map(repr, unseen(rows, [seen]).collect())) == sorted(map(repr, rows.where("size(l) = 1 or l is null").collect()))
