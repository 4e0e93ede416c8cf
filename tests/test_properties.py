"""Property tests: tables of inputs with their decisions, and a plain version of the range rule."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from towerlens.operators import serving
from towerlens.operators.clean import find_null_fields

#: Values of a text column, and whether the rule drops the column.
TEXT_CASES = [
    ([""], True), (["null"], True), ([" "], True), ([" null "], True), (["\t", "null", ""], True),
    (["x"], False), (["", "x"], False), ([None], False), (["", None], False), (["nullx"], False), (["NULL"], False),
]
NUMBER_CASES = [([-1], True), ([-1, -1], True), ([0], False), ([-1, 7], False), ([None], False), ([-1, None], False)]
#: Values of an array of structs with one text field.
ARRAY_CASES = [
    ([[("",), ("null",)]], True), ([[]], True), ([[("",)], []], True), ([[("x",)]], False), ([None], False),
    ([[(None,)]], False), ([[("",)], [("x",)]], False),
]


@settings(max_examples=8, deadline=None)
@given(st.sampled_from(TEXT_CASES), st.sampled_from(NUMBER_CASES), st.sampled_from(ARRAY_CASES), st.integers(0, 3))
def test_null_fields_of_combined_columns(spark, text, number, array, shift):
    """Each column's decision depends on its own values, whatever the order and number of rows."""
    n = max(len(c[0]) for c in (text, number, array))
    columns = [[c[0][(i + shift) % len(c[0])] for i in range(2 * n)] for c in (text, number, array)]
    df = spark.createDataFrame(list(zip(*columns)), "a string, n int, arr array<struct<x: string>>")
    paths = [("a",), ("n",), ("arr", "x")]
    assert find_null_fields(df) == [p for p, c in zip(paths, (text, number, array)) if c[1]]


HOURS = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(0, 24 * 40, 7)]


@settings(max_examples=8, deadline=None)
@given(st.sampled_from(HOURS), st.integers(0, 59), st.sampled_from(
    ["1 hour", "3 hours", "6 hours", "12 hours", "24 hours", "7 days"]))
def test_range_filter_matches_brute_force(spark, as_of_hour, minute, choice):
    as_of = as_of_hour + dt.timedelta(minutes=minute)
    rows = [(h.strftime("%Y"), h.strftime("%m"), h.strftime("%d"), h.strftime("%H")) for h in HOURS]
    df = spark.createDataFrame(rows, "ingest_year string, ingest_month string, ingest_day string, "
                                     "ingest_hour string")
    got = sorted(tuple(r) for r in serving.time_range_filter(
        df, as_of.strftime("%Y-%m-%d %H:%M:%S"), choice).collect())
    n = int(choice.split()[0]) * (24 if "day" in choice else 1)
    bound = (as_of - dt.timedelta(hours=n)).strftime("%Y-%m-%d %H:%M:%S")
    want = sorted(r for r in rows if f"{r[0]}-{r[1]}-{r[2]} {r[3]}:00:00" >= bound)
    assert got == want
