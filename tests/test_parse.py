"""Parsing and lenient typing of wire records (FIXTURES F6, first block)."""

from pyspark.sql import functions as F

from towerlens.functions.casts import lenient_int, python_strip
from towerlens.operators.parse import encode_records, parse_records, split_corrupt, type_records
from towerlens.schema import CORRUPT, MEASURED_AT


def _parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return parse_records(df)


def test_quoted_and_bare_numbers_parse(spark):
    rows = _parse(spark, ['{"signal":"12"}', '{"signal":13}']).select("signal").collect()
    assert [r.signal for r in rows] == ["12", "13"]
    typed = type_records(_parse(spark, ['{"signal":"12"}', '{"signal":13}']))
    assert [r.signal for r in typed.select("signal").collect()] == [12, 13]


def test_corrupt_json_goes_to_dead_letter(spark):
    parsed = _parse(spark, ["not json", '{"signal":1,', '{"signal":"5"}'])
    good, bad = split_corrupt(parsed)
    assert good.count() == 1
    bad_rows = bad.collect()
    assert len(bad_rows) == 2
    for r in bad_rows:
        assert r[CORRUPT] is not None
        assert r.signal is None and r.operator is None


def test_lenient_int_rules(spark):
    df = spark.createDataFrame([("abc",), ("",), ("9999999999",), ("12.5",), (" 12 ",), ("-3.9",)],
                               "s string")
    got = [r.v for r in df.select(lenient_int("s").alias("v")).collect()]
    assert got == [None, None, None, 12, 12, -3]


def test_postal_code_keeps_leading_zero(spark):
    typed = type_records(_parse(spark, ['{"postal_code":"08014"}']))
    assert typed.first().postal_code == "08014"


def test_hour_field_renamed_not_overwritten(spark):
    typed = type_records(_parse(spark, ['{"hour":"10:20:30"}']))
    assert MEASURED_AT in typed.columns and "hour" not in typed.columns
    assert typed.first()[MEASURED_AT] == "10:20:30"


def test_encode_parse_roundtrip_keeps_empty_and_null(spark):
    df = spark.createDataFrame([("net_1", "", None)], "network string, satellites string, provider string")
    enc = encode_records(df)
    row = enc.first()
    assert row.key == "net_1"
    assert '"satellites":""' in row.value and '"provider":null' in row.value
    back = parse_records(enc).first()
    assert back.satellites == "" and back.provider is None


def test_encode_key_falls_back_to_clock(spark):
    df = spark.createDataFrame([("",), (None,)], "network string")
    keys = [r.key for r in encode_records(df).collect()]
    assert all(k and float(k) > 1e9 for k in keys)


def test_python_strip_matches_str_strip(spark):
    samples = ["  a ", "\tb\n", " c　", "d"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r.v for r in df.select(python_strip("s").alias("v")).collect()]
    assert got == [s.strip() for s in samples]


def test_parse_keeps_passthrough_columns(spark):
    df = spark.createDataFrame([(1, '{"operator":"x"}')], "record_id long, value string")
    out = parse_records(df)
    assert out.columns[0] == "record_id"
    assert out.select(F.col("operator")).first()[0] == "x"


def test_type_records_is_idempotent_on_renamed_hour(spark):
    typed = type_records(_parse(spark, ['{"hour":"10:20:30","signal":"4"}']))
    again = type_records(typed)
    assert again.columns == typed.columns
    assert again.first()[MEASURED_AT] == "10:20:30" and again.first().signal == 4


def test_bigint_text_keeps_all_digits(spark):
    df = spark.createDataFrame([("9007199254740993",), ("9007199254740993.0",), ("99999999999999999999",)], "s string")
    got = [r.v for r in df.select(lenient_int("s", "bigint").alias("v")).collect()]
    assert got == [9007199254740993, 9007199254740992, None]
