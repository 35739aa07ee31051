"""Column helpers: case-insensitive text, positional keys, rule tables."""

from pyspark.sql import functions as F

from yoyflow.functions import (
    Rule,
    classify,
    classify_with_id,
    concat_null,
    decode_client,
    decode_code,
    encode_key,
    eq_ci,
    isin_ci,
    key_length,
    like_ci,
    not_isin_ci,
    year_suffix,
)


def _one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_eq_ci_ignores_case_and_trailing_blanks(spark):
    got = _one(spark, eq_ci("s", "Cross-sell"), [("Cross-Sell",), ("cross-sell  ",), (" Cross-sell",), (None,)], "s string")
    assert got == [True, True, False, None]


def test_like_without_wildcard_is_equality(spark):
    got = _one(spark, like_ci("s", "Other%"), [("Other Seg",), ("other%",), (None,)], "s string")
    assert got == [True, True, None]
    got = _one(spark, like_ci("s", "BoA"), [("boa",), ("BoA (x)",)], "s string")
    assert got == [True, False]


def test_not_in_with_null_is_null(spark):
    got = _one(spark, not_isin_ci("s", ["a", "b"]), [("A",), ("c",), (None,)], "s string")
    assert got == [False, True, None]
    assert _one(spark, isin_ci("s", ["X"]), [("x ",)], "s string") == [True]


def test_concat_null_propagates(spark):
    got = _one(spark, concat_null("a", "b"), [("HD Group", "Line"), ("HD Group", None)], "a string, b string")
    assert got == ["HD GroupLine", None]


def test_decode_short_and_normal_keys(spark):
    rows = [("12398",), ("5DL9830",), ("1230",), ("123",), ("12 ",), (None,)]
    schema = "j string"
    assert _one(spark, decode_client("j"), rows, schema) == ["1", "5DL", "", None, None, None]
    assert _one(spark, decode_code("j"), rows, schema) == ["98", "30", "30", "23", "2 ", None]
    assert _one(spark, key_length("j"), rows, schema) == [5, 7, 4, 3, 2, None]


def test_encode_round_trip(spark):
    df = spark.createDataFrame([("5DL", 1998, "30"), ("001", 2024, "99"), (None, 2024, "99")], "c string, y int, k string")
    got = [r[0] for r in df.select(encode_key("c", "y", "k")).collect()]
    assert got == ["5DL9830", "0012499", None]
    assert [r[0] for r in df.select(year_suffix("y")).collect()] == ["98", "24", "24"]


def test_classify_first_match_and_null_falls_through(spark):
    x = F.col("x")
    rules = [Rule(x > 10, "big", "r1"), Rule(x > 5, "mid", "r2"), Rule(x.isNull(), "none", "r3")]
    df = spark.createDataFrame([(20,), (7,), (1,), (None,)], "x int")
    value, rid = classify_with_id(rules, "small")
    got = [(r[0], r[1]) for r in df.select(value, rid).collect()]
    assert got == [("big", "r1"), ("mid", "r2"), ("small", "default"), ("none", "r3")]
    assert _one(spark, classify([], "d"), [(1,)], "x int") == ["d"]


def test_input_check_lists_every_missing_column(spark):
    import pytest

    from yoyflow.sources.schemas import MissingColumns, check_inputs

    ok = spark.createDataFrame([("1", "x")], "AccountSFID string, accountsegment string")
    check_inputs({"account_segments": ok})
    bad = spark.createDataFrame([("1",)], "ID string")
    with pytest.raises(MissingColumns, match="Client_Code_Adv__c.*Record_Type_Text__c"):
        check_inputs({"accounts": bad})
