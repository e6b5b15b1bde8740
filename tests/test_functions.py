from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import text


def one_col(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def apply(spark, fn, values):
    df = one_col(spark, values)
    return [r[0] for r in df.select(fn(F.col("x")).alias("y")).collect()]


def test_blank_to_null_trims_spaces_only(spark):
    got = apply(spark, text.blank_to_null, ["", "   ", "\t", " a ", None, "\n"])
    assert got == [None, None, "\t", "a", None, "\n"]


def test_na_words_exact_and_case_sensitive(spark):
    got = apply(spark, text.na_to_null, ["None", "NULL", "NA", "nan", " NA ", "none", "Film", None, ""])
    assert got == [None, None, None, None, " NA ", "none", "Film", None, None]


def test_date_guard_full_match(spark):
    vals = ["2024-01-01", "2024-1-1", "2024/01/01", "2024-01-01\n", "2024-01-01T00", None]
    got = apply(spark, text.text_to_date, vals)
    import datetime as dt

    assert got == [dt.date(2024, 1, 1), None, None, None, None, None]


def test_date_guard_bad_value_fails_or_nulls(spark):
    df = one_col(spark, ["2024-13-45"])
    with pytest.raises(Exception, match="invalid date"):
        df.select(text.text_to_date("x")).collect()
    assert df.select(text.text_to_date("x", on_bad="null")).collect()[0][0] is None


def test_year_guard_ascii_digits(spark):
    got = apply(spark, text.text_to_year, ["2019", "2019.0", "19x9", "٢٠١٩", "0007"])
    assert got == [2019, None, None, None, 7]


def test_rating_guard_and_rounding(spark):
    got = apply(spark, text.text_to_rating, ["4", "4.5", "3.25", "-1", ".5", "4.", "0.05"])
    assert got == [Decimal("4.0"), Decimal("4.5"), Decimal("3.3"), None, None, None, Decimal("0.1")]


@pytest.mark.parametrize("bad", ["100", "99.95"])
def test_rating_overflow(spark, bad):
    df = one_col(spark, [bad])
    with pytest.raises(Exception, match="invalid rating"):
        df.select(text.text_to_rating("x")).collect()
    assert df.select(text.text_to_rating("x", on_bad="null")).collect()[0][0] is None


def test_bool_tokens(spark):
    vals = ["Yes", "FALSE", "T", "0", "maybe", None, "y", "N"]
    got = apply(spark, lambda c: text.text_to_bool(text.blank_to_null(c)), vals)
    assert got == [True, False, True, False, None, None, True, False]


def test_month_start(spark):
    df = spark.createDataFrame([("2024-02-29",)], "d string").select(F.col("d").cast("date").alias("d"))
    import datetime as dt

    assert df.select(text.month_start("d")).collect()[0][0] == dt.date(2024, 2, 1)


def test_mean_2dp_is_exact(spark):
    # 1,269 ratings summing to 4752.4: a decimal average rounds to 3.75, exact is 3.74.
    values = [Decimal("3.7")] * 1269
    total = sum(values)
    values[0] += Decimal("4752.4") - total
    assert sum(values) == Decimal("4752.4")
    df = spark.createDataFrame([(v,) for v in values], "r decimal(3,1)")
    got = df.agg(text.mean_2dp("r").alias("m")).collect()[0][0]
    assert got == Decimal("3.74")


def test_mean_2dp_half_up(spark):
    df = spark.createDataFrame([(Decimal("1.0"),), (Decimal("1.5"),), (Decimal("1.5"),), (Decimal("1.5"),)], "r decimal(3,1)")
    # mean 1.375 -> 1.38
    assert df.agg(text.mean_2dp("r")).collect()[0][0] == Decimal("1.38")


def test_there_is_no_year_0(spark):
    df = spark.createDataFrame([("0000-01-01",), ("0001-01-01",)], "d string")
    assert [str(r[0]) for r in df.select(text.text_to_date("d", "null")).collect()] == ["None", "0001-01-01"]
    with pytest.raises(Exception, match="invalid date: 0000-01-01"):
        df.select(text.text_to_date("d")).collect()
