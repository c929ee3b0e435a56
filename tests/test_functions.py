import datetime as dt

import pytest
from pyspark.sql import functions as F

from ampere.functions.casts import safe_bigint, safe_divide, safe_double
from ampere.functions.cells import column_name, float_text
from ampere.functions.fuel import fuel_category, is_detail_code
from ampere.functions.periods import (hour_period, in_hourly_pull, month_start, month_window,
                                      period_date)


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_safe_double_rejects_suffixes_nan_and_separators(spark):
    vals = ["12.5", " 12.5 ", "12f", "12d", "NaN", "Infinity", "1,234", "w", "", "1e3", "-.5", None]
    assert one_col(spark, vals, safe_double) == [12.5, 12.5, None, None, None, None, None, None,
                                                  None, 1000.0, -0.5, None]


def test_safe_bigint_rejects_fractions(spark):
    assert one_col(spark, ["12", "12.0", "-3", "x", "99999999999999999999"], safe_bigint) == \
        [12, None, -3, None, None]


def test_safe_divide_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_divide("a", "b")).collect()] == [None, None, 1.5]


@pytest.mark.parametrize("text,expected", [
    ("2026-03-01T05", dt.datetime(2026, 3, 1, 5)),
    ("2026-03-01 05:00:00", dt.datetime(2026, 3, 1, 5)),
    ("2026-03-01T05:30", dt.datetime(2026, 3, 1, 5)),     # slicing truncates minutes
    ("2026-03-01T05Z", dt.datetime(2026, 3, 1, 5)),
    ("2026-03-01", dt.datetime(2026, 3, 1, 0)),           # plain cast: midnight
    ("2026-03", None),                                    # a month is not an hour
    ("bad", None),
    (None, None),
])
def test_hour_period_chain(spark, text, expected):
    assert one_col(spark, [text], hour_period) == [expected]


def test_period_date_and_month_start(spark):
    assert one_col(spark, ["2024-05", "2024-13", "bad", None], period_date) == \
        [dt.date(2024, 5, 1), None, None, None]
    df = spark.createDataFrame([(dt.datetime(2024, 5, 17, 3),)], "t timestamp_ntz")
    assert df.select(month_start("t")).first()[0] == dt.date(2024, 5, 1)


def test_month_window_includes_anchor_month():
    w = month_window(dt.date(2026, 2, 15), 3)
    assert w == [dt.date(2025, 11, 1), dt.date(2025, 12, 1), dt.date(2026, 1, 1),
                 dt.date(2026, 2, 1)]
    assert len(month_window(dt.date(2026, 2, 1), 0)) == 1


def test_hourly_pull_stops_at_the_end_day(spark):
    hours = spark.sql("SELECT explode(sequence(timestamp_ntz'2026-01-01', timestamp_ntz'2026-03-31 23:00:00', "
                      "interval 1 hour)) AS ts")

    def pulled(month):
        got = hours.filter(in_hourly_pull("ts", F.lit(month), F.lit("2026-02-10"))).agg(F.min("ts"), F.max("ts"))
        return tuple(got.first())

    assert pulled("2026-02-01") == (dt.datetime(2026, 2, 1), dt.datetime(2026, 2, 10, 23))
    assert pulled("2026-01-01") == (dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 31, 23))
    assert pulled("2026-03-01") == (None, None)


def test_fuel_category_and_exclusion(spark):
    codes = ["NGO", "WNT", "GEO", "NUC", "RC", "HPS", "PET", "XYZ"]
    assert one_col(spark, codes, fuel_category) == [
        "Natural Gas", "Wind", "Solar & Geothermal", "Nuclear", "Coal", "Hydro", "Other", "Other"]
    # NOT IN drops aggregate codes and NULL codes alike
    df = spark.createDataFrame([("ALL",), ("COL",), ("NG",), (None,), ("NGO",)], "c string")
    assert [r[0] for r in df.filter(is_detail_code("c")).collect()] == ["NGO"]


def test_column_names():
    assert [column_name(n) for n in (1, 13, 26, 27, 52, 702, 703, 18278, 18279)] == [
        "A", "M", "Z", "AA", "AZ", "ZZ", "AAA", "ZZZ", "AAAA"]


def test_float_text(spark):
    vals = [12.5, 12.0, 0.0640625, -0.0000001, 1234567.1234564, None]
    assert one_col(spark, vals, float_text, "double") == \
        ["12.5", "12", "0.064063", "0", "1234567.123456", None]
