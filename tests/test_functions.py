"""Row-local expressions on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerglass.functions import dates, numbers
from ledgerglass.functions.geo import with_distance
from ledgerglass.functions.text import similarity, token_sorted
from ledgerglass.schema import feature_columns, numeric_columns, require_columns


def _column(spark, values, kind, expression):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, x {kind}").withColumn("y", expression)
    return [r.y for r in df.orderBy("i").collect()]


def test_bins_are_right_closed(spark):
    ages = [-1.0, 0.0, 0.5, 25.0, 25.1, 45.0, 65.0, 65.5, 300.0, None]
    got = _column(spark, ages, "double", numbers.bin_right_closed("x", numbers.AGE_BOUNDS, numbers.AGE_CODES))
    assert got == [None, None, 1, 1, 0, 0, 2, 3, 3, None]
    pops = [0.0, 1.0, 88735.0, 88736.0, 1577385.0, 1577386.0, None]
    got = _column(spark, pops, "double", numbers.bin_right_closed("x", numbers.CITY_BOUNDS, numbers.CITY_CODES))
    assert got == [None, 0, 0, 1, 1, 2, None]
    with pytest.raises(ValueError):
        numbers.bin_right_closed("x", (0, 1), (1, 2))


def test_closed_upper_bound_leaves_higher_values_null(spark):
    got = _column(spark, [100.0, 101.0], "double", numbers.bin_right_closed("x", (0, 25, 45, 65, 100), (1, 0, 2, 3)))
    assert got == [3, None]


def test_parse_timestamp(spark):
    text = ["2020-01-02 03:04:05", "nonsense", "", None]
    got = _column(spark, text, "string", dates.parse_timestamp("x"))
    assert got == [dt.datetime(2020, 1, 2, 3, 4, 5), None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        _column(spark, ["nonsense"], "string", dates.parse_timestamp("x", strict=True))


@pytest.mark.parametrize(
    "day, flag",
    [
        ("2020-07-03", 1),  # Independence Day on a Saturday
        ("2020-07-04", 1),
        ("2021-12-31", 1),  # New Year on a Saturday
        ("2023-01-02", 1),  # New Year on a Sunday
        ("2021-06-18", 1),  # Juneteenth, first observed in 2021
        ("2020-06-19", 0),
        ("2019-11-28", 1),  # fourth Thursday
        ("2019-11-21", 0),
        ("2020-05-25", 1),  # last Monday of May
        ("2020-05-18", 0),
        ("2020-01-20", 1),
        ("2020-02-17", 1),
        ("2020-09-07", 1),
        ("2020-10-12", 1),
        ("2018-11-12", 1),  # Veterans Day on a Sunday
        ("2020-12-25", 1),
        ("2020-12-24", 0),
    ],
)
def test_us_holidays(spark, day, flag):
    assert _column(spark, [day], "string", dates.is_us_holiday(F.col("x").cast("timestamp"))) == [flag]


def test_time_parts(spark):
    df = spark.createDataFrame([("2020-03-01 23:10:00",), ("2020-03-02 02:00:00",), ("2020-03-03 12:00:00",)], "t string")
    rows = dates.with_time_features(df.withColumn("trans_date_trans_time", F.to_timestamp("t"))).orderBy("t").collect()
    assert [(r.transaction_hour, r.transaction_day_of_week, r.is_weekend, r.is_high_risk_hour) for r in rows] == [
        (23, 6, 1, 2),
        (2, 0, 0, 1),
        (12, 1, 0, 0),
    ]


def test_age_months_and_shifts(spark):
    df = spark.createDataFrame([("2020-03-01 10:00:00", "2019-03-02"), ("2020-03-01 10:00:00", "2020-03-02")], "t string, d string")
    df = df.select(F.to_timestamp("t").alias("t"), F.to_date("d").alias("d"))
    rows = df.select(
        dates.age_in_years("t", "d").alias("age"), dates.month_of("t").alias("m"), dates.shift_days("t", -31).alias("s")
    ).collect()
    assert [r.age for r in rows] == [1, -1]
    assert rows[0].m == dt.date(2020, 3, 1)
    assert rows[0].s == dt.datetime(2020, 1, 30, 10)


def test_date_series(spark):
    df = spark.sql("SELECT timestamp'2020-01-01 05:00:00' AS a, timestamp'2020-01-08 04:00:00' AS b")
    got = [r.point for r in dates.date_series(df, "a", "b", 3).collect()]
    assert got == [dt.datetime(2020, 1, d, 5) for d in (1, 4, 7)]


def test_ratio_rounding_and_threshold(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (None, 2.0), (-1.0, 0.0)], "a double, b double")
    assert [r.q for r in df.select(numbers.ratio("a", "b").alias("q")).collect()] == [0.5, math.inf, None, None, -math.inf]
    assert _column(spark, [0.5, 1.5, 2.5], "double", numbers.round_half_even(F.col("x"))) == [0.0, 2.0, 2.0]
    assert _column(spark, [0.5, 0.51, 0.1], "double", numbers.to_class("x")) == [0, 1, 0]
    assert _column(spark, [0.0, math.e - 1], "double", numbers.log_scale("x")) == pytest.approx([0.0, 1.0])
    assert _column(spark, [" 12 "], "string", numbers.clean_identifier("x")) == ["12"]


def _vincenty_miles(lat1, lon1, lat2, lon2):
    """Iterative inverse on the same ellipsoid."""
    f, a = 1 / 298.257223563, 6378137.0
    b = (1 - f) * a
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(p))) for p in (lat1, lat2))
    big_l = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        s = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if s == 0:
            return 0.0
        c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(s, c)
        alpha = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
        cos2 = 1 - alpha**2
        mid = c - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0.0
        k = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        new = big_l + (1 - k) * f * alpha * (sigma + k * s * (mid + k * c * (2 * mid**2 - 1)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    q = cos2 * (a**2 - b**2) / b**2
    big_a = 1 + q / 16384 * (4096 + q * (-768 + q * (320 - 175 * q)))
    big_b = q / 1024 * (256 + q * (-128 + q * (74 - 47 * q)))
    d = big_b * s * (mid + big_b / 4 * (c * (2 * mid**2 - 1) - big_b / 6 * mid * (4 * s**2 - 3) * (4 * mid**2 - 3)))
    return b * big_a * (sigma - d) / 1609.344


def test_distance(spark):
    pairs = [(40.0, -100.0, 40.0, -100.0), (30.0, -90.0, 31.0, -90.0), (37.77, -122.42, 40.71, -74.0), (25.0, -80.0, 48.9, -124.0), (35.1, -90.0, 35.6, -89.2)]
    df = spark.createDataFrame(pairs, "lat double, long double, merch_lat double, merch_long double")
    for r in with_distance(df).collect():
        assert r.distance == pytest.approx(_vincenty_miles(*r[:4]), rel=3e-6, abs=1e-9)
    antipodes = spark.createDataFrame([(0.0, 0.0, 0.1, 179.9)], df.schema)
    far = with_distance(antipodes).first().distance
    assert abs(far - 12428) < 0.006 * 12428


def _lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_similarity(spark):
    words = ["", "a", "engineer, water", "water engineer", "Water Engineer", "naïve çoder", "gardening engineer", "nurse"]
    pairs = [(a, b) for a in words for b in words]
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("s", similarity(F.col("a"), F.col("b")))
    for r in df.collect():
        total = len(r.a) + len(r.b)
        assert r.s == pytest.approx(200 * _lcs(r.a, r.b) / total if total else 100.0)
    assert _column(spark, ["  water  engineer b "], "string", token_sorted("x")) == ["b engineer water"]


def test_schema_helpers(spark):
    df = spark.range(1).selectExpr("id AS cc_num", "1.5D AS amt", "'x' AS job", "2 AS age")
    assert feature_columns(df) == ["amt", "age"]
    assert numeric_columns(df) == ["cc_num", "amt", "age"]
    with pytest.raises(ValueError, match="city, dob"):
        require_columns(df, "amt", "city", "dob")
