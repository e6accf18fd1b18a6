"""Scalar rules: golden samples of the original and every band edge."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from portrait.functions import scalars as S

AS_OF = "2025-05-12"


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def days(d: str) -> str:
    return str((dt.date.fromisoformat(d) - dt.date(1970, 1, 1)).days)


@pytest.mark.parametrize("birth,age,band,sign,year", [
    ("1980-11-23", 44, "40-49", "射手座", "1980"),
    ("1994-10-07", 30, "30-34", "天秤座", "1994"),
])
def test_golden_birthdays(spark, birth, age, band, sign, year):
    f = S.birthday_fields("x", AS_OF)
    r = spark.createDataFrame([(days(birth),)], "x string").select(
        *[v.alias(k) for k, v in f.items()], S.age_band(f["age"]).alias("band")).first()
    assert (r.birthday, r.age, r.zodiac_sign, r.birth_year, r.band) == (birth, age, sign, year, band)


def test_invalid_and_null_birthday(spark):
    f = S.birthday_fields("x", AS_OF)
    rows = spark.createDataFrame([("abc",), (None,), ("12.5",)], "x string").select(
        *[v.alias(k) for k, v in f.items()]).collect()
    assert tuple(rows[0]) == ("invalid_date", -1, "unknown", "-1")
    assert tuple(rows[1]) == (None, None, None, None)
    assert tuple(rows[2]) == ("invalid_date", -1, "unknown", "-1")


@pytest.mark.parametrize("text,iso,year", [
    ("1000000000", "+2739877-01-03", "2739877"), ("0000000011585", "2001-09-20", "2001"), ("+5", "1970-01-06", "1970"),
    ("-719163", "0000-12-31", "0"), ("-1000000", "-0768-02-04", "-768"), ("365241780471", "+999999999-12-31", "999999999"),
    ("-365243219162", "-999999999-01-01", "-999999999"), ("365241780472", "invalid_date", "-1"), ("9" * 30, "invalid_date", "-1"), ("", "invalid_date", "-1")])
def test_birthdays_of_any_length(spark, text, iso, year):
    f = S.birthday_fields("x", AS_OF)
    r = spark.createDataFrame([(text,)], "x string").select(f["birthday"].alias("b"), f["birth_year"].alias("y")).first()
    assert (r.b, r.y) == (iso, year)


def test_civil_equals_the_calendar(spark):
    rows = spark.range(-150_000, 150_000, 37).select("id", S.civil("id").alias("c")).collect()
    assert all((r.c.y, r.c.m, r.c.d) == (d.year, d.month, d.day) for r in rows for d in [dt.date(1970, 1, 1) + dt.timedelta(days=r.id)])


@pytest.mark.parametrize("birth,age", [("2025-05-13", 0), ("2026-05-11", 0), ("2026-05-12", -1), ("2026-05-13", -1), ("2025-05-12", 0)])
def test_age_of_the_unborn(spark, birth, age):
    assert one(spark, S.age_years(S.date_parts(F.to_date("x")), AS_OF), birth) == age


def test_leap_day_age(spark):
    age = S.age_years(S.date_parts(F.to_date(F.col("x"))), "2025-02-28")
    assert one(spark, age, "2000-02-29") == 24
    assert one(spark, S.age_years(S.date_parts(F.to_date(F.col("x"))), "2025-03-01"), "2000-02-29") == 25


@pytest.mark.parametrize("md,sign", [
    ("01-19", "摩羯座"), ("01-20", "水瓶座"), ("02-18", "水瓶座"), ("02-19", "双鱼座"),
    ("03-20", "双鱼座"), ("03-21", "白羊座"), ("04-19", "白羊座"), ("04-20", "金牛座"),
    ("05-20", "金牛座"), ("05-21", "双子座"), ("06-21", "双子座"), ("06-22", "巨蟹座"),
    ("07-22", "巨蟹座"), ("07-23", "狮子座"), ("08-22", "狮子座"), ("08-23", "处女座"),
    ("09-22", "处女座"), ("09-23", "天秤座"), ("10-23", "天秤座"), ("10-24", "天蝎座"),
    ("11-22", "天蝎座"), ("11-23", "射手座"), ("12-21", "射手座"), ("12-22", "摩羯座"),
])
def test_zodiac_edges(spark, md, sign):
    assert one(spark, S.zodiac_sign(S.date_parts(F.to_date(F.col("x")))), f"2001-{md}") == sign


@pytest.mark.parametrize("age,band", [
    (-1, "Under 18"), (17, "Under 18"), (18, "18-24"), (24, "18-24"), (25, "25-29"), (29, "25-29"),
    (30, "30-34"), (34, "30-34"), (35, "35-39"), (39, "35-39"), (40, "40-49"), (49, "40-49"), (50, "50+")])
def test_age_bands(spark, age, band):
    assert one(spark, S.age_band("x"), age, "x int") == band


@pytest.mark.parametrize("amount,band", [
    (1000.0, "low"), (1000.01, "mid"), (4000.0, "mid"), (4000.01, "high"), (8197.0, "high")])
def test_price_bands(spark, amount, band):
    assert one(spark, S.price_band("x"), amount, "x double") == band


def test_time_of_day_golden(spark):
    lt = S.parse_time_of_day(F.col("x"), "Asia/Shanghai")
    r = spark.createDataFrame([("1745408619000",)], "x string").select(
        S.iso_local_time(lt).alias("t"), S.day_period(lt).alias("p")).first()
    assert (r.t, r.p) == ("19:43:39", "晚上")


@pytest.mark.parametrize("text,expect", [
    ("2024-01-02 08:30:00", "08:30:00"), ("23:59:59", "23:59:59"), ("1745408619120", "19:43:39.12"),
    ("garbage", None)])
def test_time_forms(spark, text, expect):
    lt = S.parse_time_of_day(F.col("x"), "Asia/Shanghai")
    assert one(spark, S.iso_local_time(lt), text) == expect


@pytest.mark.parametrize("hour,period", [
    (0, "凌晨"), (5, "凌晨"), (6, "早晨"), (8, "早晨"), (9, "上午"), (11, "上午"), (12, "中午"),
    (13, "中午"), (14, "下午"), (17, "下午"), (18, "晚上"), (21, "晚上"), (22, "夜间"), (23, "夜间")])
def test_day_periods(spark, hour, period):
    ts = F.to_timestamp(F.concat(F.lit("2024-01-01 "), F.lpad(F.col("x").cast("string"), 2, "0"),
                                 F.lit(":00:00")))
    assert one(spark, S.day_period(ts), hour, "x int") == period


def test_half_up(spark):
    assert one(spark, S.round_half_up("x"), 0.1045, "x double") == Decimal("0.105")


@pytest.mark.parametrize("score,label", [
    ("0.75", "18-24"), ("0.749", "25-29"), ("0.69", "25-29"), ("0.585", "30-34"), ("0.47", "35-39"),
    ("0.365", "40-49"), ("0.364", "50+"), ("0.26", "50+"), ("0.259", "0-17")])
def test_label_thresholds(spark, score, label):
    assert one(spark, S.label_from_sum(F.col("x").cast("decimal(10,3)")), score) == label


@pytest.mark.parametrize("os_csv,expect", [
    ("Android,HarmonyOS,iOS", "iOS"), ("Android,HarmonyOS", "HarmonyOS"), ("Android", "Android"),
    ("Linux", "Linux")])
def test_dominant_os(spark, os_csv, expect):
    assert one(spark, S.dominant_os("x"), os_csv) == expect


def test_date_formats(spark):
    r = spark.createDataFrame([(1745408619000,)], "x long").select(
        S.ms_to_datetime("x").alias("dt"), S.ms_to_date("x").alias("d"), S.ms_to_yyyymmdd("x").alias("ymd"),
        S.datetime_to_ms(S.ms_to_datetime("x")).alias("back"), S.date_to_ms(S.ms_to_date("x")).alias("day")
    ).first()
    assert (r.dt, r.d, r.ymd, r.back) == ("2025-04-23 19:43:39", "2025-04-23", "20250423", 1745408619000)
    assert r.day == 1745337600000  # 2025-04-23 00:00 +08:00


def test_first_token_and_camel():
    assert S.snake_to_camel("user_level") == "userLevel"
    assert S.snake_to_camel("id") == "id"
