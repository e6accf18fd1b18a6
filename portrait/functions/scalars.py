"""Scalar rules of the profiling jobs as pure Column expressions.

Everything here compiles to built-in Catalyst expressions, so it stays in
whole-stage codegen; no Python runs per row.  Where the original read a
clock or the system time zone, the value is a parameter instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "AGE_BANDS", "PRICE_BANDS", "epoch_day", "civil", "date_parts", "iso_date", "birthday_fields", "age_years",
    "zodiac_sign", "age_band", "price_band", "parse_time_of_day", "day_period",
    "iso_local_time", "round_half_up", "epoch_ms", "datetime_to_ms", "ms_to_date",
    "ms_to_datetime", "ms_to_yyyymmdd", "date_to_ms", "first_token",
    "dominant_os", "snake_to_camel", "label_from_sum", "ntz_to_ms", "ms_to_utc_ntz",
    "ms_to_day_text",
]

# ---- fixed values (must equal the original jobs) --------------------------
# Age bands, upper bounds inclusive: <18, <=24, <=29, <=34, <=39, <=49, else.
AGE_BANDS = ["Under 18", "18-24", "25-29", "30-34", "35-39", "40-49", "50+"]
AGE_BAND_UPPER = [17, 24, 29, 34, 39, 49]
# Price bands on the order amount: <=1000 low, <=4000 mid, else high.
PRICE_BANDS = [("low", 1000), ("mid", 4000), ("high", None)]
# Zodiac: first month-day strictly after which the sign starts, checked top down.
ZODIAC_STARTS = [
    (12, 21, "摩羯座"), (11, 22, "射手座"), (10, 23, "天蝎座"), (9, 22, "天秤座"),
    (8, 22, "处女座"), (7, 22, "狮子座"), (6, 21, "巨蟹座"), (5, 20, "双子座"),
    (4, 19, "金牛座"), (3, 20, "白羊座"), (2, 18, "双鱼座"), (1, 19, "水瓶座"),
]
ZODIAC_DEFAULT = "摩羯座"
# Day periods by hour: [0,6) 凌晨, [6,9) 早晨, [9,12) 上午, [12,14) 中午,
# [14,18) 下午, [18,22) 晚上, [22,24) 夜间.
DAY_PERIODS = [(6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上")]
DAY_PERIOD_LAST = "夜间"
# Predicted band from the rounded score: first threshold reached wins.
LABEL_THRESHOLDS = [(0.75, "18-24"), (0.69, "25-29"), (0.585, "30-34"),
                    (0.47, "35-39"), (0.365, "40-49"), (0.26, "50+")]
LABEL_FLOOR = "0-17"
# Invalid birthday markers.
INVALID_DATE, INVALID_ZODIAC = "invalid_date", "unknown"
# Dominant OS when a user has several: the order the original's set iterated.
OS_PRIORITY = ["iOS", "HarmonyOS", "Android"]
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Days from 1970-01-01 that the proleptic calendar of the original holds
# (years -999999999 to 999999999).
EPOCH_DAY_MIN, EPOCH_DAY_MAX = -365_243_219_162, 365_241_780_471


def epoch_day(text) -> Column:
    """Epoch-day text -> BIGINT days; unparseable or outside the calendar ->
    null (ANSI-safe).  Any number of digits (leading zeros, a sign)."""
    n = F.regexp_extract(_c(text).cast("string"), "^[+-]?[0-9]+$", 0).try_cast("bigint")
    return F.when(n.between(EPOCH_DAY_MIN, EPOCH_DAY_MAX), n)


# The Gregorian calendar repeats after 400 years of so many days.
CYCLE_DAYS, CYCLE_YEARS = 146_097, 400


def civil(days) -> Column:
    """BIGINT epoch days -> struct(y, m, d) of the proleptic Gregorian
    calendar.  DATE ends at year 5.8 million, so the day is moved by whole
    400-year cycles to 1970-2369 and the year back."""
    n = _c(days)
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(n, F.lit(CYCLE_DAYS)).cast("int"))
    cycles = F.floor(n / F.lit(CYCLE_DAYS))  # exact: both are far below 2 ** 53
    return F.struct((F.year(date) + F.lit(CYCLE_YEARS) * cycles).cast("int").alias("y"),
                    F.month(date).alias("m"), F.dayofmonth(date).alias("d"))


def date_parts(date) -> Column:
    """DATE -> struct(y, m, d), null for null."""
    d = _c(date)
    return F.when(d.isNotNull(), F.struct(F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("d")))


def iso_date(c) -> Column:
    """struct(y, m, d) -> ISO text: four-digit years, a sign beyond them."""
    c = _c(c)
    y = F.abs(c["y"])
    year = F.concat(F.when(c["y"] < 0, "-").when(c["y"] > 9999, "+").otherwise(""),
                    F.when(y < 1000, F.lpad(y.cast("string"), 4, "0")).otherwise(y.cast("string")))
    return F.concat(year, F.lit("-"), F.lpad(c["m"].cast("string"), 2, "0"), F.lit("-"), F.lpad(c["d"].cast("string"), 2, "0"))


def age_years(birth, as_of: str) -> Column:
    """Whole years from struct(y, m, d) to a date: whole months (a started
    one does not count, in either direction), then whole years towards zero.
    With 32 days to the month both are one division."""
    b = _c(birth)
    y, m, d = map(int, as_of.split("-"))
    born = (b["y"].cast("bigint") * 12 + b["m"]) * 32 + b["d"]
    return F.call_function("div", F.lit((y * 12 + m) * 32 + d) - born, F.lit(12 * 32)).cast("int")


def zodiac_sign(birth) -> Column:
    b = _c(birth)
    md = b["m"] * 100 + b["d"]
    expr = F.when(md.isNull(), F.lit(None).cast("string"))
    for m, day, sign in ZODIAC_STARTS:
        expr = expr.when(md > m * 100 + day, sign)
    return expr.otherwise(ZODIAC_DEFAULT)


def birthday_fields(raw, as_of: str, days=None) -> dict[str, Column]:
    """F1-F4 of a raw epoch-day birthday (``days``: its ``epoch_day``, where
    a column holds that already).

    null -> every output null (field untouched); unparseable -> the invalid
    markers (age -1, year -1); else ISO date, age, zodiac, birth year text.
    """
    r = _c(raw)
    birth = civil(epoch_day(r) if days is None else days)

    def known(value, invalid):  # no value: the text is not a day, or there is none
        return F.coalesce(value, F.when(r.isNotNull(), invalid))

    return {
        "birthday": known(iso_date(birth), INVALID_DATE),
        "age": known(age_years(birth, as_of), -1).cast("int"),
        "zodiac_sign": known(zodiac_sign(birth), INVALID_ZODIAC),
        "birth_year": known(birth["y"].cast("string"), "-1"),
    }


def age_band(age) -> Column:
    # one list entry for each age from the first bound on: the age is named
    # twice only, so plans that repeat the band stay small
    first, last = AGE_BAND_UPPER[0], AGE_BAND_UPPER[-1] + 1
    names = [next((b for b, upper in zip(AGE_BANDS, AGE_BAND_UPPER) if a <= upper), AGE_BANDS[-1]) for a in range(first, last + 1)]
    at = F.least(F.greatest(_c(age) - F.lit(first), F.lit(0)), F.lit(last - first)) + 1
    return F.when(_c(age).isNotNull(), F.element_at(F.array(*map(F.lit, names)), at.cast("int")))


def price_band(amount) -> Column:
    a = _c(amount)
    return (F.when(a.isNull(), F.lit(None).cast("string"))
            .when(a <= PRICE_BANDS[0][1], PRICE_BANDS[0][0])
            .when(a <= PRICE_BANDS[1][1], PRICE_BANDS[1][0])
            .otherwise(PRICE_BANDS[2][0]))


def ntz_to_ms(ts) -> Column:
    """TIMESTAMP_NTZ -> epoch millis, independent of the session zone."""
    return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {ts})")


def parse_time_of_day(text, zone: str = "Asia/Shanghai") -> Column:
    """digits -> epoch ms in ``zone``; else 'yyyy-MM-dd HH:mm:ss'; else
    'HH:mm:ss'.  Returns a local TIMESTAMP_NTZ whose time part is the answer
    (the date part is meaningless for the last form); null if nothing parses
    (the original fell back to the wall clock, which cannot repeat)."""
    t = _c(text)
    is_digits = t.rlike("^[+-]?[0-9]+$")
    from_ms = F.convert_timezone(F.lit("UTC"), F.lit(zone), ms_to_utc_ntz(t.try_cast("bigint")))
    full = F.try_to_timestamp(t, F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    clock = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), t),
                               F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    return F.when(is_digits, from_ms).otherwise(F.coalesce(full, clock))


def day_period(local_ts) -> Column:
    h = F.hour(_c(local_ts))
    expr = F.when(h.isNull(), F.lit(None).cast("string"))
    for upper, name in DAY_PERIODS:
        expr = expr.when(h < upper, name)
    return expr.otherwise(DAY_PERIOD_LAST)


def iso_local_time(local_ts) -> Column:
    """HH:mm:ss plus '.fraction' (trailing zeros cut) only if non-zero."""
    t = _c(local_ts)
    frac = F.date_format(t, "SSSSSS")
    trimmed = F.regexp_replace(frac, "0+$", "")
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.date_format(t, "HH:mm:ss"),
                 F.when(trimmed == "", F.lit("")).otherwise(F.concat(F.lit("."), trimmed))))


def round_half_up(x, places: int = 3, precision: int = 18, scale: int = 6) -> Column:
    """HALF_UP on the decimal value (Spark ``round`` on DECIMAL)."""
    return F.round(_c(x).cast(f"decimal({precision},{scale})"), places)


# ---- F17-F19: date-time text <-> epoch millis -------------------------------
def datetime_to_ms(text, offset: str = "+08:00") -> Column:
    """'yyyy-MM-dd HH:mm:ss' read at a fixed offset -> epoch ms."""
    return F.unix_millis(F.try_to_timestamp(F.concat(_c(text), F.lit(offset)),
                                            F.lit("yyyy-MM-dd HH:mm:ssXXX")))


def date_to_ms(text, offset: str = "+08:00") -> Column:
    """'yyyy-MM-dd' (midnight) at a fixed offset -> epoch ms."""
    return datetime_to_ms(F.concat(_c(text), F.lit(" 00:00:00")), offset)


def ms_to_utc_ntz(ms) -> Column:
    """Epoch millis -> UTC wall time as TIMESTAMP_NTZ (no session zone)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _local(ms, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ms_to_utc_ntz(ms))


def ms_to_day_text(ms) -> Column:
    """UTC calendar day of epoch millis as 'yyyy-MM-dd' (dates carry no zone)."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"),
                                    F.floor(_c(ms) / F.lit(86_400_000)).cast("int")), "yyyy-MM-dd")


def ms_to_date(ms, zone: str = "Asia/Shanghai") -> Column:
    return F.date_format(_local(ms, zone), "yyyy-MM-dd")


def ms_to_datetime(ms, zone: str = "Asia/Shanghai") -> Column:
    return F.date_format(_local(ms, zone), "yyyy-MM-dd HH:mm:ss")


def ms_to_yyyymmdd(ms, zone: str = "Asia/Shanghai") -> Column:
    return F.date_format(_local(ms, zone), "yyyyMMdd")


def epoch_ms(ts) -> Column:
    """TIMESTAMP (instant) -> epoch millis."""
    return F.unix_millis(_c(ts))


# ---- F11, F20 -----------------------------------------------------------------
def first_token(text, sep: str = " ") -> Column:
    """``split(sep)[0]`` of the original (the whole text if no separator)."""
    return F.substring_index(_c(text), sep, 1)


def dominant_os(os_csv) -> Column:
    """first OS of the comma-joined set, by the original's set order."""
    arr = F.split(_c(os_csv), ",")
    expr = F.when(_c(os_csv).isNull(), F.lit(None).cast("string"))
    for name in OS_PRIORITY:
        expr = expr.when(F.array_contains(arr, name), name)
    return expr.otherwise(F.element_at(arr, 1))


def label_from_sum(rounded) -> Column:
    """F16 on the 3-place score."""
    s = _c(rounded)
    expr = F.when(s.isNull(), F.lit(None).cast("string"))
    for th, band in LABEL_THRESHOLDS:
        expr = expr.when(s >= F.lit(th).cast("decimal(10,3)"), band)
    return expr.otherwise(LABEL_FLOOR)


def snake_to_camel(name: str) -> str:
    """S12 column renaming (metadata only)."""
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)
