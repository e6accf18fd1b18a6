"""Weight tables of the age-band model, as small inline DataFrames.

The tables are constants of the model (a few dozen rows, size independent
of the data), so joining them with ``F.broadcast`` is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column order of every weight row: 18-24, 25-29, 30-34, 35-39, 40-49, 50+.
SCORED_BANDS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50+"]
# Field-name suffix of each band in the device_* / search_* columns.
BAND_SUFFIX = ["18_24", "25_29", "30_34", "35_39", "40_49", "50"]

# ---- fixed values (must equal the original model) --------------------------
# Dimension coefficients.
CATEGORY_COEF, BRAND_COEF, PRICE_COEF, TIME_COEF = "0.3", "0.2", "0.15", "0.1"
DEVICE_RATE, SEARCH_RATE = "0.1", "0.15"
# Weight used when a (key, band) pair is not in a table.
DEFAULT_WEIGHT = "0.5"

PRICE = {
    "low": [".8", ".6", ".4", ".3", ".2", ".1"],
    "mid": [".2", ".4", ".6", ".7", ".8", ".7"],
    "high": [".1", ".2", ".3", ".4", ".5", ".6"],
}
CATEGORY = {
    "电脑办公": [".9", ".8", ".6", ".4", ".2", ".1"],
    "家用电器": [".9", ".8", ".6", ".4", ".2", ".1"],
    "个护化妆": [".2", ".4", ".6", ".8", ".9", ".7"],
    "手机": [".1", ".2", ".4", ".6", ".8", ".9"],
}
BRAND = {
    "香奈儿": [".9", ".7", ".5", ".3", ".2", ".1"],
    "小米": [".1", ".3", ".5", ".7", ".8", ".9"],
    "联想": [".1", ".3", ".5", ".7", ".8", ".9"],
    "Redmi": [".1", ".3", ".5", ".7", ".8", ".9"],
}
TIME = {
    "凌晨": [".2", ".1", ".1", ".1", ".1", ".1"],
    "早晨": [".1", ".1", ".1", ".1", ".2", ".3"],
    "上午": [".2", ".2", ".2", ".2", ".3", ".4"],
    "中午": [".4", ".4", ".4", ".4", ".4", ".3"],
    "下午": [".4", ".5", ".5", ".5", ".5", ".4"],
    "晚上": [".8", ".7", ".6", ".5", ".4", ".3"],
    "夜间": [".9", ".7", ".5", ".3", ".2", ".1"],
}
DEVICE = {
    "iOS": [".7", ".6", ".5", ".4", ".3", ".2"],
    "Android": [".8", ".7", ".6", ".5", ".4", ".3"],
}
SEARCH = {
    "时尚与潮流": [".9", ".7", ".5", ".3", ".2", ".1"],
    "性价比": [".2", ".4", ".6", ".7", ".8", ".8"],
    "健康与养生": [".1", ".2", ".4", ".6", ".8", ".7"],
    "家庭与育儿": [".1", ".2", ".4", ".6", ".8", ".7"],
    "科技与数码": [".8", ".6", ".4", ".3", ".2", ".1"],
    "学习与发展": [".4", ".5", ".6", ".7", ".8", ".7"],
}
# ----------------------------------------------------------------------------

WEIGHT_TYPE = T.DecimalType(4, 2)
SCORE_TYPE = T.DecimalType(18, 6)

_LONG_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("age_group", T.StringType(), False),
    T.StructField("weight", WEIGHT_TYPE, False),
])


def _rows(table: dict) -> list:
    from decimal import Decimal
    return [(k, band, Decimal(w)) for k, ws in table.items() for band, w in zip(SCORED_BANDS, ws)]


def order_weight_tables(mode: str = "as_run") -> dict[str, dict]:
    """Which order-dimension tables the scoring sees.

    ``as_run``: only the price table was ever filled; category, brand and
    time lookups all fall to the default.  ``repaired``: all four tables.
    """
    if mode == "as_run":
        return {"category": {}, "brand": {}, "price": PRICE, "time": {}}
    if mode == "repaired":
        return {"category": CATEGORY, "brand": BRAND, "price": PRICE, "time": TIME}
    raise ValueError(f"unknown scoring mode {mode!r}")


def _sql_lit(v, dtype: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype.simpleString()})"
    text = "'" + str(v).replace("'", "''") + "'"
    return text if isinstance(dtype, T.StringType) else f"CAST({text} AS {dtype.simpleString()})"


def const_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A constant table as one SQL ``VALUES`` statement: a local relation
    built JVM-side (no Python worker, no RDD, one driver round trip)."""
    names = ", ".join(f.name for f in schema.fields)
    if not rows:
        cols = ", ".join(f"{_sql_lit(None, f.dataType)} AS {f.name}" for f in schema.fields)
        return spark.sql(f"SELECT {cols} WHERE false")
    values = ", ".join("(" + ", ".join(_sql_lit(v, f.dataType) for v, f in zip(r, schema.fields)) + ")"
                       for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def long_table(spark: SparkSession, table: dict) -> DataFrame:
    """(key, age_group, weight) rows of one weight table."""
    return const_frame(spark, [(k, b, str(w)) for k, b, w in _rows(table)], _LONG_SCHEMA)


def wide_table(spark: SparkSession, table: dict, prefix: str, rate: str) -> DataFrame:
    """key -> ``{prefix}_{band}`` columns, each ``round(weight * rate, 3)``."""
    schema = T.StructType([T.StructField("key", T.StringType(), False)] + [
        T.StructField(f"{prefix}_{s}", T.DecimalType(10, 3), False) for s in BAND_SUFFIX])
    from decimal import Decimal, ROUND_HALF_UP
    rows = [(k, *[str((Decimal(w) * Decimal(rate)).quantize(Decimal("0.001"), ROUND_HALF_UP)) for w in ws])
            for k, ws in table.items()]
    return const_frame(spark, rows, schema)


def price_weights(spark: SparkSession) -> DataFrame:
    return long_table(spark, PRICE).withColumnRenamed("key", "price_interval")


def lit_decimal(v: str):
    return F.lit(v).cast(WEIGHT_TYPE)
