"""Price preference by age band: users x orders (interval join) x price weights.

user -> age band; order -> price band; pair a user with the orders placed
from one day before to one minute after the user record; keep the pair
only if the price table has a weight for (band, price band); count pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.functions.scalars import price_band
from portrait.functions.weights import price_weights
from portrait.operators.joins import interval_join, lookup_default
from portrait.operators.users import enrich_users

DAY_MS = 86_400_000
MINUTE_MS = 60_000


def price_pairs(spark: SparkSession, users: DataFrame, orders: DataFrame,
                lower_ms: int = -DAY_MS, upper_ms: int = MINUTE_MS) -> DataFrame:
    """One row per matched (user, order): age_group, price_interval, weight."""
    u = users.select(F.col("id").alias("uid"), "age_group", F.col("ts_ms").alias("u_ts"))
    o = (orders.filter(F.col("total_amount").isNotNull())
         .select("user_id", price_band("total_amount").alias("price_interval"),
                 F.col("ts_ms").alias("o_ts")))
    # a user may hold many orders: bucket by time, spreading the user records
    pairs = interval_join(u, o, "uid", "user_id", "u_ts", "o_ts", lower_ms, upper_ms, bucket_ms=-1, spread="left")
    # strict lookup: a pair without weight (e.g. 'Under 18') is not emitted
    return lookup_default(pairs.select("age_group", "price_interval"), price_weights(spark),
                          ["price_interval", "age_group"], "weight", "weight", default=None)


def price_preference(spark: SparkSession, user_info: DataFrame, order_info: DataFrame,
                     as_of: str) -> DataFrame:
    users = enrich_users(user_info, as_of)
    pairs = price_pairs(spark, users, order_info)
    return (pairs.groupBy("age_group", "price_interval", "weight")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("age_group", "price_interval", F.col("weight").cast("double").alias("weight"), "n"))
