"""Order x user wide rows (the first job): users with body measures (J1),
order lines with their order (J2), orders with users (J3), then five
dimension hops (J6) and the price band of the rows that met a user."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portrait.functions.scalars import price_band
from portrait.operators.joins import BROADCAST_MAX_BYTES, dim_join, interval_join, row_preserving_bytes
from portrait.operators.users import enrich_users

DAY_MS = 86_400_000


def user_profile(users: DataFrame, body: DataFrame, bound_ms: int = DAY_MS) -> DataFrame:
    """J1 + P9: user x body measures on id = uid within +-1 day; the body
    record's fields win (including its ts_ms).  ``event_ms`` = later time."""
    u = users.withColumn("_ut", F.col("ts_ms"))
    b = body.withColumn("_bt", F.col("ts_ms"))
    j = interval_join(u, b, "id", "uid", "_ut", "_bt", -bound_ms, bound_ms,
                      merge="right", time_out="event_ms")
    return j.drop("_ut", "_bt")


def order_lines(detail: DataFrame, info: DataFrame, bound_ms: int = DAY_MS) -> DataFrame:
    """J2 + P4: order line x order on order_id = id within +-1 day."""
    d = detail.select("id", "order_id", "sku_id", "sku_name", "sku_num", F.col("ts_ms").alias("_dt"))
    i = info.select(F.col("id").alias("_oid"), "create_time", "user_id", "total_amount",
                    "original_total_amount", "ts_ms")
    j = interval_join(d, i, "order_id", "_oid", "_dt", "ts_ms", -bound_ms, bound_ms, time_out="event_ms")
    return j.select("id", "order_id", "sku_id", "sku_name", "sku_num", "create_time", "user_id",
                    "total_amount", "original_total_amount", "ts_ms", "event_ms")


@dataclass
class Dims:
    """The five dimension tables of the sku chain (all values text)."""
    sku: DataFrame
    trademark: DataFrame
    category3: DataFrame
    category2: DataFrame
    category1: DataFrame


SKU_DIM_COLUMNS = ["sku_name", "tm_id", "category3_id", "tm_name", "category3_name", "category2_id",
                   "category2_name", "category1_id", "category1_name"]


def sku_dimension(dims: Dims) -> DataFrame:
    """The snowflake flattened on the dimension side: one row per sku with
    its brand and three category levels (left joins: a miss at a hop gives
    nulls from there on).  Only dimension rows are joined here."""
    d = dims.sku.select("id", "sku_name", "tm_id", "category3_id")
    d = dim_join(d, dims.trademark, "tm_id", "id", {"tm_name": "tm_name"})
    d = dim_join(d, dims.category3, "category3_id", "id",
                 {"name": "category3_name", "category2_id": "category2_id"})
    d = dim_join(d, dims.category2, "category2_id", "id",
                 {"name": "category2_name", "category1_id": "category1_id"})
    return dim_join(d, dims.category1, "category1_id", "id", {"name": "category1_name"})


def sku_dim_chain(lines: DataFrame, dims: Dims, how: str = "left") -> DataFrame:
    """Sku -> (sku_name, tm_id, category3_id) -> tm_name ->
    (category3_name, category2_id) -> (category2_name, category1_id) ->
    category1_name.  A miss gives nulls (the original crashed).

    The fact rows meet the dimensions once: the five hops are joined among
    the dimension tables first (``sku_dimension``), so the facts take one
    join (a broadcast when the flattened dimension is proven small, else
    one shuffle) instead of five."""
    flat = sku_dimension(dims)
    # dimension keys are unique (row keys), so the left-join chain keeps one
    # row per sku: bound the flattened size by the sku table's
    bound = row_preserving_bytes(dims.sku.select("id", "sku_name", "tm_id", "category3_id"), flat)
    small = bound is not None and bound <= BROADCAST_MAX_BYTES
    return dim_join(lines, flat, "sku_id", "id", {c: c for c in SKU_DIM_COLUMNS}, how, broadcast=small)


def wide_orders(user_info: DataFrame, body: DataFrame, detail: DataFrame, info: DataFrame,
                dims: Dims, as_of: str, bound_ms: int = DAY_MS) -> DataFrame:
    """J3 + P10: enriched order lines x user profiles on user_id = uid within
    +-1 day; on shared names (id, create_time, ts_ms) the order wins."""
    users = user_profile(enrich_users(user_info, as_of), body, bound_ms).withColumnRenamed("event_ms", "_ue")
    orders = order_lines(detail, info, bound_ms).withColumnRenamed("event_ms", "_oe")
    # the dimensions keep every row, so they follow the join that drops most
    j = interval_join(orders, users.drop(*ORDER_ADDS), "user_id", "uid", "_oe", "_ue", -bound_ms, bound_ms,
                      merge="left", time_out="event_ms")
    return with_dimensions(j.drop("_oe", "_ue"), dims, [c for c in orders.columns if c != "_oe"])


#: What ``with_dimensions`` adds to an order row.
ORDER_ADDS = [*SKU_DIM_COLUMNS, "price_interval"]


def with_dimensions(rows: DataFrame, dims: Dims, order_columns: list[str]) -> DataFrame:
    """J6 and the price band of wide rows; the order's columns come first,
    then what is added here, then the user's."""
    first = [*order_columns, *[c for c in ORDER_ADDS if c not in order_columns]]
    out = sku_dim_chain(rows, dims).withColumn("price_interval", price_band("total_amount"))
    return out.select(*first, *[c for c in rows.columns if c not in first])
