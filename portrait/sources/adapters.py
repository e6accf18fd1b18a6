"""Adapters: the driver's TPC-H-like tables as the profiling jobs' inputs.

The jobs expect user, body-measure, order, order-line and page-log records
plus five dimension tables.  These adapters derive them from ``customer``,
``orders``, ``lineitem``, ``part``, ``supplier``, ``nation``, ``region`` and
``events`` with integer arithmetic only, so that an SQL engine can repeat
every value exactly (``SQL`` below holds the same mapping as DuckDB text
for the oracle queries).  Each is a projection of one scan: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portrait.functions.scalars import ntz_to_ms

# ---- fixed values of the adapters ------------------------------------------
EPOCH_2024_MS = 1704067200000          # 2024-01-01 00:00:00 UTC
SPAN_S = 2592000                       # 30 days: event times fall in Jan 2024
HALF_DAY_MS = 43200000
AS_OF = "2025-05-12"                   # "today" for ages
ZONE = "Asia/Shanghai"
USER_DIV = 10                          # events.user_id = customer key DIV 10
OS_BY_K3 = ["iOS 17", "Android 13", "HarmonyOS 4"]
BY_EVENT = {  # event_type -> (channel, model, brand, page_id)
    "view": ("appstore", "iPhone 14", "Apple", "good_detail"),
    "click": ("xiaomi", "Mi 13", "Xiaomi", "home"),
    "purchase": ("huawei", "Mate 60", "Huawei", "payment"),
    "signup": ("oppo", "Find X6", "OPPO", "register"),
    "error": ("vivo", "X90", "vivo", "error"),
}
SEARCH_TERMS_EXTRA = ["iPhone14", "口红"]   # k % 6 in (4, 5); 0..3 -> supplier names
SEARCH_CATEGORY_BY_REGION = ["时尚与潮流", "性价比", "健康与养生", "家庭与育儿", "科技与数码", "学习与发展"]
BRAND_NAMES = ["香奈儿", "小米", "联想", "Redmi"]               # Brand#.1 to Brand#.4
CATEGORY1_NAMES = ["电脑办公", "家用电器", "个护化妆", "手机"]   # regions 0 to 3
# -----------------------------------------------------------------------------


def _case(col: Column, mapping: dict, idx: int | None = None) -> Column:
    expr = None
    for k, v in mapping.items():
        val = v[idx] if idx is not None else v
        expr = F.when(col == k, val) if expr is None else expr.when(col == k, val)
    return expr


def user_ts_ms(key: Column) -> Column:
    return F.lit(EPOCH_2024_MS) + (key * 7919 % SPAN_S) * 1000


def order_ts_ms(key: Column) -> Column:
    return F.lit(EPOCH_2024_MS) + (key * 173 % SPAN_S) * 1000


def user_info(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    raw = (F.when(k % 97 == 13, F.lit("n/a"))
           .when(k % 89 == 7, F.lit(None).cast("string"))
           .when(k % 83 == 11, (F.lit(1_000_000_000) + k * 997).cast("string"))
           .when(k % 79 == 3, F.lpad((k * 997 % 16000).cast("string"), 13, "0"))
           .when(k % 73 == 5, F.concat(F.lit("-"), (k * 99_991_000).cast("string")))
           .when(k % 71 == 9, F.lit("99999999999999"))
           .otherwise((k * 997 % 16000 - 2000).cast("string")))
    ts = user_ts_ms(k)
    return customer.select(
        k.alias("id"),
        F.lower(F.regexp_replace("c_name", "Customer#", "u")).alias("login_name"),
        F.col("c_name").alias("name"),
        F.when(k % 2 == 0, "F").otherwise("M").alias("gender"),
        raw.alias("birthday"),
        (1 + k % 3).cast("int").alias("user_level"),
        ts.cast("string").alias("create_time"),
        ts.alias("ts_ms"))


def user_sup_msg(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("uid"),
        (150 + k % 50).cast("int").alias("height"), F.lit("cm").alias("unit_height"),
        (45 + k % 60).cast("int").alias("weight"), F.lit("kg").alias("unit_weight"),
        (user_ts_ms(k) + (k % 7 - 3) * HALF_DAY_MS).alias("ts_ms"))


def _cents(x: str) -> Column:
    return F.round(F.col(x) * 100).cast("bigint")


def order_info(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    cents = _cents("o_totalprice")
    ts = order_ts_ms(k)
    return orders.select(
        k.alias("id"), F.col("o_custkey").alias("user_id"),
        (F.floor(cents / 60) / 100.0).alias("total_amount"),
        (F.floor(cents / 50) / 100.0).alias("original_total_amount"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
        (k % 30).cast("int").alias("province_id"),
        ts.alias("create_time"), ts.alias("ts_ms"))


def line_id() -> Column:
    """One number for a line: the table repeats (order, line number), so
    part, supplier and quantity are taken in.  From order keys of 17.8 million
    on it passes 2^63: its low 64 bits are the id then (two's complement), which
    tells the lines of an order apart as before.  ``line_id_turn`` has the rest."""
    high, low = _line_number()
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(LOW_32)))


def line_id_turn() -> Column:
    """How many times 2^64 the id is below the line's whole number; 0 while it
    fits.  Id and turn together are as exact as the number."""
    return F.shiftright(_line_number()[0] + F.lit(1 << 31), 32).cast("int")


LOW_32 = (1 << 32) - 1


def _line_number() -> tuple[Column, Column]:
    """``(((order * 8 + line) * 1000003 + part) * 1009 + supplier % 1009) * 64 +
    quantity`` in two limbs that do not overflow: its bits from the 32nd on, and
    a number whose low 32 bits are its own."""
    line = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_003 + F.col("l_partkey")
    low = line.bitwiseAND(F.lit(LOW_32)) * (1_009 * 64) + F.col("l_suppkey") % 1_009 * 64 + F.col("l_quantity").cast("bigint")
    return F.shiftright(line, 32) * (1_009 * 64) + F.shiftright(low, 32), low


def order_detail_log(lineitem: DataFrame) -> DataFrame:
    """Order lines as delivered: every fifth twice, and for every seventh an
    earlier version with a tenth of the amounts; ``pos`` is the log position and
    ``id_turn`` goes with the id, as lines are told apart by it."""
    now, old = F.struct(F.lit(1).alias("pos"), F.lit(1).alias("part")), F.struct(F.lit(0).alias("pos"), F.lit(10).alias("part"))
    versions = F.array(now, F.when(F.col("id") % 5 == 0, now), F.when(F.col("id") % 7 == 0, old))
    lines = _order_detail(lineitem, line_id_turn().alias("id_turn"))
    each = lines.withColumn("_v", F.explode(F.filter(versions, lambda v: v.isNotNull())))
    return each.select(*[F.floor(F.col(c) / F.col("_v.part")).alias(c) if c == "original_cents" else c for c in lines.columns], F.col("_v.pos").alias("pos"))


def order_detail(lineitem: DataFrame) -> DataFrame:
    return _order_detail(lineitem)


def _order_detail(lineitem: DataFrame, *more: Column) -> DataFrame:
    k = F.col("l_orderkey")
    price = _cents("l_extendedprice")
    return lineitem.select(
        line_id().alias("id"), k.alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.concat(F.lit("sku-"), F.col("l_partkey").cast("string")).alias("sku_name"),
        F.col("l_quantity").cast("int").alias("sku_num"),
        price.alias("original_cents"),
        F.floor(price * _cents("l_discount") / 100).alias("activity_cents"),
        F.floor(price * _cents("l_tax") / 100).alias("coupon_cents"),
        (order_ts_ms(k) + ((F.col("l_linenumber") * 5) % 7 - 3) * HALF_DAY_MS).alias("ts_ms"), *more)


# ---- dimensions (all values text, like the key-value store they model) -----
def dim_sku(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey").cast("string").alias("id"),
                       F.col("p_name").alias("sku_name"), F.col("p_brand").alias("tm_id"),
                       (F.col("p_partkey") % 101).cast("string").alias("category3_id"))


def dim_trademark(part: DataFrame) -> DataFrame:
    """Brands whose number ends in 1 to 4 bear the names of the brand weights."""
    name = F.regexp_replace("id", "Brand#", "TM-")
    for digit, known in enumerate(BRAND_NAMES, 1):
        name = F.when(F.endswith("id", F.lit(str(digit))), known).otherwise(name)
    return part.select(F.col("p_brand").alias("id")).distinct().select("id", name.alias("tm_name"))


def dim_category3(supplier: DataFrame) -> DataFrame:
    return supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"),
                           F.col("s_nationkey").cast("string").alias("category2_id"))


def dim_category2(nation: DataFrame) -> DataFrame:
    return nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"),
                         F.col("n_regionkey").cast("string").alias("category1_id"))


def category1_name() -> Column:
    """Regions 0 to 3 bear the names of the category weights."""
    name = F.col("r_name")
    for key, known in enumerate(CATEGORY1_NAMES):
        name = F.when(F.col("r_regionkey") == key, known).otherwise(name)
    return name


def dim_category1(region: DataFrame) -> DataFrame:
    return region.select(F.col("r_regionkey").cast("string").alias("id"), category1_name().alias("name"))


def category_compare_dic(region: DataFrame) -> DataFrame:
    """(id, category_name, search_category); every level-1 name twice, so a
    first-match lookup has something to choose between."""
    cats = F.array(*[F.lit(c) for c in SEARCH_CATEGORY_BY_REGION])
    r = F.col("r_regionkey")
    a = region.select(r.cast("int").alias("id"), category1_name().alias("category_name"),
                      F.element_at(cats, (r % 6 + 1).cast("int")).alias("search_category"))
    b = region.select((r + 100).cast("int").alias("id"), category1_name().alias("category_name"),
                      F.element_at(cats, ((r + 1) % 6 + 1).cast("int")).alias("search_category"))
    return a.unionByName(b)


def base_dic(orders: DataFrame) -> DataFrame:
    """Dictionary (dic_code, info{dic_name}) from the order priorities."""
    return (orders.select(F.col("o_orderpriority").alias("p")).distinct()
            .select(F.substring("p", 1, 1).alias("dic_code"),
                    F.struct(F.col("p").alias("dic_name")).alias("info")))


# ---- page log ----------------------------------------------------------------
def page_log(events: DataFrame, replay_every: int = 0) -> DataFrame:
    """events -> page-log records ``{common{...}, page{...}, ts}`` as structs.

    ``seq`` plays the part of the message offset (order tie-breaker).
    Users ``% 37 == 5`` have no uid, ``% 41 == 7`` an empty one; one event
    in 53 has no ``common`` block.  ``replay_every=n`` appends an exact
    copy of every n-th event (duplicate delivery)."""
    # parse props once (a projection of its own so the parse is not
    # repeated for every derived field)
    events = events.select("event_id", "ts", "user_id", "event_type", "value",
                           F.from_json("props", "k int").getField("k").alias("_k"))
    u = F.col("user_id")
    k = F.col("_k")
    et = F.col("event_type")
    uid = (F.when(u % 37 == 5, F.lit(None).cast("string"))
           .when(u % 41 == 7, F.lit("")).otherwise(u.cast("string")))
    os_ = F.element_at(F.array(*[F.lit(o) for o in OS_BY_K3]), (k % 3 + 1).cast("int"))
    supplier_name = F.concat(F.lit("Supplier#"), F.lpad((k % 10).cast("string"), 9, "0"))
    item = (F.when(k % 6 < 4, supplier_name).when(k % 6 == 4, SEARCH_TERMS_EXTRA[0])
            .otherwise(SEARCH_TERMS_EXTRA[1]))
    common = F.struct(
        uid.alias("uid"), os_.alias("os"), _case(et, BY_EVENT, 0).alias("ch"),
        _case(et, BY_EVENT, 1).alias("md"), _case(et, BY_EVENT, 2).alias("ba"),
        (u % 10).cast("string").alias("ar"), F.concat(F.lit("v2."), (k % 4).cast("string")).alias("vc"),
        F.concat(F.lit("s"), F.floor(F.col("event_id") / 10).cast("string")).alias("sid"),
        F.concat(F.lit("m"), u.cast("string")).alias("mid"),
        F.when(et == "signup", "1").otherwise("0").alias("is_new"))
    page = F.struct(
        _case(et, BY_EVENT, 3).alias("page_id"),
        (F.round(F.col("value") * 100).cast("bigint") * 10).alias("during_time"),
        F.when(et.isin("view", "purchase"), F.when(et == "view", item).otherwise(k.cast("string"))).alias("item"),
        F.when(et == "view", "keyword").when(et == "purchase", "sku_id").alias("item_type"))
    out = events.select(
        F.when(F.col("event_id") % 53 != 0, common).alias("common"), page.alias("page"),
        ntz_to_ms("ts").alias("ts"), F.col("event_id").alias("seq"))
    if replay_every:
        out = out.unionByName(out.filter(F.col("seq") % replay_every == 0))
    return out


PAGE_LOG_DDL = ("common struct<uid:string,os:string,ch:string,md:string,ba:string,ar:string,"
                "vc:string,sid:string,mid:string,is_new:string>, "
                "page struct<page_id:string,during_time:bigint,item:string,item_type:string>, ts bigint, seq bigint")


# ---- the same mappings as DuckDB SQL (oracle side) ---------------------------
def _sql_case(expr: str, mapping: dict, idx: int) -> str:
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v[idx]}'" for k, v in mapping.items())
    return f"CASE {whens} END"


CATEGORY1_SQL = "CASE r_regionkey " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(CATEGORY1_NAMES)) + " ELSE r_name END"

SQL = {
    "user_info": f"""
        SELECT c_custkey AS id, lower(replace(c_name, 'Customer#', 'u')) AS login_name,
               c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN c_custkey % 97 = 13 THEN 'n/a' WHEN c_custkey % 89 = 7 THEN NULL
                    WHEN c_custkey % 83 = 11 THEN CAST(1000000000 + c_custkey * 997 AS VARCHAR)
                    WHEN c_custkey % 79 = 3 THEN lpad(CAST(c_custkey * 997 % 16000 AS VARCHAR), 13, '0')
                    WHEN c_custkey % 73 = 5 THEN '-' || CAST(c_custkey * 99991000 AS VARCHAR)
                    WHEN c_custkey % 71 = 9 THEN '99999999999999'
                    ELSE CAST(c_custkey * 997 % 16000 - 2000 AS VARCHAR) END AS birthday,
               CAST(1 + c_custkey % 3 AS INTEGER) AS user_level,
               CAST({EPOCH_2024_MS} + (c_custkey * 7919 % {SPAN_S}) * 1000 AS VARCHAR) AS create_time,
               {EPOCH_2024_MS} + (c_custkey * 7919 % {SPAN_S}) * 1000 AS ts_ms
        FROM customer""",
    "user_sup_msg": f"""
        SELECT c_custkey AS uid, CAST(150 + c_custkey % 50 AS INTEGER) AS height, 'cm' AS unit_height,
               CAST(45 + c_custkey % 60 AS INTEGER) AS weight, 'kg' AS unit_weight,
               {EPOCH_2024_MS} + (c_custkey * 7919 % {SPAN_S}) * 1000 + (c_custkey % 7 - 3) * {HALF_DAY_MS} AS ts_ms
        FROM customer""",
    "order_info": f"""
        SELECT o_orderkey AS id, o_custkey AS user_id,
               (CAST(round(o_totalprice * 100) AS BIGINT) // 60) / CAST(100 AS DOUBLE) AS total_amount,
               (CAST(round(o_totalprice * 100) AS BIGINT) // 50) / CAST(100 AS DOUBLE) AS original_total_amount,
               o_orderstatus AS order_status, o_orderpriority AS order_priority,
               CAST(o_orderkey % 30 AS INTEGER) AS province_id,
               {EPOCH_2024_MS} + (o_orderkey * 173 % {SPAN_S}) * 1000 AS create_time,
               {EPOCH_2024_MS} + (o_orderkey * 173 % {SPAN_S}) * 1000 AS ts_ms
        FROM orders""",
    "order_detail": f"""
        SELECT (((l_orderkey * 8 + l_linenumber) * 1000003 + l_partkey) * 1009 + l_suppkey % 1009) * 64 + CAST(l_quantity AS BIGINT) AS id, l_orderkey AS order_id, l_partkey AS sku_id,
               'sku-' || CAST(l_partkey AS VARCHAR) AS sku_name, CAST(l_quantity AS INTEGER) AS sku_num,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS original_cents,
               CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) // 100 AS activity_cents,
               CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_tax * 100) AS BIGINT) // 100 AS coupon_cents,
               {EPOCH_2024_MS} + (l_orderkey * 173 % {SPAN_S}) * 1000
                 + ((l_linenumber * 5) % 7 - 3) * {HALF_DAY_MS} AS ts_ms
        FROM lineitem""",
    "dim_sku": "SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, p_brand AS tm_id, "
               "CAST(p_partkey % 101 AS VARCHAR) AS category3_id FROM part",
    "dim_trademark": "SELECT id, CASE " + " ".join(f"WHEN id LIKE '%{i}' THEN '{n}'" for i, n in enumerate(BRAND_NAMES, 1))
        + " ELSE replace(id, 'Brand#', 'TM-') END AS tm_name FROM (SELECT DISTINCT p_brand AS id FROM part)",
    "dim_category3": "SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, "
                     "CAST(s_nationkey AS VARCHAR) AS category2_id FROM supplier",
    "dim_category2": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, "
                     "CAST(n_regionkey AS VARCHAR) AS category1_id FROM nation",
    "dim_category1": f"SELECT CAST(r_regionkey AS VARCHAR) AS id, {CATEGORY1_SQL} AS name FROM region",
    "category_compare_dic": "SELECT CAST(r_regionkey AS INTEGER) AS id, " + CATEGORY1_SQL + " AS category_name, "
        "(" + repr(SEARCH_CATEGORY_BY_REGION).replace('"', "'") + ")[r_regionkey % 6 + 1] AS search_category FROM region "
        "UNION ALL SELECT CAST(r_regionkey + 100 AS INTEGER) AS id, " + CATEGORY1_SQL + " AS category_name, "
        "(" + repr(SEARCH_CATEGORY_BY_REGION).replace('"', "'") + ")[(r_regionkey + 1) % 6 + 1] AS search_category FROM region",
    "base_dic": "SELECT substr(p, 1, 1) AS dic_code, p AS dic_name FROM (SELECT DISTINCT o_orderpriority AS p FROM orders)",
    # flattened page log: the columns the jobs read out of each record
    "page_log": f"""
        SELECT event_id AS seq, epoch_us(ts) // 1000 AS ts, event_id % 53 <> 0 AS has_common,
               CASE WHEN user_id % 37 = 5 THEN NULL WHEN user_id % 41 = 7 THEN ''
                    ELSE CAST(user_id AS VARCHAR) END AS uid,
               (['iOS 17', 'Android 13', 'HarmonyOS 4'])[CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1] AS os,
               {_sql_case('event_type', BY_EVENT, 0)} AS ch, {_sql_case('event_type', BY_EVENT, 1)} AS md,
               {_sql_case('event_type', BY_EVENT, 2)} AS ba, CAST(user_id % 10 AS VARCHAR) AS ar,
               'v2.' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 4 AS VARCHAR) AS vc,
               CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
               {_sql_case('event_type', BY_EVENT, 3)} AS page_id,
               CAST(round(value * 100) AS BIGINT) * 10 AS during_time,
               's' || CAST(event_id // 10 AS VARCHAR) AS sid,
               CASE WHEN event_type = 'view' THEN
                      CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 < 4
                           THEN 'Supplier#' || lpad(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 AS VARCHAR), 9, '0')
                           WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 6 = 4 THEN '{SEARCH_TERMS_EXTRA[0]}'
                           ELSE '{SEARCH_TERMS_EXTRA[1]}' END
                    WHEN event_type = 'purchase' THEN json_extract_string(props, '$.k') END AS item,
               CASE WHEN event_type = 'view' THEN 'keyword' WHEN event_type = 'purchase' THEN 'sku_id' END AS item_type
        FROM events""",
}


# ---- change records ------------------------------------------------------------
CDC_TABLES = ["user_info", "user_info_sup_msg", "order_info", "order_detail"]
BAD_EVERY = 97   # customers c % 97 == 0 also send one truncated (malformed) record
HOUR_MS = 3_600_000


def change_log(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Snapshot change records (op 'r') of the four source tables, and a
    delete for every 61st user (no ``after``)."""
    from portrait.sources.cdc import to_change_records, to_delete_records
    gone = to_delete_records(user_info(customer).where("id % 61 = 0"), "user_info", "id")
    return (gone.unionByName(to_change_records(user_info(customer), "user_info"))
            .unionByName(to_change_records(user_sup_msg(customer), "user_info_sup_msg"))
            .unionByName(to_change_records(order_info(orders), "order_info"))
            .unionByName(to_change_records(order_detail(lineitem), "order_detail")))


def change_log_text(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The same records as JSON text (``value``), plus broken ones: cut off,
    with a text for ``ts_ms``, with a text for ``after``, without ``after``."""
    from portrait.sources.cdc import to_json_value
    k = F.col("c_custkey")
    head = F.concat(F.lit('{"op":"r","source":{"db":"shop","table":"user_info"},"ts_ms":'), k.cast("string"))
    bad = customer.filter(k % BAD_EVERY == 0).select(
        F.when(k % 4 == 0, F.concat(F.lit('{"op":"r","after":{"id":"'), k.cast("string")))
        .when(k % 4 == 1, F.lit('{"op":"r","source":{"db":"shop","table":"user_info"},"ts_ms":"x","after":{"id":"1"}}'))
        .when(k % 4 == 2, F.concat(head, F.lit(',"after":"oops"}'))).otherwise(F.concat(head, F.lit("}"))).alias("value"))
    return to_json_value(change_log(customer, orders, lineitem)).unionByName(bad)


ORDER_CHANGE_COLS = ["id", "user_id", "order_status", "total_amount", "consignee", "province_id"]


def order_change_history(orders: DataFrame) -> DataFrame:
    """Envelopes of order_info over time: create; for id % 3 == 0 an update
    (status '1002', consignee empty = no change); for id % 10 == 3 a delete;
    for id % 20 == 3 a re-insert with only id, user_id and status 'R'; for
    id % 20 == 7 a delete and a re-insert, for id % 15 == 4 two updates, in
    one millisecond; and for id % 7 == 0 the create delivered twice.  One scan: every order
    yields an array of its versions, exploded."""
    from portrait.sources.cdc import ENVELOPE, as_string_map
    o = order_info(orders).select(
        "id", "user_id", "order_status", F.col("total_amount").cast("string").alias("total_amount"),
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("consignee"),
        F.col("province_id").cast("string").alias("province_id"), "ts_ms")
    none = F.lit(None).cast(ENVELOPE["before"].dataType)
    full = as_string_map(ORDER_CHANGE_COLS)
    ts, k = F.col("ts_ms"), F.col("id")

    def version(pos, op, before, after, t):
        src = F.struct(F.lit("shop").alias("db"), F.lit("order_info").alias("table"), F.lit(pos).cast("long").alias("pos"))
        return F.struct(F.lit(op).alias("op"), before.alias("before"), after.alias("after"),
                        src.alias("source"), t.alias("ts_ms"))

    def only(status, consignee=None):
        some = [F.lit("id"), k.cast("string"), F.lit("user_id"), F.col("user_id").cast("string"), F.lit("order_status"), F.lit(status)]
        return F.create_map(*some, *([F.lit("consignee"), F.lit(consignee)] if consignee else []))

    upd_after = F.map_concat(F.map_filter(full, lambda key, v: ~key.isin("order_status", "consignee")),
                             F.create_map(F.lit("order_status"), F.lit("1002"), F.lit("consignee"), F.lit("")))
    create = version(1, "c", none, full, ts)
    versions = F.array(
        create,
        F.when(k % 3 == 0, version(2, "u", full, upd_after, ts + HOUR_MS)),
        F.when(k % 10 == 3, version(3, "d", full, none, ts + 2 * HOUR_MS)),
        F.when(k % 20 == 3, version(4, "c", none, only("R"), ts + 3 * HOUR_MS)),
        # one millisecond: delete then insert again, and two updates
        F.when(k % 20 == 7, version(5, "d", full, none, ts + 4 * HOUR_MS)),
        F.when(k % 20 == 7, version(6, "c", none, only("Q"), ts + 4 * HOUR_MS)),
        F.when(k % 15 == 4, version(7, "u", full, only("zzz", "zzz"), ts + 5 * HOUR_MS)),
        F.when(k % 15 == 4, version(8, "u", full, only("aaa", "aaa"), ts + 5 * HOUR_MS)),
        F.when(k % 7 == 0, create))
    return (o.select(F.explode(versions).alias("_v")).filter(F.col("_v").isNotNull())
            .select("_v.op", "_v.before", "_v.after", "_v.source", "_v.ts_ms"))


ROUTING_CONFIG = [  # source_table, source_type, sink_table, sink_columns, sink_row_key, op
    ("user_info", "cdc", "dim_user", "id,name,gender,user_level", "id", "r,d"),
    ("order_info", None, "dim_order", "id,user_id,order_status", "id", None),
    ("user_info_sup_msg", "cdc", "dim_user_body", "uid,height,weight", "uid", "c,r"),
    ("order_detail", "cdc", "dim_line", "id,sku_id", "id", "u"),
    ("order_info", "file", "dim_never", "id", "id", None),
]
