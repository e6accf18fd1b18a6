"""The registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the inventory.  Output columns are aliased to the names
used by the SQL oracle (``portrait.oracle``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.functions import scalars as S
from portrait.operators import joins as J
from portrait.operators import profile as P
from portrait.operators import scoring as SC
from portrait.operators.users import enrich_users
from portrait.plans import age_label as AL
from portrait.plans import page_profile as PP
from portrait.plans import price_preference as PR
from portrait.plans import wide_orders as WO
from portrait.sources import adapters as A
from portrait.sources.tables import Tables

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
HOUR_MS = 3_600_000


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _dbl(*names):
    return [F.col(n).cast("double").alias(n) for n in names]


# ---- shared inputs ------------------------------------------------------------
def dims(t: Tables) -> WO.Dims:
    return WO.Dims(A.dim_sku(t.part), A.dim_trademark(t.part), A.dim_category3(t.supplier),
                   A.dim_category2(t.nation), A.dim_category1(t.region))


def categories(t: Tables) -> DataFrame:
    return PP.category_tree(A.dim_category3(t.supplier), A.dim_category2(t.nation),
                            A.dim_category1(t.region))


def wide(t: Tables) -> DataFrame:
    return WO.wide_orders(A.user_info(t.customer), A.user_sup_msg(t.customer),
                          A.order_detail(t.lineitem), A.order_info(t.orders), dims(t), A.AS_OF)


def pages(spark: SparkSession, t: Tables, mode: str = "as_run") -> DataFrame:
    return PP.page_profile(spark, A.page_log(t.events, replay_every=10), categories(t),
                           A.category_compare_dic(t.region), mode=mode)


# ---- users ------------------------------------------------------------------------
@register
def price_preference(spark, sf):
    t = Tables(spark, sf)
    return PR.price_preference(spark, A.user_info(t.customer), A.order_info(t.orders), A.AS_OF)


@register
def user_enrich(spark, sf):
    u = enrich_users(A.user_info(Tables(spark, sf).customer), A.AS_OF)
    return u.select("id", "birthday", "birth_year", "age", "zodiac_sign", "age_group", "gender",
                    "name", "login_name", "user_level", "create_time", "ts_ms")


@register
def zodiac(spark, sf):
    u = enrich_users(A.user_info(Tables(spark, sf).customer), A.AS_OF)
    return u.groupBy("zodiac_sign", "age_group").agg(F.count(F.lit(1)).alias("n"))


# ---- joins -----------------------------------------------------------------------
@register
def user_body_join(spark, sf):
    t = Tables(spark, sf)
    return WO.user_profile(enrich_users(A.user_info(t.customer), A.AS_OF), A.user_sup_msg(t.customer))


@register
def order_detail_join(spark, sf):
    t = Tables(spark, sf)
    return WO.order_lines(A.order_detail(t.lineitem), A.order_info(t.orders))


@register
def sku_dim_chain(spark, sf):
    t = Tables(spark, sf)
    return WO.sku_dim_chain(WO.order_lines(A.order_detail(t.lineitem), A.order_info(t.orders)), dims(t))


@register
def order_user_join(spark, sf):
    return wide(Tables(spark, sf))


@register
def dim_left_join(spark, sf):
    t = Tables(spark, sf)
    prov = t.nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))
    o = A.order_info(t.orders).select("id", "province_id")
    return J.dim_join(o, prov, "province_id", "id", {"name": "province_name"})


@register
def category_tree(spark, sf):
    return categories(Tables(spark, sf))


@register
def last_name_lookup(spark, sf):
    t = Tables(spark, sf)
    flat = P.flatten_page_log(A.page_log(t.events)).filter(F.col("search_item").isNotNull())
    b3 = J.broadcast_if_small(SC.category_by_b3name(categories(t)))
    return (flat.join(b3, F.col("search_item") == F.col("_b3"), "left")
            .select("seq", "search_item", "b1_category"))


@register
def first_match_lookup(spark, sf):
    t = Tables(spark, sf)
    sc = J.broadcast_if_small(SC.search_category_by_name(A.category_compare_dic(t.region)))
    return (categories(t).join(sc, F.col("b1name") == F.col("_b1"), "left")
            .select("id", "b1name", "searchCategory"))


@register
def dict_lookup(spark, sf):
    t = Tables(spark, sf)
    dic = J.broadcast_if_few(A.base_dic(t.orders))
    o = t.orders.select(F.col("o_orderkey").alias("id"), F.substring("o_orderpriority", 1, 1).alias("dic_code"))
    return o.join(dic, "dic_code", "left").select("id", "dic_code", F.col("info.dic_name").alias("dic_name"))


# ---- page profile ---------------------------------------------------------------
def _flat_cols(df):
    return df.select("seq", "uid", "ts", *[F.col(f"deviceInfo.{c}").alias(c) for c in ["os", "ch", "md", "ba", "ar", "vc"]],
                     "search_item")


@register
def page_flatten(spark, sf):
    return _flat_cols(P.flatten_page_log(A.page_log(Tables(spark, sf).events)))


@register
def page_dedup(spark, sf):
    raw = A.page_log(Tables(spark, sf).events, replay_every=10)
    return _flat_cols(P.dedup_exact(P.flatten_page_log(raw)))


@register
def running_profile(spark, sf):
    return PP.profile_rows(A.page_log(Tables(spark, sf).events, replay_every=10))


@register
def window_last_profile(spark, sf):
    return PP.window_rows(A.page_log(Tables(spark, sf).events, replay_every=10))


@register
def device_score(spark, sf):
    last = PP.window_rows(A.page_log(Tables(spark, sf).events, replay_every=10))
    return SC.device_scores(last, spark).select("uid", "window_start", "os", "judge_os", *_dbl(*SC.DEVICE_COLS))


@register
def search_score(spark, sf):
    t = Tables(spark, sf)
    last = PP.window_rows(A.page_log(t.events, replay_every=10))
    s = SC.search_scores(last, spark, categories(t), A.category_compare_dic(t.region))
    return s.select("uid", "window_start", "search_item", "b1_category", "searchCategory",
                    *_dbl(*SC.SEARCH_COLS))


# ---- window join and labels ------------------------------------------------------
@register
def window_join(spark, sf):
    t = Tables(spark, sf)
    o = wide(t).select("id", "event_ms", (F.col("user_id") / A.USER_DIV).cast("bigint").alias("page_uid"))
    p = pages(spark, t).select("uid", "ts", "pv")
    j = J.window_join(o, p, "page_uid", "uid", "event_ms", "ts", HOUR_MS)
    return j.select("window_start", "key", F.col("result.id").alias("id"),
                    F.col("Log.ts").alias("log_ts"), F.col("Log.pv").alias("log_pv"))


@register
def window_join_minute(spark, sf):
    """J5 with the one-minute window of the original."""
    t = Tables(spark, sf)
    o = wide(t).select("id", "event_ms", (F.col("user_id") / A.USER_DIV).cast("bigint").alias("page_uid"))
    p = pages(spark, t).select("uid", "ts", "pv")
    j = J.window_join(o, p, "page_uid", "uid", "event_ms", "ts", AL.MINUTE_MS)
    return j.select("window_start", "key", F.col("result.id").alias("id"),
                    F.col("Log.ts").alias("log_ts"), F.col("Log.pv").alias("log_pv"))


def _age_label(spark, sf, mode):
    t = Tables(spark, sf)
    uid = F.floor(F.col("user_id") / A.USER_DIV).cast("string")
    tree = categories(t) if mode == "repaired" else None

    def scores(rows):
        rows = SC.device_scores(rows, spark)
        # as run, search scores are neither shown nor added up
        return rows if tree is None else SC.search_scores(rows, spark, tree, A.category_compare_dic(t.region), "search_term")

    log = A.page_log(t.events, replay_every=10)
    return _label_cols(AL.age_label_of_log(spark, wide(t), log, lambda x: PP.window_rows(x, categories=tree), scores, mode, HOUR_MS, result_uid=uid))


def _label_cols(out):
    return out.select(
        "window_start", "key", F.col("result.id").alias("id"), F.col("result.order_id").alias("order_id"),
        F.col("result.age_group").alias("age_group"), F.col("result.price_interval").alias("price_interval"),
        F.col("result.time_period").alias("time_period"), F.col("result.parsed_time").alias("parsed_time"),
        *[F.col(f"result.{c}").cast("double").alias(c) for c in SC.ORDER_SCORE_COLS],
        F.col("Log.ts").alias("log_ts"), F.col("Log.judge_os").alias("judge_os"),
        *_dbl("device", "search", "sum"), "new_ageGroup")


@register
def age_label_as_run(spark, sf):
    return _age_label(spark, sf, "as_run")


@register
def age_label_repaired(spark, sf):
    return _age_label(spark, sf, "repaired")


# ---- scalar groups ------------------------------------------------------------------
@register
def time_period(spark, sf):
    """F7-F9 on create_time text in its three accepted forms plus junk."""
    o = A.order_info(Tables(spark, sf).orders)
    ms = F.col("create_time") + F.col("id") % 1000
    text = (F.when(F.col("id") % 101 == 0, F.lit("garbage"))
            .when(F.col("id") % 3 == 0, ms.cast("string"))
            .when(F.col("id") % 3 == 1, S.ms_to_datetime("create_time", A.ZONE))
            .otherwise(F.date_format(S._local(F.col("create_time"), A.ZONE), "HH:mm:ss")))
    local = S.parse_time_of_day(text, A.ZONE)
    return o.select("id", text.alias("text"), S.iso_local_time(local).alias("parsed_time"),
                    S.day_period(local).alias("time_period"), F.hour(local).alias("hour"))


@register
def date_formats(spark, sf):
    """Epoch ms -> local date / date-time / yyyyMMdd and back."""
    o = A.order_info(Tables(spark, sf).orders)
    dt, d = S.ms_to_datetime("ts_ms", A.ZONE), S.ms_to_date("ts_ms", A.ZONE)
    return o.select("id", "ts_ms", dt.alias("dt"), d.alias("d"), S.ms_to_yyyymmdd("ts_ms", A.ZONE).alias("ymd"),
                    S.datetime_to_ms(dt).alias("back_ms"), S.date_to_ms(d).alias("day_ms"))


# ---- change records ---------------------------------------------------------------
def _changes(spark, sf):
    from portrait.sources import cdc
    t = Tables(spark, sf)
    return cdc.parse_changes(A.change_log_text(t.customer, t.orders, t.lineitem))


@register
def cdc_parse(spark, sf):
    from portrait.sources import cdc
    p = _changes(spark, sf)
    rid = F.coalesce(cdc.field("id", "bigint"), cdc.field("uid", "bigint"), cdc.field("id", "bigint", "before"))
    ok = ~F.col("_bad")
    return p.select(F.when(ok, F.col("source.table")).alias("tbl"), F.when(ok, F.col("op")).alias("op"),
                    F.when(ok, F.col("ts_ms")).alias("ts_ms"),
                    F.when(~F.col("_bad"), rid).alias("id"),
                    F.when(~F.col("_bad"), F.size("after")).alias("n_fields"), F.col("_bad").alias("is_bad"))


@register
def cdc_route(spark, sf):
    """One parse of the log feeds the four projections (a record
    takes the branch of its table; deletes make no row)."""
    from portrait.sources import cdc
    ch = cdc.rows_after(cdc.good(_changes(spark, sf)))
    tbl = F.col("source.table")
    age = S.birthday_fields(cdc.field("birthday"), A.AS_OF)["age"]
    return ch.select(
        tbl.alias("tbl"),
        F.when(tbl == "user_info_sup_msg", cdc.field("uid", "bigint")).otherwise(cdc.field("id", "bigint")).alias("id"),
        F.when(tbl == "user_info", S.age_band(age))
        .when(tbl == "user_info_sup_msg", cdc.field("height", "int").cast("string"))
        .when(tbl == "order_info", S.price_band(cdc.field("total_amount", "double")))
        .when(tbl == "order_detail", cdc.field("sku_num", "int").cast("string")).alias("v"))


@register
def cdc_snapshot(spark, sf):
    from portrait.sources import cdc
    hist = A.order_change_history(Tables(spark, sf).orders)
    snap = cdc.apply_changes(hist, "id", A.ORDER_CHANGE_COLS)
    return snap.select(F.col("id").cast("bigint").alias("id"), *[c for c in A.ORDER_CHANGE_COLS if c != "id"])


@register
def dim_routing(spark, sf):
    from portrait.functions.weights import const_frame
    from portrait.sources import cdc
    from pyspark.sql import types as T
    cfg = const_frame(spark, A.ROUTING_CONFIG, T._parse_datatype_string(cdc.CONFIG_SCHEMA))
    t = Tables(spark, sf)
    routed = cdc.route_by_config(A.change_log(t.customer, t.orders, t.lineitem), cfg, source_type="cdc")
    return routed.select("topic", "row_key", cdc.canonical_fields().alias("fields"), "op")


@register
def camel_columns(spark, sf):
    from portrait.sources import cdc
    return cdc.camel_columns(user_enrich(spark, sf))


@register
def bean_json(spark, sf):
    from portrait.sources import cdc
    m = metric_province(spark, sf).withColumn("order_amount", F.col("order_amount").cast("decimal(18,2)"))
    m = m.select(F.col("stt"), F.col("edt"), F.col("cur_date").alias("curDate"),
                 F.col("province_id").alias("provinceId"), F.col("province_name").alias("provinceName"),
                 F.col("order_count").alias("orderCount"), F.col("order_amount").alias("orderAmount"),
                 F.col("stt").alias("ts"))
    return cdc.bean_json(m, hidden=["ts"])


@register
def sql_template(spark, sf):
    """S8 + S10 + P12 + U9: change records and the dictionary as SQL views."""
    from portrait.sources import cdc
    t = Tables(spark, sf)
    # et = event time from ts_ms read as milliseconds (the original's
    # precision-0 conversion read them as seconds); pt = processing time
    (cdc.good(_changes(spark, sf)).withColumn("et", F.timestamp_millis("ts_ms"))
     .withColumn("pt", F.current_timestamp()).createOrReplaceTempView("topic_db"))
    J.broadcast_if_few(A.base_dic(t.orders)).createOrReplaceTempView("base_dic")
    return spark.sql("""
        SELECT try_cast(after['id'] AS BIGINT) AS id, after['order_status'] AS order_status,
               d.info.dic_name AS dic_name, unix_millis(et) AS et_ms
        FROM topic_db t LEFT JOIN base_dic d ON substr(t.after['order_priority'], 1, 1) = d.dic_code
        WHERE t.source.table = 'order_info'""")


# ---- metrics --------------------------------------------------------------------
from portrait.operators import metrics as M  # noqa: E402


@register
def metric_traffic(spark, sf):
    return M.traffic(A.page_log(Tables(spark, sf).events))


@register
def metric_home_detail(spark, sf):
    return M.home_detail(A.page_log(Tables(spark, sf).events))


@register
def metric_login(spark, sf):
    return M.login(A.page_log(Tables(spark, sf).events), back_days=3)


@register
def metric_cart(spark, sf):
    return M.cart_add(A.page_log(Tables(spark, sf).events))


@register
def metric_payment(spark, sf):
    return M.payment(A.order_info(Tables(spark, sf).orders))


def _provinces(t):
    return t.nation.select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))


@register
def metric_province(spark, sf):
    t = Tables(spark, sf)
    return M.province(A.order_info(t.orders), _provinces(t))


@register
def metric_sku(spark, sf):
    t = Tables(spark, sf)
    return M.sku(A.order_detail_log(t.lineitem), dims(t))


# ---- streams (file source -> stateful/joins -> sink, drained with availableNow) ----
def _stream(spark, df, name, slice_col, n_slices=3, files=4):
    from portrait.session import scratch_path
    from portrait.streaming.sources import read_stream, stage_slices
    path = scratch_path(spark, f"stage-{name}")
    per = stage_slices(df, path, slice_col, n_slices, files)
    return read_stream(spark, "files", path=path, schema=df.schema, max_files_per_trigger=per)


def _topic(spark, df, name, **kw):
    """Drain a stream into a folder, the topic of the next one."""
    from portrait.session import scratch_path
    from portrait.streaming.sinks import run_to_completion
    out, ck = scratch_path(spark, f"out-{name}"), scratch_path(spark, f"ckpt-{name}")
    run_to_completion(df, sink="parquet", path=out, checkpoint=ck, **kw)
    return out


def _drain(spark, df, name, **kw):
    return spark.read.parquet(_topic(spark, df, name, **kw))


@register
def stream_profile(spark, sf):
    """Running profile as keyed state over three micro-batches."""
    from portrait.streaming.stateful import dedup_stream, running_profile_stream
    raw = _stream(spark, A.page_log(Tables(spark, sf).events, replay_every=10), "pagelog", "ts")
    return _drain(spark, running_profile_stream(dedup_stream(P.flatten_page_log(raw))), "profile")


def _profile_stream(spark, sf, name):
    """The page-log job up to the running profile (A1 -> T1 -> A4): records
    de-duplicated within the watermark, 2-minute windows closed by it and
    drained into a topic, which a second stream turns into profiles.  One last
    record far ahead closes the windows of the finite input."""
    from portrait.session import materialize
    from portrait.streaming import page_log as PL
    from portrait.streaming.sources import read_stream
    from portrait.streaming.stateful import running_windows_stream
    log = A.page_log(Tables(spark, sf).events, replay_every=10)
    # in the order of event time, so that no record is behind the watermark
    raw = _stream(spark, log.unionByName(materialize(PL.closing_record(log))), f"{name}-log", "ts")
    closed = PL.closed_windows(raw).where(F.col("uid") != PL.CLOSER)
    return running_windows_stream(read_stream(spark, "files", path=_topic(spark, closed, f"{name}-windows"), schema=closed.schema))


@register
def stream_profile_slices(spark, sf):
    """T1 with each uid spread over slices of event time: keyed state over
    three micro-batches, then the earlier slices added."""
    from portrait.streaming.stateful import dedup_stream, slice_profile_stream, with_earlier_slices
    raw = _stream(spark, A.page_log(Tables(spark, sf).events, replay_every=10), "pagelog-sl", "ts")
    return with_earlier_slices(_drain(spark, slice_profile_stream(dedup_stream(P.flatten_page_log(raw)), slice_ms=24 * HOUR_MS), "profile-slices"))


@register
def stream_page_profile(spark, sf):
    """The page-log job as a stream up to the device score."""
    done = _drain(spark, SC.device_scores(_profile_stream(spark, sf, "page-profile"), spark), "page-profile")
    return done.select("uid", "window_start", "os", "judge_os", *_dbl(*SC.DEVICE_COLS))


@register
def stream_search_score(spark, sf):
    """The page-log job as a stream up to its end, the search score."""
    t = Tables(spark, sf)
    done = _drain(spark, SC.search_scores(_profile_stream(spark, sf, "search"), spark, categories(t), A.category_compare_dic(t.region)), "search")
    return done.select("uid", "window_start", "search_item", "b1_category", "searchCategory", *_dbl(*SC.SEARCH_COLS))


@register
def stream_dedup(spark, sf):
    """A1 on a stream (no watermark: state kept, as in the original)."""
    from portrait.streaming.stateful import dedup_stream
    raw = _stream(spark, A.page_log(Tables(spark, sf).events, replay_every=10), "pagelog-dd", "ts")
    return _drain(spark, _flat_cols(dedup_stream(P.flatten_page_log(raw))), "dedup")


@register
def stream_interval_join(spark, sf):
    """J1 stream-stream interval join, users x body measures."""
    t = Tables(spark, sf)
    users = _stream(spark, A.user_info(t.customer), "users", "ts_ms", 2, 2)
    body = _stream(spark, A.user_sup_msg(t.customer), "body", "ts_ms", 2, 2)
    return _drain(spark, WO.user_profile(enrich_users(users, A.AS_OF), body), "ij")


@register
def stream_upsert(spark, sf):
    """Change records folded into a keyed snapshot batch by batch."""
    from portrait.session import scratch_path
    from portrait.streaming.sinks import read_upsert_snapshot, upsert_stream
    hist = _stream(spark, A.order_change_history(Tables(spark, sf).orders), "orders-cdc", "ts_ms")
    checkpoint = scratch_path(spark, "ckpt-upsert")
    upsert_stream(hist, "id", A.ORDER_CHANGE_COLS, checkpoint, trigger="availableNow").awaitTermination()
    snap = read_upsert_snapshot(spark, checkpoint, "id", A.ORDER_CHANGE_COLS)
    return snap.select(F.col("id").cast("bigint").alias("id"), *[c for c in A.ORDER_CHANGE_COLS if c != "id"])


@register
def stream_topic_sink(spark, sf):
    """S6 + S14: change records routed by config to per-topic folders."""
    from portrait.functions.weights import const_frame
    from portrait.session import scratch_path
    from portrait.sources import cdc
    from portrait.streaming.sinks import topic_sink
    from pyspark.sql import types as T
    t = Tables(spark, sf)
    changes = _stream(spark, A.change_log(t.customer, t.orders, t.lineitem), "changes", "ts_ms", 2, 4)
    cfg = const_frame(spark, A.ROUTING_CONFIG, T._parse_datatype_string(cdc.CONFIG_SCHEMA))
    out = scratch_path(spark, "out-topics")
    q = topic_sink(cdc.route_by_config(changes, cfg, source_type="cdc"), "topic", scratch_path(spark, "ckpt-topics"), path=out,
                   trigger="availableNow")
    q.awaitTermination()
    return spark.read.parquet(out).select("topic", "row_key", cdc.canonical_fields().alias("fields"), "op")


@register
def stream_price_pairs(spark, sf):
    """J4 on streams: every (user, order) pair with a price weight."""
    t = Tables(spark, sf)
    users = enrich_users(_stream(spark, A.user_info(t.customer), "pp-users", "ts_ms", 2, 2), A.AS_OF)
    orders = _stream(spark, A.order_info(t.orders), "pp-orders", "ts_ms", 3, 4)
    pairs = PR.price_pairs(spark, users, orders)
    return _drain(spark, pairs.select("age_group", "price_interval", F.col("weight").cast("double").alias("weight")),
                  "pp")


@register
def stream_wide_orders(spark, sf):
    """J1-J3 and J6 on streams: four change streams, static dimensions."""
    t = Tables(spark, sf)
    users = _stream(spark, A.user_info(t.customer), "w-users", "ts_ms", 2, 2)
    body = _stream(spark, A.user_sup_msg(t.customer), "w-body", "ts_ms", 2, 2)
    detail = _stream(spark, A.order_detail(t.lineitem), "w-detail", "ts_ms", 3, 4)
    info = _stream(spark, A.order_info(t.orders), "w-info", "ts_ms", 3, 4)
    return _drain(spark, WO.wide_orders(users, body, detail, info, dims(t), A.AS_OF), "wide")


def _wide_stream(spark, t, name):
    """J1-J3 and J6 as a chain of streams with watermarks on every join."""
    from portrait.streaming import wide_orders as SW
    from portrait.streaming.sources import read_stream

    def arriving(df, of, n, files):
        return _stream(spark, df, f"{name}-{of}", "ts_ms", n, files)

    def topic(df, of):
        return read_stream(spark, "files", path=_topic(spark, df, f"{name}-{of}"), schema=df.schema)

    users = topic(SW.user_topic(arriving(A.user_info(t.customer), "users", 2, 2), arriving(A.user_sup_msg(t.customer), "body", 2, 2), A.AS_OF), "user-topic")
    orders = topic(SW.order_topic(arriving(A.order_detail(t.lineitem), "detail", 3, 4), arriving(A.order_info(t.orders), "info", 3, 4)), "order-topic")
    return SW.wide_topic(orders, users, dims(t))


@register
def stream_wide_watermark(spark, sf):
    return _drain(spark, _wide_stream(spark, Tables(spark, sf), "ww"), "ww-wide")


@register
def stream_label_chain(spark, sf):
    """The three jobs chained by topics, all of them streams: wide orders and
    the page-log job's profiles, window-joined and labelled (as run)."""
    from portrait.streaming.sources import read_stream
    t = Tables(spark, sf)
    wide_rows = _wide_stream(spark, t, "lc").withColumn("_page_uid", F.floor(F.col("user_id") / A.USER_DIV).cast("string"))
    profiles = SC.device_scores(_profile_stream(spark, sf, "lc"), spark)
    ws, ps = (read_stream(spark, "files", path=_topic(spark, df, f"lc-{of}"), schema=df.schema) for df, of in ((wide_rows, "wide"), (profiles, "pages")))
    out = AL.age_label(spark, ws, ps, "as_run", HOUR_MS, result_uid=F.col("_page_uid"))
    return _drain(spark, _label_cols(out), "lc-label")


@register
def stream_age_label(spark, sf):
    """The scoring job as a stream over its two input topics: wide order
    rows and page-profile rows (each staged as arriving files), scored,
    window-joined and labelled per micro-batch."""
    from portrait.session import materialize
    t = Tables(spark, sf)
    wide_rows = wide(t).withColumn("_page_uid", F.floor(F.col("user_id") / A.USER_DIV).cast("string"))
    ws = _stream(spark, materialize(wide_rows), "al-wide", "event_ms", 2, 2)
    ps = _stream(spark, materialize(pages(spark, t)), "al-pages", "ts", 2, 2)
    out = AL.age_label(spark, ws, ps, "as_run", HOUR_MS, result_uid=F.col("_page_uid"))
    return _drain(spark, _label_cols(out), "age-label")


@register
def stream_watermark_join(spark, sf):
    """J1 with event-time columns and a watermark on both sides: the join's
    state is evicted once no partner can come (T2)."""
    t = Tables(spark, sf)

    def timed(df, name):
        return df.withColumn(name, F.timestamp_millis("ts_ms")).withWatermark(name, "3 days")

    users = timed(enrich_users(_stream(spark, A.user_info(t.customer), "wm-users", "ts_ms", 2, 2), A.AS_OF), "_ut")
    body = timed(_stream(spark, A.user_sup_msg(t.customer), "wm-body", "ts_ms", 2, 2), "_bt")
    j = J.interval_join(users, body, "id", "uid", "_ut", "_bt", -WO.DAY_MS, WO.DAY_MS, merge="right", time_out="event_time")
    return _drain(spark, j.withColumn("event_ms", F.unix_millis("event_time")).drop("_ut", "_bt", "event_time"), "wm-ij")


def _report(spark, name, df, keys, staged):
    """A metric's stream in update mode, drained; its report as it stands."""
    from portrait.session import scratch_path
    from portrait.streaming import metrics as SM
    from portrait.streaming.sinks import run_to_completion
    out = scratch_path(spark, f"out-{name}")
    run_to_completion(df(staged), sink=SM.report_sink(out), output_mode="update", checkpoint=scratch_path(spark, f"ckpt-{name}"))
    return SM.read_report(spark, out, keys)


def _page_stream(spark, sf, name):
    return _stream(spark, A.page_log(Tables(spark, sf).events), name, "ts")


DAY_KEYS = ["stt", "edt", "cur_date"]


@register
def stream_metric_traffic(spark, sf):
    """M1 on a stream: first-seen flags per day, summed."""
    from portrait.streaming.metrics import traffic_stream
    return _report(spark, "m1", traffic_stream, [*DAY_KEYS, "vc", "ch", "ar", "is_new"], _page_stream(spark, sf, "m1"))


@register
def stream_metric_home_detail(spark, sf):
    """M2 on a stream."""
    from portrait.streaming.metrics import home_detail_stream
    return _report(spark, "m2", home_detail_stream, DAY_KEYS, _page_stream(spark, sf, "m2"))


@register
def stream_metric_cart(spark, sf):
    """M4 on a stream."""
    from portrait.streaming.metrics import cart_add_stream
    return _report(spark, "m4", cart_add_stream, DAY_KEYS, _page_stream(spark, sf, "m4"))


@register
def stream_metric_login(spark, sf):
    """M3 on a stream: the days of each user as state."""
    from portrait.streaming.metrics import day_report, login_deltas
    return day_report(_drain(spark, login_deltas(_page_stream(spark, sf, "m3"), back_days=3), "m3"), "uu_ct", "back_ct")


@register
def stream_metric_payment(spark, sf):
    """M5 on a stream."""
    from portrait.streaming.metrics import day_report, payment_deltas
    orders = _stream(spark, A.order_info(Tables(spark, sf).orders), "m5", "ts_ms")
    return day_report(_drain(spark, payment_deltas(orders), "m5"), "payment_uu_ct", "new_payer_ct")


@register
def stream_metric_sku(spark, sf):
    """M7 on a stream: earlier versions of lines arrive first, their updates
    in a later micro-batch, which takes the old amounts back."""
    from portrait.streaming.metrics import sku_deltas, sku_report
    t = Tables(spark, sf)
    lines = _stream(spark, A.order_detail_log(t.lineitem), "m7", "pos", 2)
    return sku_report(_drain(spark, sku_deltas(lines), "m7"), dims(t))


def _orders_stream(spark, t, name):
    return _stream(spark, A.order_info(t.orders).select("id", "user_id", "total_amount", "province_id"), name, "id", 2, 2)


@register
def stream_olap_sink(spark, sf):
    """Micro-batches as JSON lines, one folder per batch."""
    from portrait.session import scratch_path
    from portrait.streaming.sinks import olap_sink, run_to_completion
    out = scratch_path(spark, "out-olap")
    orders = _orders_stream(spark, Tables(spark, sf), "olap")
    run_to_completion(orders, sink=olap_sink(out), checkpoint=scratch_path(spark, "ckpt-olap"))
    return spark.read.schema(orders.schema).json(out).select("id", "user_id", "total_amount")


@register
def stream_text_sink(spark, sf):
    """One JSON text line per row."""
    from portrait.session import scratch_path
    from portrait.streaming.sinks import text_sink
    out = scratch_path(spark, "out-text")
    orders = _orders_stream(spark, Tables(spark, sf), "text")
    text_sink(orders, out, scratch_path(spark, "ckpt-text"), trigger="availableNow").awaitTermination()
    row = F.from_json("value", orders.schema)
    return spark.read.text(out).select(row.alias("r")).select("r.id", "r.user_id", "r.total_amount")


@register
def stream_memory_sink(spark, sf):
    """S15 with the sink that tests read: orders by province, complete mode
    (the table is small: a row for each province)."""
    from portrait.session import scratch_path
    from portrait.streaming.sinks import run_to_completion
    counts = _orders_stream(spark, Tables(spark, sf), "memory").groupBy("province_id").agg(F.count("*").alias("n"))
    run_to_completion(counts, sink="memory", query_name="orders_by_province", output_mode="complete", checkpoint=scratch_path(spark, "ckpt-memory"))
    return spark.table("orders_by_province")


@register
def stream_dim_enrich(spark, sf):
    """Each micro-batch meets the current snapshot of a
    dimension that is loaded again when older than its time to live."""
    from portrait.operators.dims import DimSpec, RefreshingDim, enrich_batches
    from portrait.session import scratch_path
    from portrait.streaming.sinks import olap_sink, run_to_completion
    t = Tables(spark, sf)
    out = scratch_path(spark, "out-dims")
    provinces = RefreshingDim(lambda s: _provinces(Tables(s, sf)), ttl_seconds=3600)  # loaded by the first batch, used again by the next
    sink = enrich_batches([DimSpec("province", "province_id", {"name": "province_name"})], {"province": provinces}, olap_sink(out, "parquet"))
    run_to_completion(_orders_stream(spark, t, "dims"), sink=sink, checkpoint=scratch_path(spark, "ckpt-dims"))
    return spark.read.parquet(out).select("id", "province_id", "province_name")


@register
def stream_snapshot_log(spark, sf):
    """A table and its change log as one source.  The snapshot is read in
    key ranges; the stream then stops and starts again twice, and goes on in
    the log from its offset.  The database is DuckDB over the given file."""
    from portrait.session import scratch_path
    from portrait.sources.change_table import change_table
    from portrait.streaming.sinks import read_upsert_snapshot, upsert_stream
    orders, columns = f"read_parquet('{sf}/orders.parquet')", ["id", "status", "user_id"]
    table = f"(SELECT o_orderkey AS id, o_orderstatus AS status, o_custkey AS user_id FROM {orders})"
    log = (f"(SELECT o_orderkey * 2 AS pos, 'u' AS op, o_orderkey * 2 AS ts_ms, o_orderkey AS id, 'Z' AS status, o_custkey AS user_id FROM {orders} WHERE o_orderkey % 10 = 0 "
           f"UNION ALL SELECT o_orderkey * 2 + 1, 'd', o_orderkey * 2 + 1, o_orderkey, NULL, NULL FROM {orders} WHERE o_orderkey % 25 = 0)")

    def connect():
        import duckdb
        return duckdb.connect()

    checkpoint = scratch_path(spark, "ckpt-snapshot-log")
    for upto in ("0", f"(SELECT MAX(o_orderkey) FROM {orders})", "9223372036854775807"):  # the log as far as it has come
        source = change_table("orders_with_log", connect, table, "id", columns, log=f"(SELECT * FROM {log} WHERE pos <= {upto})", name="orders", parts=8)
        spark.dataSource.register(source)
        upsert_stream(spark.readStream.format("orders_with_log").load(), "id", columns, checkpoint, trigger="availableNow").awaitTermination()
    return read_upsert_snapshot(spark, checkpoint, "id", columns).select(F.col("id").cast("bigint").alias("id"), "status", F.col("user_id").cast("bigint").alias("user_id"))


@register
def query_rows(spark, sf):
    """A query's rows, its labels in camel case (the reader is any
    DataFrame here; with a database it is the JDBC source)."""
    from portrait.sources import jdbc
    t = Tables(spark, sf)

    def reader():
        t.nation.createOrReplaceTempView("query_rows_nation")
        return spark.sql("SELECT CAST(n_nationkey AS STRING) AS dim_id, n_name AS dim_name, n_regionkey AS parent_id FROM query_rows_nation")

    return jdbc.read_query(spark, "", "", reader=reader, underline_to_camel=True)
