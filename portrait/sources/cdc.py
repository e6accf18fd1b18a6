"""Change records.

A change record is ``{op, before, after, source{db, table, pos}, ts_ms}`` with
``before``/``after`` as string maps (values arrive as text) and ``pos`` the
position in the log: changes of one millisecond are ordered by it.  Parsing
is one ``from_json`` with a fixed schema; malformed text, fields of a wrong
type and records without a required field go to a quarantine instead of
failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portrait.functions.scalars import price_band, snake_to_camel
from portrait.operators.joins import broadcast_if_small

ENVELOPE = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("before", T.MapType(T.StringType(), T.StringType())),
    T.StructField("after", T.MapType(T.StringType(), T.StringType())),
    T.StructField("source", T.StructType([T.StructField("db", T.StringType()),
                                          T.StructField("table", T.StringType()),
                                          T.StructField("pos", T.LongType())])),
    T.StructField("ts_ms", T.LongType()),
])
CORRUPT = "_corrupt"


def as_string_map(cols: Sequence[str]) -> Column:
    """Columns -> map<string,string> (values as text, nulls kept)."""
    parts = []
    for c in cols:
        parts += [F.lit(c), F.col(c).cast("string")]
    return F.create_map(*parts)


def to_change_records(df: DataFrame, table: str, op: str | Column = "r", ts_col: str = "ts_ms",
                      db: str = "shop", cols: Sequence[str] | None = None,
                      pos: Column | None = None) -> DataFrame:
    """Rows -> envelope struct columns (``op``, ``after``, ``source``, ``ts_ms``).
    Snapshot reads use ``op='r'`` (S4 re-aimed: any DataFrame source, e.g.
    ``spark.read.jdbc`` with partitioning, becomes an initial snapshot)."""
    cols = list(cols or [c for c in df.columns if c != ts_col])
    opc = F.lit(op) if isinstance(op, str) else op
    return df.select(opc.alias("op"), F.lit(None).cast(ENVELOPE["before"].dataType).alias("before"),
                     as_string_map(cols).alias("after"),
                     _source(db, table, pos).alias("source"), F.col(ts_col).cast("long").alias("ts_ms"))


def _source(db: str, table: str, pos: Column | None = None) -> Column:
    return F.struct(F.lit(db).alias("db"), F.lit(table).alias("table"),
                    (F.lit(0) if pos is None else pos).cast("long").alias("pos"))


def to_delete_records(df: DataFrame, table: str, key: str, ts_col: str = "ts_ms", db: str = "shop",
                      pos: Column | None = None) -> DataFrame:
    """Rows -> delete envelopes: the key in ``before``, no ``after``."""
    return df.select(F.lit("d").alias("op"), as_string_map([key]).alias("before"),
                     F.lit(None).cast(ENVELOPE["after"].dataType).alias("after"),
                     _source(db, table, pos).alias("source"), F.col(ts_col).cast("long").alias("ts_ms"))


def to_json_value(envelopes: DataFrame) -> DataFrame:
    """Envelope columns -> one JSON text column ``value`` (the wire format)."""
    return envelopes.select(F.to_json(F.struct(*envelopes.columns)).alias("value"))


def parse_changes(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """S2 + S3: text -> envelope columns plus ``_bad``: not JSON, a field of
    a wrong type (the parser marks both), or without ``op``, table, ``ts_ms``
    or -- unless it is a delete -- ``after``.  Null input is bad."""
    schema = T.StructType([*ENVELOPE.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("_raw", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # a generated row, so that no filter on the parsed fields parses the text again for each of them
    out = raw.select(F.col(value_col).cast("string").alias("_raw")).select("_raw", F.explode(F.array(parsed)).alias("_e"))
    e = lambda name: F.col(f"_e.{name}")
    bad = (F.col("_e").isNull() | e(CORRUPT).isNotNull() | e("op").isNull() | e("source.table").isNull()
           | e("ts_ms").isNull() | ((e("op") != "d") & e("after").isNull()))
    return out.select(*[e(f.name).alias(f.name) for f in ENVELOPE.fields], "_raw", bad.alias("_bad"))


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("_bad")).drop("_raw", "_bad")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("_bad")).select("_raw")


def route(changes: DataFrame, table: str) -> DataFrame:
    """Records of one source table (one scan can feed several routes)."""
    return changes.filter(F.col("source.table") == table)


def field(name: str, dtype: str = "string", m: str = "after") -> Column:
    """typed read of one field of the record (try-cast, absent -> null)."""
    v = F.try_element_at(F.col(m), F.lit(name))
    return v if dtype == "string" else v.try_cast(dtype)


def rows_after(changes: DataFrame) -> DataFrame:
    """Records that leave a row: deletes (no ``after``) make none."""
    return changes.filter(F.col("after").isNotNull())


# ---- P2-P5: typed projections of the four routed streams -------------------
def project_user(changes: DataFrame) -> DataFrame:
    """P2 input: the user_info fields, birthday still raw epoch-day text."""
    return rows_after(changes).select(
        field("id", "bigint").alias("id"), field("login_name").alias("login_name"),
        field("name").alias("name"), field("gender").alias("gender"),
        field("birthday").alias("birthday"), field("user_level", "int").alias("user_level"),
        field("create_time").alias("create_time"), F.col("ts_ms"))


def project_body(changes: DataFrame) -> DataFrame:
    """P3."""
    return rows_after(changes).select(
        field("uid", "bigint").alias("uid"), field("height", "int").alias("height"),
        field("unit_height").alias("unit_height"), field("weight", "int").alias("weight"),
        field("unit_weight").alias("unit_weight"), F.col("ts_ms"))


def project_order_info(changes: DataFrame) -> DataFrame:
    """P5: the order fields; price band only when the amount is present."""
    amount = field("total_amount", "double")
    return rows_after(changes).select(
        field("id", "bigint").alias("id"), field("user_id", "bigint").alias("user_id"),
        amount.alias("total_amount"), field("original_total_amount", "double").alias("original_total_amount"),
        field("create_time", "bigint").alias("create_time"), price_band(amount).alias("price_interval"),
        F.col("ts_ms"))


def project_order_detail(changes: DataFrame) -> DataFrame:
    return rows_after(changes).select(
        field("id", "bigint").alias("id"), field("order_id", "bigint").alias("order_id"),
        field("sku_id", "bigint").alias("sku_id"), field("sku_name").alias("sku_name"),
        field("sku_num", "int").alias("sku_num"), F.col("ts_ms"))


# ---- S13: change application -------------------------------------------------------
ORDER = ("ts_ms", "source.pos")


def change_state(changes: DataFrame, key: str, columns: Sequence[str],
                 order: Sequence[str] = ORDER) -> DataFrame:
    """Fold change records into mergeable per-key state.

    Changes are ordered by time and, within a millisecond, by log position.
    Per column the state is the latest ``(when, gone, value)`` among
    non-empty values *and* deletes (``gone``), so "latest non-empty value
    after the latest delete" is one ``max`` of a struct.  ``_last`` is the
    latest ``(when, gone)``.  ``max`` over structs is associative, so state of
    old data and of new data merge exactly (``merge_change_states``), and
    Spark computes it with a map-side partial aggregation: a key holding a
    third of all records costs one row per task before the shuffle."""
    when = F.struct(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(f"o{i}") for i, c in enumerate(order)]).alias("when")
    k = F.coalesce(field(key, m="after"), field(key, m="before"))
    gone = (F.col("op") == "d").alias("gone")
    aggs = [F.max(F.struct(when, gone)).alias("_last")]
    for c in columns:
        if c == key:
            continue
        v = F.when(~(F.col("op") == "d") & (field(c) != ""), field(c))
        entry = F.struct(when, gone, v.alias("v"))
        aggs.append(F.max(F.when((F.col("op") == "d") | v.isNotNull(), entry)).alias(c))
    return changes.groupBy(k.alias(key)).agg(*aggs)


def merge_change_states(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Exact merge of two change states (snapshot state + a micro-batch)."""
    cols = [c for c in old.columns if c != key]
    return old.unionByName(new).groupBy(key).agg(*[F.max(c).alias(c) for c in cols])


def state_to_snapshot(state: DataFrame, key: str) -> DataFrame:
    """Visible rows: live keys; a column whose latest entry is a delete is null."""
    cols = [c for c in state.columns if c not in (key, "_last")]
    return state.filter(~F.col("_last.gone")).select(key, *[F.col(f"{c}.v").alias(c) for c in cols])


def apply_changes(changes: DataFrame, key: str, columns: Sequence[str],
                  order: Sequence[str] = ORDER) -> DataFrame:
    """Fold a change log into the current snapshot, one row per live key.

    Per column: the latest non-empty value after the key's latest delete
    (an update never clears a column with an empty value; a delete resets
    all columns).  Keys whose latest record is a delete are dropped.
    Replays of a record change nothing (idempotent).  One hash aggregation
    by key (see ``change_state``)."""
    return state_to_snapshot(change_state(changes, key, columns, order), key)


# ---- S14: config-driven routing ------------------------------------------------------
CONFIG_SCHEMA = "source_table string, source_type string, sink_table string, sink_columns string, sink_row_key string, op string"


def route_by_config(changes: DataFrame, config: DataFrame, source_type: str | None = None) -> DataFrame:
    """Each record -> (topic, row_key, after restricted to sink_columns).

    A config row names the source table and the operations (``op``: a comma
    list, null for all) that it routes; with ``source_type`` only the rows of
    that type (or of none) count.  The key of a delete is in ``before``.  The
    config has a handful of rows, joined by broadcast after a size check;
    records that no row routes drop out."""
    if source_type is not None:
        config = config.where(F.col("source_type").isNull() | (F.col("source_type") == source_type))
    cfg = broadcast_if_small(config.select(
        F.col("source_table").alias("_src"), F.col("sink_table").alias("topic"),
        F.split("sink_columns", ",").alias("_cols"), "sink_row_key", F.split("op", ",").alias("_ops")))
    wanted = F.col("_ops").isNull() | F.array_contains("_ops", F.col("op"))
    j = changes.join(cfg, (F.col("source.table") == F.col("_src")) & wanted, "inner")
    kept = F.map_filter("after", lambda k, v: F.array_contains(F.col("_cols"), k))
    row_key = F.coalesce(F.try_element_at(F.col("after"), F.col("sink_row_key")), F.try_element_at(F.col("before"), F.col("sink_row_key")))
    return j.select("topic", row_key.alias("row_key"), kept.alias("fields"), "op", "ts_ms")


def canonical_fields(m: str = "fields") -> Column:
    """A map as sorted ``k=v`` text (stable across engines)."""
    entries = F.transform(F.map_entries(F.col(m)),
                          lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    return F.array_join(F.array_sort(entries), ";")


# ---- S12, S17 --------------------------------------------------------------------------
def camel_columns(df: DataFrame) -> DataFrame:
    """snake_case -> camelCase column names (metadata only)."""
    return df.toDF(*[snake_to_camel(c) for c in df.columns])


def bean_json(df: DataFrame, hidden: Sequence[str] = ()) -> DataFrame:
    """One JSON object per row with snake_case keys; hidden fields
    (not serialised in the original) are left out."""
    keep = [c for c in df.columns if c not in set(hidden)]
    snake = [_camel_to_snake(c) for c in keep]
    return df.select(F.to_json(F.struct(*[F.col(c).alias(s) for c, s in zip(keep, snake)])).alias("json"))


def _camel_to_snake(name: str) -> str:
    out = []
    for ch in name:
        if ch.isupper():
            out += ["_", ch.lower()]
        else:
            out.append(ch)
    return "".join(out).lstrip("_")
