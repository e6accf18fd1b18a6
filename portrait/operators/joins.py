"""Join operators: interval, window, dimension and weight lookups, row merges.

Scale notes
-----------
* ``interval_join`` joins on its key; a hot key is split by AQE's skew-join
  handling.  Where a key can be hot on both sides, ``bucket_ms`` adds a time
  bucket to the key: the sort-merge join then compares only rows of
  neighbouring buckets, and the side named by ``spread`` (choose the smaller)
  goes to every bucket that its interval touches.
* Broadcasts happen only behind ``broadcast_if_small``: the optimizer's
  size estimate of the (already pruned and filtered) side, times
  ``UNPACKED`` for what compressed files hold in memory, is checked against a
  limit; above it the join stays a shuffle join that AQE may still turn into
  a broadcast by the size it sees at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portrait.session import materialize

# Largest side we hint as broadcast (bytes in memory), and how many bytes in
# memory we allow for a byte of the optimizer's (file size) estimate.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
UNPACKED = 8


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan times ``UNPACKED`` (no job is run)."""
    try:
        return UNPACKED * int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # streaming plans, Connect sessions
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``F.broadcast(df)`` only when the estimated size is proven small."""
    if df.isStreaming:
        return df
    size = estimated_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def broadcast_if_few(df: DataFrame, max_rows: int = 100_000, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """For small tables that are derived from large ones (a dictionary out of
    the facts), which the optimizer takes for large: written once, measured,
    and broadcast only if rows and bytes prove them small (bytes: of the rows
    as JSON, times ``UNPACKED``)."""
    df = materialize(df)
    rows, size = df.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if rows <= max_rows and UNPACKED * (size or 0) <= max_bytes else df


def row_preserving_bytes(base: DataFrame, out: DataFrame) -> int | None:
    """Size bound of ``out`` when it has at most one row per row of ``base``
    (e.g. left joins of ``base`` on unique dimension keys): ``base``'s size
    estimate scaled by the ratio of row widths.  Catalyst alone would
    estimate such a join chain as the product of its inputs."""
    b = estimated_bytes(base)
    if b is None:
        return None
    try:
        wb, wo = base._jdf.schema().defaultSize(), out._jdf.schema().defaultSize()
    except Exception:
        return None
    return int(b * max(wo, 1) / max(wb, 1))


def _is_timestamp(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))


def _ms(df: DataFrame, name: str, qual: str | None = None) -> Column:
    c = F.col(f"{qual}.{name}") if qual else F.col(name)
    return F.unix_millis(c.cast("timestamp")) if _is_timestamp(df, name) else c


def interval_join(left: DataFrame, right: DataFrame, left_key: str | Sequence[str],
                  right_key: str | Sequence[str], left_time: str, right_time: str,
                  lower_ms: int, upper_ms: int, how: str = "inner",
                  bucket_ms: int | None = None, spread: str = "right", merge: str | None = None,
                  time_out: str | None = None) -> DataFrame:
    """Rows with equal keys and ``right_time`` in
    ``[left_time + lower_ms, left_time + upper_ms]`` (both bounds inclusive).

    Times are epoch-millis longs or timestamps.  For timestamps the range is
    written with interval arithmetic so a streaming join can evict state by
    watermark.  ``bucket_ms`` (-1: the interval width) adds a time bucket to
    the equi-join key; each row of the ``spread`` side then goes to the buckets
    that its interval touches (at most two of the interval's width).  Output: all left
    columns then all right columns (names must not collide; rename first),
    or with ``merge='left'|'right'`` one key-wise merged row (``putAll``: the
    winner's value on a shared name).  ``time_out`` names an extra column
    holding the later of the two times -- the joined row's event time.
    """
    lk = [left_key] if isinstance(left_key, str) else list(left_key)
    rk = [right_key] if isinstance(right_key, str) else list(right_key)
    width = upper_ms - lower_ms
    if bucket_ms == -1:
        bucket_ms = max(width, 1)
    l, r = left.alias("_l"), right.alias("_r")
    cond = [F.col(f"_l.{a}") == F.col(f"_r.{b}") for a, b in zip(lk, rk)]
    if _is_timestamp(left, left_time) and _is_timestamp(right, right_time):
        lt, rt = F.col(f"_l.{left_time}"), F.col(f"_r.{right_time}")
        cond += [rt >= lt + F.expr(f"INTERVAL {lower_ms / 1000} SECONDS"),
                 rt <= lt + F.expr(f"INTERVAL {upper_ms / 1000} SECONDS")]
    else:
        lt, rt = F.col(f"_l.{left_time}"), F.col(f"_r.{right_time}")
        cond += [rt >= lt + F.lit(lower_ms), rt <= lt + F.lit(upper_ms)]
    if bucket_ms and how == "inner":
        def own(ms):
            return F.floor(ms / F.lit(bucket_ms))

        def touched(ms, lo, hi):
            return F.explode(F.sequence(own(ms + F.lit(lo)), own(ms + F.lit(hi))))

        lms, rms = _ms(left, left_time), _ms(right, right_time)
        if spread == "right":
            l = left.withColumn("_ib", own(lms)).alias("_l")
            r = right.withColumn("_ib", touched(rms, -upper_ms, -lower_ms)).alias("_r")
        else:
            l = left.withColumn("_ib", touched(lms, lower_ms, upper_ms)).alias("_l")
            r = right.withColumn("_ib", own(rms)).alias("_r")
        cond.append(F.col("_l._ib") == F.col("_r._ib"))
    joined = l.join(r, on=_and(cond), how=how)
    if merge:
        out = merge_rows(left.columns, right.columns, merge)
    else:
        out = [F.col(f"_l.{c}") for c in left.columns] + [F.col(f"_r.{c}") for c in right.columns]
    if time_out:
        out.append(F.greatest(F.col(f"_l.{left_time}"), F.col(f"_r.{right_time}")).alias(time_out))
    return joined.select(*out)


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def window_start_ms(df: DataFrame, time_col: str, size_ms: int) -> Column:
    """Start (epoch ms) of the tumbling window holding ``time_col``."""
    if _is_timestamp(df, time_col):
        return F.unix_millis(F.window(F.col(time_col).cast("timestamp"),
                                      f"{size_ms // 1000} seconds").start)
    return F.floor(F.col(time_col) / F.lit(size_ms)) * F.lit(size_ms)


def window_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                left_time: str, right_time: str, size_ms: int,
                left_name: str = "result", right_name: str = "Log") -> DataFrame:
    """Tumbling-window join: equal key (compared as text) and the same
    window; every pair of a (key, window) group is emitted, as in the
    original.  Output: ``window_start`` (epoch ms), key, and the two rows
    nested as structs ``left_name`` / ``right_name``."""
    l = left.select(F.col(left_key).cast("string").alias("_k"),
                    window_start_ms(left, left_time, size_ms).alias("window_start"),
                    F.struct(*left.columns).alias(left_name))
    r = right.select(F.col(right_key).cast("string").alias("_k"),
                     window_start_ms(right, right_time, size_ms).alias("window_start"),
                     F.struct(*right.columns).alias(right_name))
    return l.join(r, on=["_k", "window_start"], how="inner").withColumnRenamed("_k", "key")


#: Buckets of ``hash_filter``: the filter has at most so many rows of 4 bytes.
FILTER_BUCKETS = 1 << 20


def hash_filter(df: DataFrame, key: Column, keys_of: DataFrame, their_key: Column) -> DataFrame:
    """The rows of ``df`` whose key may be among the keys of ``keys_of``, by a
    filter of fixed size: the hash buckets that the keys fall into, broadcast.
    No row with such a key is lost; some others stay by chance, so a join on
    the key has to follow.  Beyond a few million keys it filters little."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BUCKETS)).cast("int")
    held = keys_of.select(bucket(their_key).alias("_bucket")).distinct()
    return df.withColumn("_bucket", bucket(key)).join(F.broadcast(held), "_bucket", "left_semi").drop("_bucket")


def dim_join(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: dict[str, str],
             how: str = "left", max_broadcast_bytes: int = BROADCAST_MAX_BYTES,
             broadcast: bool | None = None) -> DataFrame:
    """Enrich ``df`` from a keyed dimension.

    ``columns`` maps dimension column -> output column; an output column
    that already exists in ``df`` is overwritten (the original's ``put``).
    Only the named dimension columns are read (pruned at the scan); the
    dimension is broadcast only when its estimated size is small.  A miss
    keeps the row with nulls (``how='left'``) or drops it (``'inner'``).
    Keys are compared as text, like the original's string row keys.
    ``broadcast``: a decision the caller has proven (True/False) instead of
    the size check.
    """
    d = dim.select(F.col(dim_key).cast("string").alias("_dk"),
                   *[F.col(src).alias(f"_d_{dst}") for src, dst in columns.items()])
    if broadcast is None:
        d = broadcast_if_small(d, max_broadcast_bytes)
    elif broadcast and not d.isStreaming:
        d = F.broadcast(d)
    j = df.join(d, F.col(key).cast("string") == F.col("_dk"), how)
    for dst in columns.values():
        j = j.withColumn(dst, F.col(f"_d_{dst}"))
    return j.drop("_dk", *[f"_d_{dst}" for dst in columns.values()])


def merge_rows(left_cols: Sequence[str], right_cols: Sequence[str], winner: str,
               lq: str = "_l", rq: str = "_r") -> list[Column]:
    """Key-wise object merge (``putAll``) as a projection list.

    Every name of either side appears once; on a name in both, the winner's
    value is taken even when it is null (a put copies the entry, not only
    non-null values)."""
    win, lose = (lq, rq) if winner == "left" else (rq, lq)
    wcols = left_cols if winner == "left" else right_cols
    lcols = right_cols if winner == "left" else left_cols
    out = [F.col(f"{win}.{c}").alias(c) for c in wcols]
    out += [F.col(f"{lose}.{c}").alias(c) for c in lcols if c not in set(wcols)]
    return out


def lookup_default(df: DataFrame, table: DataFrame, on: Sequence[str], value: str,
                   out: str, default=None) -> DataFrame:
    """Nested weight lookup ``table[k1][k2]``; a miss gives ``default``
    (``None``: the row is dropped, the strict form).  ``table`` is a
    constant of the model, so broadcasting it is size-safe."""
    t = table.select(*on, F.col(value).alias(out))
    if default is None:
        return df.join(F.broadcast(t), list(on), "inner")
    j = df.join(F.broadcast(t), list(on), "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(default).cast(t.schema[out].dataType)))
