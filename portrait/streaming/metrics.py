"""Daily metrics on a stream (M1-M5, M7).

A distinct count over a day becomes a sum: the first record of a visitor (of a
session, of a page's visitor) in a day carries a flag, all others carry none,
so any window's flags add up to the day's count.

* ``first_seen`` keeps one state row per (day, key) in Spark's own
  de-duplication.  The day is a window column with the watermark on it, so a
  day's state goes when the watermark passes the day's end.
* The flags feed plain windowed sums in update mode: the report of a day moves
  while the day goes on.  ``slot_ms`` cuts days into shorter windows whose flags
  still add up to the day.
* ``login_deltas`` (M3) and ``payment_deltas`` (M5) keep the days of each user;
  a day that arrives late changes the flags of its neighbours, as deltas.
  Their state and that of M7 is one entry for each bucket of users or lines
  (``stateful.bucketed``), so Python is called once a bucket.
* ``sku_deltas`` (M7) turns deliveries of order lines into changes of the daily
  sums: a later delivery of a line takes its old amounts back and adds its new
  ones; a delivery older than the one that counts changes nothing.

Skew: state is keyed by (day, group, visitor), never by group alone; the sums
combine partially before their shuffle.  A visitor or a line that sends a third
of all records is one state row.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from portrait.functions.scalars import ms_to_day_text
from portrait.operators.metrics import DAY_MS
from portrait.streaming.stateful import bucketed

try:  # workers need not have the package: see stateful.py
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass


def page_events(raw: DataFrame, watermark: str, slot_ms: int) -> DataFrame:
    """Page records with their ``day`` (a window, the only event-time column)
    and the start of their ``slot`` in it (epoch ms)."""
    c, at = F.col("common"), F.col("_at")
    return (raw.where(c.isNotNull()).withColumn("_at", F.timestamp_millis("ts")).withWatermark("_at", watermark)
            .select(F.window(at, "1 day").alias("day"), (F.floor(F.col("ts") / slot_ms) * slot_ms).alias("slot"),
                    F.coalesce(c.uid, F.lit("-1")).alias("uid"), c.vc.alias("vc"), c.ch.alias("ch"), c.ar.alias("ar"),
                    c.is_new.alias("is_new"), c.sid.alias("sid"), F.col("page.page_id").alias("page_id"),
                    F.col("page.item_type").alias("item_type"), F.col("page.during_time").alias("during_time")))


def first_seen(events: DataFrame, *keys: str) -> DataFrame:
    """The first arrival of each (day, keys); state goes with the day."""
    return events.dropDuplicates(["day", *keys])


def _sums(rows: DataFrame, groups: list[str], sums: list[str], slot_ms: int) -> DataFrame:
    found = rows.groupBy("day", "slot", *groups).agg(*[F.sum(c).alias(c) for c in sums])
    return found.select(F.col("slot").alias("stt"), (F.col("slot") + slot_ms).alias("edt"), ms_to_day_text(F.col("slot")).alias("cur_date"), *groups, *sums)


def traffic_stream(raw: DataFrame, watermark: str = "10 minutes", slot_ms: int = DAY_MS) -> DataFrame:
    """M1: first visitors and sessions of the day, page views and stay per
    version, channel, area and new-user flag."""
    groups, sums = ["vc", "ch", "ar", "is_new"], ["uv_ct", "sv_ct", "pv_ct", "dur_sum"]
    e = page_events(raw, watermark, slot_ms)

    def entry(rows: DataFrame, **given: Column) -> DataFrame:
        none = {"dur_sum": F.lit(None).cast("bigint")}
        return rows.select("day", "slot", *groups, *[({c: F.lit(0).cast("bigint") for c in sums} | none | given)[c].alias(c) for c in sums])

    one = F.lit(1).cast("bigint")
    rows = (entry(e, pv_ct=one, dur_sum=F.col("during_time").cast("bigint"))
            .unionByName(entry(first_seen(e, *groups, "uid"), uv_ct=one))
            .unionByName(entry(first_seen(e.where("sid IS NOT NULL"), *groups, "sid"), sv_ct=one)))
    return _sums(rows, groups, sums, slot_ms)


def home_detail_stream(raw: DataFrame, watermark: str = "10 minutes", slot_ms: int = DAY_MS) -> DataFrame:
    """M2: first visitors of the day of the home and of the goods-detail page."""
    e = page_events(raw, watermark, slot_ms).where("page_id IN ('home', 'good_detail') AND uid <> ''")
    flag = lambda page: (F.col("page_id") == page).cast("bigint")
    rows = first_seen(e, "page_id", "uid").select("day", "slot", flag("home").alias("home_uv_ct"), flag("good_detail").alias("good_detail_uv_ct"))
    return _sums(rows, [], ["home_uv_ct", "good_detail_uv_ct"], slot_ms)


def cart_add_stream(raw: DataFrame, watermark: str = "10 minutes", slot_ms: int = DAY_MS) -> DataFrame:
    """M4: first cart additions of the day, one for each user."""
    e = page_events(raw, watermark, slot_ms).where("item_type = 'sku_id' AND uid <> ''")
    rows = first_seen(e, "uid").select("day", "slot", F.lit(1).cast("bigint").alias("cart_add_uu_ct"))
    return _sums(rows, [], ["cart_add_uu_ct"], slot_ms)


def report_sink(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for update mode: the rows that a batch
    changed go to a folder of their own (a retried batch overwrites it)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_report(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The report as it stands: of each key the row of the latest batch."""
    rows = spark.read.parquet(path)
    others = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return (rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("_r")).select(*keys, *[f"_r.{c}" for c in others]))


# ---- M3, M5 --------------------------------------------------------------------------
DAY_DELTA = "day_ms bigint, users bigint, flagged bigint"


def _user_days(rows: DataFrame, user: str, watermark: str) -> DataFrame:
    """(user, day_ms) of each user's first record of a day, whatever the
    traffic: de-duplicated by Spark's own operator, combined before Python."""
    timed = rows.withColumn("_at", F.timestamp_millis("_ms")).withWatermark("_at", watermark).select(user, F.window("_at", "1 day").alias("day"))
    return timed.dropDuplicates(["day", user]).select(user, F.unix_millis("day.start").alias("day_ms"))


def _neighbours(flag: Callable[[int | None, int], bool]):
    """State function over the days of a bucket's users (JSON, by user): what
    new days change.  ``flag`` says whether a day counts, from the day before
    it (None: the first) and itself."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = json.loads(state.get[0]) if state.exists else {}
        fresh = defaultdict(set)
        for f in frames:
            for user, day in zip(f["_user"].tolist(), f["day_ms"].tolist()):
                fresh[user].add(int(day))
        out = []
        for user, came in fresh.items():
            days = known.setdefault(user, [])
            for day in sorted(came.difference(days)):
                at = bisect_left(days, day)
                before = days[at - 1] if at else None
                out.append((day, 1, int(flag(before, day))))
                if at < len(days):  # the next day has another one before it now
                    out.append((days[at], 0, int(flag(day, days[at])) - int(flag(before, days[at]))))
                days.insert(at, day)
        if out:
            state.update((json.dumps(known, separators=(",", ":")),))
            yield pd.DataFrame(out, columns=["day_ms", "users", "flagged"])

    return run


def _day_deltas(rows: DataFrame, user: str, flag: Callable[[int | None, int], bool], watermark: str) -> DataFrame:
    # as text, told apart from a null user, which counts as one
    days = _user_days(rows, user, watermark).select(F.coalesce(F.concat(F.lit("="), F.col(user).cast("string")), F.lit("")).alias("_user"), "day_ms")
    return bucketed(days, "_user").applyInPandasWithState(_neighbours(flag), DAY_DELTA, "users string", "append", GroupStateTimeout.NoTimeout)


def login_deltas(raw: DataFrame, back_days: int = 8, watermark: str = "10 minutes") -> DataFrame:
    """M3 as changes (day_ms, users, flagged): active users and users who
    return (their active day before is ``back_days`` or more days before)."""
    c = F.col("common")
    rows = raw.where(c.isNotNull()).select(F.coalesce(c.uid, F.lit("-1")).alias("uid"), F.col("ts").alias("_ms")).where("uid <> ''")
    return _day_deltas(rows, "uid", lambda before, day: before is not None and day - before >= back_days * DAY_MS, watermark)


def payment_deltas(orders: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """M5 as changes: payers and first-time payers of the day."""
    return _day_deltas(orders.select("user_id", F.col("ts_ms").alias("_ms")), "user_id", lambda before, day: before is None, watermark)


def day_report(deltas: DataFrame, users: str, flagged: str) -> DataFrame:
    """(stt, edt, cur_date, users, flagged) from the changes so far."""
    from portrait.operators.metrics import day_window
    return (deltas.select(*day_window("day_ms"), "users", "flagged").groupBy("stt", "edt", "cur_date")
            .agg(F.sum("users").alias(users), F.sum("flagged").alias(flagged)).where(F.col(users) > 0))


# ---- M7 ----------------------------------------------------------------------------
CENTS = ["original_cents", "activity_cents", "coupon_cents"]
LINE = ["ts_ms", "pos", "sku_id", *CENTS]
_AMOUNTS_DDL = ", ".join(f"{c} bigint" for c in CENTS)


def retract(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """What a batch's deliveries of a bucket's lines change: the amounts of a
    line as they counted before, negative, and as they count now.  State: the
    delivery that counts of each line (JSON, by id)."""
    lines = json.loads(state.get[0]) if state.exists else {}
    old = {}  # of the lines that change: what counted before the batch
    for f in frames:
        for line, *row in zip(*(f[c].tolist() for c in ("id", *LINE))):
            now = lines.get(line)
            if now is None or row[:2] > now[:2]:
                old.setdefault(line, now)
                lines[line] = row
    if old:
        state.update((json.dumps(lines, separators=(",", ":")),))
        rows = []
        for line, before in old.items():
            now = lines[line]
            rows.append((now[0], *now[2:], 1))
            if before is not None:
                rows.append((before[0], before[2], *[-v for v in before[3:]], -1))
        yield pd.DataFrame(rows, columns=["ts_ms", "sku_id", *CENTS, "n_lines"])


def sku_deltas(lines: DataFrame) -> DataFrame:
    """A stream of deliveries (id, ts_ms, pos, sku_id, amounts in cents) as
    changes of the sums: (ts_ms, sku_id, amounts, n_lines), negative where an
    earlier delivery's amounts are taken back.  State: one entry for each bucket
    of lines, which holds one delivery a line.  Lines are told apart by ``id``,
    and by ``id_turn`` if there is one."""
    pos = F.col("pos") if "pos" in lines.columns else F.lit(0)
    amounts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in CENTS]
    # ids and skus as text, which keeps nulls and long numbers as they are
    line = F.col("id").cast("string")
    if "id_turn" in lines.columns:
        line = F.when(F.col("id_turn") == 0, line).otherwise(F.concat(line, F.lit("+"), F.col("id_turn").cast("string")))
    rows = lines.where("id IS NOT NULL").select(line.alias("id"), F.coalesce("ts_ms", F.lit(0)).cast("bigint").alias("ts_ms"), pos.cast("bigint").alias("pos"),
                                                F.col("sku_id").cast("string").alias("sku_id"), *amounts)
    deltas = bucketed(rows, "id").applyInPandasWithState(
        retract, f"ts_ms bigint, sku_id string, {_AMOUNTS_DDL}, n_lines bigint", "lines string", "append", GroupStateTimeout.NoTimeout)
    return deltas.withColumn("sku_id", F.col("sku_id").cast(lines.schema["sku_id"].dataType))


def sku_report(deltas: DataFrame, dims) -> DataFrame:
    """M7 from the changes so far (they only add up); a day and sku that all
    lines have left is no row.  Dimensions are joined after the sums."""
    from portrait.operators.metrics import day_window
    from portrait.plans.wide_orders import sku_dim_chain
    o, a, c = CENTS
    agg = (deltas.select(*day_window("ts_ms"), "sku_id", *CENTS, "n_lines").groupBy("stt", "edt", "cur_date", "sku_id")
           .agg(*[F.sum(x).alias(x) for x in (*CENTS, "n_lines")]).where("n_lines > 0"))
    return sku_dim_chain(agg.select("stt", "edt", "cur_date", "sku_id", (F.col(o) / 100.0).alias("original_amount"), (F.col(a) / 100.0).alias("activity_amount"),
                                    (F.col(c) / 100.0).alias("coupon_amount"), ((F.col(o) - F.col(a) - F.col(c)) / 100.0).alias("order_amount")), dims)
