"""Stateful stream operators: keyed running profile (T1), exact dedup
(A1), last row per window (A4), watermark options (T2/T3).

T1 keeps, per uid, the page count and the distinct values of five fields in
keyed state (``transformWithStateInPandas``, RocksDB state store) and emits
one row per input row, like the original keyed process function.  Rows of one
micro-batch are processed in (ts, seq) order; rows arriving in later batches are
taken in arrival order (the original's semantics).

A state key is a bucket of uids, not a uid: a call into Python and a read and a
write of state cost the same for one uid as for a few hundred.
"""

from __future__ import annotations

import json
from bisect import insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from portrait.operators.profile import SET_FIELDS

# The processor runs in Python workers that need not have this package on
# their path (a cluster ships only what the job names): pickle this
# module's classes and functions by value instead of by import path.
try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

FIELDS = SET_FIELDS + ["search_item"]
PROFILE_OUT = ("uid string, ts bigint, seq bigint, pv bigint, os string, ch string, md string, "
               "ba string, search_item string")


#: Buckets of keys that share a state entry.  Part of the state's layout: fixed
#: for the life of a checkpoint.  An entry grows with the number of keys (for
#: 40 million uids 10,000 in each), so a larger job takes more buckets.
STATE_BUCKETS = 4096


def bucketed(rows: DataFrame, key: str, *also: str, buckets: int = STATE_BUCKETS) -> GroupedData:
    """``rows`` grouped by the hash bucket of ``key`` (and by ``also``)."""
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).groupBy(*also, "_bucket")


class RunningProfile(StatefulProcessor):
    """Per uid of a bucket: page count and values; one output row per input
    row.  A row stands for one record, or with ``windows`` for the ``n`` records
    and the values (arrays) of a closed window.  With ``slices`` the key is
    (slice, bucket) and the values come out as arrays, to be added to others.
    State: ``{uid: [pv, values of each field]}`` as JSON."""

    def __init__(self, windows: bool = False, slices: bool = False):
        self.windows, self.slices = windows, slices

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.users = handle.getValueState("users", "users string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        order = ["window_start", "ts", "seq"] if self.windows else ["ts", "seq"]
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(order, kind="stable")
        users = json.loads(self.users.get()[0]) if self.users.exists() else {}

        def show(x: list) -> list | str:
            return [v for _, v in x] if self.slices else ",".join(v for _, v in x)

        met = {}  # uid -> count, values sorted by bytes, the same as sets, as shown
        uids, out, pvs = pdf["uid"].tolist(), {f: [] for f in FIELDS}, []
        counts = pdf["n"].tolist() if self.windows else [1] * len(pdf)
        for uid, n, *values in zip(uids, counts, *(pdf[f].tolist() for f in FIELDS)):
            if uid not in met:
                pv, *had = users.get(uid) or [0, *([] for _ in FIELDS)]
                sets = [sorted((v.encode("utf-8"), v) for v in x) for x in had]
                met[uid] = [pv, sets, [set(x) for x in had], [show(x) for x in sets]]
            user = met[uid]
            user[0] += int(n)
            pvs.append(user[0])
            _, sets, known, text = user
            for j, f in enumerate(FIELDS):
                for v in (values[j] if self.windows else (values[j],)):
                    if v is not None and v == v and v not in known[j]:  # null / NaN is no value
                        known[j].add(v)
                        insort(sets[j], (v.encode("utf-8"), v))
                        text[j] = show(sets[j])
                out[f].append(text[j])
        for uid, (pv, sets, *_) in met.items():
            users[uid] = [pv, *([v for _, v in x] for x in sets)]
        self.users.update((json.dumps(users, ensure_ascii=False, separators=(",", ":")),))
        first = {"uid": uids} | ({"slice": [key[0]] * len(pdf)} if self.slices else {}) | {c: pdf[c].tolist() for c in order}
        yield pd.DataFrame(first | {"pv": pvs} | out)

    def close(self) -> None:
        pass


def running_profile_stream(flat: DataFrame) -> DataFrame:
    """T1 over a flattened, de-duplicated page-log stream.  Start it with
    ``sinks.run_stream``, which keeps state in RocksDB as this needs."""
    base = flat.select("uid", "ts", "seq", *[F.col(f"deviceInfo.{f}").alias(f) for f in SET_FIELDS],
                       "search_item")
    return bucketed(base, "uid").transformWithStateInPandas(
        RunningProfile(), PROFILE_OUT, "append", "None")


def slice_profile_stream(flat: DataFrame, slice_ms: int = 3_600_000, buckets: int = 256) -> DataFrame:
    """T1 for a hot uid: state is keyed by (slice of event time, bucket of
    uids), so a uid's records are spread over as many tasks as there are slices
    in a micro-batch, and none holds all of a uid's values.  A row's count and
    values are those of its slice so far; ``with_earlier_slices`` adds the
    others."""
    base = flat.select("uid", F.floor(F.col("ts") / slice_ms).alias("slice"), "ts", "seq", *[F.col(f"deviceInfo.{f}").alias(f) for f in SET_FIELDS], "search_item")
    out = "uid string, slice bigint, ts bigint, seq bigint, pv bigint, " + ", ".join(f"{f} array<string>" for f in FIELDS)
    return bucketed(base, "uid", "slice", buckets=buckets).transformWithStateInPandas(RunningProfile(slices=True), out, "append", "None")


def with_earlier_slices(rows: DataFrame) -> DataFrame:
    """The running profile of each row of ``slice_profile_stream`` (a table):
    what the uid's earlier slices came to is added.  The sum over earlier slices
    runs over one row a slice; rows meet it by (uid, slice), not by uid."""
    last = rows.groupBy("uid", "slice").agg(F.max_by(F.struct("pv", *FIELDS), "pv").alias("_l")).select("uid", "slice", "_l.*")
    earlier = Window.partitionBy("uid").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    none = F.array().cast("array<string>")
    before = last.select("uid", "slice", F.coalesce(F.sum("pv").over(earlier), F.lit(0)).alias("_pv"),
                         *[F.coalesce(F.array_distinct(F.flatten(F.collect_list(F.when(F.size(f) > 0, F.col(f))).over(earlier))), none).alias(f"_{f}") for f in FIELDS])
    return rows.join(before, ["uid", "slice"]).select("uid", "ts", "seq", (F.col("pv") + F.col("_pv")).alias("pv"),
                                                     *[F.array_join(F.array_sort(F.array_union(f, f"_{f}")), ",").alias(f) for f in FIELDS])


def running_windows_stream(closed: DataFrame) -> DataFrame:
    """The running profile at the end of each closed window (``page_log``):
    the state's input is one row a uid and window, whatever their traffic."""
    out = PROFILE_OUT.replace("uid string,", "uid string, window_start bigint,")
    return bucketed(closed.select("uid", "window_start", "ts", "seq", "n", *FIELDS), "uid").transformWithStateInPandas(
        RunningProfile(windows=True), out, "append", "None")


def content_digest(flat: DataFrame, content: list[str]) -> DataFrame:
    """``flat`` with ``_digest``: 32 bytes that stand for the content (SHA-256
    of its JSON, which tells null, text and number apart)."""
    return flat.withColumn("_digest", F.unhex(F.sha2(F.to_json(F.struct(*content)).cast("binary"), 256)))


def dedup_stream(flat: DataFrame, watermark: str | None = None, time_col: str = "event_time") -> DataFrame:
    """A1 on a stream: the first arrival of each distinct record passes.
    State holds a digest of each record, not the record.
    ``watermark=None`` keeps every record's digest for ever, as the original
    kept its text; with a delay, ``dropDuplicatesWithinWatermark`` bounds the
    state (``time_col`` must be a timestamp column)."""
    content = [c for c in flat.columns if c not in ("seq", time_col)]
    rows = content_digest(flat, content)
    if watermark is None:
        return rows.dropDuplicates(["_digest"]).drop("_digest")
    return rows.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def with_event_time(df: DataFrame, ms_col: str = "ts", out: str = "event_time") -> DataFrame:
    """Epoch millis -> an event-time TIMESTAMP column (watermarks need the
    TIMESTAMP type, not TIMESTAMP_NTZ)."""
    return df.withColumn(out, F.timestamp_millis(F.col(ms_col)))


def window_last_stream(profile: DataFrame, size: str = "2 minutes", watermark: str = "0 seconds",
                       time_col: str = "event_time") -> DataFrame:
    """A4 on a stream: per uid and tumbling event-time window, the last row
    (by time, then seq).  Emitted when the watermark passes the window end
    (append); a finite run needs a later row to close its last window."""
    others = [c for c in profile.columns if c not in ("uid", time_col)]
    return (profile.withWatermark(time_col, watermark)
            .groupBy("uid", F.window(time_col, size))
            .agg(F.max_by(F.struct(*others), F.struct("ts", "seq")).alias("_last"))
            .select("uid", F.unix_millis(F.col("window.start")).alias("window_start"), "_last.*"))
