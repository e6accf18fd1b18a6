"""Per-user page profile: flatten (P6/P7), exact dedup (A1), running count
and running distinct sets (A2/A3), last row per tumbling window (A4).

Skew: one uid may own a third of all rows (anonymous traffic lands on
``-1``).  ``running_profile`` never sends a whole uid to one task: rows are
windowed per (uid, chunk of rows) and only a one-row-per-chunk summary is
ordered per uid.  ``window_profile``, which the page-log job uses, keeps one
row per (uid, window) and none per record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from portrait.functions.scalars import first_token
from portrait.session import materialize

SET_FIELDS = ["os", "ch", "md", "ba"]
DROPPED_COMMON = ["sid", "mid", "is_new"]


def flatten_page_log(raw: DataFrame) -> DataFrame:
    """P6 + P7.  ``raw``: ``common`` struct, ``page`` struct, ``ts``, ``seq``.

    uid defaults to ``'-1'``; ``deviceInfo`` = common minus sid/mid/is_new
    with ``os`` cut to its first word; ``search_item`` = page.item when
    page.item_type is ``keyword``.  Records without ``common`` (the original
    crashed on them) and with an empty uid are dropped."""
    common = F.col("common")
    device = common.dropFields(*DROPPED_COMMON).withField("os", first_token(common.getField("os")))
    page = F.col("page")
    search = F.when(page.getField("item_type") == "keyword", page.getField("item"))
    return (raw.filter(common.isNotNull())
            .select(F.coalesce(common.getField("uid"), F.lit("-1")).alias("uid"),
                    F.col("ts"), device.alias("deviceInfo"), search.alias("search_item"),
                    F.col("seq"))
            .filter(F.col("uid") != ""))


def dedup_exact(flat: DataFrame) -> DataFrame:
    """A1: drop a record whose full content was seen before for its uid; the
    earliest delivery (lowest ``seq``) is kept.  A hash aggregate with a
    map-side partial step, so heavy duplication collapses before the shuffle."""
    content = [c for c in flat.columns if c != "seq"]
    return flat.groupBy(*content).agg(F.min("seq").alias("seq"))


def _sets_to_text(arr: Column) -> Column:
    return F.array_join(F.array_sort(arr), ",")


def running_profile_window(flat: DataFrame) -> DataFrame:
    """A2 + A3, textbook form: one window per uid.  Reference version for
    tests; a hot uid is processed by a single task here."""
    w = (Window.partitionBy("uid").orderBy("ts", "seq")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cols = [F.col("uid"), F.col("ts"), F.col("seq"), F.count(F.lit(1)).over(w).alias("pv")]
    cols += [_sets_to_text(F.collect_set(F.col("deviceInfo").getField(f)).over(w)).alias(f)
             for f in SET_FIELDS]
    cols.append(_sets_to_text(F.collect_set("search_item").over(w)).alias("search_item"))
    return flat.select(*cols)


def _so_far(new: str, w) -> Column:
    """The non-empty lists of new values up to a row.  A value is new once, so
    a row's list has at most as many entries as the user has values, however
    many windows there are."""
    return F.collect_list(F.when(F.size(new) > 0, F.col(new))).over(w)


def _tag(name: str):
    # one-argument lambda: a second parameter would receive the index
    return lambda v: F.struct(F.lit(name).alias("f"), v.alias("v"))


def _first_seen(fields: list[str]) -> Column:
    """(f, v) of every non-null value among ``fields``, to be exploded."""
    return F.filter(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in fields]), lambda e: e["v"].isNotNull())


def row_chunks(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_chunk``: ranges of (uid, ts, seq) of about as many
    rows each, numbered in that order; written once, as the bounds are
    sampled."""
    return materialize(rows.repartitionByRange("uid", "ts", "seq").withColumn("_chunk", F.spark_partition_id()))


def running_profile(flat: DataFrame) -> DataFrame:
    """A2 + A3 by row: emits per input row the uid's running page count
    ``pv`` and the comma-joined sorted distinct os/ch/md/ba/search_item seen
    so far (order: ts, then seq).

    0. rows are range-partitioned by (uid, ts, seq), so every uid, large or
       small, is cut by rows: a chunk is what one partition holds of a uid.
       The range bounds are sampled, so the rows are written once (checkpoint);
    1. chunk summaries: count and value sets per (uid, chunk), a hash
       aggregate with a map-side partial step;
    2. each distinct (uid, field, value) is kept once, in the chunk where it
       first appears (another partial aggregation);
    3. prefix per uid over its chunk summaries: rows and first-seen values
       of earlier chunks (at most one row per partition and uid);
    4. rows join their chunk's prefix on (uid, chunk) and a window per
       (uid, chunk) -- on the join's partitioning, no new exchange -- adds
       the running count and sets inside the chunk.
    Only steps 0 and 4 move full rows, and a hot uid is spread over the
    partitions that its rows fill.  Results equal ``running_profile_window``."""
    fields = SET_FIELDS + ["search_item"]
    rows = flat.select("uid", "ts", "seq", *[F.col("deviceInfo").getField(f).alias(f) for f in SET_FIELDS], "search_item")
    base = row_chunks(rows)
    summary = base.groupBy("uid", "_chunk").agg(
        F.count(F.lit(1)).alias("_n"), *[F.collect_set(f).alias(f"_s_{f}") for f in fields])
    tagged = F.flatten(F.array(*[F.transform(F.col(f"_s_{f}"), _tag(f)) for f in fields]))
    first = (summary.select("uid", "_chunk", F.explode(tagged).alias("_e"))
             .groupBy("uid", F.col("_e.f").alias("f"), F.col("_e.v").alias("v"))
             .agg(F.min("_chunk").alias("_chunk")))
    new_vals = first.groupBy("uid", "_chunk").agg(
        *[F.collect_list(F.when(F.col("f") == f, F.col("v"))).alias(f"_new_{f}") for f in fields])
    wp = (Window.partitionBy("uid").orderBy("_chunk")
          .rowsBetween(Window.unboundedPreceding, -1))
    empty = F.array().cast("array<string>")
    prefix = (summary.select("uid", "_chunk", "_n").join(new_vals, ["uid", "_chunk"], "left")
              .select("uid", "_chunk", F.coalesce(F.sum("_n").over(wp), F.lit(0)).alias("_off"),
                      *[F.coalesce(F.flatten(_so_far(f"_new_{f}", wp)), empty).alias(f"_p_{f}")
                        for f in fields]))
    wl = (Window.partitionBy("uid", "_chunk").orderBy("ts", "seq")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = base.join(prefix, ["uid", "_chunk"], "inner")
    return j.select("uid", "ts", "seq", (F.col("_off") + F.count(F.lit(1)).over(wl)).alias("pv"),
                    *[_sets_to_text(F.array_union(F.col(f"_p_{f}"), F.collect_set(f).over(wl))).alias(f)
                      for f in fields])


def window_profile(flat: DataFrame, size_ms: int = 120_000, matched: str | None = None) -> DataFrame:
    """A2 + A3 + A4 in one: the running profile at the last row of every
    (uid, tumbling window), without making a row for each record.

    Every record is exploded into its values, tagged by field, and one entry
    that stands for its window.  One aggregation by (uid, field, value) then
    gives each value's first window and each window's count and last
    (ts, seq): a value is kept once, whatever the traffic, after a map-side
    partial step.  A second groups these by (uid, window), and the prefix
    per uid runs over one row per window -- bounded by time, not by traffic --
    and carries only the windows that brought a new value.

    ``matched``: a boolean column that marks search terms; adds
    ``search_term``, the most recent one so marked up to the window's end."""
    fields = SET_FIELDS + ["search_item"]
    ws = F.floor(F.col("ts") / F.lit(size_ms)) * F.lit(size_ms)
    term = F.when(F.col(matched), F.col("search_item")) if matched else F.lit(None).cast("string")
    rows = flat.select("uid", "ts", "seq", ws.alias("_ws"), *[F.col("deviceInfo").getField(f).alias(f) for f in SET_FIELDS], "search_item", term.alias("_term"))
    own = F.array(F.struct(F.lit("").alias("f"), F.col("_ws").cast("string").alias("v")))
    each = rows.select("uid", "_ws", "ts", "seq", "_term", F.explode(F.concat(own, _first_seen(fields))).alias("_e"))
    window_row = F.col("_e.f") == ""
    at = F.struct("ts", "seq")
    seen = each.groupBy("uid", F.col("_e.f").alias("f"), F.col("_e.v").alias("v")).agg(
        F.min("_ws").alias("window_start"), F.count(F.lit(1)).alias("_n"),
        F.max(F.when(window_row, at)).alias("_last"),
        F.max(F.when(window_row & F.col("_term").isNotNull(), F.struct("ts", "seq", "_term"))).alias("_t"))
    is_window = F.col("f") == ""
    by_window = seen.groupBy("uid", "window_start").agg(
        F.max(F.when(is_window, F.col("_n"))).alias("_n"), F.max("_last").alias("_last"), F.max("_t").alias("_t"),
        *[F.collect_list(F.when(F.col("f") == f, F.col("v"))).alias(f) for f in fields])
    w = Window.partitionBy("uid").orderBy("window_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = by_window.select(
        "uid", "window_start", F.col("_last.ts").alias("ts"), F.col("_last.seq").alias("seq"), F.sum("_n").over(w).alias("pv"),
        *[_sets_to_text(F.flatten(_so_far(f, w))).alias(f) for f in fields],
        F.max("_t").over(w).getField("_term").alias("search_term"))
    return out if matched else out.drop("search_term")


def window_last(profile: DataFrame, size_ms: int = 120_000, key: str = "uid",
                time_col: str = "ts", tie: str = "seq") -> DataFrame:
    """A4: per key and tumbling window, the last row (by time, tie).
    ``max_by`` aggregates partially on the map side, so a hot key costs one
    row per task before the shuffle.  Adds ``window_start`` (epoch ms)."""
    others = [c for c in profile.columns if c != key]
    ws = (F.floor(F.col(time_col) / F.lit(size_ms)) * F.lit(size_ms)).alias("window_start")
    last = F.max_by(F.struct(*others), F.struct(time_col, tie)).alias("_last")
    return (profile.groupBy(key, ws).agg(last)
            .select(key, "window_start", "_last.*"))


def reduce_by_window(df: DataFrame, key: str, time_col: str, size_ms: int, *aggs) -> DataFrame:
    """U6, general form of a keyed tumbling-window reduce: any aggregate
    expressions per (key, window); ``window_last`` is the ``(a, b) -> b``
    case.  Aggregates combine partially on the map side."""
    ws = (F.floor(F.col(time_col) / F.lit(size_ms)) * F.lit(size_ms)).alias("window_start")
    return df.groupBy(key, ws).agg(*aggs)
