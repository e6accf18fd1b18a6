"""Per-user device and search profile (the page-log job): flatten, dedup,
running profile, last row per 2-minute window, device and search scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.operators.profile import dedup_exact, flatten_page_log, running_profile, window_profile
from portrait.operators.scoring import category_by_b3name, device_scores, match_search_terms, search_scores

TWO_MINUTES_MS = 120_000


def category_tree(category3: DataFrame, category2: DataFrame, category1: DataFrame) -> DataFrame:
    """(id, b3name, b2name, b1name) over the three category levels."""
    c3 = category3.select("id", F.col("name").alias("b3name"), "category2_id")
    c2 = category2.select(F.col("id").alias("_c2"), F.col("name").alias("b2name"), "category1_id")
    c1 = category1.select(F.col("id").alias("_c1"), F.col("name").alias("b1name"))
    return (c3.join(c2, F.col("category2_id") == F.col("_c2"))
            .join(c1, F.col("category1_id") == F.col("_c1"))
            .select("id", "b3name", "b2name", "b1name"))


def profile_rows(raw_page_log: DataFrame) -> DataFrame:
    """flatten -> dedup -> running profile (one row per kept record)."""
    return running_profile(dedup_exact(flatten_page_log(raw_page_log)))


def window_rows(raw_page_log: DataFrame, window_ms: int = TWO_MINUTES_MS, categories: DataFrame | None = None) -> DataFrame:
    """flatten -> dedup -> profile at the end of every (uid, window).  With
    ``categories`` also ``search_term``: the most recent single search term
    that is a level-3 category name."""
    flat = dedup_exact(flatten_page_log(raw_page_log))
    if categories is None:
        return window_profile(flat, window_ms)
    names = category_by_b3name(categories).select("_b3", F.lit(True).alias("_known"))
    known = match_search_terms(flat, names, "search_item", F.xxhash64("uid", "ts", "seq"))
    return window_profile(known, window_ms, matched="_known")


def page_profile(spark: SparkSession, raw_page_log: DataFrame, categories: DataFrame,
                 compare_dic: DataFrame, window_ms: int = TWO_MINUTES_MS, mode: str = "as_run") -> DataFrame:
    """``as_run``: the whole comma-joined search text must be a category name
    (a user with two distinct searches never matches).  ``repaired``: the most
    recent single search term that is one counts."""
    if mode not in ("as_run", "repaired"):
        raise ValueError(mode)
    last = window_rows(raw_page_log, window_ms, categories if mode == "repaired" else None)
    return search_scores(device_scores(last, spark), spark, categories, compare_dic,
                         "search_item" if mode == "as_run" else "search_term")
