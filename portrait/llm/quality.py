"""Quality rules as weak supervision.

Every rule looks at counts of the whole text and votes good or bad, or
abstains.  Expectation-maximisation estimates, without labels, how often each
rule's vote is bad among good and among bad documents (its accuracies) and
the share of bad documents; an abstention says nothing.  The posterior
probability of being good, not the passing of every rule, decides.

EM needs only how many documents show each pattern of votes: one partial
aggregation, at most 3 ** rules patterns (a proven bound, whatever the
corpus).  These come to the driver and go back as a broadcast table.  A text
is judged where it lies; nothing shuffles texts.

Defined cases: null and empty texts have no words and fail the base rule;
repeated ids and rows are judged row by row; an empty table gives an empty
result; other columns pass through ``keep_good`` whatever their names.
A document without a bad vote is never rejected by the method.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portrait.llm.common import cut, table, trimmed

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
          "n_lines", "n_ended", "n_alpha", "n_distinct", "n_upper", "n_letters", "n_marks"]


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else
    abstains (SQL conditions over the counts)."""

    name: str
    bad: str
    good: str


RULES = (
    Rule("symbols", "10 * n_symbols > n_words", "100 * n_symbols <= n_words"),
    Rule("symbol_heavy", "10 * n_symbols > 4 * n_words", "10 * n_symbols <= n_words"),
    Rule("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words", "10 * word_chars BETWEEN 42 * n_words AND 65 * n_words"),
    Rule("letters", "100 * n_alpha < 80 * n_words", "100 * n_alpha >= 95 * n_words"),
    Rule("upper_case", "100 * n_upper > 30 * n_letters", "100 * n_upper <= 8 * n_letters"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines", "n_dup_lines = 0 AND n_lines > 1"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    Rule("line_ends", "100 * n_ended < 10 * n_lines", "100 * n_ended >= 80 * n_lines"),
    Rule("exclamations", "10 * n_marks > n_words", "100 * n_marks <= n_words"),
    Rule("variety", "100 * n_distinct < 10 * n_words", "100 * n_distinct >= 40 * n_words"),
)

#: Base rule of a text that no vote can save.
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
SYMBOLS = b"#*$%&|<>"


def text_counts(text: str | None) -> tuple:
    """The ``COUNTS`` of a text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ids: dict[bytes, int] = {}
    seq = np.array([ids.setdefault(w, len(ids)) for w in words], dtype=np.int64)
    n, kinds = len(seq), max(1, len(ids))
    repeat = 0
    if n > 3:
        two = seq[:-2] * kinds + seq[1:-1]
        if kinds > 2_000_000:  # three ids do not fit 64 bits
            two = np.unique(two, return_inverse=True)[1]
        three = two * kinds + seq[2:]
        order = np.argsort(three, kind="stable")
        ranked = three[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(n - 2, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(n, dtype=bool)
        for k in range(3):
            covered[k:n - 2 + k] |= twice
        repeat = int(covered.sum())
    has_letter = re.compile(rb"[A-Za-z\x80-\xff]").search
    alpha = np.array([has_letter(w) is not None for w in ids], dtype=bool)
    upper = len(raw) - len(raw.translate(None, UPPER))
    lower = len(raw) - len(raw.translate(None, LOWER))
    return (
        n, len(text) - sum(map(text.count, " \t\n\x0b\x0c\r")),
        len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeat,
        len(lines), sum(x.rstrip()[-1:] in (b".", b"!", b"?", b'"') for x in lines),
        int(alpha[seq].sum()) if n else 0, len(ids), upper, upper + lower, raw.count(b"!"),
    )


def with_counts(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the ``carry`` columns) and the counts."""
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    rows = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_counts(t.as_py()) for t in batch.column(1)], dtype=np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, i]) for i in range(len(COUNTS)))], names=["row", *COUNTS])

    schema = StructType().add("row", rows.schema["row"].dataType)
    for c in COUNTS:
        schema = schema.add(c, "long")
    return rows.mapInArrow(trimmed(run), schema)


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """The pattern of votes, one letter a rule: g, b or - (abstains)."""
    return F.concat(*[F.when(F.expr(r.bad), "b").when(F.expr(r.good), "g").otherwise("-") for r in rules])


@dataclass(frozen=True)
class Model:
    """Shares of bad votes among the votes of each rule, and of bad documents."""

    bad_if_good: list[float]
    bad_if_bad: list[float]
    bad_share: float
    posterior: dict[str, float]  # pattern -> probability of being good


def fit(patterns: dict[str, int], turns: int = 100) -> Model:
    """EM over the counts of vote patterns.  Starts from rules that are wrong
    once in twenty on good documents and right every third time on bad ones;
    a hundredth of the documents counts for that start throughout, so a rule
    without evidence keeps it.  A rule votes bad at least as often on bad
    documents as on good ones, and at most half of the documents are bad."""
    keys = list(patterns)
    if not keys:
        return Model([], [], 0.0, {})
    count = np.array([patterns[k] for k in keys], dtype=float)
    bad = np.array([[c == "b" for c in k] for k in keys], dtype=float)
    cast = np.array([[c != "-" for c in k] for k in keys], dtype=float)
    a0, b0, share0 = 0.05, 0.35, 0.1
    start = 0.01 * count.sum()
    a, b, share = np.full(bad.shape[1], a0), np.full(bad.shape[1], b0), share0
    is_bad = np.zeros(len(keys))
    for _ in range(turns):
        odds = np.log(share / (1 - share)) + bad @ np.log(b / a) + (cast - bad) @ np.log((1 - b) / (1 - a))
        is_bad = 1 / (1 + np.exp(-odds))
        p, q = count * is_bad, count * (1 - is_bad)
        b = (p @ bad + start * b0) / (p @ cast + start)
        a = (q @ bad + start * a0) / (q @ cast + start)
        a = np.clip(a, 1e-4, 0.5)
        b = np.clip(np.maximum(a, b), 1e-3, 0.99)
        share = float(np.clip((p.sum() + start * share0) / (count.sum() + start), 1e-4, 0.5))
    good = np.where(bad.any(axis=1), 1 - is_bad, 1.0)
    return Model(a.tolist(), b.tolist(), share, dict(zip(keys, good.tolist())))


def judged(counted: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``counted`` with votes, base_failed, p_good and kept."""
    spark = counted.sparkSession
    known = spark.createDataFrame(list(model.posterior.items()) or [("", 1.0)], "votes string, p_good double")
    out = counted.withColumn("votes", votes()).join(F.broadcast(known), "votes", "left")
    return (out.withColumn("base_failed", F.expr(BASE_FAILED))
            .withColumn("p_good", F.coalesce("p_good", F.lit(1.0)))
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def fit_on(counted: DataFrame) -> Model:
    """The model of a table of counts (texts that pass the base rule)."""
    rows = counted.where(~F.expr(BASE_FAILED)).groupBy(votes().alias("votes")).count()
    return fit({r["votes"]: r["count"] for r in rows.collect()})


def keep_good(docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are kept.  Reads the texts
    twice (for the patterns, then to judge) rather than moving them."""
    model = fit_on(with_counts(docs, [], text_col))
    return judged(with_counts(docs, docs.columns, text_col), model, threshold).where("kept").select("row.*")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = cut(with_counts(table(spark, sf_dir, "documents"), ["doc_id"]))
    return judged(counted, fit_on(counted)).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "p_good", "votes")
