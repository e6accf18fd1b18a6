"""Personal data by candidate gradient boosting.

Generators with high recall propose spans, overlapping ones too: e-mail
addresses (also written with "at" and "dot"), IP addresses, card numbers and
phone numbers, and every run of whole digit groups inside a longer run of
digits.  Boosted trees score a span by its format and its context; a span is
taken if its score reaches its kind's calibrated threshold.  What the base
patterns match is always taken, and a span that the trees add never overlaps
one that is taken already.

Training needs no labels by hand.  Base matches are positive; candidates that
fail their kind's format test, or are a part of a base match, are negative;
all others (what the base patterns miss) are left out of the training and are
what the trees decide on.  All labelled candidates of all documents train and
calibrate: equal ones are one row that weighs as many, and a kind weighs as
much as its share of ``BALANCE`` rows, so one frequent kind does not crowd out
the others.  A hash holds a fifth back: trees on four fifths, and for each kind
the least threshold that holds ``precision`` on the last fifth (without such a
threshold the kind adds nothing); scores count in steps of 1 in ``STEPS``
there, so that any number of held rows comes to a bounded table of counts.  A
kind with fewer than ``MIN_HELD`` positive held rows cannot be calibrated: its
threshold is ``FALLBACK``, raised above the score of every negative row that
was held.  A caller who wants less work may set ``train_rows``: at most so many
labelled candidates are then chosen by a 64-bit hash, each kind and label with
a share of its own, and weights give the labels of a kind their share in the
corpus back.  The query does not.

One pass over the texts writes the candidates; texts are not shuffled.  Only
the candidates that are no base match are scored by Spark and grouped by row.

Defined cases: null and empty texts have no spans; repeated ids and rows are
judged row by row; an empty table gives an empty result, and with no labelled
candidates of both classes the base spans alone are returned; other columns
are ignored.  Ties between overlapping added spans go to the higher score,
then the longer, then the earlier span, then the kind as listed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import islice
from math import isqrt, nextafter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portrait.llm.common import cut, sha256_text, table, trimmed

KINDS = ("email", "ip", "card", "phone")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBERS = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,3}[0-9])++")
GROUP = re.compile(r"[0-9]++")
SPOKEN = re.compile(r"(?<![^\s(<])[\w.+-]{1,64}\s?[(\[]?\s?(?:at|AT|@)\s?[)\]]?\s?[\w-]{1,63}(?:\s?[(\[]?(?:\.|dot|DOT)[)\]]?\s?[\w-]{2,63}){1,4}")
TOKEN_STOP = frozenset(" \t\n\r\x0b\x0c<>()[]\",;:")
CUES = {
    "email": ("mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "telefon", "téléphone", "teléfono"),
}
#: Digits of a candidate; longer ones are proposed by no generator.
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)
#: A number in a run of digit groups is proposed if it has so many groups at
#: most, or is the whole run (digits written one by one).
MAX_GROUPS = 7
#: Candidates in an array; a text with more has several.
PART = 20_000
#: Held positive rows that calibrate a kind, and the score that a span needs
#: where a kind has fewer.
MIN_HELD, FALLBACK = 20, 0.8
#: Steps of a score that are told apart by a threshold.
STEPS = 10_000
#: A kind weighs as much in the training as its share of so many rows.
BALANCE = 20_000
#: Larger values of a feature are alike to the trees; so a feature has a
#: bounded number of places to split at.
LARGEST = 500
FEATURES = ["kind_email", "kind_ip", "kind_card", "kind_phone", "chars", "digits", "groups", "first_group", "last_group", "longest_group",
            "separators", "plus", "parentheses", "checksum", "small_parts", "domain_end", "ascii", "before", "after", "run_digits",
            "digits_before", "digits_after", "cue", "upper"]


def digits_of(s: str) -> list[int]:
    return [ord(c) - 48 for c in s if "0" <= c <= "9"]


def luhn(digits: list[int]) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, each the leftmost
    non-overlapping matches of its kind without those that fail its test.
    Written so that a run of any length costs time in proportion."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), "email"))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    for m in DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            start, parts = m.start(), m[0].split(".")
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in four):
                    out.append((start, end, "ip"))
                start = end + 1
    for m in CARD.finditer(text):
        if 14 <= len(m[0]) and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append((*m.span(), "card"))
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m[0])) <= 15:
            out.append((*m.span(), "phone"))
    return out


def candidates(text: str) -> Iterator[tuple[int, int, str, int]]:
    """(start, end, kind, digits of the run it is from); overlapping."""
    at = text.find("@")
    while at >= 0:
        s, e = at, at + 1
        while s > 0 and at - s < 64 and text[s - 1] not in TOKEN_STOP:
            s -= 1
        while e < len(text) and e - at < 256 and text[e] not in TOKEN_STOP:
            e += 1
        while e > at + 1 and not text[e - 1].isalnum():
            e -= 1
        if s < at < e - 1:
            yield s, e, "email", 0
        at = text.find("@", at + 1)
    if "dot" in text or "DOT" in text or " @" in text or "@ " in text:
        for m in SPOKEN.finditer(text):
            yield *m.span(), "email", 0
    for m in DOTTED.finditer(text):
        if m[0].count(".") >= 3:
            parts = m[0].split(".")
            starts, digits = [m.start()], sum(map(len, parts))
            for p in parts:
                starts.append(starts[-1] + len(p) + 1)
            for k in range(len(parts) - 3):
                yield starts[k], starts[k + 4] - 1, "ip", digits
    for m in NUMBERS.finditer(text):
        run = digits_of(m[0])
        if len(run) < 10:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in GROUP.finditer(m[0])]
        for i, (start, _) in enumerate(groups):
            n, last = 0, len(groups) if i == 0 and len(groups) <= CARD_DIGITS[1] else i + MAX_GROUPS
            for j, (first, end) in enumerate(groups[i:last], i):
                n += end - first
                if n > CARD_DIGITS[1] or end - start >= 64:
                    break
                if j - i >= MAX_GROUPS and j < len(groups) - 1:
                    continue
                if CARD_DIGITS[0] <= n and CARD.fullmatch(text, start, end):
                    yield start, end, "card", len(run)
                if PHONE_DIGITS[0] <= n <= PHONE_DIGITS[1]:
                    s = start
                    while s > m.start() and text[s - 1] in "(+":
                        s -= 1
                    yield s, end, "phone", len(run)


def valid(kind: str, span: str) -> bool:
    """The kind's format test."""
    if kind == "email":
        name, _, host = span.partition("@")
        return bool(LOCAL.match(name) and DOMAIN.fullmatch(host) and host.rpartition(".")[2].isalpha())
    if kind == "ip":
        return all(len(p) < 4 and int(p) <= 255 for p in span.split("."))
    digits = digits_of(span)
    if kind == "card":
        return luhn(digits) and len(set(digits)) > 2
    return span.startswith("+") and digits[0] != 0


class Intervals:
    """Disjoint intervals; questions cost a binary search."""

    def __init__(self, spans=()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted(spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, s: int, e: int) -> bool:
        i = bisect_left(self.starts, e) - 1
        return i >= 0 and self.ends[i] > s

    def holds(self, s: int, e: int) -> bool:
        i = bisect_right(self.starts, s) - 1
        return i >= 0 and e <= self.ends[i]

    def add(self, s: int, e: int) -> None:
        i = bisect_left(self.starts, s)
        self.starts.insert(i, s)
        self.ends.insert(i, e)


def side(c: str) -> int:
    """What stands beside a span: 0 nothing or white space, 1 punctuation, 2 letter, 3 digit."""
    return 0 if not c or c.isspace() else 3 if c.isdigit() else 2 if c.isalpha() else 1


def features(text: str, start: int, end: int, kind: str, run: int) -> list[float]:
    span = text[start:end]
    digits = digits_of(span)
    groups = [len(x) for x in GROUP.findall(span)] or [0]
    left, right = text[max(0, start - 40):start], text[end:end + 24]
    near = left.lower()
    host = span.rpartition("@")[2].rpartition(".")[2]
    return [float(x) if x < LARGEST else float(LARGEST) for x in (
        *(kind == k for k in KINDS), len(span), len(digits), len(groups), groups[0], groups[-1], max(groups),
        len({c for c in span if not c.isalnum()}), span.startswith("+"), "(" in span,
        kind == "card" and luhn(digits), kind == "ip" and valid("ip", span), len(host) if kind == "email" and host.isalpha() else 0,
        span.isascii(), side(left[-1:]), side(right[:1]), min(run, 60), sum(c.isdigit() for c in left[-12:]), sum(c.isdigit() for c in right[:12]),
        any(c in near for c in CUES[kind]), sum(c.isupper() for c in span))]


def described(text: str, base: list[tuple]) -> Iterator[tuple]:
    """(start, end, kind, label, features) of the other candidates and of the
    base spans, one after the other; label: 1 base, 0 negative, -1 open."""
    taken = {(s, e, k) for s, e, k in base}
    of_kind = {k: Intervals(x[:2] for x in base if x[2] == k) for k in KINDS}
    any_kind = Intervals(x[:2] for x in base)
    seen = set()  # only addresses are proposed twice
    for s, e, k, run in candidates(text):
        if k == "email":
            if (s, e) in seen:
                continue
            seen.add((s, e))
        if (s, e, k) in taken:
            label = 1
        elif not valid(k, text[s:e]) and k != "phone" or of_kind[k].holds(s, e):
            label = 0
        elif k == "phone" and not text[s:e].startswith("+") and any_kind.meets(s, e):
            label = 0
        else:
            label = -1
        yield s, e, k, label, features(text, s, e, k, run)


def sorted_base(text: str | None) -> list[tuple]:
    return sorted(base_spans(text), key=lambda x: (x[0], KINDS.index(x[2]), x[1])) if text else []


def text_candidates(text: str | None) -> tuple[list[tuple], list[tuple]]:
    """Base spans and described candidates of a text."""
    base = sorted_base(text)
    return base, list(described(text, base)) if text else []


SPAN = "struct<start:long,end:long,kind:string>"
CANDIDATE = "struct<start:long,end:long,kind:string,label:int,x:array<double>>"


def propose(docs: DataFrame, carry: list[str], text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the ``carry`` columns), the base spans and the
    candidates of every row, numbered by ``rid``.  A row of more than ``PART``
    candidates goes on in further ones (``part`` 1, 2, ...) without ``row``."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("_text"))
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])
    candidate = pa.struct([*span, ("label", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            out: list[tuple] = []
            weight = 0

            def done() -> pa.RecordBatch:
                nonlocal weight
                at, rid, part, base, more = zip(*out)
                cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(rid, pa.int64()), pa.array(part, pa.int32()),
                        pa.array([[dict(zip(("start", "end", "kind"), x)) for x in b] for b in base], pa.list_(span)),
                        pa.array([[dict(zip(("start", "end", "kind", "label", "x"), x)) for x in m] for m in more], pa.list_(candidate))]
                out.clear()
                weight = 0
                return pa.RecordBatch.from_arrays(cols, names=["row", "rid", "part", "base", "candidates"])

            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                base = sorted_base(text)
                each = described(text, base) if text else iter(())
                part = 0
                while part == 0 or more:
                    more = list(islice(each, PART))
                    if part == 0 or more:
                        out.append((i if part == 0 else None, number, part, base if part == 0 else [], more))
                        weight += len(more) + len(out[-1][3]) + 1
                        if weight >= PART:
                            yield done()
                    part += 1
                number += 1
            if out:
                yield done()

    schema = StructType().add("row", rows.schema["row"].dataType)
    for f in StructType.fromDDL(f"rid long, part int, base array<{SPAN}>, candidates array<{CANDIDATE}>").fields:
        schema = schema.add(f)
    return rows.mapInArrow(trimmed(run), schema)


def shares(counts: dict, rows: int) -> dict:
    """How many of each class go to a sample of at most ``rows``: an equal part
    each; what small classes leave goes to the others."""
    out, left = {}, rows
    for n, k in enumerate(sorted(counts, key=lambda k: (counts[k], k))):
        out[k] = min(counts[k], left // (len(counts) - n))
        left -= out[k]
    return out


def chosen(draw: Column, counts: dict, rows: int) -> Column:
    """Whether a 64-bit ``draw`` is in its class's part of the sample."""
    test = F.lit(False)
    for k, n in shares(counts, rows).items():
        mine = F.lit(True) if n == counts[k] else draw < F.lit(-(1 << 63) + (n << 64) // counts[k])
        test = F.when((F.col("kind") == k[0]) & (F.col("label") == k[1]), mine).otherwise(test)
    return test


def threshold(rows: list[tuple], precision: float) -> float | None:
    """The least score that holds ``precision`` on a kind's held ``rows``
    (score, label, weight and, if it stands for several, their number); with
    fewer than MIN_HELD positive ones FALLBACK, or more than every held
    negative one's score."""
    rows = sorted(((p, y, w, *(n or (1,))) for p, y, w, *n in rows), reverse=True)
    if sum(y * n for _, y, _, n in rows) < MIN_HELD:
        return max([FALLBACK, *(nextafter(p, 2.0) for p, y, _, _ in rows if not y)])
    right, total, seen, best = 0.0, 0.0, 0, None
    for i, (p, y, w, n) in enumerate(rows, 1):
        right, total, seen = right + y * w, total + w, seen + n
        if (i == len(rows) or rows[i][0] != p) and seen >= MIN_HELD and right / total >= precision:
            best = p
    return None if best is None else max(0.5, best)


def stepped(p: Column) -> Column:
    return F.floor(p * STEPS) / STEPS


def split_bins(rows: int) -> int:
    """The bins a feature may have.  Spark looks for places to split at in
    10,000 rows, or in the square of the bins if that is more: so many bins
    that it looks at all ``rows`` (as long as their square is an int)."""
    return 32 if rows <= 10_000 else min(46_340, isqrt(rows - 1) + 1)


def train(labelled: DataFrame, train_rows: int | None = None, precision: float = 0.99, seed: int = 42):
    """(model, thresholds by kind) from (kind, label, x, place); None without
    both classes.  Rows are held (and, with ``train_rows``, chosen) by hash, so
    that does not depend on order."""
    counts = {(r["kind"], r["label"]): r["count"] for r in labelled.groupBy("kind", "label").count().collect()}  # at most 8 rows
    if len({label for _, label in counts}) < 2:
        return None, {}
    draw = lambda n: F.xxhash64(F.lit(n), "kind", "label", "x", "place")
    rows = labelled if train_rows is None else labelled.where(chosen(draw(seed), counts, train_rows))
    # equal candidates are one row that weighs as many
    rows = cut(rows.groupBy("kind", "label", "x", (F.pmod(draw(seed + 1), F.lit(5)) == 0).alias("held")).agg(F.count("*").alias("n"))
               .select("kind", F.col("label").cast("double").alias("label"), array_to_vector("x").alias("features"), "held", "n"))
    drawn = {(r["kind"], int(r["label"])): r["n"] for r in rows.groupBy("kind", "label").agg(F.sum("n").alias("n")).collect()}
    # kinds weigh the same as far as they have rows, labels inside a kind as they do in the corpus
    mass = shares(counts, BALANCE) if train_rows is None else drawn
    of_kind = lambda c, kind: sum(n for k, n in c.items() if k[0] == kind)
    weight = F.lit(1.0)
    for k, n in drawn.items():
        own = counts[k] / of_kind(counts, k[0]) * of_kind(mass, k[0]) / n
        weight = F.when((F.col("kind") == k[0]) & (F.col("label") == k[1]), F.lit(own)).otherwise(weight)
    rows = rows.withColumn("weight", weight * F.col("n"))
    fit = rows.where("not held")
    fit_rows = {r["label"]: r["count"] for r in fit.groupBy("label").count().collect()}
    if set(fit_rows) != {0.0, 1.0}:
        fit = rows  # too few to do without the held ones
        fit_rows = {r["label"]: r["count"] for r in fit.groupBy("label").count().collect()}
    if {label for _, label in drawn} != {0, 1}:
        return None, {}
    model = GBTClassifier(maxIter=12, maxDepth=4, maxBins=split_bins(sum(fit_rows.values())), seed=seed, checkpointInterval=-1, weightCol="weight").fit(fit)
    # at most a row for each kind, label and step
    held = (model.transform(rows.where("held")).groupBy("kind", "label", stepped(vector_to_array("probability")[1]).alias("p"))
            .agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")).collect())
    found = {kind: threshold([(r["p"], r["label"], r["weight"], r["n"]) for r in held if r["kind"] == kind], precision) for kind in KINDS}
    return model, {k: t for k, t in found.items() if t is not None}


def no_overlap(spans: list, base: list) -> list[tuple]:
    """The added spans that stay: best first, none that overlaps another."""
    kept, out = Intervals((b["start"], b["end"]) for b in base), []
    for x in sorted(spans, key=lambda x: (-x["p"], x["start"] - x["end"], x["start"], KINDS.index(x["kind"]))):
        if not kept.meets(x["start"], x["end"]):
            kept.add(x["start"], x["end"])
            out.append((x["start"], x["end"], x["kind"]))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def find_spans(docs: DataFrame, carry: list[str], text_col: str = "text", train_rows: int | None = None, precision: float = 0.99) -> DataFrame:
    """(row, base, added): the spans of every row as arrays of (start, end,
    kind), code points, end exclusive, sorted by start and then kind."""
    found = cut(propose(docs, carry, text_col))
    each = found.select("rid", "part", F.posexplode("candidates").alias("at", "c"))
    labelled = each.where("c.label >= 0").select("c.kind", "c.label", "c.x", F.struct("rid", "part", "at").alias("place"))
    found = found.where("part = 0").drop("part", "candidates")
    model, thresholds = train(labelled, train_rows, precision)
    nothing = F.array().cast(f"array<{SPAN}>")
    if not thresholds:
        return found.select("row", "base", nothing.alias("added"))
    limit = F.coalesce(*[F.when(F.col("c.kind") == k, F.lit(t)) for k, t in thresholds.items()], F.lit(2.0))
    scored = (model.transform(each.where("c.label = -1").select("rid", "c", array_to_vector("c.x").alias("features")))
              .withColumn("p", vector_to_array("probability")[1]).where(stepped(F.col("p")) >= limit))
    open_ = scored.groupBy("rid").agg(F.collect_list(F.struct("c.start", "c.end", "c.kind", "p")).alias("open"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stay = [no_overlap(x, b) for x, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
            added = pa.array([[dict(zip(("start", "end", "kind"), x)) for x in xs] for xs in stay], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), added], names=["rid", "added"])

    # only the rows that have an open span of enough score go through Python
    picked = open_.join(found.select("rid", "base"), "rid").select("rid", "open", "base").mapInArrow(pick, f"rid long, added array<{SPAN}>")
    return found.join(picked, "rid", "left").select("row", "base", F.coalesce("added", nothing).alias("added"))


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All rows and columns of ``docs``, every found span replaced by its
    kind in brackets."""
    found = find_spans(docs, docs.columns, text_col, **options)

    def replace(text: str | None, spans: list) -> str | None:
        if text is None or not spans:
            return text
        out, at = [], 0
        for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= at:  # one that begins inside the last goes with it
                out += [text[at:s["start"]], f"[{s['kind']}]"]
            at = max(at, s["end"])
        return "".join(out) + text[at:]

    spans = F.concat("base", "added")
    clean = F.udf(replace, "string")(F.col(f"row.`{text_col}`"), spans)
    return found.select(*[clean.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_spans(table(spark, sf_dir, "documents"), ["doc_id"])

    def joined(spans: Column) -> Column:
        keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))))
        return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("row.doc_id").alias("doc_id"), *map(count, KINDS), sha256_text(joined(F.col("base"))).alias("base_sha256"),
                        joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
