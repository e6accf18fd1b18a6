"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that starts
anywhere else too.

The suffixes of all texts are told apart by their first ``length`` bytes, as in
a blockwise suffix array over a difference cover: a sparse cover sample is
ranked first, then the other suffixes are sorted one bucket at a time, and what
the ranks of the sample already decide is not sorted.

* **Cover.**  Sample positions are those whose offset in the text, modulo
  ``period``, lies in a perfect difference set.  For any two positions there is
  a step below ``period`` that leads both to sample positions; so if two
  strings of ``length`` bytes are equal, two sample suffixes in them share
  their first ``length - period + 1`` bytes (the *core*).
* **Ranks.**  Round one sorts the cores, bucket by bucket: a sample whose core
  is its own alone needs no further look (a core's rank is a digest; a chance
  tie costs work, not truth).  Round two ranks what is left by *hull*, all the
  bytes of the strings that start within ``period`` before the sample and hold
  it.  Samples of equal hull resolve the long ties: all those strings repeat.
  Where samples of one core differ in hull, one sample of each hull is passed
  on, so a group of a thousand copies passes on its variants only.
* **Buckets.**  Round three sorts the suffixes that start in such a hull by a
  128-bit digest of their first ``length`` bytes, one bucket at a time;
  neighbours that are equal repeat.

Order is by digest, not by byte value: equality is all that is asked for.
Texts are written once, in slices of bounded size, bucketed by slice, and
never shuffled; a round sends packed sorted keys from slices to buckets (each
different key of a slice once) and bitmaps back.  The number of buckets follows
the bytes of all texts, so a bucket has a bounded share of the keys; a string
that fills a third of the corpus is one key a slice.

* **Passages** of words (where asked for) go the same way, in the same rounds: the
  units are then hashes of words instead of bytes, their keys have buckets of
  their own, and white space between words is of no account.  They are found
  beside the strings and change nothing in what is removed.

Defined cases: a null text is empty; texts shorter than ``length`` keep all;
repeated rows repeat each other; ids may be null or repeat; an empty table gives
an empty result; a text longer than a slice is a slice of its own; further
columns are ignored.  Spans are in bytes, so what is kept need not be UTF-8.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm.common import ensure_checkpoint_dir, table, written

#: Perfect difference sets, by period.
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
}
#: Bytes of text in a slice, and sample keys in a bucket.
SLICE_BYTES = 4_000_000
BUCKET_KEYS = 2_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of words, and the longest word that the sums tell apart by themselves.
SOLID = ~np.isin(np.arange(256), [32, *range(9, 14)])
LONG_WORD = 255


def cover_of(length: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves two thirds of ``length`` to the core."""
    period = max(p for p in COVERS if 3 * p <= length + 2)
    return period, COVERS[period]


class Slice:
    """The texts of a slice as one array of bytes."""

    def __init__(self, texts: pa.Array, length: int, bits: int):
        self.length, self.bits = length, bits
        self.period, self.cover = cover_of(length)
        texts = texts.cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        self.data = np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
        self.starts, self.ends = ends[:-1] - ends[0], ends[1:] - ends[0]

    def samples(self) -> None:
        """Sample positions ``at`` (with the bounds of their texts) and their
        cores' ``code``: the bucket in front, 32 further bits behind."""
        core = self.length - self.period + 1
        sizes = self.ends - self.starts
        most = int(sizes.max(initial=0))
        steps = (np.arange(0, most + 1, self.period)[:, None] + np.array(self.cover)[None, :]).ravel()
        steps = steps[steps + core <= most]
        held = np.where(sizes >= self.length, np.searchsorted(steps, sizes - core, side="right"), 0)
        doc = np.repeat(np.arange(len(sizes)), held)
        self.at = steps[np.arange(len(doc)) - np.repeat(np.cumsum(held) - held, held)] + self.starts[doc]
        self.lo, self.hi = self.starts[doc], self.ends[doc]
        # a polynomial over the slice: the digest of any stretch is a difference of two sums
        power = np.full(len(self.data) + 1, BASE, dtype=np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        self.sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=self.sums[1:])
        self.back = np.full(len(self.data) + 1, pow(int(BASE), -1, 1 << 64), dtype=np.uint64)
        self.back[0] = 1
        np.multiply.accumulate(self.back, out=self.back)
        self.code = self.digests(self.at, self.at + core) >> np.uint64(32 - self.bits)
        self.codes, self.code_of, self.code_n = np.unique(self.code, return_inverse=True, return_counts=True)

    def digests(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        key = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        key ^= key >> np.uint64(31)
        key *= np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(29)
        return key

    def forget(self) -> None:
        """The sums, which only ``samples`` and ``digests`` need."""
        self.sums = self.back = None

    def tie(self, across: np.ndarray) -> None:
        """Keep the samples whose core is found elsewhere too and digest their
        hulls.  ``across``: for each of ``codes``, whether other slices have it."""
        tied = (across | (self.code_n > 1))[self.code_of]
        self.at, self.lo, self.hi, self.code = self.at[tied], self.lo[tied], self.hi[tied], self.code[tied]
        self.first = np.maximum(self.lo, self.at - self.period + 1)
        upto = np.minimum(self.hi, self.at + self.length)
        view = memoryview(self.data)
        digest, span = xxhash.xxh3_64_intdigest, 2 * self.length + self.period
        hull = np.array([digest(view[s:e], (p - s) * span + (e - s)) for p, s, e in zip(self.at.tolist(), self.first.tolist(), upto.tolist())], dtype=np.uint64)
        order = np.lexsort((hull, self.code))
        self._entries(order, self.code, hull)
        self.hulls, self.hull_codes = hull[order][self.entry_start], self.code[order][self.entry_start]

    def _entries(self, order: np.ndarray, *keys: np.ndarray) -> None:
        """Different keys in order: where each begins in ``order``, how often
        it is there, and which one each row has."""
        new = np.ones(len(order), dtype=bool)
        for i, k in enumerate(keys):
            k = k[order]
            new[1:] = (k[1:] != k[:-1]) if i == 0 else new[1:] | (k[1:] != k[:-1])
        self.entry_start = np.flatnonzero(new)
        self.entry_n = np.diff(np.append(self.entry_start, len(order)))
        self.entry_first = order[self.entry_start]  # lexsort is stable: the first by position
        self.entry_of = np.empty(len(order), dtype=np.int64)
        self.entry_of[order] = np.cumsum(new) - 1

    def windows(self, flags: np.ndarray) -> None:
        """The strings that the ranks decide (``decided``: marks of starts) and
        the ones to sort.  ``flags`` of each hull: 1 repeats in other slices, 2
        speaks for its hull in a core of several."""
        repeats = ((flags & 1).astype(bool) | (self.entry_n > 1))[self.entry_of]
        speaks = self.entry_first[(flags & 2) > 0]
        last = np.minimum(self.at, self.hi - self.length)
        self.decided = marks(len(self.data), self.first[repeats], last[repeats] + 1)
        self.starts_at = np.flatnonzero(marks(len(self.data), self.first[speaks], last[speaks] + 1))
        view, length = memoryview(self.data), self.length
        digest = xxhash.xxh3_128_digest
        raw = b"".join([digest(view[i:i + length]) for i in self.starts_at.tolist()])
        both = np.frombuffer(raw, dtype=">u8").reshape(-1, 2).astype(np.uint64)
        high, low = both[:, 0], (both[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        order = np.lexsort((low, high))
        self._entries(order, high, low)
        self.high, self.low = high[order][self.entry_start], low[order][self.entry_start]

    def repeated(self, across: np.ndarray) -> np.ndarray:
        """Marks of the units in repeated strings."""
        again = (across | (self.entry_n > 1))[self.entry_of]
        self.decided[self.starts_at[again]] = True
        at = np.flatnonzero(self.decided)
        return marks(len(self.data), at, at + self.length)


class Words(Slice):
    """The words of a slice's texts, as hashes, in the place of bytes (after
    its ``samples``); ``begin`` and ``end`` of each word are bytes of the slice."""

    def __init__(self, texts: Slice, length: int):
        self.length, self.bits = length, texts.bits
        self.period, self.cover = cover_of(length)
        self.begin, last = runs(SOLID[texts.data], texts.starts)
        self.end = last + 1
        self.data = texts.digests(self.begin, self.end)
        view = memoryview(texts.data)
        for i in np.flatnonzero(self.end - self.begin > LONG_WORD).tolist():
            self.data[i] = xxhash.xxh3_64_intdigest(view[self.begin[i]:self.end[i]])
        self.text_starts = texts.starts
        self.starts, self.ends = np.searchsorted(self.begin, texts.starts), np.searchsorted(self.begin, texts.ends)

    def passages(self, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The stretches of marked words: start and end in bytes of their text,
        and how many each text has."""
        first, last = runs(gone, self.starts)
        doc = np.searchsorted(self.starts, first, side="right") - 1
        return self.begin[first] - self.text_starts[doc], self.end[last] - self.text_starts[doc], np.bincount(doc, minlength=len(self.starts))


def runs(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and last places of the stretches ``inside``; none goes on
    over a cut."""
    n = len(inside)
    cut = np.zeros(n + 1, dtype=bool)
    cut[cuts] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last)


def marks(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in any [start, end)."""
    step = np.bincount(starts, minlength=n + 1).astype(np.int64) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def packed(slice_id: int, bucket: np.ndarray, *keys: np.ndarray) -> pa.RecordBatch:
    """(bucket, slice, keys...) rows of sorted keys, one for each bucket."""
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(bucket))
    cols = [pa.array([k[s:e].tobytes() for s, e in zip(cuts.tolist(), ends.tolist())], pa.binary()) for k in keys]
    names = ["bucket", "slice", *(f"k{i}" for i in range(len(keys)))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts].astype(np.int64)), pa.array(np.full(len(cuts), slice_id), pa.int64()), *cols], names=names)


def _new(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return new


def _times(new: np.ndarray) -> np.ndarray:
    """For sorted rows, how many equal ones there are of each."""
    start = np.flatnonzero(new)
    n = np.diff(np.append(start, len(new)))
    return np.repeat(n, n)


def same_core(codes: np.ndarray) -> np.ndarray:
    order = np.argsort(codes, kind="stable")
    out = np.empty(len(codes), dtype=np.uint8)
    out[order] = _times(_new(codes[order])) > 1
    return out


def same_hull(codes: np.ndarray, hulls: np.ndarray) -> np.ndarray:
    order = np.lexsort((hulls, codes))
    c, h = codes[order], hulls[order]
    new_core, new_hull = _new(c), _new(c, h)
    variants = np.add.reduceat(new_hull.astype(np.int64), np.flatnonzero(new_core))
    several = (variants > 1)[np.cumsum(new_core) - 1]
    out = np.empty(len(codes), dtype=np.uint8)
    out[order] = (_times(new_hull) > 1) + 2 * (several & new_hull)
    return out


def same_window(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    order = np.lexsort((low, high))
    out = np.empty(len(high), dtype=np.uint8)
    out[order] = _times(_new(high[order], low[order])) > 1
    return out


def bucket_round(keys: DataFrame, parts: int, types: tuple[str, ...], solve: Callable[..., np.ndarray]) -> DataFrame:
    """Sort the buckets of ``keys`` one at a time; (slice, flags): the flags of
    each slice's keys in the order they were sent (buckets ascending)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, owners, pieces = None, [], []

        def done() -> pa.RecordBatch:
            cols = [np.frombuffer(b"".join(p[i] for p in pieces), dtype=t) for i, t in enumerate(types)]
            flags = solve(*cols)
            at = np.cumsum([0, *(len(p[0]) // np.dtype(types[0]).itemsize for p in pieces)]).tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array(owners, pa.int64()), pa.array([now] * len(owners), pa.int64()), pa.array([flags[s:e].tobytes() for s, e in zip(at, at[1:])], pa.binary())],
                names=["slice", "bucket", "flags"])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for bucket, owner, *data in zip(*cols):
                if bucket != now and pieces:
                    yield done()
                    owners, pieces = [], []
                now = bucket
                owners.append(owner)
                pieces.append(data)
        if pieces:
            yield done()

    answered = (keys.repartition(parts, "bucket").sortWithinPartitions("bucket", "slice")
                .mapInArrow(run, "slice bigint, bucket bigint, flags binary"))
    grouped = answered.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("bucket", "flags"))).alias("f"))
    return written(grouped.select("slice", F.transform("f", lambda x: x["flags"]).alias("flags")))


def sliced(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(slice, ids, texts) rows of at most about ``SLICE_BYTES`` of text each
    (or one longer text), written once and bucketed by slice, so that joins on
    it leave the texts where they are."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []
        size = 0

        def done() -> pa.RecordBatch:
            nonlocal serial, size
            cols = [pa.concat_arrays([w.column(i) for w in waiting]) for i in range(2)]
            one = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cols]
            waiting.clear()
            size, serial = 0, serial + 1
            return pa.RecordBatch.from_arrays([pa.array([(part << 32) | serial], pa.int64()), *one], names=["slice", "ids", "texts"])

        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).tolist()
            start = 0
            for i, n in enumerate(sizes):
                if size and size + n > SLICE_BYTES:
                    if i > start:
                        waiting.append(batch.slice(start, i - start))
                    yield done()
                    start = i
                size += n + 1
            waiting.append(batch.slice(start))
        if waiting and sum(w.num_rows for w in waiting):
            yield done()

    id_type = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"slice bigint, ids array<{id_type}>, texts array<string>")
    name = f"portrait_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{name}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found.write.option("path", path).option("compression", "zstd").bucketBy(parts, "slice").saveAsTable(name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.table(name)


def repeated_spans(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", words: int | None = None) -> DataFrame:
    """(id, n_bytes, spans array<struct<start, end>>, kept binary) of every
    row of ``docs``: the removed byte spans and what is left.  With ``words``
    also ``passages``, the byte spans of the words covered by a passage of so
    many words (whatever white space is between them) that starts anywhere else
    too; they are reported, not removed."""
    spark = docs.sparkSession
    texts = sliced(docs, id_col, text_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    period, cover = cover_of(length)
    total = texts.select(F.sum(F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t))).alias("n")).first()["n"] or 0
    bits = max(1, int(np.ceil(np.log2(max(2.0, total * len(cover) / period / BUCKET_KEYS)))))

    def each(solve: Callable) -> Callable:
        """Rows (slice, ids, texts, flags...) one at a time through ``solve``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    flags = [np.frombuffer(b"".join(batch.column(c)[i].as_py() or []), dtype=np.uint8) for c in range(3, batch.num_columns)]
                    yield solve(batch.column(0)[i].as_py(), batch.column(1)[i].values, batch.column(2)[i].values, *flags)

        return run

    def opened(values: pa.Array, *flags: np.ndarray) -> list[tuple[Slice, np.ndarray | None]]:
        """The levels (bytes, and words where asked for) after the rounds of
        ``flags``; with the third round's, each has its own beside it."""
        levels = [Slice(values, length, bits)]
        levels[0].samples()
        if words:
            levels.append(Words(levels[0], words))
            levels[1].samples()
        for s in levels:
            s.forget()
        own = [None] * len(levels)
        for turn, (sent, f) in enumerate(zip(("codes", "hulls", "high"), flags)):
            ends = np.cumsum([len(getattr(s, sent)) for s in levels])
            own = np.split(f, ends[:-1])
            for s, o in zip(levels, own):
                if turn == 0:
                    s.tie(o.astype(bool))
                elif turn == 1:
                    s.windows(o)
        return list(zip(levels, own))

    def both(i: int, levels: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        """The (bucket, keys...) of all levels; each has buckets of its own."""
        rows = [(bucket + np.uint64(k << bits), *keys) for k, (bucket, *keys) in enumerate(levels)]
        return packed(i, *(np.concatenate(c) for c in zip(*rows)))

    def cores(i, ids, values):
        return both(i, [(s.codes >> np.uint64(32), s.codes.astype("<u4")) for s, _ in opened(values)])

    def hulls(i, ids, values, *flags):
        return both(i, [(s.hull_codes >> np.uint64(32), s.hull_codes.astype("<u4"), s.hulls) for s, _ in opened(values, *flags)])

    def strings(i, ids, values, *flags):
        return both(i, [(s.high >> np.uint64(64 - bits), s.high, s.low) for s, _ in opened(values, *flags)])

    def finish(i, ids, values, *flags):
        levels = opened(values, *flags)
        s, gone = levels[0][0], levels[0][0].repeated(levels[0][1].astype(bool))
        kept, spans, counts = [], [], []
        for a, b in zip(s.starts.tolist(), s.ends.tolist()):
            g = gone[a:b]
            kept.append(s.data[a:b][~g].tobytes())
            edge = np.flatnonzero(np.diff(np.concatenate([[0], g.view(np.int8), [0]])))
            spans.append(edge)
            counts.append(len(edge) // 2)
        edge = np.concatenate([*spans, np.zeros(0, np.int64)]).astype(np.int64)
        pairs = pa.StructArray.from_arrays([pa.array(edge[::2]), pa.array(edge[1::2])], names=["start", "end"])
        cols = [ids, pa.array(s.ends - s.starts), pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pairs), pa.array(kept, pa.binary())]
        for w, again in levels[1:]:
            first, last, counts = w.passages(w.repeated(again.astype(bool)))
            pairs = pa.StructArray.from_arrays([pa.array(first), pa.array(last)], names=["start", "end"])
            cols.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *counts]), pa.int32()), pairs))
        return pa.RecordBatch.from_arrays(cols, names=["id", "n_bytes", "spans", "kept", "passages"][:len(cols)])

    core_flags = bucket_round(texts.mapInArrow(each(cores), "bucket bigint, slice bigint, k0 binary"), parts, ("<u4",), same_core)

    def flagged(flags: DataFrame) -> DataFrame:
        """``texts`` with the flags: the small side is the one that moves."""
        return texts.join(flags.hint("shuffle_hash"), "slice", "left")

    one = core_flags.withColumnRenamed("flags", "f1")
    hull_flags = bucket_round(flagged(one).mapInArrow(each(hulls), "bucket bigint, slice bigint, k0 binary, k1 binary"), parts, ("<u4", "<u8"), same_hull)
    two = written(one.join(hull_flags.withColumnRenamed("flags", "f2"), "slice", "left"))
    string_flags = bucket_round(flagged(two).mapInArrow(each(strings), "bucket bigint, slice bigint, k0 binary, k1 binary"), parts, ("<u8", "<u2"), same_window)
    three = two.join(string_flags.withColumnRenamed("flags", "f3"), "slice", "left")
    id_type = texts.schema["ids"].dataType.elementType.simpleString()
    span_type = "array<struct<start:bigint,end:bigint>>"
    more = f", passages {span_type}" if words else ""
    return flagged(three).mapInArrow(each(finish), f"id {id_type}, n_bytes bigint, spans {span_type}, kept binary{more}")


def op11_suffixdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"), length=400, words=50)

    def covered(spans: str) -> Column:
        return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])

    return found.select(
        F.col("id").alias("doc_id"), "n_bytes",
        covered("spans").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.size("passages").cast("long").alias("n_passages"),
        covered("passages").alias("n_passage_bytes"))
