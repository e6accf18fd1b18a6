"""Line dedup: hashes in range partitions, read in order.

A line's key is the line without white space at its ends and with A-Z
lower-cased.  A key of at least ``min_chars`` code points that stands in at
least ``min_docs`` documents loses all its lines but those of the document
with the largest id.

Per document one row for each distinct key (128-bit hash, id, positions) is
written, then range-partitioned and sorted by (hash, id descending).  The
range takes the id in, so a key that stands in a third of all documents is
spread over many partitions.  A task streams its partition: it remembers the
current key's first document and at most the lines of the second until a
third shows that the key is repeated.  Only for the first and the last key of
a partition a neighbour may know more; for these a task returns its first
three documents and what hangs on them (a few rows for each partition), which
one small join settles.  The result is a compressed keep bitmap for each
document that loses lines, not text; texts move once, to meet their bitmaps.

Defined cases: a null or empty text is one empty line, which stays; ids are
integers, rows of one id count as one document but keep a bitmap each, null
ids count as one document smaller than all others; rows that repeat id and
text get the same bitmap; an empty table gives an empty result; other columns
pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portrait.llm.common import cut, sha256_text, slices, table, text_key, trimmed, written

SPACE = " \t\n\x0b\x0c\r"
UPPER = {i: i + 32 for i in range(65, 91)}
NO_ID = -(1 << 63)
DROP, PENDING, SEEN = 0, 1, 2


def text_lines(text: str | None) -> list[str]:
    return (text or "").split("\n")


def line_keys(docs: DataFrame, min_chars: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(hi, lo, doc, tk, n_lines, at) for every distinct key of a row."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       text_key(F.col(text_col)).alias("tk"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for s, e in slices(texts):
                hashes, row, lines, at = [], [], [], []
                for i in range(s, e):
                    found: dict[bytes, list[int]] = {}
                    split = text_lines(texts[i])
                    for p, line in enumerate(split):
                        key = line.strip(SPACE)
                        if len(key) >= min_chars:
                            found.setdefault(digest(key.translate(UPPER).encode("utf-8", "replace")), []).append(p)
                    hashes.extend(found)
                    at.extend(found.values())
                    row.extend([i] * len(found))
                    lines.extend([len(split)] * len(found))
                h = np.frombuffer(b"".join(hashes), dtype=">i8").astype(np.int64).reshape(-1, 2)
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column(0).take(take), batch.column(1).take(take), pa.array(lines, pa.int32()), pa.array(at, pa.list_(pa.int32()))],
                    names=["hi", "lo", "doc", "tk", "n_lines", "at"])

    return rows.mapInArrow(trimmed(run), "hi long, lo long, doc long, tk long, n_lines int, at array<int>")


#: Rows of a key's first documents that a task holds before it knows whether
#: there are ``min_docs`` of them.
HELD_ROWS = 10_000


def stream_keys(min_docs: int):
    """A function over one partition's rows in order of (key, id descending):
    yields lines to drop, and what only the neighbour partitions can settle."""
    names = ["hi", "lo", "doc", "tk", "n_lines", "at", "kind"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int8()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first_key = None, True
        seen: list[int] = []  # the first min_docs documents of the key
        head: list[tuple] = []  # rows of its first document, if a neighbour may hold a larger one
        wait: list[tuple] = []  # rows of the documents up to min_docs - 1, beside the first
        last = row_before = None
        left_open = False  # rows of the key went out undecided
        out: list[tuple] = []

        def settle() -> None:
            """Return what a key leaves open."""
            out.extend((*key, d, 0, 0, [], SEEN) for d in seen)
            out.extend((*key, *r, PENDING) for r in head + wait)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            hi, lo, doc = (batch.column(i).to_numpy() for i in range(3))
            same = (hi[1:] == hi[:-1]) & (lo[1:] == lo[:-1])
            need = np.zeros(n, dtype=bool)
            need[1:] |= same
            need[:-1] |= same
            need[[0, n - 1]] = True  # keys of one row inside a batch have nothing to drop
            rows = np.flatnonzero(need)
            part = batch.take(pa.array(rows)).to_pydict()
            for a, b, d, tk, lines, at in zip(part["hi"], part["lo"], part["doc"], part["tk"], part["n_lines"], part["at"]):
                if (a, b) != key:
                    if key is not None and (first_key or left_open):
                        settle() if first_key else out.extend((*key, d, 0, 0, [], SEEN) for d in seen)
                        first_key = False
                    key, seen, head, wait, last, row_before, left_open = (a, b), [], [], [], None, None, False
                if (d, tk) == row_before:  # the same text of the same id says the same again
                    continue
                row_before = (d, tk)
                if d != last:
                    last = d
                    if len(seen) < min_docs:
                        seen.append(d)
                        if len(seen) == min_docs:
                            out.extend((*key, *r, DROP) for r in wait)
                            wait = []
                row = (d, tk, lines, at)
                if d == seen[0]:
                    if first_key:
                        head.append(row)
                elif len(seen) < min_docs:
                    wait.append(row)
                else:
                    out.append((*key, *row, DROP))
                if len(head) + len(wait) > HELD_ROWS:
                    out.extend((*key, *r, PENDING) for r in head + wait)
                    head, wait, left_open = [], [], True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out.clear()
        if key is not None:
            settle()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return run


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tk, n_lines, n_dropped, bitmap) for every row that loses lines.
    bitmap: zlib of one bit a line, 1 = stays, first line in the high bit."""
    keys = written(line_keys(docs, min_chars, id_col, text_col))
    order = ["hi", "lo", F.desc("doc"), "tk"]  # one id (or none) may be on many rows
    dealt = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut(dealt.mapInArrow(stream_keys(min_docs), "hi long, lo long, doc long, tk long, n_lines int, at array<int>, kind byte"))
    # at most two keys for each partition, and one for each HELD_ROWS rows
    open_keys = (found.where(F.col("kind") == SEEN).groupBy("hi", "lo")
                 .agg(F.countDistinct("doc").alias("docs"), F.max("doc").alias("largest")).where(F.col("docs") >= min_docs))
    late = (found.where(F.col("kind") == PENDING).join(F.broadcast(open_keys), ["hi", "lo"]).where("doc < largest")
            .select("doc", "tk", "n_lines", "at"))
    drops = found.where(F.col("kind") == DROP).select("doc", "tk", "n_lines", "at").union(late)
    lost = (drops.groupBy("doc", "tk").agg(F.max("n_lines").alias("n_lines"), F.array_distinct(F.flatten(F.collect_list("at"))).alias("lost")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for n, lost in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                keep = np.ones(n, dtype=bool)
                keep[lost] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array([len(x) for x in batch.column(3).to_pylist()], pa.int32()), pa.array(maps, pa.binary())],
                                             names=["doc", "tk", "n_lines", "n_dropped", "bitmap"])

    return lost.mapInArrow(trimmed(run), "doc long, tk long, n_lines int, n_dropped int, bitmap binary")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, carry: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n_lines, n_dropped, kept): ``row`` holds the ``carry`` columns,
    ``kept`` the lines that stay, joined."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("_text"),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc"), text_key(F.col(f"`{text_col}`")).alias("tk"))
    met = rows.join(bitmaps.select("doc", "tk", "bitmap").hint("shuffle_hash"), ["doc", "tk"], "left").select("row", "_text", "bitmap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, maps = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for s, e in slices(texts):
                lines, dropped, kept = [], [], []
                for text, bits in zip(texts[s:e], maps[s:e]):
                    if bits is None:
                        lines.append((text or "").count("\n") + 1)
                        dropped.append(0)
                        kept.append(text or "")
                        continue
                    split = text_lines(text)
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(bits), dtype=np.uint8), count=len(split)).astype(bool).tolist()
                    stay = [x for x, k in zip(split, keep) if k]
                    lines.append(len(split))
                    dropped.append(len(split) - len(stay))
                    kept.append("\n".join(stay))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, e - s), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=["row", "n_lines", "n_dropped", "kept"])

    schema = StructType().add("row", rows.schema["row"].dataType)
    for f in StructType.fromDDL("n_lines long, n_dropped long, kept string").fields:
        schema = schema.add(f)
    return met.mapInArrow(trimmed(run), schema)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, each text with the lines that stay."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_chars, min_docs, id_col, text_col), docs.columns, id_col, text_col)
    return kept.select(*[F.col("kept").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op7_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_chars=20, min_docs=3), ["doc_id"])
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", sha256_text(F.col("kept")).alias("kept_sha256"))


OP7_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
repeated AS (
    SELECT key, max(doc_id) AS largest FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
    SELECT k.*, r.key IS NOT NULL AND k.doc_id < r.largest AS dropped
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
