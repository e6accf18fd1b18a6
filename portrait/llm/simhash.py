"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has a bit set where more than half of its shingles'
XXH64 values have it.  Two fingerprints within ``max_bits`` bits agree within
t = max_bits // 2 bits on their lower or on their upper 32 bits, so each half
is covered on its own by a code: ``code_blocks`` Hamming [7,4] codes (perfect,
covering radius 1 each) beside free bits (radius 0), that is a code of
covering radius R = code_blocks.  Its words are the anchors.  A half's home is
its nearest anchor (within R); a fingerprint is replicated to every anchor
within R + t that can be the home of a half within t bits of its own, and to
no other (at most 33 anchors for t = 1).  Per anchor, replicas are compared
with the fingerprints that are at home there, on all 64 bits.

Scale.  Equal fingerprints are one row before the replication.  Rows are
dealt by (anchor, chunk): an anchor that is home to more than ``chunk_rows``
fingerprints is split into chunks, its replicas go to every chunk, and a task
holds the home rows of one chunk and streams the replicas past them.  A batch
of comparisons returns one row per linked fingerprint (its least partner in
that batch's components), never all pairs of a group.  Components are then
joined up by ``connected_components``.

Defined cases: null and empty texts and texts without words have fingerprint
zero and link like any other; rows of equal fingerprint are one group; an
empty table gives an empty result; other columns are ignored.  A repeated
doc_id is returned for each row.  A null doc_id never names a component
unless all its members are null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm.common import cut, table, trimmed, written
from portrait.llm.components import connected_components

#: Home fingerprints that a task holds of one anchor at a time.
CHUNK_ROWS = 2048
#: Rows of the table of split anchors (16 bytes each) that may be broadcast.
HOT_ROWS = 200_000
#: Comparisons made at one time.
PAIRS = 2_000_000


def text_fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a text (see ``op3`` for its rules)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    size = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - size + 1
    counts = np.zeros(8 * 256, dtype=np.int64)
    slot = np.arange(8) * 256
    ends = ends[size - 1:].tolist()
    for s in range(0, n, 100_000):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[s:s + 100_000], ends[s:s + 100_000])], dtype="<u8")
        counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + slot).ravel(), minlength=2048)
    bits = (np.arange(256)[:, None] >> np.arange(8)) & 1
    of_bit = (counts.reshape(8, 256) @ bits).ravel()
    return int(np.packbits(2 * of_bit > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp long) of every row."""
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([text_fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=[id_col, "fp"])

    return rows.mapInArrow(trimmed(run), f"`{id_col}` {rows.schema[0].dataType.simpleString()}, fp long")


def hamming_nearest() -> np.ndarray:
    """The nearest word of the Hamming [7,4] code for each 7-bit word: the
    positions (1 to 7) of a word's set bits sum, by XOR, to its wrong bit."""
    words = np.arange(128)
    wrong = np.zeros(128, dtype=np.int64)
    for i in range(7):
        wrong ^= np.where((words >> i) & 1, i + 1, 0)
    return np.where(wrong > 0, words ^ (1 << np.maximum(wrong - 1, 0)), words).astype(np.uint32)


def homes(half: np.ndarray, code_blocks: int) -> np.ndarray:
    """The nearest anchor of each 32-bit half."""
    nearest = hamming_nearest()
    out = half.copy()
    for b in range(code_blocks):
        shift = np.uint32(7 * b)
        part = (half >> shift) & np.uint32(127)
        out ^= (part ^ nearest[part]) << shift
    return out


def replicate(classes: DataFrame, near: int, code_blocks: int) -> DataFrame:
    """(anchor, home, fp): each fingerprint at its home anchor and at every
    anchor that is home to a half within ``near`` bits of its own."""
    flips = np.array([sum(1 << i for i in c) for n in range(near + 1) for c in combinations(range(32), n)], dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in range(0, len(fps), 20_000):
                fp = fps[s:s + 20_000]
                bits = fp.view(np.uint64)
                for half in (0, 1):
                    h = ((bits >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    key = (homes(h, code_blocks).astype(np.int64) << 1) | half
                    near_keys = np.sort(homes(h[:, None] ^ flips[None, :], code_blocks), axis=1)
                    first = np.ones(near_keys.shape, dtype=bool)
                    first[:, 1:] = near_keys[:, 1:] != near_keys[:, :-1]
                    row, col = np.nonzero(first)
                    anchor = np.concatenate([key, (near_keys[row, col].astype(np.int64) << 1) | half])
                    home = np.concatenate([np.ones(len(fp), dtype=bool), np.zeros(len(row), dtype=bool)])
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(home), pa.array(np.concatenate([fp, fp[row]]))], names=["anchor", "home", "fp"])

    return classes.select("fp").mapInArrow(trimmed(run), "anchor long, home boolean, fp long")


def component_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the nodes of these edges, root being the least node
    of the component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


def compare(max_bits: int):
    """A function over rows (anchor, chunk, home, fp) sorted by anchor and
    chunk with home rows first: yields edges (u, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.int64)]  # home rows of the group that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, chunk, home, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            anchor = np.concatenate([kept[0], anchor])
            chunk = np.concatenate([kept[1], chunk.astype(np.int64)])
            fp = np.concatenate([kept[2], fp])
            home = np.concatenate([np.ones(len(kept[0]), dtype=bool), home.astype(bool)])
            fresh = len(kept[0])
            start = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (chunk[1:] != chunk[:-1])))
            group = np.cumsum(np.isin(np.arange(len(anchor)), start, assume_unique=True)) - 1
            k = np.bincount(group, weights=home, minlength=len(start)).astype(np.int64)
            last = start[-1]
            kept = [x[last:last + k[-1]] for x in (anchor, chunk, fp)]
            other = np.flatnonzero(~home)
            other = other[(other >= fresh) & (k[group[other]] > 0)]
            if not len(other):
                continue
            width = k[group[other]]
            upto = np.cumsum(width)
            s = 0
            while s < len(other):
                e = max(s + 1, int(np.searchsorted(upto, (upto[s - 1] if s else 0) + PAIRS, side="right")))
                w = width[s:e]
                y = np.repeat(other[s:e], w)
                x = np.repeat(start[group[other[s:e]]], w) + np.arange(len(y)) - np.repeat(np.cumsum(w) - w, w)
                gap = np.bitwise_count((fp[x] ^ fp[y]).view(np.uint64))
                hit = (gap > 0) & (gap <= max_bits)
                if hit.any():
                    node, root = component_roots(fp[x[hit]], fp[y[hit]])
                    far = node != root
                    yield pa.RecordBatch.from_arrays([pa.array(root[far]), pa.array(node[far])], names=["u", "v"])
                s = e

    return run


def links(classes: DataFrame, max_bits: int = 3, code_blocks: int = 2, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of distinct
    fingerprints within ``max_bits`` bits."""
    near = max_bits // 2
    rows = replicate(classes, near, code_blocks)
    split = cut(rows.where("home").groupBy("anchor").count().where(F.col("count") > chunk_rows)
                .select("anchor", F.ceil(F.col("count") / chunk_rows).cast("int").alias("chunks")))
    n = split.count()
    if n:
        rows = rows.join(F.broadcast(split) if n <= HOT_ROWS else split, "anchor", "left")
        own = F.array(F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
        rows = rows.select("anchor", F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).when(F.col("home"), own).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1))).alias("chunk"), "home", "fp")
    else:
        rows = rows.select("anchor", F.lit(0).alias("chunk"), "home", "fp")
    dealt = rows.repartition("anchor", "chunk").sortWithinPartitions("anchor", "chunk", F.desc("home"))
    return dealt.mapInArrow(compare(max_bits), "u long, v long")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3, code_blocks: int = 2,
                   chunk_rows: int = CHUNK_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp long, component_id) of every row: ``component_id`` is the
    least id of all rows reachable over links of at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 5:
        raise ValueError("max_bits must be 0 to 5")
    prints = cut(fingerprints(docs, shingle, id_col, text_col))
    classes = cut(prints.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = connected_components(links(classes, max_bits, code_blocks, chunk_rows))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return (prints.join(rooted.select("fp", "root").join(named, "root").select("fp", "component_id"), "fp")
            .select(id_col, "fp", "component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group of ``docs``, all columns: the one
    with the least id (a null id comes after all others), and of rows that
    share it the one with the least number in a written table."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("n"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")))
    own = F.col(f"doc.`{id_col}`")
    keyed = rows.select(F.struct(own.isNull().alias("last"), own.alias("id"), "n").alias("row_key"), F.col(f"doc.`{text_col}`").alias("text"))
    groups = simhash_groups(keyed, shingle, max_bits, id_col="row_key", text_col="text")
    first = groups.where(F.col("row_key") == F.col("component_id")).select("row_key.n")
    return rows.join(first.hint("shuffle_hash"), "n", "left_semi").select("doc.*")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
