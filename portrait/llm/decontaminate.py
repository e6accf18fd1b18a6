"""Benchmark decontamination with suffix arrays of the training texts.

The documents are the training shards: each task builds, slice by slice, the
suffix array of its documents' words and binary-searches every suffix of
every benchmark item in it.  A suffix that occurs to the depth of a window
(``window`` words, or the whole of a shorter item) gives the range of all its
places; places that follow each other in both texts join into the longest
verbatim matches.  ``longest`` is 0 for a document whose longest shared
passage with an item is shorter than a window (or than the whole item).

The array is sorted by as many words as a window has, and leaves out suffixes
that cannot match because one of their first words is in no benchmark item
(or the document ends).  No shuffle: a document lies in one slice, so its
counts are complete there.  The benchmark goes to the tasks in blocks of at
most ``BLOCK_WORDS`` words, each a broadcast of that bounded size; the driver
holds one block at a time and a task loads one after the other, so a larger
benchmark costs more passes over a slice's words, not more memory.

Defined cases: null texts have no words; an item without words has no window;
an item with a null id counts for the words that are hit, but is in no list of
items (``longest_item`` is null where only such items match longest);
equal windows of several items count for each of them, items of equal words are
kept and searched once; repeated ids and rows
are judged row by row; an empty benchmark hits nothing and an empty document
table gives an empty result; other columns pass through ``remove_matches``
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from portrait.llm.common import SLICE_CHARS, slices, table, trimmed

#: Words of one block of benchmark items (a longer item is a block of its own).
BLOCK_WORDS = 1_000_000
#: Matches (place in a document, place in an item) held at one time.
MATCHES = 2_000_000

RESULT = "n_words long, n_hit long, items array<string>, longest long, longest_item string, longest_at long, longest_item_at long"


def word_splitter():
    """text -> its words as bytes: runs of 0-9, a-z and every character
    beyond ASCII, A-Z lower-cased."""
    keep = bytes(c if chr(c).isdigit() and c < 128 or c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))
    return lambda text: (text or "").encode("utf-8", "replace").translate(keep).split()


@dataclass
class Block:
    """Some benchmark items: their words' ids (from 1) and their distinct
    windows with the places where each stands."""

    ids: dict[bytes, int]
    names: list[list[str]]  # ids of the items with the same words, sorted, nulls left out
    windows: np.ndarray  # (distinct windows, window), 0 beyond the end
    lengths: np.ndarray
    first_place: np.ndarray  # window -> its run of places
    place_item: np.ndarray
    place_at: np.ndarray


def make_block(items: list[tuple[str | None, list[bytes]]], window: int) -> Block:
    ids: dict[bytes, int] = {}
    rows, item, at = [], [], []
    same: dict[tuple, list[str]] = {}
    for name, words in items:
        names = same.setdefault(tuple(words), [])
        if name is not None:
            names.append(name)
    for k, words in enumerate(same):
        seq = [ids.setdefault(w, len(ids) + 1) for w in words]
        for j in range(max(1, len(seq) - window + 1)):
            rows.append(seq[j:j + window] + [0] * (window - len(seq)))
            item.append(k)
            at.append(j)
    windows, kind = np.unique(np.array(rows, dtype=np.int32).reshape(-1, window), axis=0, return_inverse=True)
    order = np.argsort(kind, kind="stable")
    first = np.searchsorted(kind[order], np.arange(len(windows) + 1))
    return Block(ids, [sorted(x) for x in same.values()], windows, (windows > 0).sum(axis=1), first, np.array(item)[order], np.array(at)[order])


def blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[Block]:
    """The items in blocks, one at a time (each comes to the driver alone)."""
    split, items, total = word_splitter(), [], 0
    for row in benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        words = split(row[1])
        if not words:
            continue
        if items and total + len(words) > BLOCK_WORDS:
            yield make_block(items, window)
            items, total = [], 0
        items.append((row[0], words))
        total += len(words)
    if items:
        yield make_block(items, window)


def bound(col: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each value in its own run col[lo:hi]."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        seen = col[np.minimum(mid, len(col) - 1)]
        up = open_ & ((seen <= value) if right else (seen < value))
        lo = np.where(up, mid + 1, lo)
        hi = np.where(open_ & ~up, mid, hi)
    return lo


def occurrences(words: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence.  ``words``: the ids of a slice's
    words, 0 for words of no item and between documents."""
    n, depth = len(words), block.windows.shape[1]
    none = np.zeros(0, dtype=np.int64)
    stops = np.append(np.flatnonzero(words == 0), n)
    room = stops[np.searchsorted(stops, np.arange(n))] - np.arange(n)
    suffixes = np.flatnonzero(room >= block.lengths.min())
    if not len(suffixes):
        return none, none
    padded = np.append(words, np.zeros(depth, dtype=words.dtype))
    cols = [np.where(room[suffixes] > d, padded[suffixes + d], 0) for d in range(depth)]
    order = np.lexsort(cols[::-1])
    array, cols = suffixes[order], [c[order] for c in cols]
    lo = np.zeros(len(block.windows), dtype=np.int64)
    hi = np.full(len(block.windows), len(array), dtype=np.int64)
    for d in range(depth):
        live = np.flatnonzero((block.lengths > d) & (lo < hi))
        if not len(live):
            break
        value = block.windows[live, d]
        low = bound(cols[d], lo[live], hi[live], value, False)
        hi[live] = bound(cols[d], low, hi[live], value, True)
        lo[live] = low
    count = np.maximum(hi - lo, 0)
    kind = np.repeat(np.arange(len(count)), count)
    run = np.arange(len(kind)) - np.repeat(np.cumsum(count) - count, count)
    place = array[np.repeat(lo, count) + run]
    order = np.lexsort([kind, place])
    return place[order], kind[order]


def scan_slice(texts: list, loaded, split) -> dict[str, list]:
    """The result columns for these texts.  ``loaded``: yields the blocks."""
    words = [split(t) for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    n = int((sizes + 1).sum())
    hit = np.zeros(n, dtype=bool)
    items: list[set] = [set() for _ in texts]
    longest: list[tuple] = [(0, None, None, None)] * len(texts)
    for block in loaded():
        get, ids = block.ids.get, np.zeros(n, dtype=np.int32)
        for s, w in zip(starts.tolist(), words):
            ids[s:s + len(w)] = [get(x, 0) for x in w]
        place, kind = occurrences(ids, block)
        if not len(place):
            continue
        edge = np.zeros(n + 1, dtype=np.int64)
        np.add.at(edge, place, 1)
        np.add.at(edge, place + block.lengths[kind], -1)
        hit |= np.cumsum(edge)[:n] > 0
        doc = np.searchsorted(starts, place, side="right") - 1
        # which items: each window of a document once, however often it stands there
        for key in np.unique(doc * len(block.windows) + kind).tolist():
            i, k = divmod(key, len(block.windows))
            for x in set(block.place_item[block.first_place[k]:block.first_place[k + 1]].tolist()):
                items[i].update(block.names[x])
        width = block.first_place[kind + 1] - block.first_place[kind]
        upto, s = np.cumsum(width), 0
        while s < len(place):
            e = max(s + 1, int(np.searchsorted(upto, (upto[s - 1] if s else 0) + MATCHES, side="right")))
            while e < len(place) and doc[e] == doc[e - 1]:  # a document's matches stay together
                e += 1
            w = width[s:e]
            at = np.repeat(block.first_place[kind[s:e]], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            item, item_at = block.place_item[at], block.place_at[at]
            where, size, d = (np.repeat(x, w) for x in (place[s:e], block.lengths[kind[s:e]], doc[s:e]))
            order = np.lexsort([where, where - item_at, item, d])
            item, item_at, where, size, d = (x[order] for x in (item, item_at, where, size, d))
            new = np.ones(len(item), dtype=bool)
            new[1:] = (item[1:] != item[:-1]) | (d[1:] != d[:-1]) | (where[1:] != where[:-1] + 1) | (where[1:] - item_at[1:] != where[:-1] - item_at[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(new)) - 1
            total = where[last] + size[last] - where[first]
            for i, length, k, a, b in zip(d[first].tolist(), total.tolist(), item[first].tolist(), (where[first] - starts[d[first]]).tolist(), item_at[first].tolist()):
                name = block.names[k][0] if block.names[k] else None
                rank = lambda n, *at: (n is None, n or "", *at)  # noqa: E731  least item, nulls last
                if length > longest[i][0] or length == longest[i][0] and rank(name, a, b) < rank(*longest[i][1:]):
                    longest[i] = (length, name, a, b)
            s = e
    sums = np.concatenate([[0], np.cumsum(hit)])
    return {
        "n_words": sizes.tolist(),
        "n_hit": (sums[starts + sizes] - sums[starts]).tolist(),
        "items": [sorted(x) for x in items],
        "longest": [x[0] for x in longest],
        "longest_item": [x[1] for x in longest],
        "longest_at": [x[2] for x in longest],
        "longest_item_at": [x[3] for x in longest],
    }


RESULT_TYPES = {"n_words": pa.int64(), "n_hit": pa.int64(), "items": pa.list_(pa.string()), "longest": pa.int64(),
                "longest_item": pa.string(), "longest_at": pa.int64(), "longest_item_at": pa.int64()}


def scan(docs: DataFrame, benchmark: DataFrame, carry: list[str], window: int = 10, text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``row`` (a struct of the ``carry`` columns), its
    words, the words inside an occurrence of a benchmark window, the items
    with such windows (sorted as strings) and the longest verbatim match: its
    words, item, and first word in the document and in the item (ties: the
    least item, then the first place)."""
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(b) for b in blocks(benchmark, window, item_col, item_text_col)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.col(f"`{text_col}`").alias("_text"))

    def loaded() -> Iterator[Block]:
        for b in shared:
            yield b.value
            if len(shared) > 1:
                b.__dict__.pop("_value", None)  # read again from the worker's file for the next slice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = word_splitter()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s, e in slices(texts, SLICE_CHARS):
                found = scan_slice(texts[s:e], loaded, split)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(s, e - s), *(pa.array(v, RESULT_TYPES[k]) for k, v in found.items())], names=["row", *found])

    schema = StructType().add("row", rows.schema["row"].dataType)
    for f in StructType.fromDDL(RESULT).fields:
        schema = schema.add(f)
    return rows.mapInArrow(trimmed(run), schema)


def remove_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, without a word inside a match."""
    return scan(docs, benchmark, docs.columns, window, text_col, item_col, item_text_col).where("n_hit = 0").select("row.*")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"], window=10)
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest", "longest_item", "longest_at", "longest_item_at",
    )
