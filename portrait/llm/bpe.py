"""BPE encoding and decoding with a pair occurrence index.

Spark partitions the texts; inside a task the distinct words of a slice of
texts are merged together.  An index maps every adjacent pair that has a
merge rank to all its positions in the slice.  The active ranks are taken in
ascending order from a heap; all positions of the pair are merged at once and
the lists of the neighbouring pairs are updated.  This equals merging each
word on its own because a pair that a merge creates always has a higher rank
than that merge (checked when the vocabulary is loaded).

The vocabulary is a broadcast of fixed size (its number of tokens does not
depend on the data).  No shuffle; memory is bounded by ``SLICE_CHARS`` of
text, a group of ``GROUP_CHARS`` of them or ``GROUP_CHUNKS`` different chunks,
and ``CACHE_BYTES`` of remembered ones a task.

Defined cases: a null text encodes as the empty text (no ids); repeated rows
and ties are encoded each on its own; an empty table gives an empty result;
other columns are ignored; a text of any length is encoded whole.  Decoding
null gives the empty text; ids outside the vocabulary are skipped.  Character
classes are those of the running Python (letters added to Unicode after its
version count as "other").
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections import ChainMap
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm.common import SLICE_CHARS, sha256_text, slices, table, trimmed

#: Chunks of text, and words, whose ids a task remembers at most, and the bytes
#: of either memory.
CACHE_WORDS = 400_000
CACHE_BYTES = 100_000_000
#: Texts are merged together up to so many characters or different chunks.
GROUP_CHARS = 16_000_000
GROUP_CHUNKS = 300_000
#: Positions that enter the pair index at one time.
NOTE_POSITIONS = 1_000_000


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level BPE."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {b: chr(b) for b in own}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(own))
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Tokens, merges, special tokens and text rules of a tokenizer file of
    the kind "BPE with word ends" (see the README of the vocabulary files)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or spec.get("decoder"):
            raise ValueError(f"{path} is not a BPE vocabulary with word ends")
        suffix = model["end_of_word_suffix"] or ""
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: list[str | None] = [None] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in chain(vocab.items(), self.special.items()):
            self.tokens[i] = token
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], dtype=np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        latest = dict(zip(self.made.tolist(), range(len(pairs))))
        for rank, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
            if max(latest.get(a, -1), latest.get(b, -1)) >= rank:
                raise ValueError("a merge uses a token that a later merge makes")
        self.size = len(self.tokens)
        keys = self.left * self.size + self.right
        self.rank_of = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of]
        self.split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge rank of each pair; -1 where it has none."""
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of[at], -1)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Token ids (int32 bytes) of each (normalised, non-empty) word."""
        raw = [w.encode("utf-8", "replace") for w in words]
        sizes = np.array([len(w) for w in raw], dtype=np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        n, ends = len(data), np.cumsum(sizes)
        # one slot more: slot n stands for "no neighbour"
        place = np.int32 if n < 2**31 - 2 else np.int64
        sym = np.append(self.inner[data], -1).astype(np.int32)
        sym[ends - 1] = self.last[data[ends - 1]]
        nxt, prv = np.arange(1, n + 2, dtype=place), np.arange(-1, n, dtype=place)
        nxt[ends - 1] = n
        prv[ends - sizes] = n
        nxt[n] = prv[n] = n
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter the pairs that begin at these positions."""
            rank = self.ranks(sym[at], sym[nxt[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.append(0, cuts)].tolist(), np.split(at, cuts)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heapq.heappush(heap, r)

        for s in range(0, n, NOTE_POSITIONS):
            note(s + np.flatnonzero(nxt[s:min(n, s + NOTE_POSITIONS)] != n).astype(place))
        while heap:
            r = heapq.heappop(heap)
            lists = index.pop(r)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b = self.left[r], self.right[r]
            at = at[(sym[at] == a) & (sym[nxt[at]] == b)]
            if a == b and len(at) > 1:  # runs of one letter: pair them off from the left
                taken, free = [], -1
                for p in np.sort(at).tolist():
                    if p != free:
                        taken.append(p)
                        free = nxt[p]
                    else:
                        free = -1
                at = np.array(taken, dtype=place)
            if not len(at):
                continue
            gone = nxt[at]
            sym[at], sym[gone] = self.made[r], -2
            after = nxt[gone]
            nxt[at] = after
            prv[after] = at
            nxt[n] = prv[n] = n
            before = prv[at]
            note(np.unique(np.concatenate([before[before != n], at[after != n]])))
        alive = sym[:n] >= 0
        ids = sym[:n][alive].astype(np.int32).tobytes()
        upto = 4 * np.concatenate([[0], np.cumsum(alive)])
        return [ids[s:e] for s, e in zip(upto[ends - sizes].tolist(), upto[ends].tolist())]


def text_chunks(vocabulary: Vocabulary):
    """Two functions: text -> its chunks between white space in order (str;
    a special token in the text is the int of its id), and chunk -> its
    normalised words.  A word never holds white space, so chunks can be
    remembered with their ids."""
    white, odd = regex.compile(r"\s+"), regex.compile("[\x1c-\x1f]")
    word = regex.compile(vocabulary.split)
    special = vocabulary.special
    names = sorted(special, key=len, reverse=True)
    mark = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

    def split(text: str) -> list:
        # str.split() takes four control characters for white space, the vocabulary does not
        return [x for x in white.split(text) if x] if odd.search(text) else text.split()

    def chunks(text: str) -> list:
        if mark is None or not any(x in text for x in names):
            return split(text)
        out: list = []
        for part in mark.split(text):
            out.extend([special[part]] if part in special else split(part))
        return out

    def words(chunk: str) -> list[str]:
        # letter by letter: the one rule of lower() that looks around is the final sigma
        return word.findall(chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())

    return chunks, words


def chunk_encoder(vocabulary: Vocabulary):
    """A function: chunk lists of some texts -> a mapping that has the ids
    (int32 bytes) of each chunk in them.  It remembers chunks, and beside
    them words, and forgets the oldest beyond ``CACHE_WORDS`` or
    ``CACHE_BYTES``."""
    _, words = text_chunks(vocabulary)
    as_bytes = {i: np.int32(i).tobytes() for i in vocabulary.special.values()}
    known: dict = dict(as_bytes)
    merged: dict[str, bytes] = {}
    held = {id(known): 0, id(merged): 0}

    def weight(entries: dict) -> int:
        return sum(map(len, entries)) + sum(map(len, entries.values())) + 200 * len(entries)

    def remember(cache: dict, new: dict, keep: set) -> None:
        """Enter ``new``; if there is no room older entries go, but for those
        in ``keep``."""
        size = held[id(cache)] + weight(new)
        over = len(cache) + len(new) - len(as_bytes) - CACHE_WORDS
        if over > 0 or size > CACHE_BYTES:
            gone = []
            for key, ids in cache.items():
                if over <= 0 and size <= CACHE_BYTES:
                    break
                if key not in as_bytes and key not in keep:
                    gone.append(key)
                    size -= len(key) + len(ids) + 200
                    over -= 1
            for key in gone:
                del cache[key]
        cache.update(new)
        held[id(cache)] = size

    def ids_of(split: list[list]) -> dict:
        every = set().union(*split)
        fresh = [c for c in every if c not in known]
        if fresh:
            parts = [words(c) for c in fresh]
            distinct = list({w for ws in parts for w in ws if w not in merged})
            got = dict(zip(distinct, vocabulary.encode_words(distinct))) if distinct else {}
            get = (merged | got).__getitem__ if len(got) > len(merged) else ChainMap(got, merged).__getitem__
            new = {c: get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws)) for c, ws in zip(fresh, parts)}
            remember(merged, got, set())
            remember(known, new, every)
        return known

    return ids_of


def _encoded(shared, out: list[str]):
    """A function over batches (id, text): ids, and with ``decoded`` in
    ``out`` the text that they decode to, in one pass.  Texts wait until
    ``GROUP_CHARS`` of them, or ``GROUP_CHUNKS`` different chunks, are there;
    these are merged together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        chunks, _ = text_chunks(vocabulary)
        ids_of = chunk_encoder(vocabulary)
        tokens = vocabulary.tokens

        def emit(group: list[pa.RecordBatch], seen: set) -> Iterator[pa.RecordBatch]:
            get = ids_of([seen]).__getitem__
            for batch in group:
                split = [chunks(t) if t else [] for t in batch.column(1).to_pylist()]
                raw = [b"".join(map(get, c)) for c in split]
                offsets = np.cumsum([0, *map(len, raw)]) // 4
                ids = np.frombuffer(b"".join(raw), dtype=np.int32)
                cols = [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))]
                if "decoded" in out:
                    names, upto = list(map(tokens.__getitem__, ids.tolist())), offsets.tolist()
                    cols.append(pa.array([" ".join(names[s:e]) for s, e in zip(upto, upto[1:])], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=out)

        group: list[pa.RecordBatch] = []
        seen: set = set()
        chars = 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s, e in slices(texts, SLICE_CHARS // 4):
                if chars >= GROUP_CHARS or len(seen) >= GROUP_CHUNKS:
                    yield from emit(group, seen)
                    group, seen, chars = [], set(), 0
                group.append(batch.slice(s, e - s))
                for t in texts[s:e]:
                    if t:
                        seen.update(chunks(t))
                        chars += len(t)
            del texts
        if group:
            yield from emit(group, seen)

    return trimmed(run)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    id_type = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_encoded(shared, [id_col, "ids"]), f"`{id_col}` {id_type}, ids array<int>")


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>, decoded) of every row of ``docs``: ``encode``
    and ``decode`` in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    id_type = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(_encoded(shared, [id_col, "ids", "decoded"]), f"`{id_col}` {id_type}, ids array<int>, decoded string")


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids: the tokens joined by one space
    (this kind of vocabulary has no rule that takes the word ends away)."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value.tokens
        known = {i for i, t in enumerate(tokens) if t is not None}
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            sizes = np.cumsum(np.nan_to_num(batch.column(at).value_lengths().to_numpy(zero_copy_only=False)))
            s = 0
            while s < batch.num_rows:
                e = max(s + 1, int(np.searchsorted(sizes, (sizes[s - 1] if s else 0) + SLICE_CHARS // 8, side="right")))
                part = batch.slice(s, e - s)
                texts = []
                for ids in part.column(at).to_pylist():
                    if ids and not known.issuperset(ids):
                        ids = [i for i in ids if i in known]
                    texts.append(" ".join([tokens[i] for i in ids]) if ids else "")
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out_col])
                s = e

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, `{out_col}` string")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = encode_decode(table(spark, sf_dir, "documents"), path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256_text(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256_text(F.col("decoded")).alias("decoded_sha256"),
    )
