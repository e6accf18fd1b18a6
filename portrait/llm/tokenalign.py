"""Alignment of the tokens of two tokenizers over the same texts.

Side A is a byte-level BPE file of the tokenizers library, side B a
sentencepiece model.  Each text is tokenised by both; where the bytes of
either side's tokens are not exactly " " + text, the text has no tokens.

* **Overlaps** come from ``pandas.merge_asof`` over a batch of documents,
  keyed by document: each A token finds the B token that covers its start and
  each B token the A token that covers its own.  Every overlapping pair shows
  up in one of the directions (the later of the two starts lies in the other
  token), in both where the starts are equal, which is taken once.
* **Groups** end where tokens of both sides end.
* **Counts.**  A block of documents (``BLOCK_CHARS``) keeps a dictionary of its
  different id pairs with the number of its documents that hold each; the
  documents refer to it by position.  Counts over the corpus are a partial
  aggregation over the dictionaries, and only dictionary entries are joined
  with the counts: a pair that all documents hold is one row for each block.

Memory is bounded by a block (a longer text is a block of its own).  What is
broadcast is the two tokenizer files and one number for each id of A.

Defined cases: a null or empty text has no tokens; repeated rows are documents
of their own and count each; ties for the highest count are all "best"; an
empty table gives an empty result; strings of special tokens in a text are
plain text; further columns are ignored.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm.bpe import byte_letters
from portrait.llm.common import slices, table, trimmed, written

#: Characters whose documents share a dictionary of id pairs.
BLOCK_CHARS = 4_000_000
#: Characters that are aligned, and that are tokenised, at one time.
ALIGN_CHARS = 500_000
TOKEN_CHARS = 50_000
#: Bytes of remembered segments a task (as many older ones stay beside them),
#: and parts known as plain.
CACHE_BYTES = 80_000_000
PLAIN_PARTS = 300_000
#: What may open a segment and end one: no white space, marks or controls there.
opens = regex.compile(r"[^\s\p{C}\p{Z}\p{M}]")
closes = regex.compile(r"[^\s\p{C}\p{Z}]\Z")
#: A piece that holds a space after something else.
inside = regex.compile("[^▁]▁")


class Sides:
    """Both tokenizers: ids of texts and the bytes of each id.

    Texts are tokenised by *segment*: what stands between two single spaces.
    Byte-level BPE cuts a text by its pattern before a space that follows a
    letter, digit or mark, and no piece of B goes on over such a place, so a
    segment's tokens do not depend on what is around it; they are remembered.
    Where the files do not warrant this, a text is one segment."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte_of = {c: i for i, c in enumerate(byte_letters())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        spec = json.loads(a_json)
        before = spec.get("pre_tokenizer") or {}
        self.local = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and not spec.get("normalizer")
                      and not any(inside.search(p) for p in pieces) and self.b.encode("a b  c") == self.b.encode("a b") + self.b.encode(" c"))
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.known: dict[str, tuple[bytes, bytes] | None] = {}
        self.older: dict[str, tuple[bytes, bytes] | None] = {}
        self.bad: set[str] = set()  # those known as None
        self.held = 0
        self.plain: set[str] = set()

    def segments(self, text: str) -> list[str]:
        """The segments of a text; each follows a space that is its own."""
        if not self.local:
            return [text]
        parts = text.split(" ")
        odd = set()
        for part in set(parts) - self.plain:
            if part.isalnum() or part and opens.match(part) and closes.search(part):
                if len(part) < 40:
                    self.plain.add(part)
            else:
                odd.add(part)
        if len(self.plain) > PLAIN_PARTS:
            self.plain.clear()
        if not odd:
            return parts
        out: list[str] = []
        loose = True  # the segment before is not closed for the next
        for part in parts:
            fits = ends = True
            if part in odd:
                fits, ends = bool(part) and bool(opens.match(part)), bool(part) and bool(closes.search(part))
            if out and (loose or not fits):
                out[-1] += " " + part
            else:
                out.append(part)
            loose = not ends
        return out

    def _side(self, ids: list[list[int]], names: list[bytes], sizes: np.ndarray, want: bytes, upto: np.ndarray) -> list[bytes] | None:
        """Ids (bytes) of segments that end at ``upto`` in ``want``; None where
        these are not the tokens' bytes and ends."""
        flat = list(chain.from_iterable(ids))
        if b"".join(map(names.__getitem__, flat)) != want:
            return None
        flat = np.array(flat, dtype="<i4")
        ends = np.cumsum(sizes[flat])
        at = np.searchsorted(ends, upto)
        if (ends[at] != upto).any():
            return None
        cuts = (4 * np.concatenate([[0], at + 1])).tolist()
        data = flat.tobytes()
        return [data[s:e] for s, e in zip(cuts, cuts[1:])]

    def _learn(self, part: list[str]) -> None:
        """Tokenise segments at one go, as one text; where that does not give
        their bytes back, in halves; one that never does is known as None."""
        if self.local:
            texts, spaced = [" ".join(part)], [" " + " ".join(part)]
        else:
            texts, spaced = part, [" " + s for s in part]
        want = [b" " + s.encode() for s in part]
        upto = np.cumsum([len(w) for w in want])
        want = b"".join(want)
        a = self._side([e.ids for e in self.a.encode_batch_fast(spaced, add_special_tokens=False)], self.a_bytes, self.a_size, want, upto)
        b = a and self._side(self.b.encode(texts, num_threads=1), self.b_bytes, self.b_size, want, upto)
        if b:
            self.known.update(zip(part, zip(a, b)))
            self.held += 300 * len(part) + 2 * len(want)
        elif len(part) == 1:
            self.known[part[0]] = None
            self.bad.add(part[0])
            self.held += 300 + len(want)
        else:
            half = len(part) // 2
            self._learn(part[:half])
            self._learn(part[half:])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both sides, or None where a side's bytes are not the text's."""
        split = [self.segments(t) for t in texts]
        if self.held > CACHE_BYTES:  # what is asked for again comes back from the older ones
            self.known, self.older, self.held = {}, self.known, 0
            self.bad = {s for s, entry in self.older.items() if entry is None}
        new = set().union(*split).difference(self.known)
        again = {s for s in new if s in self.older}
        self.known.update((s, self.older[s]) for s in again)
        self.held += 350 * len(again)
        new = list(new - again)
        for i, j in slices(new, TOKEN_CHARS):
            self._learn(new[i:j])
        out = []
        get = self.known.__getitem__
        for s in split:
            if self.bad and not self.bad.isdisjoint(s):
                out.append(None)
            else:
                a, b = zip(*map(get, s))
                out.append((np.frombuffer(b"".join(a), dtype="<i4"), np.frombuffer(b"".join(b), dtype="<i4")))
        return out


def overlaps(doc_a: np.ndarray, size_a: np.ndarray, doc_b: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all overlapping tokens.  Both sides tile the
    same bytes, document after document."""
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    a = pd.DataFrame({"doc": doc_a, "at": start_a, "a": np.arange(len(size_a))}, copy=False)
    b = pd.DataFrame({"doc": doc_b, "at": start_b, "b": np.arange(len(size_b))}, copy=False)
    covered = pd.merge_asof(a, b, on="at", by="doc")
    # equal starts are met by the first direction already
    own = start_a[np.minimum(np.searchsorted(start_a, start_b), len(start_a) - 1)] != start_b
    covering = pd.merge_asof(b[own], a, on="at", by="doc")
    return (np.concatenate([covered["a"].to_numpy(np.int64), covering["a"].to_numpy(np.int64)]),
            np.concatenate([covered["b"].to_numpy(np.int64), covering["b"].to_numpy(np.int64)]))


@dataclass
class _Block:
    """What a block's documents hold; lists of one array for each batch."""

    ids: list = field(default_factory=list)
    numbers: list = field(default_factory=list)
    groups: list = field(default_factory=list)
    pairs: list = field(default_factory=list)
    times: list = field(default_factory=list)
    held: list = field(default_factory=list)
    chars: int = 0


class Aligner:
    """Tokenise and align batches of texts."""

    def __init__(self, sides: Sides):
        self.sides = sides
        self.size_a, self.size_b = sides.a_size, sides.b_size
        # each id followed by what parts it from the next: inside a side, at its end
        self.names = ([f"{i}{e}" for i in range(len(sides.a_bytes)) for e in ",|"]
                      + [f"{i}{e}" for i in range(len(sides.b_bytes)) for e in ",;"])

    def tokens(self, texts: list[str | None]) -> tuple[list, list]:
        """Ids of both sides; none where the bytes are not the text's."""
        got = iter(self.sides.encode([t for t in texts if t]))
        none = np.zeros(0, dtype=np.int64)
        both = [(next(got) or (none, none)) if t else (none, none) for t in texts]
        return [a for a, _ in both], [b for _, b in both]

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """For a batch: (tokens of A and B, groups, links) of each text, its
        groups in writing, its different id pairs (a * size of B + b) with how
        many links have each, and how many different pairs it has."""
        by_a, by_b = self.tokens(texts)
        n = len(texts)
        n_a, n_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (by_a, by_b))
        ids_a, ids_b = (np.concatenate([*side, np.zeros(0, np.int64)]).astype(np.int64) for side in (by_a, by_b))
        doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        size_a, size_b = self.size_a[ids_a], self.size_b[ids_b]
        at_a, at_b = overlaps(doc_a, size_a, doc_b, size_b) if len(ids_a) else (doc_a, doc_b)

        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        partner = np.searchsorted(end_b, end_a)  # the last B end is the last A end
        last_a = end_b[partner] == end_a if len(end_a) else np.zeros(0, dtype=bool)
        last_b = np.zeros(len(end_b), dtype=bool)
        last_b[partner[last_a]] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        upto_a, upto_b = (np.concatenate([[0], np.flatnonzero(last) + 1]) for last in (last_a, last_b))  # tokens in the groups before
        name = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        name[np.arange(len(ids_a)) + upto_b[group_a]] = ids_a * 2 + last_a
        name[np.arange(len(ids_b)) + upto_a[group_b + 1]] = 2 * len(self.size_a) + ids_b * 2 + last_b
        written_out = list(map(self.names.__getitem__, name.tolist()))
        upto = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        groups = ["".join(written_out[s:e])[:-1] for s, e in zip(upto, upto[1:])]

        n_groups = np.bincount(doc_a[last_a], minlength=n)
        doc_l = doc_a[at_a]
        n_links = np.bincount(doc_l, minlength=n)
        kinds = len(self.size_a) * len(self.size_b)
        key = doc_l * kinds + ids_a[at_a] * len(self.size_b) + ids_b[at_b]
        key.sort()
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
        times = np.diff(np.append(first, len(key)))
        doc, pair = np.divmod(key[first], kinds)
        return np.stack([n_a, n_b, n_groups, n_links], axis=1), groups, pair, times, np.bincount(doc, minlength=n)


def squeeze(numbers: np.ndarray) -> bytes:
    return pa.compress(numbers.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=4 * n, codec="zstd", asbytes=True), dtype="<i4")


def blocks(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each block of documents: (block, pairs array<long>, holders
    array<long>, docs array<struct<id, n_a, n_b, n_groups, n_links, n_pairs,
    groups>>, n, at, times).  ``holders`` counts the block's documents with
    the pair; ``at`` and ``times`` are the ``n`` (steps of) positions in
    ``pairs`` and numbers of links of the documents' pairs, compressed."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    with open(b_path, "rb") as f:
        b_model = f.read()
    shared = spark.sparkContext.broadcast((a_json, b_model))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(Sides(*shared.value))
        part, serial, block = TaskContext.get().partitionId(), 0, _Block()

        def done() -> pa.RecordBatch:
            nonlocal serial, block
            pair, held = np.concatenate(block.pairs), np.concatenate(block.held)
            at, known = pd.factorize(pair)
            order = np.argsort(known)
            known = known[order]
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            at = place[at]
            holders = np.bincount(at, minlength=len(known))
            step = np.diff(at, prepend=0)
            first = (np.cumsum(held) - held)[held > 0]
            step[first] = at[first]
            numbers = np.concatenate(block.numbers)
            names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_pairs", "groups"]
            doc = pa.StructArray.from_arrays([pa.concat_arrays(block.ids), *(pa.array(numbers[:, j]) for j in range(4)), pa.array(held),
                                              pa.array(sum(block.groups, []), pa.string())], names=names)
            out = pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | serial]), pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), pa.array(known)),
                 pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), pa.array(holders)),
                 pa.ListArray.from_arrays(pa.array([0, len(doc)], pa.int32()), doc), pa.array([len(at)]),
                 pa.array([squeeze(step)], pa.binary()), pa.array([squeeze(np.concatenate(block.times))], pa.binary())],
                names=["block", "pairs", "holders", "docs", "n", "at", "times"])
            serial, block = serial + 1, _Block()
            return out

        for batch in batches:
            texts = batch.column(1).to_pylist()
            for s, e in slices(texts, ALIGN_CHARS):
                chars = sum(len(t or "") for t in texts[s:e])
                if block.chars and block.chars + chars > BLOCK_CHARS:
                    yield done()
                numbers, groups, pairs, times, held = aligner.align(texts[s:e])
                for x, y in ((block.ids, batch.column(0).slice(s, e - s)), (block.numbers, numbers), (block.groups, groups),
                             (block.pairs, pairs), (block.times, times), (block.held, held)):
                    x.append(y)
                block.chars += chars + e - s
        if block.ids:
            yield done()

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(trimmed(run), "block bigint, pairs array<bigint>, holders array<bigint>, "
                                f"docs array<struct<id:{id_type},n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,n_pairs:bigint,groups:string>>, "
                                "n bigint, at binary, times binary")


def pair_counts(block_rows: DataFrame, b_size: int) -> DataFrame:
    """(pair, a, count): in how many documents of the corpus tokens of the
    two ids overlap."""
    entry = block_rows.select(F.explode(F.arrays_zip("pairs", "holders")).alias("e"))
    return (entry.groupBy(F.col("e.pairs").alias("pair")).agg(F.sum("e.holders").alias("count"))
            .select("pair", F.floor(F.col("pair") / b_size).alias("a"), "count"))


def score(block_rows: DataFrame, b_size: int) -> DataFrame:
    """``docs`` of the (written) block rows, one row each, with n_best (links
    whose pair has its A id's highest count) and count_sum (over the links)."""
    counts = written(pair_counts(block_rows, b_size))
    top = counts.groupBy("a").agg(F.max("count").alias("top"))  # a row for each id of A at most
    scored = counts.join(F.broadcast(top), "a").select("pair", (F.col("count") * 2 + (F.col("count") == F.col("top")).cast("long")).alias("score"))
    entry = block_rows.select("block", F.posexplode("pairs").alias("place", "pair"))
    looked = (entry.join(scored, "pair").groupBy("block")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "score"))), lambda x: x["score"]).alias("scores")))
    joined = block_rows.select("block", "docs", "n", "at", "times").join(looked, "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs = batch.column("docs")[i].values
                n = batch.column("n")[i].as_py()
                held = docs.field("n_pairs").to_numpy()
                best = sums = np.zeros(len(docs), dtype=np.int64)
                if n:
                    at = unsqueeze(batch.column("at")[i].as_py(), n).astype(np.int64)
                    times = unsqueeze(batch.column("times")[i].as_py(), n).astype(np.int64)
                    upto = np.concatenate([[0], np.cumsum(held)])
                    run_on = np.concatenate([[0], np.cumsum(at)])  # steps begin anew with each document
                    at = run_on[1:] - np.repeat(run_on[upto[:-1]], held)
                    value = batch.column("scores")[i].values.to_numpy(zero_copy_only=False)[at]
                    total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[upto])
                    best, sums = total(times * (value & 1)), total(times * (value >> 1))
                yield pa.RecordBatch.from_arrays([*(docs.field(c) for c in kept), pa.array(best), pa.array(sums)], names=[*kept, "n_best", "count_sum"])

    fields = [f for f in block_rows.schema["docs"].dataType.elementType.fields if f.name != "n_pairs"]
    kept = [f.name for f in fields]
    return joined.mapInArrow(trimmed(run), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", n_best bigint, count_sum bigint")


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every
    row of ``docs``; ``groups`` reads `a1,a2|b1;a3|b2,b3` (decimal ids)."""
    return score(written(blocks(docs, a_path, b_path, id_col, text_col)), piece_count(b_path))


def piece_count(b_path: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()


def op13_tokenalign(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a_path, b_path = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = blocks(table(spark, sf_dir, "documents"), a_path, b_path)
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_pairs"]
    hashed = aligned.withColumn("docs", F.transform("docs", lambda d: F.struct(
        *(d[n].alias(n) for n in names),
        F.when(d["groups"] == "", "").otherwise(F.sha2(d["groups"].cast("binary"), 256)).alias("groups_sha256"))))
    done = score(written(hashed), piece_count(b_path))
    return done.select(F.col("id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
