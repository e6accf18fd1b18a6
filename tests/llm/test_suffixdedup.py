"""Suffix-array dedup against a dictionary of all strings."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from portrait.llm import suffixdedup as S


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    raw = [(t or "").encode() for t in texts]
    places = defaultdict(int)
    for b in raw:
        for i in range(len(b) - length + 1):
            places[b[i:i + length]] += 1
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - length + 1):
            if places[b[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), int(gone[:len(b)].sum()), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def rows(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=repr)


def expected(table, length=400):
    return sorted(((i, n, g, k, hashlib.sha256(x).hexdigest()) for (i, _), (n, g, k, x) in zip(table, brute([t for _, t in table], length))), key=repr)


def write(spark, path, table, schema="doc_id long, text string"):
    spark.createDataFrame(table, schema).repartition(4).write.parquet(f"{path}/documents.parquet")
    return str(path)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gämma", "delta", "épsilon", "zeta", "eta", "日本", "theta", "iota"]) + str(rng.randrange(1000)) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (30, 45, 60, 80, 120)]
    texts = [prose(rng, rng.randrange(1, 250)) for _ in range(40)]
    for p in passages:  # in many documents, cut at other places each time
        for _ in range(12):
            a, b = sorted((rng.randrange(0, 30), len(p) - rng.randrange(0, 30)))
            texts.append(prose(rng, rng.randrange(0, 30)) + p[a:b] + prose(rng, rng.randrange(0, 30)))
    base = prose(rng, 300)
    for _ in range(15):  # near copies
        t = list(base)
        for _ in range(rng.randrange(0, 6)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    texts += [texts[3]] * 3 + ["a" * 399, "a" * 400, "b" * 401, "c" * 1500, "xyz" * 300, "", None, "short", texts[5][:399], texts[5][-700:]]
    edge = prose(rng, 70)[:400]
    texts += [edge, "prefix" + edge, edge + "suffix", edge[:399] + "!", "é" * 250]
    return [(i, t) for i, t in enumerate(texts)]


def test_difference_covers():
    for period, cover in S.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("seed,slice_bytes", [(1, 3000), (2, 4_000_000)])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, seed, slice_bytes):
    monkeypatch.setattr(S, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(S, "BUCKET_KEYS", 500)
    table = corpus(seed)
    table += [(7, table[7][1]), (None, table[9][1]), (None, None)]
    sf = write(spark, tmp_path, table)
    assert rows(S.op11_suffixdedup(spark, sf)) == expected(table)


def one_slice(texts, length):
    """All rounds over slices of one text each, without Spark."""
    bits = 2
    slices = []
    for t in texts:
        s = S.Slice(pa.array([t or ""]), length, bits)
        s.samples()
        slices.append(s)

    def round_(keys, solve):
        flags = solve(*(np.concatenate(k) for k in zip(*keys)))
        at = np.cumsum([0, *(len(k[0]) for k in keys)])
        return [flags[a:b] for a, b in zip(at, at[1:])]

    for s, f in zip(slices, round_([(s.codes,) for s in slices], S.same_core)):
        s.tie(f.astype(bool))
    for s, f in zip(slices, round_([(s.hull_codes, s.hulls) for s in slices], S.same_hull)):
        s.windows(f)
    return [s.repeated(f.astype(bool)) for s, f in zip(slices, round_([(s.high, s.low) for s in slices], S.same_window))]


@pytest.mark.parametrize("length", [1, 2, 5, 8, 21, 40, 100])
def test_rounds_on_small_alphabets(length):
    rng = random.Random(length)
    for _ in range(12):
        texts = ["".join(rng.choice("ab" if length > 5 else "abcdefgh") for _ in range(rng.randrange(0, 3 * length + 20))) for _ in range(8)]
        for _ in range(6):
            t = rng.choice(texts)
            a = rng.randrange(0, len(t) + 1)
            texts.append(rng.choice(["", "x", "yy"]) + t[a:] + rng.choice(["", "zz"]) + t[:a])
        for got, (n, gone, _, _) in zip(one_slice(texts, length), brute(texts, length)):
            assert (len(got), int(got.sum())) == (n, gone)


def test_empty_table_and_extra_columns(spark, tmp_path):
    sf = write(spark, tmp_path / "a", [])
    assert S.op11_suffixdedup(spark, sf).collect() == []
    table = [(1, "p" * 500, 3, "x"), (2, "q" * 100, 4, "y")]
    sf = write(spark, tmp_path / "b", table, "doc_id long, text string, slice int, id string")
    assert rows(S.op11_suffixdedup(spark, sf)) == expected([r[:2] for r in table])


def test_spans_and_kept(spark):
    same = "The same words stand in both of these texts, more than fifty bytes of them."
    docs = spark.createDataFrame([("x", "Begin. " + same + " End."), ("y", same)], "name string, body string")
    got = {r["id"]: r for r in S.repeated_spans(docs, 50, "name", "body").collect()}
    assert [tuple(s) for s in got["x"]["spans"]] == [(7, 7 + len(same))] and bytes(got["x"]["kept"]) == b"Begin.  End."
    assert bytes(got["y"]["kept"]) == b""


def test_long_text(spark, tmp_path):
    rng = random.Random(9)
    long = "".join(rng.choice("abcdefghijklmnop \n") for _ in range(5_000_000))
    table = [(1, long), (2, long[1_234_567:1_236_000]), (3, "own " * 10)]
    sf = write(spark, tmp_path, table)
    got = {r["doc_id"]: r for r in S.op11_suffixdedup(spark, sf).collect()}
    assert [got[i]["n_removed"] for i in (1, 2, 3)] == [1433, 1433, 0]


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(S.op11_suffixdedup(spark, sf)) == expected(table)


def brute_passages(texts, words):
    """Byte spans of the words in passages of ``words`` words that start twice."""
    split = [[(m.start(), m.end(), m.group()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    places = defaultdict(int)
    for found in split:
        for i in range(len(found) - words + 1):
            places[tuple(w for _, _, w in found[i:i + words])] += 1
    out = []
    for found in split:
        gone = {i + k for i in range(len(found) - words + 1) if places[tuple(w for _, _, w in found[i:i + words])] > 1 for k in range(words)}
        first = [i for i in sorted(gone) if i - 1 not in gone]
        last = [i for i in sorted(gone) if i + 1 not in gone]
        out.append([(found[a][0], found[b][1]) for a, b in zip(first, last)])
    return out


def passage_corpus(seed):
    rng = random.Random(seed)
    texts = [t for _, t in corpus(seed)]
    for n in (49, 50, 51, 55, 70):  # of short words: most are below 400 bytes
        p = [rng.choice(["a", "of", "the", "é", "日"]) + str(rng.randrange(100)) for _ in range(n)]
        for _ in range(3):
            texts.append(prose(rng, rng.randrange(0, 90)) + "\n" + "".join(w + rng.choice([" ", "\n", "\t ", "  "]) if i % 9 == 0 else w + " " for i, w in enumerate(p)) + prose(rng, 20))
            texts.append("  " + "\r\n".join(p) + " ")
    long = "".join(rng.choice("xy") for _ in range(2000))
    texts += [" ".join([long] * 60), " ".join([long[:-1] + "z"] * 60), "w " * 51, "w " * 50, "v " * 50, " \n ", " " * 60]
    return texts


@pytest.mark.parametrize("seed,slice_bytes", [(1, 3000), (2, 4_000_000)])
def test_passages_equal_brute_force(spark, monkeypatch, seed, slice_bytes):
    monkeypatch.setattr(S, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(S, "BUCKET_KEYS", 500)
    texts = passage_corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["id"]: r for r in S.repeated_spans(docs, 400, words=50).collect()}
    assert [[tuple(s) for s in got[i]["passages"]] for i in range(len(texts))] == brute_passages(texts, 50)
    for i, (_, n, g, k) in enumerate(brute(texts, 400)):  # what is removed stays what it was
        assert (sum(s["end"] - s["start"] for s in got[i]["spans"]), len(got[i]["spans"]), bytes(got[i]["kept"])) == (n, g, k)


def test_passages_below_400_bytes_are_reported(spark, tmp_path):
    rng = random.Random(3)
    passage = " ".join(f"w{rng.randrange(1000)}" for _ in range(52))
    assert len(passage) < 400
    own = [" ".join(f"{k}x{rng.randrange(10**6)}" for _ in range(80)) for k in "abc"]
    table = [(1, own[0] + " " + passage), (2, passage.replace(" ", "\n", 3) + "\n" + own[1]), (3, own[2]), (4, None)]
    got = {r["doc_id"]: r for r in S.op11_suffixdedup(spark, write(spark, tmp_path, table)).collect()}
    assert [(got[i]["n_passages"], got[i]["n_passage_bytes"]) for i in (1, 2, 3, 4)] == [(1, len(passage))] * 2 + [(0, 0)] * 2
    assert [got[i]["n_removed"] for i in (1, 2, 3, 4)] == [0] * 4
