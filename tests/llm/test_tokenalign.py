"""Token alignment against plain loops over all pairs of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from portrait.llm import tokenalign as T

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def byte_of():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain(rows):
    """The contract's row of each (doc_id, text), in order."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = byte_of()
    docs = []
    for _, text in rows:
        links, groups, ids = [], [], ([], [])
        if text:
            x = a.encode(" " + text, add_special_tokens=False).ids
            y = b.encode(text)
            bx = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
            by = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
            if b"".join(bx) == b"".join(by) == (" " + text).encode():
                ids = (x, y)
                spans = []
                for parts in (bx, by):
                    at, out = 0, []
                    for p in parts:
                        out.append((at, at + len(p)))
                        at += len(p)
                    spans.append(out)
                links = [(x[i], y[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if max(s, u) < min(e, v)]
                ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
                start = 0
                for e in ends:
                    groups.append(",".join(str(t) for t, (u, v) in zip(x, spans[0]) if start <= u and v <= e) + "|"
                                  + ",".join(str(t) for t, (u, v) in zip(y, spans[1]) if start <= u and v <= e))
                    start = e
        docs.append((ids, groups, links))
    count = Counter(p for _, _, links in docs for p in set(links))
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for (doc_id, _), (ids, groups, links) in zip(rows, docs):
        text = ";".join(groups)
        out.append((doc_id, len(ids[0]), len(ids[1]), len(groups), len(links), sum(count[p] == top[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if ids[0] else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def run(spark, path, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    return sorted((tuple(r[c] for c in COLUMNS) for r in T.op13_tokenalign(spark, str(path)).collect()), key=repr)


def some_texts():
    rng = random.Random(11)
    words = ["straße", "the", "Über", "don't", "日本語", "🙂", "naïve", "x1234567", "  ", "\n\n", "\t", "é", "é", "ﬁ", "<s>", "<0x41>", "<|endoftext|>", "</s>", "…"]
    out = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 25))) for _ in range(60)]
    return out + ["", None, " ", "   ", "▁", "a▁b", "\u0000x", "\r\nx\r\n", " lead", "trail ", "a" * 3000, "1 " * 2000, "🙂" * 50, "  two", " nbsp　wide"]


@pytest.mark.parametrize("block", [200, 16_000_000])
def test_query_equals_plain_loops(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(T, "BLOCK_CHARS", block)
    monkeypatch.setattr(T, "ALIGN_CHARS", 150)
    monkeypatch.setattr(T, "TOKEN_CHARS", 60)
    rows = list(enumerate(some_texts()))
    rows += [(500, "the same text"), (500, "the same text"), (None, "no id at all"), (None, None)]
    assert run(spark, tmp_path, rows) == sorted(plain(rows), key=repr)


def test_empty_table_and_only_texts_without_tokens(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == []
    rows = [(1, None), (2, ""), (3, "a▁b")]
    assert run(spark, tmp_path / "b", rows) == sorted(plain(rows), key=repr)


def test_extra_columns(spark, tmp_path):
    rows = [(1, "some text", 5, "x"), (2, "other text", 6, "y")]
    assert run(spark, tmp_path, rows, "doc_id long, text string, id int, pairs string") == sorted(plain([r[:2] for r in rows]), key=repr)


def test_long_text(spark, tmp_path):
    rows = [(1, "lorem ipsum dolor " * 60_000), (2, "lorem ipsum")]
    got = {r[0]: r for r in run(spark, tmp_path, rows)}
    a = Tokenizer.from_file(A)
    assert got[1][1] == len(a.encode(" " + rows[0][1]).ids) and got[1][3] > 100_000
    assert got[2][1:5] == plain([rows[1]])[0][1:5]


def test_overlaps_by_merge_asof():
    rng = np.random.default_rng(2)
    for _ in range(30):
        total = int(rng.integers(1, 40))
        cut = [np.diff(np.concatenate([[0], np.sort(rng.choice(np.arange(1, total), size=int(rng.integers(0, total)), replace=False)), [total]])) for _ in range(2)]
        at_a, at_b = T.overlaps(np.zeros(len(cut[0]), int), cut[0], np.zeros(len(cut[1]), int), cut[1])
        s = [np.cumsum(c) - c for c in cut]
        want = {(i, j) for i in range(len(cut[0])) for j in range(len(cut[1])) if max(s[0][i], s[1][j]) < min(s[0][i] + cut[0][i], s[1][j] + cut[1][j])}
        assert set(zip(at_a.tolist(), at_b.tolist())) == want and len(at_a) == len(want)


def test_operator_gives_groups(spark):
    got = T.alignments(spark.createDataFrame([(1, "Hello wide world")], "doc_id long, text string"), A, B).collect()[0]
    x = Tokenizer.from_file(A).encode(" Hello wide world").ids
    assert [i for g in got["groups"].split(";") for i in g.split("|")[0].split(",")] == [str(i) for i in x]


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows_short = [(i, t) for i, t in rows if len(t or "") < 4000]
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS[:5]) + (r["groups_sha256"],) for r in T.op13_tokenalign(spark, sf).collect()}
    want = plain(rows_short)
    assert len(got) == len(rows) and all(got[w[0]] == w[:5] + w[7:] for w in want)


def test_segments_give_the_tokens_of_the_whole_text():
    sides = T.Sides(open(A, encoding="utf-8").read(), open(B, "rb").read())
    assert sides.local
    rng = random.Random(4)
    letters = [chr(c) for c in (*range(256), 0x301, 0x2028, 0x3000, 0x200B, 0x1F600, 0x4E2D, 0x2581, 0xFEFF, 0x1680, 0xFB01)] + [" "] * 70 + ["'s", "the", "<s>", "<0x0A>", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 60))) for _ in range(4000)]
    whole = zip(sides.a.encode_batch([" " + t for t in texts], add_special_tokens=False), sides.b.encode(texts, num_threads=1))
    for t, got, (a, b) in zip(texts, sides.encode(texts), whole):
        same = b"".join(sides.a_bytes[i] for i in a.ids) == (" " + t).encode() == b"".join(sides.b_bytes[i] for i in b)
        assert (got is not None) == same
        assert not same or (got[0].tolist(), got[1].tolist()) == (a.ids, b)
