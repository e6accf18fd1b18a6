import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from portrait.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


def ids(vocabulary, texts):
    chunks, _ = bpe.text_chunks(vocabulary)
    split = [chunks(t) for t in texts]
    known = bpe.chunk_encoder(vocabulary)(split)
    return [np.frombuffer(b"".join(known[c] for c in cs), dtype=np.int32).tolist() for cs in split]


SPECIAL = ["", " ", "\n", "a" * 50, "aAaa'S", "İstanbul ΑΣΑ ΑΣ", "é é", "<|endoftext|>", "x<|startoftext|>y<|endoftext|>z", "<|endof text|>",
           "a\x1cb\x1f c", "\x85\xa0 x", "½٣४ 1234", "世界 😀👍🏽", "it's we'll I'M 'd'd", "\x00�"]


def test_special_texts_equal_library(vocabulary, library):
    assert ids(vocabulary, SPECIAL) == [e.ids for e in library.encode_batch(SPECIAL, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aabbeettoo' .,!#éñß世😀Σİ19\n\t<|>endoftx", max_size=40), max_size=6))
def test_random_texts_equal_library(texts):
    vocabulary, library = bpe.Vocabulary(PATH), Tokenizer.from_file(PATH)
    assert ids(vocabulary, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_cache_is_bounded_and_results_do_not_depend_on_it(vocabulary, monkeypatch):
    random.seed(3)
    texts = [" ".join("".join(random.choice("abcde") for _ in range(6)) for _ in range(30)) for _ in range(20)]
    want = ids(vocabulary, texts)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    chunks, _ = bpe.text_chunks(vocabulary)
    ids_of = bpe.chunk_encoder(vocabulary)
    for t, w in zip(texts, want):
        known = ids_of([chunks(t)])
        assert np.frombuffer(b"".join(known[c] for c in chunks(t)), dtype=np.int32).tolist() == w
        assert len(known) <= 50 + 2


def test_operator_on_rows(spark, library):
    rows = [(1, "The quick brown fox", "a"), (2, None, "b"), (3, "", "c"), (1, "The quick brown fox", "a"), (None, "x " * 5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    want = []
    for i, t, _ in rows:
        e = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, e, library.decode(e, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([tuple(r) for r in got], key=key) == sorted(want, key=key)


def test_decode_skips_unknown_ids_and_null(spark):
    df = spark.createDataFrame([([518, 999999, -1],), (None,), ([],)], "ids array<int>")
    assert sorted(r.decoded for r in bpe.decode(df, PATH).collect()) == ["", "", "the</w>"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH), PATH).count() == 0


def test_query_equals_library(spark, library):
    sf = "/root/testdata/sf0.001"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        e = library.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(e), sha(" ".join(map(str, e))), sha(library.decode(e, skip_special_tokens=False))))
    assert {tuple(r) for r in bpe.op1_bpe(spark, sf).collect()} == want


def test_later_merge_used_by_earlier_one_is_refused(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    bad = tmp_path / "bad.json"
    bad.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(bad))
