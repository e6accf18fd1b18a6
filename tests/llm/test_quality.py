import random
import re
from collections import Counter

import numpy as np
import pytest

from portrait.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    three = list(zip(words, words[1:], words[2:]))
    count = Counter(three)
    inside = {i + k for i, t in enumerate(three) if count[t] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))


TEXTS = [None, "", " \n\t", "one", "a b", "a b c", "a b c a b c", "a b c d a b c", "a a a a", "x\nx\nx\n\n", "  x\nx", "é世 😀 #*$%&|<>!", "a\xa0b\x1cc\x85d", "w " * 300,
         "line one\nline one \nline one\n" * 3]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert Q.text_counts(text)[:5] == brute_base(text)


def test_base_counts_of_random_texts():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "ab", "é", " ", " ", "\n", "\t", "#", "!"]) for _ in range(rng.randrange(120)))
        assert Q.text_counts(text)[:5] == brute_base(text)


def brute_fit(patterns, turns=100):
    """The same EM, document by document."""
    rows = [k for k, n in patterns.items() for _ in range(n)]
    rules = range(len(rows[0]))
    a, b, share, start = [0.05] * len(rules), [0.35] * len(rules), 0.1, 0.01 * len(rows)
    post = {}
    for _ in range(turns):
        post = {}
        for k in patterns:
            p, q = share, 1 - share
            for j in rules:
                if k[j] != "-":
                    p *= b[j] if k[j] == "b" else 1 - b[j]
                    q *= a[j] if k[j] == "b" else 1 - a[j]
            post[k] = p / (p + q)
        for j in rules:
            cast = [k for k in rows if k[j] != "-"]
            nb = (sum(post[k] for k in cast if k[j] == "b") + start * 0.35) / (sum(post[k] for k in cast) + start)
            na = (sum(1 - post[k] for k in cast if k[j] == "b") + start * 0.05) / (sum(1 - post[k] for k in cast) + start)
            a[j] = min(0.5, max(1e-4, na))
            b[j] = min(0.99, max(1e-3, max(a[j], nb)))
        share = min(0.5, max(1e-4, (sum(post[k] for k in rows) + start * 0.1) / (len(rows) + start)))
    return {k: 1 - p if "b" in k else 1.0 for k, p in post.items()}


def test_em_equals_document_by_document():
    patterns = {"ggg": 300, "gg-": 60, "bgg": 12, "gbg": 5, "bbg": 25, "bbb": 9, "-b-": 4, "---": 7}
    model, want = Q.fit(patterns), brute_fit(patterns)
    assert model.posterior.keys() == want.keys()
    for k in want:
        assert model.posterior[k] == pytest.approx(want[k], abs=1e-6)
    assert model.posterior["ggg"] == 1.0 and model.posterior["bbb"] < 0.5


def test_em_finds_the_accuracies_of_simulated_rules():
    rng = np.random.default_rng(5)
    n, right_good, right_bad = 20_000, [0.98, 0.95, 0.99, 0.97], [0.8, 0.6, 0.9, 0.7]
    bad = rng.random(n) < 0.15
    votes = np.array([np.where(rng.random(n) < 0.2, "-", np.where(bad, np.where(rng.random(n) < b, "b", "g"), np.where(rng.random(n) < g, "g", "b"))) for g, b in zip(right_good, right_bad)])
    patterns = Counter("".join(x) for x in votes.T)
    model = Q.fit(patterns)
    assert model.bad_share == pytest.approx(0.15, abs=0.02)
    assert model.bad_if_bad == pytest.approx(right_bad, abs=0.1)
    assert model.bad_if_good == pytest.approx([1 - x for x in right_good], abs=0.02)


def test_without_bad_votes_nothing_is_rejected():
    assert set(Q.fit({"ggg": 50, "g--": 5, "---": 1}).posterior.values()) == {1.0}
    assert Q.fit({}).posterior == {}


def clean(i, n=80):
    rng = random.Random(i)
    return "\n".join(" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n // 4)) + "." for _ in range(4))


def test_rows_and_kept(spark):
    junk = ["###  $$$ %%% word& " * 2 + " ".join(f"{w}###" for w in clean(500 + i).split()) for i in range(40)]
    rows = [(i, clean(i)) for i in range(300)] + [(1000 + i, t) for i, t in enumerate(junk)]
    rows += [(2000, None), (2001, ""), (2002, "few words only"), (2003, "again and " * 100), (None, clean(77)), (5, clean(5))]
    df = spark.createDataFrame([(*r, 1.5, "v", k) for k, r in enumerate(rows)], "doc_id long, text string, p_good double, votes string, n_words int")
    kept = Q.keep_good(df)
    assert kept.columns == df.columns
    got = {r.n_words for r in kept.collect()}
    assert got == {k for k, (i, _) in enumerate(rows) if i is None or i < 300}
    assert Q.keep_good(df.limit(0)).count() == 0


def test_query_columns_and_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    out = Q.op6_quality(spark, sf)
    rows = {r.doc_id: r for r in out.collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for i, r in rows.items():
        n, chars, symbols, dup, repeat = brute_base(docs[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)
        assert not (r.kept and r.base_failed)
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in rows and not rows[r.doc_id].base_failed]
    assert sum(rows[r.doc_id].kept == (r.quality == 1) for r in labels) >= 0.97 * len(labels)  # the model never sees them
