import random
import re

import pytest

from portrait.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
W = 10


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "")))


def brute(docs, items, window=W):
    """(n_words, n_hit, items, longest) of each text."""
    windows = {}
    for k, t in items:
        w = words(t)
        if w:  # an item with a null id counts for the words, but has no id to list
            for j in range(max(1, len(w) - window + 1)):
                windows.setdefault(tuple(w[j:j + window]), set()).update([] if k is None else [str(k)])
    lengths = {len(x) for x in windows}
    out = []
    for t in docs:
        w = words(t)
        hit, found, longest = [0] * len(w), set(), 0
        for p in range(len(w)):
            for n in lengths:
                key = tuple(w[p:p + n])
                if len(key) == n and key in windows:
                    hit[p:p + n] = [1] * n
                    found |= windows[key]
        for k, it in items:
            v = words(it)
            if v:
                for p in range(len(w)):
                    for j in range(len(v)):
                        n = 0
                        while p + n < len(w) and j + n < len(v) and w[p + n] == v[j + n]:
                            n += 1
                        if n >= min(window, len(v)):
                            longest = max(longest, n)
        out.append((len(w), sum(hit), sorted(found), longest))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = ["the", "of", "é", "7", "world"] + [f"w{i}" for i in range(12)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 9, 10, 11, 25, 40])).upper() if i % 3 else say(30)) for i in range(25)]
    items += [(100, None), (101, ""), (102, " .,!"), (103, items[0][1]), (104, "on the " * 20), (None, "w1 w2")]
    docs = [say(rng.randrange(0, 80)) for _ in range(40)]
    for k, t in items[:25]:
        w = (t or "").split()
        docs.append(say(20) + ", " + " ".join(w[3:]) + ". " + say(5))
        docs.append(say(4) + "\n" + "\t".join(w) + "  " + " ".join(w[:12]))
    docs += [None, "", "...", "on the " * 30, "ON-THE_on/the " * 8, items[0][1]]
    return docs, items


@pytest.mark.parametrize("block_words, matches", [(10**6, 10**6), (40, 50)])
def test_slice_equals_brute_force(monkeypatch, block_words, matches):
    monkeypatch.setattr(D, "MATCHES", matches)
    docs, items = corpus()
    items = [x for x in items if x[0] is not None]
    split, blocks, held, n = D.word_splitter(), [], [], 0
    for k, t in items:
        w = split(t)
        if not w:
            continue
        if held and n + len(w) > block_words:
            blocks.append(D.make_block(held, W))
            held, n = [], 0
        held.append((str(k), w))
        n += len(w)
    blocks.append(D.make_block(held, W))
    got = D.scan_slice(docs, lambda: iter(blocks), split)
    want = brute(docs, items)
    assert list(zip(got["n_words"], got["n_hit"], got["items"], got["longest"])) == want


def test_longest_match_and_its_places():
    split = D.word_splitter()
    item = [f"a{i}" for i in range(30)]
    block = D.make_block([("x", [w.encode() for w in item])], W)
    found = D.scan_slice(["zz " + " ".join(item[5:20]) + " yy " + " ".join(item[18:30])], lambda: iter([block]), split)
    assert [found[k][0] for k in ("longest", "longest_item", "longest_at", "longest_item_at", "n_hit")] == [15, "x", 1, 5, 27]


def test_words_of_every_character():
    text = "".join(chr(c) + "x" for c in range(0x250))
    assert [w.decode() for w in D.word_splitter()(text)] == words(text)


def test_rows_and_removal(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WORDS", 60)
    docs, items = corpus(2)
    rows = [(k if k % 7 else None, t, "a", k) for k, t in enumerate(docs)]
    df = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, row string, n_hit long")
    bench = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    want = brute([*docs, docs[3]], items)
    got = sorted((r.n_words, r.n_hit, r["items"], r.longest) for r in D.scan(df, bench, ["doc_id"]).collect())
    assert got == sorted(want)
    kept = D.remove_matches(df, bench)
    assert kept.columns == df.columns
    assert sorted(r.n_hit for r in kept.collect()) == sorted(r[3] for r, w in zip([*rows, rows[3]], want) if w[1] == 0)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit, r["items"]) for r in D.scan(docs, bench, ["doc_id"]).collect()] == [(3, 0, [])]
    assert D.scan(none, bench, ["doc_id"]).count() == 0
    assert D.remove_matches(docs, bench).count() == 1


def test_query_equals_brute_force(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    windows = {}
    for k, t in items:
        w = words(t)
        for j in range(max(1, len(w) - W + 1)) if w else []:
            windows.setdefault(tuple(w[j:j + W]), set()).add(str(k))
    want = set()
    for i, t in docs:
        w = words(t)
        hit, found = [0] * len(w), set()
        for p in range(len(w)):
            key = tuple(w[p:p + W])
            if key in windows:
                hit[p:p + W] = [1] * W
                found |= windows[key]
        want.add((i, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0))
    assert {tuple(r)[:6] for r in D.op4_decontaminate(spark, sf).collect()} == want


def test_items_with_a_null_id_count_for_the_words(spark):
    docs = spark.createDataFrame([(1, "say one two three again"), (2, "nothing")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "one two three"), ("b", "two three")], "item_id string, text string")
    got = {r.row.doc_id: r for r in D.scan(docs, items, ["doc_id"], window=10).collect()}
    assert (got[1].n_hit, got[1].items, got[1].longest, got[1].longest_item) == (3, ["b"], 3, None)
    assert (got[2].n_hit, got[2].items) == (0, [])
    assert [r.doc_id for r in D.remove_matches(docs, items).collect()] == [2]


def test_many_equal_items_and_a_window_many_times():
    import resource
    split = D.word_splitter()
    passage = "a b c d e f g h i j"
    block = D.make_block([(f"{k:05}", split(passage)) for k in range(5000)], W)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = D.scan_slice([" x ".join([passage] * 5000)], lambda: iter([block]), split)
    assert found["n_hit"] == [50_000] and len(found["items"][0]) == 5000 and found["longest"] == [10]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
