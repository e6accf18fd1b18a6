import random

import numpy as np
import pytest

from portrait.llm import linededup as L

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_chars=20, min_docs=3):
    """(n_lines, n_dropped, kept) of each (id, text)."""
    holders = {}
    order = lambda i: L.NO_ID if i is None else i
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(h := holders.get(key(x), ())) >= min_docs and order(i) < max(h))]
        out.append((len(lines), len(lines) - len(keep), "\n".join(keep)))
    return out


def corpus(seed=5, n=150):
    rng = random.Random(seed)
    hot = "This line is in a third of all the documents"
    common = [f"A rather common line with the number {i}" for i in range(12)]
    rows = []
    for i in range(n):
        lines = [f"own line {i} {k} " + "é" * rng.randrange(20) for k in range(rng.randrange(4))]
        lines += rng.sample(common, rng.randrange(4))
        lines += ["short", "", " \t"]
        if i % 3 == 0:
            lines += [hot, "  " + hot.upper() + "\x0b"] * rng.choice([1, 1, 2])
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "\n"), (None, hot + "\n" + common[0]), (None, common[1] + "\r\n" + common[0]),
             (7, "another text of an id that is there already\n" + hot), rows[9], (2000, "x" * 19 + "\n" + "É" * 20), (2001, "É" * 20), (2002, "é" * 20), (2003, "É" * 20),
             (3000, "\n".join([common[0]] * 3000 + ["only once in the whole of this corpus"]))]
    return rows


@pytest.mark.parametrize("parts", [None, 40])
def test_equals_brute_force(spark, parts):
    rows = corpus()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    if parts:  # more partitions than keys: the hot key spans several
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame([(*r, k, 1, "x") for k, r in enumerate(rows)], "doc_id long, text string, kept int, doc int, bitmap string")
        found = L.apply_bitmaps(df, L.keep_bitmaps(df), ["kept"]).collect()
        got = {r.row.kept: (r.n_lines, r.n_dropped, r["kept"]) for r in found}
        assert len(found) == len(rows)
        assert [got[k] for k in range(len(rows))] == brute(rows)
        out = L.drop_repeated_lines(df)
        assert out.columns == df.columns
        assert {r["kept"]: r.text for r in out.collect()} == {k: x[2] for k, x in enumerate(brute(rows))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(6))
def test_stream_over_any_partition_bounds(seed):
    """Cut the sorted rows anywhere, into batches of any size: the decisions
    are those of all rows together."""
    import pyarrow as pa

    rng = random.Random(seed)
    rows = sorted(({(k, 0, -d): None for k in range(4) for d in rng.sample(range(12), rng.choice([1, 2, 3, 8]))}))
    names = ["hi", "lo", "doc", "tk", "n_lines", "at"]
    cuts = sorted(rng.sample(range(len(rows) + 1), min(5, len(rows))))
    out = []
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        part, batches = rows[a:b], []
        while part:
            n = rng.randrange(1, 4)
            c, part = part[:n], part[n:]
            batches.append(pa.RecordBatch.from_arrays([pa.array([x[0] for x in c]), pa.array([x[1] for x in c]), pa.array([-x[2] for x in c]), pa.array([0] * len(c)), pa.array([1] * len(c)), pa.array([[0]] * len(c))], names=names))
        for batch in L.stream_keys(3)(iter(batches)):
            out += batch.to_pylist()
    seen = {}
    for r in out:
        if r["kind"] == L.SEEN:
            seen.setdefault(r["hi"], set()).add(r["doc"])
    dropped = {(r["hi"], r["doc"]) for r in out if r["kind"] == L.DROP}
    dropped |= {(r["hi"], r["doc"]) for r in out if r["kind"] == L.PENDING and len(seen[r["hi"]]) >= 3 and r["doc"] < max(seen[r["hi"]])}
    docs = {}
    for k, _, d in rows:
        docs.setdefault(k, []).append(-d)
    assert dropped == {(k, d) for k, ds in docs.items() if len(ds) >= 3 for d in ds if d < max(ds)}


def test_bitmap_has_one_bit_a_line(spark):
    import zlib

    line = "a line that is long enough"
    df = spark.createDataFrame([(i, f"x\n{line}\ny") for i in range(3)], "doc_id long, text string")
    maps = {r.doc: r for r in L.keep_bitmaps(df).collect()}
    assert set(maps) == {0, 1}
    assert np.unpackbits(np.frombuffer(zlib.decompress(maps[0].bitmap), dtype=np.uint8), count=3).tolist() == [1, 0, 1]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.drop_repeated_lines(df).count() == 0


@pytest.mark.parametrize("held", [0, 1, 3])
def test_rows_beyond_what_a_task_holds(monkeypatch, held):
    monkeypatch.setattr(L, "HELD_ROWS", held)
    for seed in range(6):
        test_stream_over_any_partition_bounds(seed)


def test_many_rows_of_one_id_and_of_none(spark, monkeypatch):
    monkeypatch.setattr(L, "HELD_ROWS", 5)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 12)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    line, other = "a line of more than twenty characters", "another line of more than twenty characters"
    rows = [(None, f"{line}\nrow {k}") for k in range(60)] + [(5, f"{line}\n{other}\nown {k}") for k in range(60)] + [(5, f"{line}\nsame")] * 40
    rows += [(4, other), (3, line), (3, other)]
    try:
        df = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, kept int")
        found = L.apply_bitmaps(df, L.keep_bitmaps(df), ["kept"]).collect()
        assert {r.row.kept: (r.n_lines, r.n_dropped, r["kept"]) for r in found} == dict(enumerate(brute(rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
