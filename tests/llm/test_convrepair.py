"""Conversation repair against a plain dynamic program over whole conversations."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from portrait.llm import convrepair as cr

NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
WHITE = " \t\n\x0b\x0c\r"


def least(rows):
    """(cost, audit, repaired turns) by trying every edit, least cost first and
    then the least audit."""
    seen, marks = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        marks.append("dead" if not bare or (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    far = (10**9, "", [])

    def options(i, s, rest):
        out = []
        if i == len(rows):
            return [(0, "", [])] if s in (0, 3) else []
        (role, text), mark = rows[i], marks[i]
        c, a, t = rest[s]
        out.append((c + 4, "D" + a, t))
        if mark != "dead":
            to = NEXT.get((s, role[:1]))
            if to is not None:
                c, a, t = rest[to]
                out.append((c + mark, "K" + a, [(role, text)] + t))
            for new in ("user", "assistant"):
                to = NEXT.get((s, new[0]))
                if to is not None:
                    c, a, t = rest[to]
                    out.append((c + 3 + mark, "R" + a, [(new, text)] + t))
        return out

    best = None
    for i in range(len(rows), -1, -1):
        now = [min(options(i, s, best) or [far], key=lambda x: x[:2]) for s in range(4)]
        for _ in range(4):  # insertions before turn i
            for s in range(4):
                for new in ("user", "assistant"):
                    to = NEXT.get((s, new[0]))
                    if to is not None:
                        c, a, t = now[to]
                        now[s] = min(now[s], (c + 3, "I" + a, [(new, "")] + t), key=lambda x: x[:2])
        best = now
    return best[0]


def expected(table):
    """The contract's row of each conversation, from (conv_id, turn, role, text) rows."""
    convs = {}
    for c, t, r, x in table:
        convs.setdefault(c, [])
        r, x = " " if r is None else r, " " if x is None else x
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        convs[c] += [(t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    out = {}
    for c, rows in convs.items():
        rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [t for t, _, _ in rows if t is not None]
        blank = duplicate = truncated = illegal = 0
        seen = set()
        for _, r, x in rows:
            bare = x.strip(WHITE)
            if not bare:
                blank += 1
            elif (r, x) in seen:
                duplicate += 1
            elif bare[-1] not in ".!?":
                truncated += 1
            seen.add((r, x))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, turned = least([(r, x) for _, r, x in rows])
        text = "\n".join(f"{r}:{x}" for r, x in turned)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[c] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def rows_of(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def write(spark, path, table, schema="conv_id long, turn long, role string, text string", parts=3):
    spark.createDataFrame(table, schema).repartition(parts).write.parquet(f"{path}/conversations.parquet")
    return str(path)


def some_text(rng):
    return rng.choice(["", " \t", "one.", "two?", "three", "four! ", "fünf", "x" * rng.randrange(1, 4) + ".", "y" * rng.randrange(1, 9)])


def test_backward_equals_plain_program():
    rng = random.Random(3)
    for lane in (1, 3, 64):
        cr.LANE, before = lane, cr.LANE
        try:
            for kinds in (["user", "assistant"], ["system"], ["tool", "system"], ["system", "user", "assistant", "tool"]):
                runs = [[(rng.choice(kinds), f"{i}" + rng.choice([".", ""])) for i in range(rng.randrange(0, 23))] for _ in range(60)]
                codes = [cr._codes([r for r, _ in x], [0 if t.endswith(".") else 3 for _, t in x]) for x in runs]
                sizes = np.array([len(c) for c in codes])
                edits, _, _ = cr.backward(np.concatenate(codes), sizes, np.tile(cr.FINISH, (len(runs), 1)))
                upto = np.concatenate([[0], np.cumsum(sizes)])
                for x, c, s, e in zip(runs, codes, upto, upto[1:]):
                    audit, cost, _, roles, texts = cr.trace(c, edits[s:e], 0, True, [r for r, _ in x], [t for _, t in x])
                    assert (cost, audit, list(zip(roles, texts))) == least(x)
        finally:
            cr.LANE = before


def test_vectors_that_meet_need_few_passes():
    rng = random.Random(5)
    codes = np.array([rng.choice([1, 2]) for _ in range(6400)], dtype=np.uint8)
    _, _, passes = cr.backward(codes, np.array([6400]), cr.FINISH[None, :])
    assert passes <= 3


@pytest.mark.parametrize("limit", [4, 20_000])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(cr, "PIECE_ROWS", limit)
    monkeypatch.setattr(cr, "LANE", 3)
    rng = random.Random(limit)
    table = []
    for c in [None, *range(60)]:
        for t in range(rng.randrange(1, 12)):
            if rng.random() < 0.9:
                table.append((c, None if rng.random() < 0.05 and t == 0 else t * rng.choice([1, 1, 1, 3]) if t < 2 else 3 * t,
                              rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None]), rng.choice([some_text(rng), None]) if rng.random() < 0.2 else some_text(rng)))
    table = list({(c, t): (c, t, r, x) for c, t, r, x in table}.values())
    for kinds in (["user", "assistant"], ["system"], ["user"]):  # long ones, spread over tasks
        c = 1000 + len(kinds) + len(kinds[0])
        table += [(c, t, rng.choice(kinds), some_text(rng) + rng.choice(["", f"{t}."])) for t in range(150)]
    sf = write(spark, tmp_path, table, parts=5)
    assert rows_of(cr.op12_convrepair(spark, sf)) == expected(table)


def test_ties_and_repeated_rows(spark, tmp_path):
    table = [(1, 1, "user", "a.")] * 3 + [(1, 2, "assistant", "b.")] + [(2, None, None, None)] * 2
    sf = write(spark, tmp_path, table)
    assert rows_of(cr.op12_convrepair(spark, sf)) == expected(table)


def test_empty_table_and_extra_columns(spark, tmp_path):
    sf = write(spark, tmp_path / "a", [])
    assert cr.op12_convrepair(spark, sf).collect() == []
    table = [(7, 0, "user", "Hi.", "x", 1), (7, 1, "assistant", "Well.", "y", 2)]
    sf = write(spark, tmp_path / "b", table, "conv_id long, turn long, role string, text string, conv string, piece int")
    assert rows_of(cr.op12_convrepair(spark, sf)) == expected([r[:4] for r in table])


def test_turns_are_the_repaired_ones(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b"), (1, 2, "assistant", "c.")]
    done = cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [(r.role, r.text) for r in done.turns().orderBy("piece", "at").collect()] == least([r[2:] for r in rows])[2]
    assert [tuple(r) for r in done.report.select("cost", "audit").collect()] == [least([r[2:] for r in rows])[:2]]


def test_long_text_and_string_ids(spark, tmp_path):
    table = [("a", 0, "user", "long " * 600_000 + "."), ("a", 1, "assistant", "x."), ("b", 0, "user", "y.")]
    sf = write(spark, tmp_path, table, "conv_id string, turn long, role string, text string")
    assert rows_of(cr.op12_convrepair(spark, sf)) == expected(table)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(cr.op12_convrepair(spark, sf)) == expected(table)
