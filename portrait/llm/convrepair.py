"""Conversation structure repair: a rank-convergence parallel Viterbi.

The turns of a conversation are kept, given another role, deleted or filled
up with empty turns so that the roles read "an optional system turn, then
user and assistant in turn", at least cost.  The dynamic program has four
states (start, after system, after user, after assistant) and runs backwards:
a cost vector says what the rest costs from each state.

* **Chunks.**  A conversation is cut into chunks of ``LANE`` turns; all chunks
  of a slice run side by side as lanes, each from a speculative vector.  Fix-up
  passes give a chunk the vector that the chunk behind it arrived at and rerun
  it; a rerun stops where its vectors differ from the former ones by a
  constant only, for then every choice before that point stays as it was.
* **Pieces.**  Rows are range-partitioned by (conversation, turn, ...), so a
  conversation of any size is dealt over tasks.  What a task holds of a
  conversation that may go on in a neighbouring task, or is longer than
  ``PIECE_ROWS``, is emitted as open pieces of bounded size.  A piece cannot
  know the vector behind it, so it speculates from each of the four states;
  costs being min-plus linear, the true vector follows from these four without
  a rerun, and if all four agree but for constants (rank one) it does not even
  depend on what lies behind.
* **Stitching.**  A stream over the small piece rows hands the vectors from
  the end to the start, a second one the states from the start to the end.
  With both known every piece traces its own edits: at each step the edit of
  the least initial (D, I, K, R) that lies on a cheapest way.

Memory is bounded by a piece and a slice of rows; text is shuffled once, that
of open pieces a second time.

Defined cases: a null role or text counts as one space; a null conversation id
is a conversation of its own; null turns come first; rows with the same turn
stand in the order of role and text hash, repeated rows beside each other; rows
whose ``present`` column is false only name their conversation; an empty table
gives an empty result; a text of any length is kept whole; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portrait.llm.common import table, written

#: Turns in a chunk, the unit that is speculated on.
LANE = 64
#: A piece of a conversation, and a slice of closed conversations that is
#: solved at one time, hold at most this many turns and characters (and one
#: more turn).
PIECE_ROWS = 20_000
PIECE_CHARS = 2_000_000

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted turn or a turn of new role, by state: a user
#: turn everywhere but after a user.
FILLED = np.array([USER, USER, ASSISTANT, USER])
#: The state after a kept turn by its role (system, user, assistant, other)
#: and the state before; 4: not allowed.
KEPT = np.array([[SYSTEM, 4, 4, 4], [USER, USER, 4, USER], [4, 4, ASSISTANT, 4], [4, 4, 4, 4]])
#: Cost of finishing after the last turn, by state.
FINISH = np.array([0, 2 * INSERT, INSERT, 0], dtype=np.int64)
FAR = np.int64(1) << 40
#: The cost vectors that stand for "the rest must be entered in this state".
UNITS = np.array([[0, FAR, FAR, FAR], [FAR, 0, FAR, FAR],
                  [INSERT, INSERT, 0, INSERT], [2 * INSERT, 2 * INSERT, INSERT, 0]], dtype=np.int64)
#: Codes of a turn: role class + 4 if truncated; blank and duplicate turns are
#: DEAD (they go, whatever the state is).
DEAD = 8
EDITS = "DIKR"
ROLES = {USER: "user", ASSISTANT: "assistant"}


def step(code: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One live turn for each lane: the cost vectors before it and the index
    in ``EDITS`` of the first edit from each state."""
    extra = np.where(code >= 4, TRUNCATED, 0)[:, None]
    drop = rest + DELETE
    other = rest[:, FILLED] + (REROLE + extra)
    wide = np.concatenate([rest, np.full((len(rest), 1), FAR)], axis=1)
    keep = np.take_along_axis(wide, KEPT[code % 4], axis=1) + (KEEP + extra)
    best = np.minimum(np.minimum(drop, other), keep)
    cost = best.copy()
    cost[:, USER] = np.minimum(best[:, USER], INSERT + best[:, ASSISTANT])
    cost[:, ASSISTANT] = np.minimum(best[:, ASSISTANT], INSERT + best[:, USER])
    for s in (START, SYSTEM):
        cost[:, s] = np.minimum(best[:, s], INSERT + cost[:, USER])
    edit = np.where(drop == cost, 0, np.where(INSERT + cost[:, FILLED] == cost, 1, np.where(keep == cost, 2, 3)))
    edit[cost >= FAR] = 0  # no way from here: any edit will do
    return np.minimum(cost, FAR), edit.astype(np.uint8)


def level(v: np.ndarray) -> np.ndarray:
    """Vectors without their constant: the least entry is 0."""
    return np.where(v >= FAR, FAR, v - v.min(axis=1, keepdims=True))


def backward(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """First edits (turns x 4) and the vectors before each segment but for a
    constant.  ``codes`` holds the live turns of all segments one after the
    other, ``sizes`` their numbers, ``ends`` the vectors behind them.  Third:
    the number of fix-up passes."""
    codes = codes.astype(np.int64)
    n_lanes = -(-sizes // LANE)
    total = int(n_lanes.sum())
    edits = np.zeros((len(codes), 4), dtype=np.uint8)
    out = ends.astype(np.int64).copy()
    if not total:
        return edits, out, 0
    seg = np.repeat(np.arange(len(sizes)), n_lanes)
    first_lane = np.cumsum(n_lanes) - n_lanes
    in_seg = np.arange(total) - first_lane[seg]
    start = (np.cumsum(sizes) - sizes)[seg] + in_seg * LANE
    length = np.minimum(LANE, sizes[seg] - in_seg * LANE)
    last = in_seg == n_lanes[seg] - 1
    # the speculative vector is that of a conversation's end
    given = np.where(last[:, None], ends[seg], FINISH[None, :])
    kept = np.zeros((LANE + 1, total, 4), dtype=np.int64)  # kept[t]: vectors before the t-th last turn

    def run(lanes: np.ndarray, rerun: bool) -> None:
        now = given[lanes].copy()
        kept[0, lanes] = now
        for t in range(int(length[lanes].max())):
            inside = t < length[lanes]
            if not inside.all():
                lanes, now = lanes[inside], now[inside]
            at = start[lanes] + length[lanes] - 1 - t
            now, edit = step(codes[at], now)
            edits[at] = edit
            if rerun:
                same = (level(now) == level(kept[t + 1, lanes])).all(axis=1)
                lanes, now = lanes[~same], now[~same]  # all before these differs by a constant, which changes no choice
                if not len(lanes):
                    return
            kept[t + 1, lanes] = now

    everything = np.arange(total)
    run(everything, False)
    passes = 0
    while True:
        arrived = kept[length, everything]
        inner = everything[~last]
        new = arrived[inner + 1]
        wrong = (level(new) != level(given[inner])).any(axis=1)
        if not wrong.any():
            break
        passes += 1
        lanes = inner[wrong]
        given[lanes] = new[wrong]
        run(lanes, True)
    has = n_lanes > 0
    out[has] = kept[length, everything][first_lane[has]]
    return edits, out, passes


def trace(codes: np.ndarray, edits: np.ndarray, state: int, finish: bool, roles: list, texts: list) -> tuple[str, int, int, list, list]:
    """(audit, cost, state, roles, texts) of a segment entered in ``state``.
    ``codes`` holds all its turns, ``edits`` a row for each live one."""
    filled, kept = FILLED.tolist(), KEPT.tolist()
    plan = edits.tobytes()
    audit, cost, out_roles, out_texts, at = [], 0, [], [], 0

    def insert() -> None:
        nonlocal state, cost
        state = filled[state]
        audit.append("I")
        out_roles.append(ROLES[state])
        out_texts.append("")
        cost += INSERT

    for i, code in enumerate(codes.tolist()):
        if code == DEAD:
            audit.append("D")
            cost += DELETE
            continue
        edit = plan[at + state]
        while edit == 1:
            insert()
            edit = plan[at + state]
        at += 4
        audit.append(EDITS[edit])
        if edit == 0:
            cost += DELETE
            continue
        cost += TRUNCATED if code >= 4 else 0
        if edit == 2:
            state = kept[code % 4][state]
            cost += KEEP
            out_roles.append(roles[i])
        else:
            state = filled[state]
            cost += REROLE
            out_roles.append(ROLES[state])
        out_texts.append(texts[i])
    while finish and state in (SYSTEM, USER):
        insert()
    return "".join(audit), cost, state, out_roles, out_texts


def exits(codes: np.ndarray, edits: np.ndarray) -> list[int]:
    """The state in which a segment is left, for each state it is entered in
    (what lies behind it decides about turns after its last one)."""
    nobody = [""] * len(codes)
    return [trace(codes, edits, s, False, nobody, nobody)[2] for s in range(4)]


@dataclass
class _Run:
    """Turns of one conversation in order, as far as they are read."""

    conv: object
    k: int = 0
    chars: int = 0

    def __post_init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.turns, self.roles, self.texts, self.faults = [], [], [], []
        self.chars = 0


ROLE_CLASS = {"s": 0, "u": 1, "a": 2}


def _codes(roles: list[str], faults: list[int]) -> np.ndarray:
    """Codes from roles and faults (0 none, 1 blank, 2 duplicate, 3 truncated)."""
    return np.array([DEAD if f in (1, 2) else ROLE_CLASS.get(r[:1], 3) + (4 if f == 3 else 0) for r, f in zip(roles, faults)], dtype=np.uint8)


def _turns(turns: list) -> tuple[int | None, int | None, int]:
    """First and last turn and the number of different ones, without nulls."""
    known = [t for t in turns if t is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))


COLUMNS = [
    ("piece", "bigint", pa.int64()), ("open", "boolean", pa.bool_()), ("k", "int", pa.int32()),
    ("t_first", "bigint", pa.int64()), ("t_last", "bigint", pa.int64()), ("t_n", "bigint", pa.int64()),
    ("blank", "bigint", pa.int64()), ("duplicate", "bigint", pa.int64()), ("truncated", "bigint", pa.int64()),
    ("illegal", "bigint", pa.int64()), ("cost", "bigint", pa.int64()), ("audit", "string", pa.string()),
    ("roles", "array<string>", pa.list_(pa.string())), ("texts", "array<string>", pa.list_(pa.string())),
    ("faults", "binary", pa.binary()), ("digests", "array<binary>", pa.list_(pa.binary())),
]


def _read(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One task's sorted rows -> closed conversations, solved, and open pieces."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    serial = 0
    closed: list[_Run] = []
    weight = [0, 0]
    rows: list[tuple] = []

    def emit() -> pa.RecordBatch:
        names = ["conv", *(c[0] for c in COLUMNS)]
        types = [id_type, *(c[2] for c in COLUMNS)]
        cols = list(zip(*rows)) if rows else [()] * len(names)
        out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)
        rows.clear()
        return out

    def number() -> int:
        nonlocal serial
        serial += 1
        return (part << 32) | serial

    def solve() -> None:
        """Solve the closed conversations at hand."""
        codes = [_codes(c.roles, c.faults) for c in closed]
        live = [c[c != DEAD] for c in codes]
        sizes = np.array([len(x) for x in live], dtype=np.int64)
        edits, _, _ = backward(np.concatenate(live) if live else np.zeros(0, np.uint8), sizes, np.tile(FINISH, (len(closed), 1)))
        upto = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        for c, code, s, e in zip(closed, codes, upto, upto[1:]):
            audit, cost, _, roles, texts = trace(code, edits[s:e], START, True, c.roles, c.texts)
            first, last, n = _turns(c.turns)
            rows.append((c.conv, number(), False, 0, first, last, n, c.faults.count(1), c.faults.count(2), c.faults.count(3),
                         _illegal(c.roles), cost, audit, roles, texts, None, None))
        closed.clear()
        weight[:] = [0, 0]

    def mark(run: _Run) -> None:
        """Duplicates among the turns of a whole conversation."""
        seen = set()
        for i, key in enumerate(zip(run.roles, run.texts)):
            if key in seen and run.faults[i] != 1:
                run.faults[i] = 2
            seen.add(key)

    def piece(run: _Run) -> None:
        """An open piece: repeats inside it are marked, others go by digest."""
        keys = [hashlib.blake2b(f"{run.conv!r}\0{r}\0{t}".encode("utf-8", "surrogatepass"), digest_size=16).digest() if f != 1 else None
                for r, t, f in zip(run.roles, run.texts, run.faults)]
        seen: set = set()
        for i, key in enumerate(keys):
            if key in seen:
                run.faults[i], keys[i] = 2, None
            elif key is not None:
                seen.add(key)
        first, last, n = _turns(run.turns)
        rows.append((run.conv, number(), True, run.k, first, last, n, None, None, None, _illegal(run.roles), None, None,
                     run.roles, run.texts, bytes(run.faults), keys))
        run.k += 1
        run.clear()

    now: _Run | None = None
    leading = True  # the first conversation may have begun in the task before
    for batch in batches:
        conv, turn, role, text, fault, present = (batch.column(i).to_pylist() for i in range(6))
        for i in range(batch.num_rows):
            if now is None or conv[i] != now.conv or type(conv[i]) is not type(now.conv):
                if now is not None:
                    if leading or now.k:
                        piece(now)
                    else:
                        mark(now)
                        closed.append(now)
                        weight[0] += len(now.roles) + 1
                        weight[1] += now.chars
                        if weight[0] > PIECE_ROWS or weight[1] > PIECE_CHARS:
                            solve()
                    leading = False
                    if len(rows) >= 512:
                        yield emit()
                now = _Run(conv[i])
            if not present[i]:
                continue
            now.turns.append(turn[i])
            now.roles.append(role[i])
            now.texts.append(text[i])
            now.faults.append(fault[i])
            now.chars += len(text[i])
            if len(now.roles) >= PIECE_ROWS or now.chars >= PIECE_CHARS:
                piece(now)
                yield emit()
    if closed:
        solve()
        yield emit()
    if now is not None:  # the last one may go on in the next task
        piece(now)
        yield emit()


def _arrow(t: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_type(_parse_datatype_string(t))


def _respond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compact open pieces -> their codes, counts and response vectors."""
    for batch in batches:
        roles, faults, late = (batch.column(n).to_pylist() for n in ("initials", "faults", "late"))
        codes = []
        counts = []
        for r, f, x in zip(roles, faults, late):
            f = bytearray(f)
            for i in x or ():
                f[i] = 2
            codes.append(_codes(r, f))
            counts.append([f.count(1), f.count(2), f.count(3)])
        live = [c[c != DEAD] for c in codes]
        sizes = np.repeat(np.array([len(x) for x in live], dtype=np.int64), 4)
        four = [x for x in live for _ in range(4)]
        vectors = _unleveled(np.concatenate(four) if four else np.zeros(0, np.uint8), sizes, np.tile(UNITS, (len(codes), 1)))
        counts = np.array(counts, dtype=np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("piece"), pa.array([c.tobytes() for c in codes], pa.binary()),
             pa.array(vectors.reshape(-1, 16).tolist(), pa.list_(pa.int64())),
             *(pa.array(counts[:, j]) for j in range(3)), batch.column("illegal"),
             batch.column("t_first"), batch.column("t_last"), batch.column("t_n"),
             pa.array([r[0] if r else None for r in roles], pa.string()), pa.array([r[-1] if r else None for r in roles], pa.string())],
            names=["conv", "piece", "codes", "response", "blank", "duplicate", "truncated", "illegal", "t_first", "t_last", "t_n", "i_first", "i_last"])


def _unleveled(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The vectors before each segment with their constants: the choices of
    ``backward`` are followed from each state and their costs added."""
    edits, _, _ = backward(codes, sizes, ends)
    upto = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    out = np.full((len(sizes), 4), FAR, dtype=np.int64)
    for k, (s, e) in enumerate(zip(upto, upto[1:])):
        nobody = [""] * (e - s)
        for state in range(4):
            _, cost, end, _, _ = trace(codes[s:e], edits[s:e], state, False, nobody, nobody)
            out[k, state] = min(FAR, cost + ends[k, end])
    return out


def _stream(backwards: bool):
    """A function over piece rows sorted by conversation: the vector behind
    each piece (from the end), or its entry state and what changes at its edge
    (from the start).  It holds one row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, behind = object(), None
        state, initial, turn = START, None, None
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in batch.schema.names}
            out: list[list] = [[], [], [], []]
            for i in range(batch.num_rows):
                fresh = col["conv"][i] != conv or type(col["conv"][i]) is not type(conv)
                conv = col["conv"][i]
                if backwards:
                    if fresh:
                        behind = FINISH
                    out[0].append(behind.tolist())
                    out[1].append(fresh)
                    answer = np.array(col["response"][i], dtype=np.int64).reshape(4, 4)
                    behind = (answer + behind[:, None]).min(axis=0)
                    behind = np.minimum(behind - behind.min(), FAR)
                else:
                    if fresh:
                        state, initial, turn = START, None, None
                    out[0].append(state)
                    state = col["exits"][i][state]
                    a, b = initial, col["i_first"][i]
                    out[1].append(int(a is not None and b is not None and a + b not in ("su", "ua", "au")))
                    out[2].append(int(turn is not None and turn == col["t_first"][i]))
                    initial = col["i_last"][i] if col["i_last"][i] is not None else initial
                    turn = col["t_last"][i] if col["t_last"][i] is not None else turn
            if backwards:
                yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(out[0], pa.list_(pa.int64())), pa.array(out[1], pa.bool_())],
                                                 names=["piece", "behind", "final"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())],
                                                 names=["piece", "entry", "edge_illegal", "edge_turn"])

    return run


def _edits_of(codes: list[bytes], behind: list[list[int]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(codes, first edits) of pieces whose vector behind is known."""
    every = [np.frombuffer(c, dtype=np.uint8) for c in codes]
    live = [c[c != DEAD] for c in every]
    sizes = np.array([len(x) for x in live], dtype=np.int64)
    edits, _, _ = backward(np.concatenate(live), sizes, np.array(behind, dtype=np.int64))
    return list(zip(every, np.split(edits, np.cumsum(sizes)[:-1])))


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            solved = _edits_of(batch.column("codes").to_pylist(), batch.column("behind").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array([exits(c, e) for c, e in solved], pa.list_(pa.int32()))],
                                             names=["piece", "exits"])


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):  # a piece at a time: it may hold PIECE_CHARS of text
            row = {n: batch.column(n)[i].as_py() for n in ("codes", "behind", "final", "entry", "roles", "texts")}
            (codes, edits), = _edits_of([row["codes"]], [row["behind"]])
            audit, cost, _, roles, texts = trace(codes, edits, row["entry"], row["final"], row["roles"], row["texts"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv").slice(i, 1), batch.column("piece").slice(i, 1), pa.array([cost]), pa.array([audit]),
                 pa.array([roles], pa.list_(pa.string())), pa.array([texts], pa.list_(pa.string()))],
                names=["conv", "piece", "cost", "audit", "roles", "texts"])


@dataclass
class Repaired:
    """``report``: a row for each conversation.  ``pieces``: the repaired
    turns, (conv, piece, whole, roles, texts), in the order of ``piece``;
    ``whole`` says that the piece is all of its conversation."""

    report: DataFrame
    pieces: DataFrame

    def turns(self) -> DataFrame:
        """(conv, piece, at, role, text): one row for each repaired turn."""
        return (self.pieces.select("conv", "piece", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "turn"))
                .select("conv", "piece", "at", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text")))


#: The white space that does not count as text.
WHITE = "\t\n\x0b\x0c\r "


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: str | None = None) -> Repaired:
    """Repair every conversation of ``rows``.  The report holds conv, gaps,
    blank, duplicate, truncated, illegal, cost (long) and audit."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text), F.lit(" ")).alias("text"),
                       (F.coalesce(F.col(present), F.lit(False)) if present else F.lit(True)).alias("present"),
                       F.monotonically_increasing_id().alias("serial"))  # parts rows that repeat
    order = ["conv", "turn", "role", F.xxhash64("text"), "serial"]
    fault = F.when(F.length(bare) == 0, 1).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0).cast("int")
    ordered = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
               .select("conv", "turn", "role", "text", fault.alias("fault"), "present"))
    id_name = rows.schema["conv"].dataType.simpleString()
    id_type = _arrow(id_name)
    schema = f"conv {id_name}, " + ", ".join(f"{n} {t}" for n, t, _ in COLUMNS)
    read = written(ordered.mapInArrow(lambda batches: _read(batches, id_type), schema))

    closed, opened = read.where("not open"), read.where("open")
    marks = opened.select("piece", F.posexplode("digests").alias("at", "digest")).where("digest is not null")
    repeated = marks.groupBy("digest").agg(F.min("piece").alias("first"), F.max("piece").alias("last")).where("first < last")
    late = (marks.join(repeated, "digest").where("piece > first").groupBy("piece").agg(F.collect_list("at").alias("late")))
    compact = opened.select("conv", "piece", F.transform("roles", lambda r: F.substring(r, 1, 1)).alias("initials"), "faults", "illegal", "t_first", "t_last", "t_n")
    answered = written(compact.join(late, "piece", "left").mapInArrow(
        _respond, f"conv {id_name}, piece bigint, codes binary, response array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                  "t_first bigint, t_last bigint, t_n bigint, i_first string, i_last string"))
    behind = (answered.select("conv", "piece", "response").repartition("conv").sortWithinPartitions("conv", F.desc("piece"))
              .mapInArrow(_stream(True), "piece bigint, behind array<bigint>, final boolean"))
    known = written(answered.join(behind, "piece"))
    left = known.select("piece", "codes", "behind").mapInArrow(_exits, "piece bigint, exits array<int>")
    entered = (known.select("conv", "piece", "t_first", "t_last", "i_first", "i_last").join(left, "piece")
               .repartition("conv").sortWithinPartitions("conv", "piece")
               .mapInArrow(_stream(False), "piece bigint, entry int, edge_illegal bigint, edge_turn bigint"))
    stitched = written(known.drop("conv", "response").join(entered, "piece"))
    traced = written(opened.select("conv", "piece", "roles", "texts").join(stitched.select("piece", "codes", "behind", "final", "entry"), "piece")
                     .mapInArrow(_trace, f"conv {id_name}, piece bigint, cost bigint, audit string, roles array<string>, texts array<string>"))

    def gaps(lo: Column, hi: Column, n: Column) -> Column:
        return F.coalesce(hi - lo + 1 - n, F.lit(0)).cast("long")

    joined = (traced.select("conv", "piece", "cost", "audit").join(stitched, "piece").groupBy("conv").agg(
        gaps(F.min("t_first"), F.max("t_last"), F.sum(F.col("t_n") - F.col("edge_turn"))).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        F.sum(F.col("illegal") + F.col("edge_illegal")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "").alias("audit")))
    report = closed.select("conv", gaps(F.col("t_first"), F.col("t_last"), F.col("t_n")).alias("gaps"),
                           "blank", "duplicate", "truncated", "illegal", "cost", "audit").unionByName(joined)
    pieces = (closed.select("conv", "piece", F.lit(True).alias("whole"), "roles", "texts")
              .unionByName(traced.select("conv", "piece", F.lit(False).alias("whole"), "roles", "texts")))
    return Repaired(report, pieces)


def _lines(sep: str) -> Column:
    return F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), sep)


def digests(pieces: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): SHA-256 of the `role:text` lines of a
    conversation.  A digest is a chain, so the pieces of a conversation that
    has several pass one task in order, one piece in memory at a time."""
    whole = pieces.where("whole").select("conv", F.sha2(_lines("\n").cast("binary"), 256).alias("repaired_sha256"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, empty, begun = None, hashlib.sha256(), True, False
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            done: list[tuple] = []
            for i in range(batch.num_rows):
                c = batch.column(0)[i].as_py()
                if begun and (c != conv or type(c) is not type(conv)):
                    done.append((conv, state.hexdigest()))
                    state, empty = hashlib.sha256(), True
                conv, begun = c, True
                line = batch.column(2)[i].as_py()
                if line is not None:
                    state.update(("" if empty else "\n").encode() + line.encode("utf-8", "surrogatepass"))
                    empty = False
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], kind), pa.array([d[1] for d in done])], names=["conv", "repaired_sha256"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])

    id_name = pieces.schema["conv"].dataType.simpleString()
    parts = (pieces.where("not whole").select("conv", "piece", F.when(F.size("roles") > 0, _lines("\n")).alias("lines"))
             .repartition("conv").sortWithinPartitions("conv", "piece")
             .mapInArrow(chain, f"conv {id_name}, repaired_sha256 string"))
    return whole.unionByName(parts)


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the faults that the query plants,
    chosen by the CRC-32 of `conv_id:turn`; dropped rows stay with a false
    ``present``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), space)
    return (conversations.select("conv_id", "turn", F.col("role").alias("_role"), text.alias("_text"), fault.alias("_fault"))
            .select("conv_id", "turn",
                    F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.coalesce("_role", space)).alias("role"),
                    F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text")).alias("text"),
                    (F.col("_fault") != 0).alias("present"),
                    F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"))
            .drop("_copy"))


def op12_convrepair(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = repair(damaged(table(spark, sf_dir, "conversations")), present="present")
    hashed = digests(done.pieces).withColumnRenamed("conv", "other")
    return (done.report.join(hashed, F.col("conv").eqNullSafe(F.col("other")))
            .select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
