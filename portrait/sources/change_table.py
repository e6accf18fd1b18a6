"""A database table with its change log as one Spark source (S4): the snapshot
first, then the log, under one offset.

``change_table`` makes a Python data source.  Its readers run on the executors,
each over its own connection (any DB-API driver), and hand out change records
in the envelope of ``cdc.ENVELOPE``.

* ``spark.read``: the snapshot, records of op ``r``, cut into ranges of the key
  by one min/max query.
* ``spark.readStream``: the offset is a log position.  The first batch is the
  snapshot, read after the log's end was asked for, and ends at that position;
  later batches are the log after it, cut into ranges of positions.  Nothing
  between the two is lost; a change that the snapshot has seen already is
  delivered again by the log, which ``cdc.apply_changes`` (latest per key) takes
  as a replay.  A query that starts again goes on after its last offset.

Defined cases: rows with a null key belong to the first range; an empty table
and an empty log give no records; a null value is no entry of ``after``.  Key
ranges have equal width, so a key column with large gaps gives uneven tasks;
``ranges`` raises their number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from portrait.sources.cdc import ENVELOPE

try:  # workers need not have the package: see streaming/stateful.py
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

#: Rows that a reader fetches at one time.
FETCH_ROWS = 10_000


class Range(InputPartition):
    """Rows of the table or the log with ``lo`` <= number < ``hi``."""

    def __init__(self, of: str, lo: int, hi: int, first: bool, pos: int):
        super().__init__(0)
        self.of, self.lo, self.hi, self.first, self.pos = of, lo, hi, first, pos


def ranges(of: str, lo: int, hi: int, parts: int, least: int, pos: int) -> list[Range]:
    """[lo, hi) in at most ``parts`` ranges of at least ``least`` numbers."""
    width = max(least, -(-(hi - lo) // parts), 1)
    return [Range(of, a, min(a + width, hi), a == lo, pos) for a in range(lo, hi, width)]


class Table:
    """What both readers ask the database."""

    def __init__(self, connect: Callable, table: str, log: str | None, key: str, columns: Sequence[str], db: str, name: str, parts: int):
        self.connect, self.table, self.log, self.key, self.columns = connect, table, log, key, list(columns)
        self.db, self.name, self.parts = db, name, parts

    def one(self, sql: str) -> tuple:
        con = self.connect()
        try:
            cur = con.cursor()
            cur.execute(sql)
            return tuple(cur.fetchone())
        finally:
            con.close()

    def rows(self, sql: str) -> Iterator[tuple]:
        con = self.connect()
        try:
            cur = con.cursor()
            cur.execute(sql)
            while found := cur.fetchmany(FETCH_ROWS):
                yield from found
        finally:
            con.close()

    def snapshot_ranges(self, pos: int) -> list[Range]:
        lo, hi, n = self.one(f"SELECT MIN({self.key}), MAX({self.key}), COUNT(*) FROM {self.table}")
        if lo is None:
            return [Range("table", 0, 0, True, pos)] if n else []
        return ranges("table", int(lo), int(hi) + 1, self.parts, 1, pos)

    def log_end(self) -> int:
        return int(self.one(f"SELECT COALESCE(MAX(pos), 0) FROM {self.log}")[0]) if self.log else 0

    def read(self, r: Range) -> Iterator[tuple]:
        names = ", ".join(f"CAST({c} AS VARCHAR)" for c in self.columns)
        if r.of == "table":
            where = f"{self.key} >= {r.lo} AND {self.key} < {r.hi}" + (f" OR {self.key} IS NULL" if r.first else "")
            for row in self.rows(f"SELECT {names} FROM {self.table} WHERE {where}"):
                yield ("r", None, self.filled(row), (self.db, self.name, r.pos), 0)
        else:
            for op, pos, ts, *row in self.rows(f"SELECT op, pos, ts_ms, {names} FROM {self.log} WHERE pos >= {r.lo} AND pos < {r.hi} ORDER BY pos"):
                values = self.filled(row)
                yield (op, values if op == "d" else None, None if op == "d" else values, (self.db, self.name, int(pos)), None if ts is None else int(ts))

    def filled(self, row: Sequence) -> dict:
        return {c: str(v) for c, v in zip(self.columns, row) if v is not None}


class SnapshotReader(DataSourceReader):
    def __init__(self, table: Table):
        self.table = table

    def partitions(self) -> list[Range]:
        return self.table.snapshot_ranges(0) or [Range("table", 0, 0, True, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        return self.table.read(partition)


class ChangeReader(DataSourceStreamReader):
    def __init__(self, table: Table):
        self.table = table

    def initialOffset(self) -> dict:
        return {"pos": -1}  # before the snapshot

    def latestOffset(self) -> dict:
        return {"pos": self.table.log_end()}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        if start["pos"] < 0:
            return self.table.snapshot_ranges(end["pos"])
        return ranges("log", start["pos"] + 1, end["pos"] + 1, self.table.parts, 1000, end["pos"])

    def read(self, partition: Range) -> Iterator[tuple]:
        return self.table.read(partition)


def change_table(format_name: str, connect: Callable, table: str, key: str, columns: Sequence[str], *, log: str | None = None,
                 db: str = "shop", name: str | None = None, parts: int = 64) -> type[DataSource]:
    """A data source class for ``spark.dataSource.register``.

    ``connect`` opens a DB-API connection (it runs on the executors); ``table``
    is a table name or a parenthesised query with the numeric ``key``; ``log``
    likewise, with ``pos`` (growing position from 1), ``op`` (c, u, d),
    ``ts_ms`` and the same columns (the key alone for a delete)."""
    of = Table(connect, table, log, key, columns, db, name or table, parts)

    class ChangeTable(DataSource):
        @classmethod
        def name(cls) -> str:
            return format_name

        def schema(self):
            return ENVELOPE

        def reader(self, schema) -> DataSourceReader:
            return SnapshotReader(of)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return ChangeReader(of)

    return ChangeTable
