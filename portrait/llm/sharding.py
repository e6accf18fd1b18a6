"""Sharding by balanced label propagation.

Documents with equal texts are linked.  Linked documents start on shards
evenly (by hash); in each turn they ask to move to the shard where most of
their group is, as far as the quotas allow.  A group larger than a shard is
led to as many shards as have the room for it, those with most members first.  Quotas keep the law: shard j never holds
more linked documents than its number of rows, ``rows // shards`` and one
more for the first ``rows % shards``.  Documents without links cut nothing;
they fill, by hash order, what the quotas leave, so row counts end at most
one apart and slots have no gaps.

Everything is DataFrame operations.  A turn's requests come to the driver as
counts from shard to shard (at most shards ** 2 numbers), go back as as many
quotas, and are granted by rank; the linked rows are cut by a checkpoint.
Ranks are two-level: rows are counted by (key, bucket of a hash), the counts
(a table of bounded size) give each bucket's offset, and rows are numbered
inside their bucket, so no task sorts all rows of a shard.  A group is known
by its texts' hashes and is joined, not collected; a group that holds a third
of the rows is counted by partial aggregation and its members meet its aims in
parts.

Defined cases: null texts are no group and have size 16; empty texts are
equal texts; repeated ids are rows of their own; fewer rows than shards leave
shards empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from portrait.llm.common import cut, table, written

#: Rows in a bucket of a two-level rank, about; there are ``BUCKETS`` at least.
BUCKET_ROWS = 50_000
BUCKETS = 128
#: Members of a group that are joined with its aims in one part.
PART_ROWS = 500


def nodes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: rid (a number of its own), id, size, crc of the
    text, and its group (null: none)."""
    text = F.col(text_col)
    raw = F.coalesce(text, F.lit("")).cast("binary")
    group = F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), F.octet_length(text).alias("n")))
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                       (F.octet_length(raw) + F.lit(16)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), group.alias("g"))
    return cut(rows)


def ranked(df: DataFrame, keys: list[str], rows: int, name: str = "rank") -> DataFrame:
    """``df`` with each row's rank (from 0) among the rows of its key, in an
    order drawn by hash of ``rid``.  The number of buckets follows ``rows``, how
    many rows there are, so no task sorts more than a bucket; the offsets are a
    row for each bucket and value of the keys and come by a join on both, which
    the rows are dealt by already."""
    buckets = max(BUCKETS, -(-rows // BUCKET_ROWS))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(F.lit(7), "rid"), F.lit(buckets)))
    part = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    offsets = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(part), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy("rid"))
    numbered = df.withColumn("_inside", inside)
    return (numbered.join(offsets, [*keys, "_bucket"])
            .withColumn(name, (F.col("_offset") + F.col("_inside") - 1).cast("long")).drop("_bucket", "_inside", "_offset"))


def values(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A small table of whole numbers."""
    if not rows:
        return spark.range(0).select(*[F.lit(0).alias(n) for n in names.split(", ")])
    return spark.sql(f"SELECT * FROM VALUES {', '.join(str(tuple(map(int, r))) for r in rows)} AS t({names})")


def grant(wishes: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many of the wished moves (from, to) may happen when shard j has
    ``room[j]`` free places: exchanges first, then what the room allows; a
    move frees a place where it comes from."""
    left, room = dict(wishes), list(room)
    granted: dict[tuple[int, int], int] = {}

    def move(i: int, j: int, n: int) -> None:
        granted[i, j] = granted.get((i, j), 0) + n
        left[i, j] -= n

    for i, j in sorted(wishes):
        if i < j and (n := min(left[i, j], left.get((j, i), 0))):
            move(i, j, n)
            move(j, i, n)
    moved = True
    while moved:
        moved = False
        for i, j in sorted(left, key=lambda x: (-left[x], x)):
            if n := min(left[i, j], room[j]):
                move(i, j, n)
                room[j] -= n
                room[i] += n
                moved = True
    return granted


def propagate(linked: DataFrame, quotas: list[int], turns: int) -> DataFrame:
    """``linked`` (rid, g, members, shard, ...) after the moves."""
    spark, total = linked.sparkSession, sum(quotas)
    average = max(1, total // len(quotas))
    for _ in range(turns):
        held = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        room = [q - held.get(j, 0) for j, q in enumerate(quotas)]
        places = linked.groupBy("g", "shard").agg(F.count("*").alias("n"), F.first("members").alias("members"))
        free = F.greatest(F.element_at(F.array(*map(F.lit, room)), F.col("shard") + 1), F.lit(0))
        # first the shards with room (or with more than one member), then those with most members
        turn = Window.partitionBy("g").orderBy(F.desc((F.col("free") > 0) | (F.col("n") > 1)), F.desc("n"), F.xxhash64("g", "shard"))
        before = F.coalesce(F.sum(F.col("n") + F.col("free")).over(turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        first = places.withColumn("free", free).withColumn("place", F.row_number().over(turn)).withColumn("before", before)
        chosen = first.where((F.col("place") == 1) | ((F.col("members") > average) & (F.col("before") < F.col("members"))))
        aims = chosen.groupBy("g").agg(F.collect_list("shard").alias("aims"), F.collect_list(F.when(F.col("free") > 0, F.col("shard"))).alias("with_room"), F.first("members").alias("members"))
        ask = F.when(F.size("with_room") > 0, F.col("with_room")).otherwise(F.col("aims"))
        aim = F.element_at(ask, (F.pmod(F.xxhash64(F.lit(3), "rid"), F.size(ask)) + 1).cast("int"))
        stays = F.array_contains("aims", F.col("shard"))
        # a large group's members are dealt over parts of PART_ROWS, its aims go to each
        parts = F.ceil(F.col("members") / PART_ROWS).cast("int")
        spread = aims.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("members")
        dealt = linked.withColumn("part", F.pmod(F.xxhash64(F.lit(5), "rid"), parts).cast("int"))
        asked = cut(dealt.join(spread, ["g", "part"]).withColumn("to", F.when(stays, F.col("shard")).otherwise(aim)).drop("aims", "with_room", "part"))
        wishes = {(r["shard"], r["to"]): r["n"] for r in asked.where("shard <> to").groupBy("shard", "to").agg(F.count("*").alias("n")).collect()}
        granted = grant(wishes, room)
        if not granted:
            return linked
        allowed = values(spark, [(i, j, n) for (i, j), n in granted.items()], "shard, to, allowed")
        moving = ranked(asked.where("shard <> to"), ["shard", "to"], total // len(quotas)).join(F.broadcast(allowed), ["shard", "to"], "left")
        moved = moving.withColumn("shard", F.when(F.col("rank") < F.coalesce("allowed", F.lit(0)), F.col("to")).otherwise(F.col("shard")))
        linked = cut(moved.select(linked.columns).unionByName(asked.where("shard = to").select(linked.columns)))
    return linked


def assign(docs: DataFrame, shards: int = 40, turns: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row."""
    rows = nodes(docs, id_col, text_col)
    total = rows.count()
    quotas = [total // shards + (j < total % shards) for j in range(shards)]
    groups = rows.where("g IS NOT NULL").groupBy("g").agg(F.count("*").alias("members")).where("members > 1")
    # written: where both sides are plain reads, Spark can split one large group
    met = cut(rows.join(written(groups), "g", "left").select("rid", "id", "size", "text_crc32", "g", "members"))
    linked, single = met.where("members IS NOT NULL"), met.where("members IS NULL")
    start = ranked(linked.withColumn("_all", F.lit(0)), ["_all"], total).withColumn("shard", (F.col("rank") % shards).cast("int"))
    linked = propagate(cut(start.drop("_all", "rank")), quotas, turns)
    held = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    upto, ends = 0, []
    for j, q in enumerate(quotas):
        upto += q - held.get(j, 0)
        ends.append(upto)
    full = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("rank")))
    filled = ranked(single.withColumn("_all", F.lit(0)), ["_all"], total).withColumn("shard", full.cast("int"))
    names = ["rid", "id", "size", "text_crc32", "shard"]
    placed = cut(linked.select(names).unionByName(filled.select(names)))
    return ranked(placed, ["shard"], total // shards, "slot").select("id", "size", "text_crc32", "shard", "slot")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = assign(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
