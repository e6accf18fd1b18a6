"""Order keys of a 6 GB input (54 million orders): the number of a line passes
2^63 there, and the queries go on."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from oracle_harness import compare, duck
from portrait.sources import adapters as A
from portrait.sources.tables import Tables

SF = "/root/testdata/sf0.001"
SHIFT = 21 * A.SPAN_S  # 54 million; event times stay as they are
WRAP = 1 << 64
LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"


@pytest.fixture(scope="module")
def large(spark, tmp_path_factory):
    """The small tables with the order keys of a large one, and their oracle:
    DuckDB reckons in 128 bits and takes the low 64 of an id."""
    d, con = str(tmp_path_factory.mktemp("large")), duck(SF)
    t = Tables(spark, SF)
    for name in ("customer", "supplier", "part", "nation", "region", "events"):
        getattr(t, name).write.parquet(f"{d}/{name}.parquet")
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        getattr(t, name).withColumn(key, F.col(key) + SHIFT).write.parquet(f"{d}/{name}.parquet")
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * REPLACE (CAST({key} AS HUGEINT) AS {key}) FROM read_parquet('{d}/{name}.parquet/*.parquet')")
    return d, con


def equal(r):
    assert r["schema_ok"] and r["values_ok"] and r["spark_rows"] == r["oracle_rows"] > 0, r


@pytest.mark.parametrize("name", ["stream_wide_watermark", "stream_wide_orders", "stream_label_chain"])
def test_rows_with_line_ids(spark, large, name):
    d, con = large
    low = f"CAST((id + {WRAP // 2}) % {WRAP} - {WRAP // 2} AS BIGINT)"
    equal(compare(E.queries()[name](spark, d), con, f"SELECT * REPLACE ({low} AS id) FROM ({E.oracle_sql()[name]})"))


def test_line_id_is_the_low_64_bits_and_turn_the_rest(spark):
    keys = [None, 0, 1, 17_854_000, 17_855_000, 20_000_000, 35_710_000, 54_000_000, 10**9, 10**12, -1, -54_000_000]
    rows = [(k, p, s, n, q, 1.0, 0.0, 0.0) for k in keys for p, s, n, q in ((1, 1, 1, 1.0), (7_199_999, 359_999, 7, 50.0), (0, -7, 3, -2.0))]
    df = spark.createDataFrame([*rows, (5, 5, None, 5, 5.0, 1.0, 0.0, 0.0)], LINE)
    for r in df.withColumns({"id": A.line_id(), "turn": A.line_id_turn()}).collect():
        if None in r[:3]:
            assert r["id"] is None and r["turn"] is None
            continue
        number = (((r[0] * 8 + r[3]) * 1_000_003 + r[1]) * 1_009 + int(math.fmod(r[2], 1_009))) * 64 + int(r[4])
        assert r["id"] + r["turn"] * WRAP == number and -WRAP // 2 <= r["id"] < WRAP // 2
        assert r["turn"] == 0 or not -WRAP // 2 <= number < WRAP // 2


@pytest.mark.parametrize("name", ["stream_metric_sku", "metric_sku"])
def test_amounts_are_those_of_small_keys(spark, large, name):
    equal(compare(E.queries()[name](spark, large[0]), duck(SF), E.oracle_sql()[name]))


@pytest.mark.parametrize("name", ["stream_metric_sku", "metric_sku"])
def test_lines_of_one_id_but_another_turn_count_both(spark, large, tmp_path, name):
    """Two lines whose numbers are 2^64 apart."""
    orders, rest = divmod(WRAP, 1_000_003 * 1_009 * 64)
    part, rest = divmod(rest, 1_009 * 64)
    at = 9 + orders
    rows = [(1, 1, 0, 1, 1.0, 2.0, 0.0, 0.0), (at // 8, 1 + part, rest // 64, at % 8, 1.0 + rest % 64, 3.0, 0.0, 0.0)]
    lines = spark.createDataFrame(rows, LINE)
    log = A.order_detail_log(lines).where("pos = 1").select("id", "id_turn").distinct().collect()
    assert len({r["id"] for r in log}) == 1 and sorted(r["id_turn"] for r in log) == [0, 1]
    for t in ("supplier", "part", "nation", "region"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    got = E.queries()[name](spark, str(tmp_path)).select("sku_id", "original_amount").collect()
    assert sorted(map(tuple, got)) == [(1, 2.0), (1 + part, 3.0)]
