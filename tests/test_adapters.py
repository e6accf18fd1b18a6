"""The adapters (driver tables -> job inputs) equal their SQL twins, which
every oracle query builds on."""

import pytest

from oracle_harness import compare, duck
from portrait.sources import adapters as A
from portrait.sources.tables import Tables

SF = "/root/testdata/sf0.001"
CASES = {
    "user_info": lambda t: A.user_info(t.customer),
    "user_sup_msg": lambda t: A.user_sup_msg(t.customer),
    "order_info": lambda t: A.order_info(t.orders),
    "order_detail": lambda t: A.order_detail(t.lineitem),
    "dim_sku": lambda t: A.dim_sku(t.part),
    "dim_trademark": lambda t: A.dim_trademark(t.part),
    "dim_category3": lambda t: A.dim_category3(t.supplier),
    "dim_category2": lambda t: A.dim_category2(t.nation),
    "dim_category1": lambda t: A.dim_category1(t.region),
    "category_compare_dic": lambda t: A.category_compare_dic(t.region),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_adapter_matches_sql(spark, name):
    r = compare(CASES[name](Tables(spark, SF)), duck(SF), A.SQL[name])
    assert r["schema_ok"] and r["values_ok"] and r["spark_rows"] == r["oracle_rows"], r


def test_base_dic_matches_sql(spark):
    from pyspark.sql import functions as F
    df = A.base_dic(Tables(spark, SF).orders).select("dic_code", F.col("info.dic_name").alias("dic_name"))
    r = compare(df, duck(SF), A.SQL["base_dic"])
    assert r["schema_ok"] and r["values_ok"], r
