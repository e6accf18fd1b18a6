"""Change records: parsing, routing, change application, config routing."""

from pyspark.sql import functions as F

from portrait.sources import cdc

ENV = "op string, after map<string,string>, ts_ms long, before map<string,string>, source struct<db:string,table:string,pos:bigint>"


def changes(spark, rows):
    data = [(op, after, ts, before, ("db", "order_info", pos[0] if pos else None)) for op, after, ts, before, *pos in rows]
    return spark.createDataFrame(data, ENV)


def test_parse_and_quarantine(spark):
    good = '{"op":"r","after":{"id":"1"},"source":{"db":"d","table":"t"},"ts_ms":5}'
    df = spark.createDataFrame([(good,), ('{"op":"r","after":{"id":',), (None,), ('{"x":1}',)], "value string")
    p = cdc.parse_changes(df)
    assert cdc.good(p).count() == 1 and cdc.quarantine(p).count() == 3
    r = cdc.good(p).first()
    assert r.after["id"] == "1" and r.source.table == "t" and r.ts_ms == 5


def test_apply_changes_semantics(spark):
    rows = [
        ("c", {"id": "1", "a": "x", "b": "y"}, 1, None),
        ("u", {"id": "1", "a": "", "b": "z"}, 2, None),       # empty does not overwrite
        ("c", {"id": "2", "a": "p", "b": "q"}, 1, None),
        ("d", None, 2, {"id": "2", "a": "p"}),               # tombstone
        ("c", {"id": "3", "a": "m", "b": "n"}, 1, None),
        ("d", None, 2, {"id": "3"}),
        ("c", {"id": "3", "a": "k"}, 3, None),                # re-insert after delete: b reset
        ("c", {"id": "1", "a": "x", "b": "y"}, 1, None),      # replay
    ]
    snap = {r.id: (r.a, r.b) for r in cdc.apply_changes(changes(spark, rows), "id", ["id", "a", "b"]).collect()}
    assert snap == {"1": ("x", "z"), "3": ("k", None)}


def test_change_state_merge_is_exact(spark):
    rows = [("c", {"id": "1", "a": "x"}, 1, None), ("d", None, 2, {"id": "1"}), ("c", {"id": "1", "b": "w"}, 3, None),
            ("u", {"id": "2", "a": "q"}, 4, None)]
    full = cdc.apply_changes(changes(spark, rows), "id", ["a", "b"])
    s1 = cdc.change_state(changes(spark, rows[:2]), "id", ["a", "b"])
    s2 = cdc.change_state(changes(spark, rows[2:]), "id", ["a", "b"])
    merged = cdc.state_to_snapshot(cdc.merge_change_states(s1, s2, "id"), "id")
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, full.collect()))


def test_route_by_config(spark):
    ch = spark.createDataFrame(
        [("r", {"id": "1", "name": "n", "secret": "s"}, 1, None, ("db", "user_info", 1)),
         ("r", {"id": "9"}, 1, None, ("db", "unrouted", 2))], ENV)
    cfg = spark.createDataFrame([("user_info", "cdc", "dim_user", "id,name", "id", "r,d"), ("user_info", "file", "never", "id", "id", None),
                                 ("user_info", None, "updates", "id", "id", "u")], cdc.CONFIG_SCHEMA)
    out = cdc.route_by_config(ch, cfg, source_type="cdc").select("topic", "row_key", cdc.canonical_fields().alias("f")).collect()
    assert [tuple(r) for r in out] == [("dim_user", "1", "id=1;name=n")]
    assert {r.topic for r in cdc.route_by_config(ch, cfg).collect()} == {"dim_user", "never"}


def test_route_of_a_delete_has_its_key(spark):
    ch = changes(spark, [("d", None, 1, {"id": "7"})])
    cfg = spark.createDataFrame([("order_info", None, "t", "id", "id", None)], cdc.CONFIG_SCHEMA)
    assert [(r.row_key, r.op) for r in cdc.route_by_config(ch, cfg).collect()] == [("7", "d")]


def test_changes_of_one_millisecond_follow_the_log(spark):
    rows = [
        ("c", {"id": "1", "a": "x"}, 5, None, 1), ("d", None, 9, {"id": "1"}, 2), ("c", {"id": "1", "b": "new"}, 9, None, 3),
        ("u", {"id": "2", "a": "zzz"}, 9, None, 4), ("u", {"id": "2", "a": "aaa"}, 9, None, 5),
        ("c", {"id": "3", "a": "x"}, 9, None, 6), ("d", None, 9, {"id": "3"}, 7),
    ]
    want = {"1": (None, "new"), "2": ("aaa", None)}
    for order in (rows, rows[::-1]):
        snap = {r.id: (r.a, r.b) for r in cdc.apply_changes(changes(spark, order), "id", ["id", "a", "b"]).collect()}
        assert snap == want


def test_wrong_types_and_missing_fields_are_quarantined(spark):
    head = '{"op":"r","source":{"db":"d","table":"t"}'
    bad = [head + ',"ts_ms":"x","after":{"id":"1"}}', head + ',"ts_ms":1,"after":"oops"}', head + ',"ts_ms":1}', head + ',"after":{"id":"1"}}',
           '{"op":"r","ts_ms":1,"after":{}}', "[]", "", "null"]
    good = [head + ',"ts_ms":1,"after":{"id":1}}', '{"op":"d","source":{"table":"t"},"ts_ms":1,"before":{"id":"1"},"after":null}']
    p = cdc.parse_changes(spark.createDataFrame([(t,) for t in bad + good], "value string"))
    assert sorted(r._raw for r in cdc.quarantine(p).collect()) == sorted(bad)
    assert cdc.good(p).count() == len(good)


def test_deletes_make_no_rows(spark):
    ch = changes(spark, [("c", {"id": "1", "uid": "1"}, 1, None), ("d", None, 2, {"id": "1"})])
    for project in (cdc.project_user, cdc.project_body, cdc.project_order_info, cdc.project_order_detail):
        assert project(ch).count() == 1


def test_camel_and_bean(spark):
    df = spark.createDataFrame([(1, "a", 5)], "province_id int, province_name string, ts long")
    assert cdc.camel_columns(df).columns == ["provinceId", "provinceName", "ts"]
    js = cdc.bean_json(cdc.camel_columns(df), hidden=["ts"]).first().json
    assert js == '{"province_id":1,"province_name":"a"}'


def test_text_is_parsed_once(spark):
    """Filters on parsed fields do not parse the text again."""
    from portrait.sources import cdc
    raw = spark.createDataFrame([('{"op":"r","after":{"id":"1"},"source":{"table":"t"},"ts_ms":1}',), ("{",), (None,)], "value string")
    rows = cdc.rows_after(cdc.good(cdc.parse_changes(raw))).select("op", "ts_ms", cdc.field("id", "bigint").alias("id"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json") + plan.lower().count("jsontostructs") == 1, plan
    assert [tuple(r) for r in rows.collect()] == [("r", 1, 1)]
    assert cdc.quarantine(cdc.parse_changes(raw)).count() == 2
