"""Unknown fields told by the data, and the functions for SQL text."""

import json

import pytest
from pyspark.sql import functions as F

from tidemirror.functions.sql import register_functions
from tidemirror.operators import discover as D


def told(spark, bodies):
    rows = spark.createDataFrame([(i, None if b is None else json.dumps(b)) for i, b in enumerate(bodies)], "id BIGINT, body STRING")
    return rows.select("id", F.expr("try_parse_json(body)").alias("custom"), F.lit("x").alias("_entries"))


def test_fields_their_kinds_and_the_columns_read_from_them(spark):
    bodies = [{"Known": 1, "n": 1, "x": 1, "b": True, "mix": 1, "it's": "a"}, {"n": -2, "x": 2.5, "b": None, "mix": "t", "o": {"k": 1}}, {"N": 7, "void": None}, None, {}, [1]]
    rows = told(spark, bodies)
    found = {r["field"]: (r["kind"], r["records"], r["filled"]) for r in D.unknown_fields(rows, "custom", ["known"]).collect()}
    assert found == {
        "N": ("BIGINT", 3, 3), "x": ("DOUBLE", 2, 2), "b": ("BOOLEAN", 2, 1), "mix": ("STRING", 2, 2),
        "it's": ("STRING", 1, 1), "o": ("STRING", 1, 1), "void": ("STRING", 1, 0),
    }
    columns = D.new_columns(D.unknown_fields(rows, "custom", ["known"]))
    assert "void" not in columns
    got = {r["id"]: r.asDict() for r in D.with_fields(rows, "custom", columns, ["id", "_entries"]).collect()}
    assert [got[i]["N"] for i in range(6)] == [1, -2, 7, None, None, None]
    assert (got[0]["x"], got[1]["x"], got[0]["b"], got[1]["b"], got[1]["mix"], got[0]["it's"], got[1]["o"]) == (1.0, 2.5, True, None, "t", "a", '{"k":1}')
    assert got[0]["_entries"] == "x"
    with pytest.raises(D.TooManyFields):
        D.new_columns(D.unknown_fields(rows, "custom", []), most=3)


def test_an_empty_table_has_no_fields(spark):
    rows = told(spark, [{"a": 1}]).limit(0)
    found = D.unknown_fields(rows, "custom", [])
    assert found.count() == 0 and D.new_columns(found) == {}
    assert D.with_fields(rows, "custom", {}, ["id"]).columns == ["id"]


def test_functions_in_sql_give_what_the_columns_give(spark):
    names = register_functions(spark, "t_")
    assert len(names) == 6
    got = spark.sql("SELECT t_parse_ts(x) AS at, t_to_bit(x) AS bit FROM VALUES ('Tue, 05 Mar 2024 10:11:12 GMT'), ('yes'), (NULL) AS v(x)").collect()
    assert [(str(r["at"]), r["bit"]) for r in got] == [("2024-03-05 10:11:12", False), ("None", True), ("None", None)]
    pages = """VALUES (1, '{"deals":[{"id":1},{"id":2}]}'), (2, '{"x":1}'), (3, 'broken'), (4, NULL) AS v(n, body)"""
    got = spark.sql(f"SELECT n, pos, CAST(rec:id AS INT) AS id FROM {pages}, LATERAL t_page_records(body, 'deals')")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 0, 1), (1, 1, 2)]
    texts = spark.range(3).selectExpr("CAST(id AS STRING) AS x")
    plan = spark.sql("SELECT t_to_bit(x) AS bit FROM {texts}", texts=texts)._jdf.queryExecution().executedPlan().toString()
    assert "lower(" in plan and "t_to_bit" not in plan and "Python" not in plan
