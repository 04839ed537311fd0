"""Column functions against the value vectors of the data model."""

from datetime import date, datetime

import pytest
from tidemirror.functions import normalize as N

TIMES = [
    ("2024-03-05T10:11:12.987654-03:00", datetime(2024, 3, 5, 10, 11, 12)),
    ("2024-03-05T10:11:12Z", datetime(2024, 3, 5, 10, 11, 12)),
    ("2024-03-05", datetime(2024, 3, 5)),
    ("  2024-03-05 ", datetime(2024, 3, 5)),
    ("01/02/2024", datetime(2024, 1, 2)),
    ("20240305", datetime(2024, 3, 5)),
    ("Mar 5 2024", datetime(2024, 3, 5)),
    ("2024-03-05 10:11 PM", datetime(2024, 3, 5, 22, 11)),
    ("15 Jan 2024", datetime(2024, 1, 15)),
    ("January 15, 2024", datetime(2024, 1, 15)),
    ("Mon, 15 Jan 2024 10:00:00 GMT", datetime(2024, 1, 15, 10)),
    ("2024/01/15", datetime(2024, 1, 15)),
    ("15/01/2024", datetime(2024, 1, 15)),
    ("20240115T101112", datetime(2024, 1, 15, 10, 11, 12)),
    ("Jan 15 2024 3:04 PM", datetime(2024, 1, 15, 15, 4)),
    (None, None),
    ("", None),
    ("garbage", None),
    ("2024-02-30", None),
    ("1752-12-31", None),
    ("1753-01-01", datetime(1753, 1, 1)),
    ("9999-12-31T00:00:00", datetime(9999, 12, 31)),
    ("9999-12-31T00:00:00.5", datetime(9999, 12, 31)),
    ("9999-12-31T00:00:01", None),
    ("2024", None),
    ("2024-03", None),
    ("5", None),
]


def column(spark, values, expression, sql_type="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {sql_type}")
    return [r[0] for r in df.orderBy("i").select(expression("v")).collect()]


def test_parse_ts(spark):
    assert column(spark, [t for t, _ in TIMES], N.parse_ts) == [v for _, v in TIMES]


def test_parse_ts_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 on 2024-03-10 does not exist in that zone.
        texts = ["2024-03-10T02:30:15.25Z", "2024-03-05T10:11:12-03:00"]
        assert column(spark, texts, N.parse_ts) == [datetime(2024, 3, 10, 2, 30, 15), datetime(2024, 3, 5, 10, 11, 12)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_date(spark):
    assert column(spark, ["2024-03-05T23:59:59-03:00", "x"], N.parse_date) == [date(2024, 3, 5), None]


def test_to_bit(spark):
    true = ["True", "true", "1", "Si", "SÍ", "sí", "yes"]
    false = ["", "no", "1.0", " si", "verdadero", "0", "false"]
    assert column(spark, [None, *true, *false], N.to_bit) == [None] + [True] * len(true) + [False] * len(false)


@pytest.mark.parametrize("default", [True, False])
def test_default_if_missing(spark, default):
    bodies = ["{}", '{"x":null}', '{"x":true}', '{"x":false}', '{"x":1}']
    got = column(
        spark, bodies, lambda v: N.default_if_missing(f"from_json({v}, 'x VARIANT').x", default)
    )
    assert got == [default, None, True, False, True]


def test_truthy_bit(spark):
    bodies = ["{}", '{"x":null}', '{"x":false}', '{"x":0}', '{"x":0.0}', '{"x":""}', '{"x":true}', '{"x":7}', '{"x":"no"}']
    got = column(spark, bodies, lambda v: N.truthy_bit(f"from_json({v}, 'x VARIANT').x"))
    assert got == [False] * 6 + [True] * 3


def test_join_list(spark):
    assert column(spark, [None, [], ["a", "b"]], N.join_list, "array<string>") == ["", "", "a,b"]


def test_first_element(spark):
    values = [None, [], [(7,), (8,)]]
    assert column(spark, values, lambda v: N.first_element(v, "id"), "array<struct<id:bigint>>") == [None, None, 7]


def test_typed_numbers(spark):
    assert column(spark, ["5", "5.0", "5.7", "x", None], lambda v: N.typed(v, "bigint")) == [5, 5, 5, None, None]
    assert [str(v) for v in column(spark, ["12.50", "3"], lambda v: N.typed(v, "decimal(18,2)"))] == ["12.50", "3.00"]


def test_flatten_json_fields(spark):
    body = '{"cf_a":"Sí","cf_b":1.0,"cf_c":"2024-12-31","cf_d":"12.5"}'
    df = spark.createDataFrame([(body,), (None,)], "v STRING")
    fields = {"cf_a": "bit", "cf_b": "bit", "cf_c": "date", "cf_d": "decimal(18,2)", "cf_e": "string"}
    first, second = df.select(*N.flatten_json_fields("v", fields)).collect()
    assert (first.cf_a, first.cf_b, first.cf_c, str(first.cf_d), first.cf_e) == (True, False, date(2024, 12, 31), "12.50", None)
    assert set(second) == {None}
