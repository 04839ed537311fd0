"""Typing, flattening, row rules and schema alignment."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemirror.catalog.registry import land, query, table
from tidemirror.functions import normalize as N
from tidemirror.functions import quality as Q
from tidemirror.functions.sql import register_functions
from tidemirror.operators import discover as D
from tidemirror.operators.align import ensure_columns, evolve
from tidemirror.operators.upsert import ACTION, upsert
from tidemirror.plans.entities import CONTACTS
from tidemirror.plans.project import CUSTOM, project, record_type
from tidemirror.session import checkpointed
from tidemirror.sources import pages as P


def _by_type(**forms):
    """One expression per event type."""
    first, *rest = forms.items()
    chosen = F.when(F.col("event_type") == first[0], first[1])
    for kind, form in rest:
        chosen = chosen.when(F.col("event_type") == kind, form)
    return chosen


_PARSED_TIMES = """
    SELECT event_id,
           CASE WHEN value < 1 THEN NULL
                WHEN event_type = 'click' THEN date_trunc('second', ts)
                WHEN event_type = 'view' THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
                WHEN event_type = 'signup' THEN CAST(date_trunc('day', ts) AS TIMESTAMP)
                WHEN event_type = 'purchase' THEN date_trunc('minute', ts) END AS at
    FROM events
"""


def told_times(spark, sf):
    """Five spellings of a time; small values land outside the accepted range."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = _by_type(
        click=F.concat(iso, F.lit("-03:00")),
        view=F.date_format("ts", "MM/dd/yyyy"),
        signup=F.date_format("ts", " yyyyMMdd "),
        purchase=F.date_format("ts", "yyyy-MM-dd hh:mm a"),
        error=F.date_format("ts", "yyyy"),
    )
    text = F.when(F.col("value") < 1, F.concat(F.lit("1700"), F.substring(iso, 5, 30))).otherwise(text)
    return table(spark, sf, "events").select("event_id", text.alias("raw"))


@query(_PARSED_TIMES)
def parse_timestamp(spark, sf):
    return told_times(spark, sf).select("event_id", N.parse_ts("raw").alias("at"))


@query(_PARSED_TIMES)
def parse_timestamp_sql(spark, sf):
    """The same in SQL text."""
    register_functions(spark)
    return spark.sql("SELECT event_id, parse_ts(raw) AS at FROM {told}", told=told_times(spark, sf))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders
""")
def parse_date_only(spark, sf):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'23:59:59.9'Z'")
    slash = F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss")
    text = F.when(F.col("o_orderstatus") == "O", iso).when(F.col("o_orderstatus") == "P", slash).otherwise("2024-02-30")
    told = table(spark, sf, "orders").select("o_orderkey", text.alias("raw"))
    return told.select("o_orderkey", N.parse_date("raw").cast("string").alias("day"))


@query("""
    SELECT event_id, CASE event_type WHEN 'click' THEN true WHEN 'view' THEN true WHEN 'signup' THEN false
                                     WHEN 'purchase' THEN value >= 50 END AS flag
    FROM events
""")
def to_bit(spark, sf):
    raw = _by_type(
        click=F.lit("SÍ"),
        view=F.lit("Yes"),
        signup=F.lit(" si"),
        purchase=F.when(F.col("value") >= 50, "1").otherwise("1.0"),
        error=F.lit(None),
    )
    told = table(spark, sf, "events").select("event_id", raw.alias("raw"))
    return told.select("event_id", N.to_bit("raw").alias("flag"))


@query("""
    SELECT event_id, CASE event_type WHEN 'signup' THEN false WHEN 'view' THEN false
                                     ELSE CAST(json_extract(props, '$.k') AS INTEGER) <> 0 END AS flag
    FROM events
""")
def truthy_bit(spark, sf):
    """The props' number, an empty text, or nothing at all."""
    body = F.when(F.col("event_type") == "signup", '{"k":""}').when(F.col("event_type") == "view", "{}").otherwise(F.col("props"))
    told = table(spark, sf, "events").select("event_id", F.from_json(body, "k VARIANT").alias("rec"))
    return told.select("event_id", N.truthy_bit("rec.k").alias("flag"))


@query("""
    SELECT event_id, CASE event_type WHEN 'click' THEN false WHEN 'view' THEN NULL ELSE value > 20 END AS is_deleted,
           CASE event_type WHEN 'click' THEN true WHEN 'view' THEN NULL ELSE value > 20 END AS is_active
    FROM events
""")
def default_if_missing(spark, sf):
    told = F.concat(F.lit('{"x":'), F.when(F.col("value") > 20, "true").otherwise("false"), F.lit("}"))
    body = F.when(F.col("event_type") == "click", "{}").when(F.col("event_type") == "view", '{"x":null}').otherwise(told)
    told = table(spark, sf, "events").select("event_id", F.from_json(body, "x VARIANT").alias("rec"))
    return told.select(
        "event_id",
        N.default_if_missing("rec.x", False).alias("is_deleted"),
        N.default_if_missing("rec.x", True).alias("is_active"),
    )


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.k') = 1 AS is_one,
           strftime(ts, '%Y-%m-%d') AS day, value AS amount
    FROM events
""")
def flatten_json_fields(spark, sf):
    """The props' number read twice, with two fields of the row added to the object."""
    added = F.format_string(
        ',"is_one":%s,"day":"%s","amount":"%s"}',
        F.get_json_object("props", "$.k"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.col("value").cast("string"),
    )
    body = F.concat(F.rtrim("props", F.lit("}")), added)
    fields = {"k": "bigint", "is_one": "bit", "day": "date", "amount": "double"}
    told = table(spark, sf, "events").select("event_id", body.alias("body"))
    flat = told.select("event_id", *N.flatten_json_fields("body", fields))
    return flat.withColumn("day", F.col("day").cast("string"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_custkey END AS contact_id FROM orders
""")
def first_element(spark, sf):
    contacts = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<struct<id:bigint>>")).otherwise(
        F.array(F.struct(F.col("o_custkey").alias("id")), F.struct(F.col("o_orderkey").alias("id")))
    )
    deals = table(spark, sf, "orders").select("o_orderkey", contacts.alias("contacts"))
    return deals.select("o_orderkey", N.first_element("contacts", "id").alias("contact_id"))


@query("""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 OR c_mktsegment = 'BUILDING' THEN ''
                           ELSE c_mktsegment || ',' || c_name END AS tags
    FROM customer
""")
def join_list(spark, sf):
    items = F.when(F.col("c_acctbal") < 0, F.lit(None)).otherwise(
        F.when(F.col("c_mktsegment") == "BUILDING", F.array().cast("array<string>")).otherwise(
            F.array("c_mktsegment", "c_name")
        )
    )
    people = table(spark, sf, "customer").select("c_custkey", items.alias("items"))
    return people.select("c_custkey", N.join_list("items").alias("tags"))


@query("""
    SELECT c_custkey AS id, c_name AS display_name, lower(c_name) || '@example.com' AS email,
           CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS owner_id,
           CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN true ELSE false END AS is_deleted,
           CASE WHEN c_acctbal >= 0 THEN c_acctbal >= 5000 END AS cf_contacto_principal,
           c_mktsegment AS cf_pais, c_mktsegment || ',lead' AS tags,
           TIMESTAMP '2024-03-05 10:11:12' AS updated_at,
           CASE WHEN c_acctbal < 0 THEN 'owner_id:unreadable' ELSE '' END AS errors
    FROM customer
""")
def project_entity(spark, sf):
    """Customers as raw contact records, projected by the contacts spec."""
    deleted = (
        F.when(F.col("c_mktsegment") == "BUILDING", ',"is_deleted":null')
        .when(F.col("c_mktsegment") == "MACHINERY", ',"is_deleted":true')
        .otherwise("")
    )
    custom = F.when(F.col("c_acctbal") >= 5000, '"Si"').when(F.col("c_acctbal") >= 0, '"No"').otherwise("null")
    body = F.concat(
        F.format_string(
            '{"id":%s,"display_name":"%s","email":"%s@example.com","updated_at":"2024-03-05T10:11:12.9-03:00",',
            F.col("c_custkey").cast("string"),
            F.col("c_name"),
            F.lower("c_name"),
        ),
        F.when(F.col("c_acctbal") < 0, F.lit('"owner_id":"nobody"')).otherwise(
            F.concat(F.lit('"owner_id":'), F.col("c_nationkey").cast("string"), F.lit(".0"))
        ),
        deleted,
        F.format_string(
            ',"tags":["%s","lead"],"custom_field":{"cf_contacto_principal":%s,"cf_pais":"%s"}}',
            F.col("c_mktsegment"),
            custom,
            F.col("c_mktsegment"),
        ),
    )
    records = table(spark, sf, "customer").select(F.from_json(body, record_type(CONTACTS)).alias("rec"))
    rows = project(records, CONTACTS)
    shown = ["id", "display_name", "email", "owner_id", "is_deleted", "cf_contacto_principal", "cf_pais", "tags", "updated_at"]
    return rows.select(*shown, F.array_join(Q.ERRORS, ";").alias("errors"))


@query("""
    SELECT c_custkey, concat_ws(';', CASE WHEN c_mktsegment = 'FURNITURE' THEN 'segment:missing' END,
                                     CASE WHEN length(c_name || c_mktsegment) > 27 THEN 'label:too_long' END,
                                     CASE WHEN c_acctbal NOT BETWEEN 0 AND 9000 THEN 'c_acctbal:out_of_range' END) AS errors
    FROM customer
""")
def quarantine_rows(spark, sf):
    """Good rows with no error, quarantined rows with all of theirs."""
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        "c_acctbal",
        F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment"),
        F.concat("c_name", "c_mktsegment").alias("label"),
    )
    rules = [Q.required("segment"), Q.max_length("label", 27), Q.in_range("c_acctbal", 0, 9000)]
    good, bad = Q.split(Q.check(rows, rules))
    return (
        good.select("c_custkey", F.lit("").alias("errors"))
        .unionByName(bad.select("c_custkey", F.array_join(Q.ERRORS, ";").alias("errors")))
    )


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1
""")
def constraint_check(spark, sf):
    """Pairs that a unique constraint would refuse."""
    return Q.check_unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS INTEGER) AS nation, NULL AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, NULL, c_nationkey, c_mktsegment FROM customer
""")
def schema_align(spark, sf):
    """A table without the batch's new columns, a batch without one of the table's."""
    old = table(spark, sf, "supplier").selectExpr("s_suppkey as id", "s_name as name", "s_acctbal as balance")
    new = table(spark, sf, "customer").selectExpr(
        "c_custkey as id", "c_name as name", "c_nationkey as nation", "c_mktsegment as segment"
    )
    target, rows = evolve(old, new)
    return target.unionByName(rows)


@query("""
    SELECT p_partkey AS id, p_name AS name, p_type AS category, p_retailprice AS price, CAST(NULL AS VARCHAR) AS currency,
           CAST(NULL AS TIMESTAMP) AS updated_at, p_brand AS brand
    FROM part
""")
def ensure_table_columns(spark, sf):
    """An older, narrower table widened to a schema; its own extra column stays."""
    schema = T.StructType.fromDDL(
        "id BIGINT, name STRING, category STRING, price DOUBLE, currency STRING, updated_at TIMESTAMP_NTZ"
    )
    older = table(spark, sf, "part").selectExpr(
        "p_partkey as id", "p_name as name", "p_type as category", "p_retailprice as price", "p_brand as brand"
    )
    return ensure_columns(spark, older, schema)


def _told_contacts(spark, sf):
    """Customers as contacts whose custom fields tell one known name and three that no specification has."""
    custom = F.struct(
        F.col("c_mktsegment").alias("cf_rol_del_contacto"),
        F.col("c_acctbal").alias("cf_balance"),
        F.when(F.col("c_acctbal") < 0, F.lit(True)).alias("cf_debtor"),
        F.col("c_nationkey").alias("cf_nation"),
    )
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("display_name"), custom.alias(CUSTOM))
    return land(table(spark, sf, "customer"), "contacts", "contacts", "c_custkey", record, 7)


def _read_contacts(spark, sf):
    kind = f"STRUCT<id: BIGINT, display_name: STRING, {CUSTOM}: VARIANT>"
    return P.read_pages(_told_contacts(spark, sf), "contacts", kind, P.FIRST_PAGE).select("rec.*")


@query("""
    SELECT 'cf_balance' AS field, 'DOUBLE' AS kind, count(*) AS records, count(*) AS filled FROM customer HAVING count(*) > 0
    UNION ALL SELECT 'cf_debtor', 'BOOLEAN', count(*), count(*) FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0
    UNION ALL SELECT 'cf_nation', 'BIGINT', count(*), count(*) FROM customer HAVING count(*) > 0
""")
def discover_fields(spark, sf):
    return D.unknown_fields(_read_contacts(spark, sf), CUSTOM, CONTACTS.declared.names)


@query("""
    SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'old' END AS display_name,
           CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS cf_balance,
           CASE WHEN c_custkey % 2 = 0 AND c_acctbal < 0 THEN true END AS cf_debtor,
           CASE WHEN c_custkey % 2 = 0 THEN c_nationkey END AS cf_nation
    FROM customer
""")
def evolve_by_discovery(spark, sf):
    """A table widened by the fields of a batch that told changes of every second row."""
    # Written once: the fields are found in these rows and read from them.
    records = checkpointed(spark, _read_contacts(spark, sf).filter("id % 2 = 0"))
    columns = D.new_columns(D.unknown_fields(records, CUSTOM, CONTACTS.declared.names))
    old = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.lit("old").alias("display_name"))
    target, batch = evolve(old, D.with_fields(records, CUSTOM, columns, ["id", "display_name"]))
    return upsert(target, batch, "id").drop(ACTION)


@query("""
    SELECT c_custkey // 100 + 1 AS page, row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS pos,
           c_custkey AS id, c_acctbal < 0 AS debtor, true AS known
    FROM customer
""")
def page_records_sql(spark, sf):
    """Records out of landed pages, in SQL text: missing fields are false, or the default."""
    register_functions(spark)
    return spark.sql(
        """
        SELECT page, pos, CAST(rec:id AS BIGINT) AS id, truthy_bit(rec:custom_field.cf_debtor) AS debtor,
               bit_or_default(rec:known, true) AS known
        FROM {pages}, LATERAL page_records(body, 'contacts')
        """,
        pages=_told_contacts(spark, sf),
    )
