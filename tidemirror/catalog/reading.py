"""Landed pages, scans, sweeps, nested rows and load modes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemirror.catalog.registry import CHANGED_SINCE, land, query, table
from tidemirror.operators import control as C
from tidemirror.sources import nested
from tidemirror.sources import pages as P


def contact_record():
    """A customer as the source would send it."""
    return F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("display_name"),
        F.col("c_mktsegment").alias("job_title"),
        F.col("c_acctbal").alias("balance"),
    )


@query("""
    SELECT 'contacts' AS entity, c_custkey // 100 + 1 AS page,
           row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS pos,
           c_custkey AS id, c_name AS display_name, c_mktsegment AS job_title, c_acctbal AS balance
    FROM customer
""")
def ingest_pages_explode(spark, sf):
    pages = land(table(spark, sf, "customer"), "contacts", "contacts", "c_custkey", contact_record(), 7)
    record = "STRUCT<id: BIGINT, display_name: STRING, job_title: STRING, balance: DOUBLE>"
    read = P.read_pages(pages, "contacts", record, P.FIRST_PAGE)
    return read.select("entity", "page", "pos", "rec.*")


_ACTIVITY_PAGES = """
    WITH p AS (SELECT event_id, event_type, value, event_id // 100 + 1 AS page,
                      ts < TIMESTAMP '2024-01-20' OR ts >= TIMESTAMP '2024-01-25' AS served FROM events),
         s AS (SELECT coalesce(min(page), 1000000000) AS stop FROM
               (SELECT page FROM p GROUP BY page HAVING count(*) FILTER (served) = 0))
    SELECT event_id AS id, event_type AS title, value, page FROM p, s WHERE served AND page < stop
"""


@query(_ACTIVITY_PAGES)
def ingest_stop_on_empty(spark, sf):
    """Activities of some days are gone at the source; the first page without any ends the scan."""
    served = (F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) | (
        F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")
    )
    record = F.when(
        served,
        F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("title"), F.col("value")),
    )
    pages = land(table(spark, sf, "events"), "sales_activities", "sales_activities", "event_id", record)
    record_type = "STRUCT<id: BIGINT, title: STRING, value: DOUBLE>"
    read = P.read_pages(pages, "sales_activities", record_type, P.UNTIL_EMPTY)
    return read.select("rec.id", "rec.title", "rec.value", "page")


def _nation_pages(spark, sf):
    """Contacts by nation view; pages with a single contact failed to land."""
    pages = land(table(spark, sf, "customer"), "contacts", "contacts", "c_custkey", contact_record(), F.col("c_nationkey"))
    size = F.size(F.from_json("body", "contacts ARRAY<STRUCT<id: BIGINT>>")["contacts"])
    return pages.withColumn("body", F.when(size == 1, "{}").otherwise(F.col("body")))


_NATION_PAGES = """
    p AS (SELECT c_nationkey AS view_id, c_custkey // 100 + 1 AS page, count(*) > 1 AS ok FROM customer GROUP BY ALL),
    t AS (SELECT view_id, max(page) AS total FROM p GROUP BY view_id),
    v AS (SELECT view_id, max(total) FILTER (page = 1 AND ok) AS expected, count(*) FILTER (ok) AS seen,
                 count(*) FILTER (NOT ok) AS failed FROM p JOIN t USING (view_id) GROUP BY view_id),
    c AS (SELECT v.*, coalesce((SELECT count(*) FROM p WHERE p.view_id = v.view_id AND ok AND page <= expected)
                               = expected, false) AS is_complete FROM v)
"""


@query(f"""
    WITH {_NATION_PAGES}
    SELECT 'contacts' AS entity, view_id, expected AS expected_pages, seen AS seen_pages,
           failed AS failed_pages, is_complete
    FROM c
""")
def page_completeness(spark, sf):
    return P.page_completeness(_nation_pages(spark, sf), "contacts", P.FIRST_PAGE)


@query("""
    WITH p AS (SELECT o_orderkey % 3 AS view_id, o_orderkey // 100 + 1 AS page FROM orders),
         v AS (SELECT view_id, max(page) AS total, count(DISTINCT page) AS seen FROM p GROUP BY view_id)
    SELECT 'deals' AS entity, o_orderkey AS id FROM orders
    WHERE o_orderkey <> 0 AND (SELECT bool_and(total = seen) AND count(*) = 3 FROM v)
""")
def active_id_sweep(spark, sf):
    """All orders, in three views."""
    record = F.struct(F.col("o_orderkey").alias("id"))
    pages = land(table(spark, sf, "orders"), "deals", "deals", "o_orderkey", record, F.col("o_orderkey") % 3)
    return P.active_ids(pages, "deals", P.FIRST_PAGE, [0, 1, 2], needs_view=True)


@query(f"""
    WITH {_NATION_PAGES}
    SELECT 'contacts' AS entity, c_custkey AS id FROM customer
    WHERE c_custkey <> 0 AND (SELECT bool_and(is_complete) FROM c)
    UNION ALL SELECT 'whole_contacts', c_custkey FROM customer WHERE c_custkey <> 0
""")
def active_id_sweep_incomplete(spark, sf):
    """All or nothing for each entity: a missing page of one withholds all its ids, and none of the other's."""
    whole = land(table(spark, sf, "customer"), "whole_contacts", "contacts", "c_custkey", contact_record(), 7)
    return P.active_ids(_nation_pages(spark, sf).unionByName(whole), "contacts", P.FIRST_PAGE)


@query(f"""
    WITH r AS (
        SELECT *, 1 AS o FROM orders
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1, o_orderdate, o_orderpriority, 2
                  FROM orders WHERE o_orderdate >= TIMESTAMP '{CHANGED_SINCE}'
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 2, o_orderdate, o_orderpriority, 3
                  FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT o_orderkey AS id, arg_max(o_totalprice, o) AS amount, arg_max(o_orderpriority, o) AS priority,
           CASE max(o) WHEN 1 THEN 30 WHEN 2 THEN 10 ELSE 20 END AS view_id
    FROM r GROUP BY o_orderkey
""")
def dedup_multi_view(spark, sf):
    """Deals come through three views; the copy of the view read last wins."""
    orders = table(spark, sf, "orders")
    recent = orders.filter(F.col("o_orderdate") >= F.lit(CHANGED_SINCE).cast("timestamp_ntz"))
    urgent = orders.filter("o_orderpriority = '1-URGENT'")

    def copies(rows, view, change):
        return rows.select(
            F.lit(view).cast("bigint").alias("view_id"),
            F.expr("o_orderkey div 100 + 1").alias("page"),
            F.col("o_orderkey").alias("pos"),
            F.col("o_orderkey").alias("id"),
            (F.col("o_totalprice") + change).alias("amount"),
            F.col("o_orderpriority").alias("priority"),
        )

    read = copies(orders, 30, 0).unionByName(copies(recent, 10, 1)).unionByName(copies(urgent, 20, 2))
    return P.dedup_views(read, "id", [30, 10, 20]).drop("page", "pos")


@query("SELECT event_id, ts, event_type, value FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'")
def incremental_filter(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return P.since(events, "ts", "2024-01-15 00:00:00")


def audit_log(spark, sf):
    """Events as an audit log; purchases never succeed, so they have no watermark."""
    bad = (F.col("event_type") == "purchase") | (F.col("value") >= 100)
    return table(spark, sf, "events").select(
        F.col("event_type").alias("entity_name"),
        F.col("ts").alias("last_execution_date"),
        F.when(bad, C.ERROR).otherwise(C.SUCCESS).alias("execution_status"),
        F.col("user_id").cast("int").alias("records_extracted"),
        F.col("event_id").cast("int").alias("records_inserted"),
        F.lit(0).alias("records_updated"),
        F.lit(0).alias("records_failed"),
        F.when(bad, F.col("props")).alias("error_message"),
        F.floor("value").cast("int").alias("execution_duration_seconds"),
    )


AUDIT = """
    SELECT event_type AS entity_name, ts AS last_execution_date,
           CASE WHEN event_type = 'purchase' OR value >= 100 THEN 'ERROR' ELSE 'SUCCESS' END AS execution_status,
           CAST(user_id AS INTEGER) AS records_extracted, CAST(event_id AS INTEGER) AS records_inserted,
           0 AS records_updated, 0 AS records_failed,
           CASE WHEN event_type = 'purchase' OR value >= 100 THEN props END AS error_message,
           CAST(floor(value) AS INTEGER) AS execution_duration_seconds
    FROM events
"""


@query(f"""
    WITH a AS ({AUDIT}),
         m AS (SELECT entity_name, max(last_execution_date) AS watermark FROM a
               WHERE execution_status = 'SUCCESS' GROUP BY entity_name),
         e AS (SELECT DISTINCT event_type AS entity_name, event_type <> 'signup' AS incremental FROM events)
    SELECT e.entity_name, incremental,
           CASE WHEN NOT incremental THEN 'full' WHEN watermark IS NULL THEN 'first' ELSE 'incremental' END AS mode,
           CASE WHEN incremental THEN watermark END AS watermark
    FROM e LEFT JOIN m ON m.entity_name = e.entity_name
""")
def resolve_load_mode(spark, sf):
    entities = table(spark, sf, "events").select(F.col("event_type").alias("entity_name")).distinct()
    entities = entities.withColumn("incremental", F.col("entity_name") != "signup")
    return C.load_modes(entities, audit_log(spark, sf))


@query("""
    SELECT o_orderkey * 10 + i AS id, list_extract(string_split(o_orderpriority, '-'), i) AS name, i AS position,
           o_orderkey AS deal_pipeline_id
    FROM orders, (SELECT unnest([1, 2]) AS i) WHERE i <= len(string_split(o_orderpriority, '-'))
""")
def explode_nested_children(spark, sf):
    """Each order a pipeline, the parts of its priority the nested stages."""
    stages = F.transform(
        F.split("o_orderpriority", "-"),
        lambda word, i: F.struct(
            (F.col("o_orderkey") * 10 + i + 1).alias("id"),
            word.alias("name"),
            (i + 1).alias("position"),
            F.col("o_orderkey").alias("deal_pipeline_id"),
        ),
    )
    body = F.to_json(F.struct(F.col("o_orderkey").alias("id"), stages.alias("deal_stages")))
    record = "deal_stages ARRAY<STRUCT<id: BIGINT, name: STRING, position: INT, deal_pipeline_id: BIGINT>>"
    pipelines = table(spark, sf, "orders").select(F.from_json(body, record).alias("rec")).select("rec.*")
    return nested.nested_children(pipelines, "deal_stages")


@query("""
    SELECT l_orderkey AS deal_id, 'part' AS name, l_partkey AS product_id, l_extendedprice AS total FROM lineitem
    UNION ALL SELECT l_orderkey, 'discount', l_partkey, l_discount FROM lineitem WHERE l_discount > 0
    UNION ALL SELECT l_orderkey, 'tax', l_partkey, l_tax FROM lineitem WHERE l_tax > 0
""")
def explode_parent_key(spark, sf):
    """Each line a deal record whose products are the part and, where charged, discount and tax."""

    def item(name, amount, wanted):
        return F.when(
            wanted, F.struct(F.lit(name).alias("name"), F.col("l_partkey").alias("product_id"), amount.alias("total"))
        )

    products = F.array_compact(
        F.array(
            item("part", F.col("l_extendedprice"), F.lit(True)),
            item("discount", F.col("l_discount"), F.col("l_discount") > 0),
            item("tax", F.col("l_tax"), F.col("l_tax") > 0),
        )
    )
    body = F.to_json(F.struct(F.col("l_orderkey").alias("id"), products.alias("products")))
    record = "id BIGINT, products ARRAY<STRUCT<name: STRING, product_id: BIGINT, total: DOUBLE>>"
    deals = table(spark, sf, "lineitem").select(F.from_json(body, record).alias("rec")).select("rec.*")
    return nested.children_with_parent(deals, "id", "products", "deal_id")


@query("""
    SELECT l_orderkey AS team_id, unnest(CASE WHEN l_returnflag = 'R' THEN [] ELSE [l_suppkey, l_partkey] END) AS user_id
    FROM lineitem
""")
def explode_relation(spark, sf):
    """Each line a team of two members; returned lines are empty teams."""
    members = F.when(F.col("l_returnflag") == "R", F.array().cast("array<bigint>")).otherwise(
        F.array("l_suppkey", "l_partkey")
    )
    body = F.to_json(F.struct(F.col("l_orderkey").alias("id"), members.alias("user_ids")))
    teams = table(spark, sf, "lineitem").select(F.from_json(body, "id BIGINT, user_ids ARRAY<BIGINT>").alias("rec"))
    return nested.relation_pairs(teams.select("rec.*"), "id", "user_ids", "team_id", "user_id")


@query("""
    SELECT p_partkey * 10 + i AS id, list_extract(string_split(p_name, ' '), i) AS name, i AS position
    FROM part, (SELECT unnest([1, 2, 3]) AS i) WHERE i <= len(string_split(p_name, ' '))
""")
def option_list_extract(spark, sf):
    """Each part a settings page whose first matching field lists the words of its name."""
    choices = F.transform(
        F.split("p_name", " "),
        lambda word, i: F.struct((F.col("p_partkey") * 10 + i + 1).alias("id"), word.alias("value"), (i + 1).alias("position")),
    )
    none = F.filter(choices, lambda _: F.lit(False))
    fields = F.array(
        F.struct(F.lit("deal_prediction").alias("name"), none.alias("choices")),
        F.struct(F.lit("forecast_category").alias("name"), choices.alias("choices")),
        F.struct(F.lit("forecast_category").alias("name"), none.alias("choices")),
    )
    body = F.to_json(F.struct(fields.alias("fields")))
    record = "fields ARRAY<STRUCT<name: STRING, choices: ARRAY<STRUCT<id: BIGINT, value: STRING, position: INT>>>>"
    settings = table(spark, sf, "part").select(F.from_json(body, record).alias("rec")).select("rec.*")
    return nested.option_list(settings, "fields", "forecast_category").withColumnRenamed("value", "name")
