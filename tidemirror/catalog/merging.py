"""Upserts, child and relation replacement, reconciliation, surrogate keys."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tidemirror.catalog.registry import CHANGED_SINCE, FIRST_TS, LOADED_UNTIL, RUN_TS, query, table
from tidemirror.operators import reconcile as R
from tidemirror.operators.children import cascade, replace_children, replace_relations
from tidemirror.operators.lookup import lookup
from tidemirror.operators.upsert import ACTION, action_counts, surrogate_keys, upsert
from tidemirror.session import checkpointed, shared_dir
from tidemirror.warehouse import Layout, Warehouse, slice_of

_TARGET = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'"

_BATCH = f"""
    SELECT o_orderkey, o_custkey, 'P' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
           CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderdate >= TIMESTAMP '{CHANGED_SINCE}'
"""

_MERGED = f"""
    WITH t AS ({_TARGET}), b AS ({_BATCH})
    SELECT coalesce(t.o_orderkey, b.o_orderkey) AS o_orderkey,
           CASE WHEN b.o_orderkey IS NULL THEN t.o_custkey ELSE b.o_custkey END AS o_custkey,
           CASE WHEN b.o_orderkey IS NULL THEN t.o_orderstatus ELSE b.o_orderstatus END AS o_orderstatus,
           CASE WHEN b.o_orderkey IS NULL THEN t.o_totalprice ELSE b.o_totalprice END AS o_totalprice,
           CASE WHEN b.o_orderkey IS NULL THEN t.o_orderdate ELSE b.o_orderdate END AS o_orderdate,
           CASE WHEN b.o_orderkey IS NULL THEN t.o_orderpriority ELSE b.o_orderpriority END AS o_orderpriority,
           CASE WHEN b.o_orderkey IS NULL THEN 'KEEP' WHEN t.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END
               AS _action
    FROM t FULL OUTER JOIN b ON t.o_orderkey = b.o_orderkey
"""


def target(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))


def batch(spark, sf):
    changed = table(spark, sf, "orders").filter(F.col("o_orderdate") >= F.lit(CHANGED_SINCE).cast("timestamp_ntz"))
    return as_batch(changed)


def as_batch(changed):
    """Orders as the source now tells them: pending, dearer, some without priority."""
    return changed.select(
        "o_orderkey",
        "o_custkey",
        F.lit("P").alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        "o_orderdate",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("o_orderpriority"),
    )


@query(_MERGED)
def upsert_merge(spark, sf):
    return upsert(target(spark, sf), batch(spark, sf), "o_orderkey")


def published(spark, rows, name: str, key: str, slices: int = 16) -> Warehouse:
    """Rows as a published table of a warehouse of its own."""
    mark = uuid4().hex
    house = Warehouse(spark, f"{shared_dir(spark)}/merge-{mark}", f"merge_{mark}", Layout(slices))
    house.replace(rows, name, key)
    return house


def stamped(rows, at: str = FIRST_TS):
    first = F.lit(at).cast("timestamp_ntz")
    return rows.withColumn("etl_created_at", first).withColumn("etl_updated_at", first)


def merge_stamped(part, changed):
    return upsert(part, changed, "o_orderkey", run_ts=RUN_TS)


@query(_MERGED)
def upsert_merge_small_batch(spark, sf):
    """The same merge into a published table, of which only the touched slices are rewritten."""
    house = published(spark, stamped(target(spark, sf)), "orders", "o_orderkey")
    house.change("orders", batch(spark, sf), merge_stamped).commit()
    now = F.lit(RUN_TS).cast("timestamp_ntz")
    action = F.when(F.col("etl_created_at") == now, "INSERT").when(F.col("etl_updated_at") == now, "UPDATE").otherwise("KEEP")
    return house.read("orders").withColumn(ACTION, action).drop("etl_created_at", "etl_updated_at")


_FEW = "o_orderkey % 1000 = 7"


@query(f"""
    SELECT o_orderkey, CASE WHEN {_FEW} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           true AS rewritten_if_touched
    FROM orders
""")
def merge_touched_buckets(spark, sf):
    """A few changed orders: exactly the slices their keys fall into get new files."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    few = orders.filter(_FEW).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    house = published(spark, orders, "orders", "o_orderkey", slices=64)
    files = lambda: house.read("orders").select(slice_of("o_orderkey", 64).alias("slice"), "*", "_metadata.file_path")
    # One row per file.
    before = files().select("slice", "file_path").distinct().withColumn("old", F.lit(True))
    before = F.broadcast(checkpointed(spark, before))
    house.change("orders", few, lambda part, changed: upsert(part, changed, "o_orderkey")).commit()
    touched = few.select(slice_of("o_orderkey", 64).alias("slice")).distinct().withColumn("touched", F.lit(True))
    rows = files().join(before, ["slice", "file_path"], "left").join(F.broadcast(touched), "slice", "left")
    same = F.coalesce("touched", F.lit(False)) == F.col("old").isNull()
    return rows.select("o_orderkey", "o_totalprice", same.alias("rewritten_if_touched"))


@query(
    f"SELECT count(*) FILTER (_action = 'INSERT') AS inserted, count(*) FILTER (_action = 'UPDATE') AS updated"
    f" FROM ({_MERGED})"
)
def upsert_action_counts(spark, sf):
    return action_counts(upsert(target(spark, sf), batch(spark, sf), "o_orderkey"))


@query(f"""
    SELECT o_orderkey, _action,
           CASE WHEN _action = 'INSERT' THEN TIMESTAMP '{RUN_TS}' ELSE TIMESTAMP '{FIRST_TS}' END AS etl_created_at,
           CASE WHEN _action = 'KEEP' THEN TIMESTAMP '{FIRST_TS}' ELSE TIMESTAMP '{RUN_TS}' END AS etl_updated_at
    FROM ({_MERGED})
""")
def upsert_stamps(spark, sf):
    first = F.lit(FIRST_TS).cast("timestamp_ntz")
    old = target(spark, sf).withColumn("etl_created_at", first).withColumn("etl_updated_at", first)
    merged = upsert(old, batch(spark, sf), "o_orderkey", run_ts=RUN_TS)
    return merged.select("o_orderkey", ACTION, "etl_created_at", "etl_updated_at")


@query("""
    WITH t AS (SELECT c_name AS email, c_custkey AS id, c_mktsegment AS segment FROM customer WHERE c_acctbal < 5000),
         b AS (SELECT c_name AS email, c_custkey AS id, lower(c_mktsegment) AS segment FROM customer
               WHERE c_acctbal >= 0)
    SELECT coalesce(t.email, b.email) AS email, coalesce(b.id, t.id) AS id, coalesce(b.segment, t.segment) AS segment,
           CASE WHEN b.email IS NULL THEN 'KEEP' WHEN t.email IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS _action
    FROM t FULL OUTER JOIN b ON t.email = b.email
""")
def upsert_by_natural_key(spark, sf):
    people = table(spark, sf, "customer").withColumnsRenamed({"c_name": "email", "c_custkey": "id"})
    known = people.filter("c_acctbal < 5000").select("email", "id", F.col("c_mktsegment").alias("segment"))
    seen = people.filter("c_acctbal >= 0").select("email", "id", F.lower("c_mktsegment").alias("segment"))
    return upsert(known, seen, "email")


_LINES = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_shipdate"
_OLD_LINES = f"SELECT {_LINES} FROM lineitem WHERE l_shipdate < TIMESTAMP '{LOADED_UNTIL}'"
_NEW_LINES = f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1 AS l_quantity, l_extendedprice,
           l_discount, l_shipdate
    FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CHANGED_SINCE}'
"""


def old_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select(*_LINES.split(", "))
    return lines.filter(F.col("l_shipdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))


def new_lines(spark, sf):
    lines = table(spark, sf, "lineitem").select(*_LINES.split(", "))
    changed = lines.filter(F.col("l_shipdate") >= F.lit(CHANGED_SINCE).cast("timestamp_ntz"))
    return changed.withColumn("l_quantity", F.col("l_quantity") + 1)


@query(f"""
    WITH o AS ({_OLD_LINES}), n AS ({_NEW_LINES})
    SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = o.l_orderkey)
    UNION ALL SELECT * FROM n
""", name="replace_children")
def replace_children_of_batch(spark, sf):
    return replace_children(old_lines(spark, sf), new_lines(spark, sf), "l_orderkey")


@query(f"""
    WITH o AS ({_OLD_LINES}), n AS ({_NEW_LINES}),
         p AS (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CHANGED_SINCE}')
    SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.l_orderkey = o.l_orderkey)
                      AND NOT EXISTS (SELECT 1 FROM p WHERE p.o_orderkey = o.l_orderkey)
    UNION ALL SELECT * FROM n
""")
def replace_children_with_parents(spark, sf):
    """Parents of the batch without any child lose their old children too."""
    parents = batch(spark, sf).select(F.col("o_orderkey").alias("l_orderkey"))
    return replace_children(old_lines(spark, sf), new_lines(spark, sf), "l_orderkey", parents=parents)


@query(f"""
    WITH o AS (SELECT DISTINCT l_orderkey AS team_id, l_suppkey AS user_id FROM lineitem
               WHERE l_shipdate < TIMESTAMP '{LOADED_UNTIL}'),
         p AS (SELECT o_orderkey AS team_id FROM orders WHERE o_orderdate >= TIMESTAMP '{CHANGED_SINCE}'),
         n AS (SELECT DISTINCT l_orderkey AS team_id, l_suppkey AS user_id FROM lineitem
               JOIN p ON p.team_id = l_orderkey WHERE l_shipdate >= TIMESTAMP '{CHANGED_SINCE}')
    SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.team_id = o.team_id)
    UNION ALL SELECT * FROM n
""", name="replace_relations")
def replace_relations_of_batch(spark, sf):
    pairs = (F.col("l_orderkey").alias("team_id"), F.col("l_suppkey").alias("user_id"))
    parents = batch(spark, sf).select(F.col("o_orderkey").alias("team_id"))
    old = old_lines(spark, sf).select(*pairs).distinct()
    new = new_lines(spark, sf).select(*pairs).join(parents, "team_id", "left_semi")
    return replace_relations(old, new, parents, "team_id")


@query("""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, o_orderstatus = 'F' AS deleted
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def cascade_delete(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    gone = table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    kept, deleted = cascade(lines, gone, "l_orderkey", "o_orderkey")
    return kept.withColumn("deleted", F.lit(False)).unionByName(deleted.withColumn("deleted", F.lit(True)))


@query("""
    SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def reconcile_ids(spark, sf):
    active = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.missing_ids(table(spark, sf, "orders"), active, "o_orderkey")


@query("""
    SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def reconcile_id_bitmaps(spark, sf):
    """The same ids by the difference of two sets of bitmaps."""
    active = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.missing_whole_ids(table(spark, sf, "orders"), active, "o_orderkey")


@query("""
    SELECT 'orders' AS table_name, o_orderkey AS id, CAST(NULL AS INTEGER) AS line_number, o_orderstatus = 'F' AS deleted
    FROM orders
    UNION ALL
    SELECT 'lineitem', l_orderkey, l_linenumber, o_orderstatus = 'F' FROM lineitem JOIN orders ON o_orderkey = l_orderkey
""")
def reconcile_delete(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    active = orders.filter("o_orderstatus in ('O', 'P')").select("o_orderkey")
    done = R.reconcile(orders, active, "o_orderkey", children={"lineitem": (lines, "l_orderkey")})

    def shown(name, rows, key, line, deleted):
        return rows.select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("id"),
            line.alias("line_number"),
            F.lit(deleted).alias("deleted"),
        )

    no_line, line = F.lit(None).cast("int"), F.col("l_linenumber")
    return (
        shown("orders", done.kept, "o_orderkey", no_line, False)
        .unionByName(shown("orders", done.deleted, "o_orderkey", no_line, True))
        .unionByName(shown("lineitem", done.kept_children["lineitem"], "l_orderkey", line, False))
        .unionByName(shown("lineitem", done.deleted_children["lineitem"], "l_orderkey", line, True))
    )


@query("""
    WITH n AS (SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS gone FROM orders)
    SELECT 'load_failed' AS scenario, 'skipped_load_failed' AS outcome, total AS kept, 0 AS deleted FROM n
    UNION ALL SELECT 'incomplete', 'skipped_incomplete', total, 0 FROM n
    UNION ALL SELECT 'empty', 'skipped_empty', total, 0 FROM n
    UNION ALL SELECT 'not_allowed', 'skipped_not_allowed', total, 0 FROM n
    UNION ALL SELECT 'normal', 'applied', total - gone, gone FROM n
""")
def reconcile_guard(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    active = orders.filter("o_orderstatus <> 'F'")
    without_lines = R.missing_ids(orders, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")
    scenarios = {
        "load_failed": {"active": active, "failed": without_lines.count()},
        "incomplete": {"active": active, "complete": False},
        "empty": {"active": orders.filter("o_orderstatus = 'X'")},
        "not_allowed": {"active": active, "table": "orders", "allowed": {"customer"}},
        "normal": {"active": active, "table": "orders", "allowed": {"orders"}},
    }
    shown = []
    for name, options in scenarios.items():
        done = R.reconcile(orders, options.pop("active"), "o_orderkey", **options)
        both = done.kept.withColumn("gone", F.lit(False)).unionByName(done.deleted.withColumn("gone", F.lit(True)))
        shown.append(
            both.agg(
                F.lit(name).alias("scenario"),
                F.lit(done.outcome).alias("outcome"),
                F.count_if(~F.col("gone")).alias("kept"),
                F.count_if("gone").alias("deleted"),
            )
        )
    result = shown[0]
    for one in shown[1:]:
        result = result.unionByName(one)
    return result


_LINE_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


@query(f"""
    SELECT row_number() OVER (ORDER BY {", ".join(_LINE_ORDER)}) + 1000 AS id,
           l_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM lineitem
""", name="surrogate_keys")
def surrogate_keys_of_lines(spark, sf):
    numbered = surrogate_keys(table(spark, sf, "lineitem"), _LINE_ORDER, start=1000)
    return numbered.select("id", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("""
    SELECT c_custkey, c_name, n_name AS stage_name, r_name AS pipeline_name
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = c_nationkey
""")
def enrich_lookup(spark, sf):
    """Nations as stages, all matched; regions by the same key, mostly unmatched."""
    people = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    stages, pipelines = table(spark, sf, "nation"), table(spark, sf, "region")
    named = lookup(people, stages, "c_nationkey", "stage_name", key="n_nationkey", value="n_name")
    named = lookup(named, pipelines, "c_nationkey", "pipeline_name", key="r_regionkey", value="r_name")
    return named.drop("c_nationkey")
