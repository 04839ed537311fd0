"""Audit, watermark, run totals, snapshots, fact and post-load steps."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemirror.catalog.reading import AUDIT, audit_log
from tidemirror.catalog.registry import LOADED_UNTIL, RUN_TS, query, table
from tidemirror.operators import control as C
from tidemirror.operators import history as H
from tidemirror.operators import reports as B
from tidemirror.operators import statistics as S
from tidemirror.session import shared_dir


@query(f"""
    SELECT entity_name, max(last_execution_date) AS watermark FROM ({AUDIT})
    WHERE execution_status = 'SUCCESS' GROUP BY entity_name
""")
def last_success_watermark(spark, sf):
    return C.last_success(audit_log(spark, sf))


@query(f"SELECT * FROM ({AUDIT}) ORDER BY last_execution_date DESC, records_inserted LIMIT 10")
def audit_latest(spark, sf):
    return C.latest_runs(audit_log(spark, sf), 10, "records_inserted")


@query(f"SELECT * FROM ({AUDIT}) WHERE execution_status = 'ERROR'")
def audit_errors(spark, sf):
    return C.failed_runs(audit_log(spark, sf))


@query(f"""
    SELECT entity_name, last_execution_date - INTERVAL 3 HOUR AS last_execution_date, execution_status,
           records_extracted, records_inserted, records_failed, error_message
    FROM (SELECT * FROM ({AUDIT})
          UNION ALL
          SELECT event_type, TIMESTAMP '{RUN_TS}', 'SUCCESS', CAST(count(*) AS INTEGER), 0, 0, 0, NULL, 0
          FROM events GROUP BY event_type)
""")
def audit_append(spark, sf):
    """One more run per entity, shown in local time (three hours behind in that season)."""
    run = table(spark, sf, "events").groupBy(F.col("event_type").alias("entity_name")).agg(
        F.lit(RUN_TS).cast("timestamp_ntz").alias("last_execution_date"),
        F.lit(C.SUCCESS).alias("execution_status"),
        F.count("*").cast("int").alias("records_extracted"),
        *[F.lit(0).alias(f"records_{c}") for c in ("inserted", "updated", "failed")],
        F.lit(None).cast("string").alias("error_message"),
        F.lit(0).alias("execution_duration_seconds"),
    )
    shown = C.shown_local(C.append_audit(audit_log(spark, sf), run))
    return shown.drop("records_updated", "execution_duration_seconds")


@query(f"""
    WITH o AS (SELECT *, CASE WHEN entity_name = 'signup' THEN 'step' ELSE 'entity' END AS kind FROM ({AUDIT}))
    SELECT CAST(sum(records_extracted) FILTER (kind = 'entity') AS BIGINT) AS total_extracted,
           CAST(sum(records_inserted) FILTER (kind = 'entity') AS BIGINT) AS total_inserted,
           0 AS total_updated,
           CAST(sum(execution_duration_seconds) FILTER (kind = 'entity') AS BIGINT) AS total_deleted,
           0 AS total_cascade_deleted, 0 AS total_failed,
           count(*) FILTER (kind = 'entity' AND execution_status <> 'ERROR') AS entities_ok,
           count(*) FILTER (kind = 'entity' AND execution_status = 'ERROR') AS entities_failed,
           count(*) FILTER (kind = 'step' AND execution_status <> 'ERROR') AS steps_ok,
           count(*) FILTER (kind = 'step' AND execution_status = 'ERROR') AS steps_failed,
           bool_or(kind = 'entity' AND execution_status = 'ERROR') AS run_failed
    FROM o
""")
def run_summary(spark, sf):
    outcomes = (
        audit_log(spark, sf)
        .withColumn("records_deleted", F.col("execution_duration_seconds"))
        .withColumn("records_cascade_deleted", F.lit(0))
        .withColumn("kind", F.when(F.col("entity_name") == "signup", "step").otherwise("entity"))
    )
    return C.run_summary(outcomes)


_COUNTED = ("orders", "lineitem", "customer", "supplier", "part", "events")


@query(" UNION ALL ".join(f"SELECT '{t}' AS entity, count(*) AS total FROM {t}" for t in _COUNTED))
def table_counts(spark, sf):
    return C.table_counts({t: table(spark, sf, t) for t in _COUNTED})


@query(f"""
    SELECT '1999-06-30' AS snapshot_date, o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'
    UNION ALL SELECT '1999-07-01', o_orderkey, o_totalprice + 1 FROM orders
""")
def snapshot_append(spark, sf):
    """A day appended to the history twice; the second copy replaces the first."""
    orders = table(spark, sf, "orders")
    before = orders.filter(F.col("o_orderdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    before, now = before.select("o_orderkey", "o_totalprice"), orders.select("o_orderkey", "o_totalprice")
    history = B.append_snapshot(B.dated(before, "1999-06-30"), now, "1999-07-01")
    history = B.append_snapshot(history, now.withColumn("o_totalprice", F.col("o_totalprice") + 1), "1999-07-01")
    return history.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


@query(f"""
    SELECT '1999-06-30' AS snapshot_date, o_orderkey, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL}'
    UNION ALL SELECT '1999-07-01', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'
""")
def snapshot_today(spark, sf):
    """Today's partition written twice; only the last write of it stays, other days untouched."""
    path = f"{shared_dir(spark)}/snapshots-{uuid4().hex}"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate")
    before = orders.filter(F.col("o_orderdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
    for rows, day in ((before, "1999-06-30"), (orders, "1999-07-01"), (orders.filter("o_orderstatus <> 'F'"), "1999-07-01")):
        B.write_snapshot(rows.select("o_orderkey", "o_totalprice"), day, path)
    history = spark.read.parquet(path)
    return history.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


# Copies of the orders on some days: known ones only, and those still open change their price on two days.
SNAPSHOT_DAYS = {"1996-01-01": 0, "1997-01-01": 0, "1997-01-02": 1, "1998-01-01": 1, "1998-01-02": 0, "1999-07-01": 0}
_PRICE = "CASE WHEN o_orderstatus = 'O' THEN o_totalprice + {more} ELSE o_totalprice END"
_COPIES = " UNION ALL ".join(
    f"SELECT DATE '{day}' AS day, o_orderkey, {_PRICE.format(more=more)} AS price FROM orders WHERE o_orderdate < TIMESTAMP '{day}' OR o_orderstatus = 'P'"
    for day, more in SNAPSHOT_DAYS.items()
)


def _copy(spark, sf, day):
    known = (F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz")) | (F.col("o_orderstatus") == "P")
    price = F.expr(_PRICE.format(more=SNAPSHOT_DAYS[day])).alias("price")
    return table(spark, sf, "orders").filter(known).select("o_orderkey", price)


def _as_text(history):
    return history.select("o_orderkey", "price", *[F.col(c).cast("string").alias(c) for c in H.BOUNDS])


@query(f"""
    WITH copies AS ({_COPIES}),
    days AS (SELECT day, row_number() OVER (ORDER BY day) AS n, lead(day, 1, DATE '{H.OPEN}') OVER (ORDER BY day) AS next FROM (SELECT DISTINCT day FROM copies)),
    islands AS (SELECT *, n - row_number() OVER (PARTITION BY o_orderkey, price ORDER BY n) AS island FROM copies JOIN days USING (day))
    SELECT o_orderkey, price, CAST(min(day) AS VARCHAR) AS valid_from, CAST(max(next) AS VARCHAR) AS valid_to
    FROM islands GROUP BY o_orderkey, price, island
""")
def snapshot_intervals(spark, sf):
    """A history by intervals, a day at a time: one day comes late, one is run again after a wrong copy."""
    first, second, third, fourth, late, last = SNAPSHOT_DAYS
    history = H.begin_history(_copy(spark, sf, first), first)
    history = H.put_snapshot(history, _copy(spark, sf, second), second)
    history = H.put_snapshot(history, _copy(spark, sf, last), third)
    for day in (third, fourth, last):
        history = H.put_snapshot(history, _copy(spark, sf, day), day)
    history = H.put_snapshot(history, _copy(spark, sf, late), late, next_day=last)
    return _as_text(history)


@query(f"SELECT CAST(day AS VARCHAR) AS snapshot_date, o_orderkey, price FROM ({_COPIES})")
def snapshots_from_intervals(spark, sf):
    """Daily copies turned into intervals and back."""
    copies = [B.dated(_copy(spark, sf, day), day) for day in SNAPSHOT_DAYS]
    history = H.from_daily(reduce(DataFrame.unionByName, copies))
    return H.daily(history, list(SNAPSHOT_DAYS)).withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


_FACT = """
    SELECT l_orderkey AS deal_id, l_partkey AS product_id, count(*) AS line_count,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS gross_amount,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(6,4)))) AS DOUBLE) AS net_amount
    FROM lineitem GROUP BY ALL
"""


@query(f"""
    SELECT f.*, o_orderpriority AS deal_name, o_custkey AS deal_owner_id, o_orderdate AS deal_closed_date, p_name AS product_name
    FROM ({_FACT}) f JOIN orders ON o_orderkey = deal_id LEFT JOIN part ON p_partkey = product_id
""")
def fact_deal_products(spark, sf):
    deals = table(spark, sf, "orders").selectExpr(
        "o_orderkey as id", "o_orderpriority as name", "o_custkey as owner_id", "o_orderdate as closed_date"
    )
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey as deal_id",
        "l_partkey as product_id",
        "l_quantity as quantity",
        "l_extendedprice as total_price",
        "l_discount as discount",
    )
    products = table(spark, sf, "part").selectExpr("p_partkey as id", "p_name as name")
    fact = B.deal_product_fact(deals, lines, products)
    amounts = ("quantity", "gross_amount", "net_amount")
    return fact.withColumns({c: F.col(c).cast("double") for c in amounts})


@query(f"""
    SELECT 'snapshot' AS entity_name, 'SUCCESS' AS execution_status, 0 AS has_error, (SELECT count(*) FROM orders) AS rows_written
    UNION ALL SELECT 'broken', 'ERROR', 1, 0
    UNION ALL SELECT 'fact', 'SUCCESS', 0, (SELECT count(*) FROM ({_FACT}) JOIN orders ON o_orderkey = deal_id)
""")
def post_step_audit(spark, sf):
    """Steps over the tables and the rows each wrote; a failing one is told and does not stop the next."""
    root = f"{shared_dir(spark)}/steps-{uuid4().hex}"
    steps = [
        ("snapshot", lambda: B.write_snapshot(table(spark, sf, "orders"), "1999-07-01", f"{root}/snapshot")),
        ("broken", lambda: table(spark, sf, "no_such_table")),
        ("fact", lambda: fact_deal_products(spark, sf).write.parquet(f"{root}/fact")),
    ]
    done = B.run_steps(spark, steps)
    written = [spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("entity_name"), F.count("*").alias("rows_written")) for name in ("snapshot", "fact")]
    told = done.join(written[0].unionByName(written[1]), "entity_name", "left")
    has_error = F.col("error_message").isNotNull().cast("int").alias("has_error")
    return told.select("entity_name", "execution_status", has_error, F.coalesce("rows_written", F.lit(0)).alias("rows_written"))


@query("""
    SELECT event_type, count(*) AS rows, count(DISTINCT user_id) AS exact_ids, true AS ids_near, true AS median_near, true AS p95_near
    FROM events GROUP BY event_type
""")
def statistics_over_runs(spark, sf):
    """Sketches of a run a day, one of them repeated, united; whether the estimates lie within their stated errors.

    The distinct count may be off by four standard errors, a quantile's rank by 2.66 %.
    """
    events = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("run"), "user_id", "value")
    by = ["event_type", "run"]
    kept = S.scan_statistics(events, by, "user_id", "value")
    repeated = S.scan_statistics(events.filter("run = DATE '2024-01-10'"), by, "user_id", "value")
    estimates = S.told(S.united(S.put_statistics(kept, repeated, by), ["event_type"]))
    # One row per event type.
    seen = events.join(F.broadcast(estimates.select("event_type", "size_p50", "size_p95")), "event_type")
    exact = seen.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("exact_ids"),
        *[(F.count_if(F.col("value") < F.col(p)) / F.count("value")).alias(f"{p}_below") for p in ("size_p50", "size_p95")],
        *[(F.count_if(F.col("value") <= F.col(p)) / F.count("value")).alias(f"{p}_upto") for p in ("size_p50", "size_p95")],
    )

    def near(p, rank):
        return (F.col(f"{p}_below") <= rank + 0.0266) & (F.col(f"{p}_upto") >= rank - 0.0266)

    off = F.abs(F.col("distinct_ids") - F.col("exact_ids")) <= 4 * 1.04 / 2 ** (S.LG_K / 2) * F.col("exact_ids")
    return estimates.join(exact, "event_type").select(
        "event_type", "rows", "exact_ids", off.alias("ids_near"), near("size_p50", 0.5).alias("median_near"), near("size_p95", 0.95).alias("p95_near")
    )
