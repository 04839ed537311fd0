"""Every entity from landed pages through a real load to its published table, read back.

Each entity borrows a table of growing size. ``fields`` are the JSON fields of a
record as SQL over that table, ``expect`` the typed columns the spec must give; columns
named in neither get a value made from their name and the key. ``$v`` is 1 in the copy
loaded first and 2 in the changed copy.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial
from uuid import uuid4

from pyspark.sql import functions as F

from tidemirror.catalog.registry import CHANGED_SINCE, FIRST_TS, LOADED_UNTIL, RUN_TS, land, query, table
from tidemirror.operators import control as C
from tidemirror.operators import reconcile as R
from tidemirror.plans.entities import REGISTRY
from tidemirror.plans.load import AUDIT_TABLE, QUARANTINE_TABLE, Job, ensure_tables, load_entity, quarantined, run
from tidemirror.session import shared_dir
from tidemirror.sources import pages as P
from tidemirror.warehouse import Warehouse


@dataclass(frozen=True)
class Source:
    table: str
    key: str
    known: str
    changed: str
    fields: dict[str, str]
    expect: dict[str, str]
    custom: dict[str, str] = field(default_factory=dict)


_BY_DATE = {
    "known": f"o_orderdate < TIMESTAMP '{LOADED_UNTIL}'",
    "changed": f"o_orderdate >= TIMESTAMP '{CHANGED_SINCE}'",
}
_BY_VALUE = {"known": "value < 60", "changed": "value >= 20"}
_BY_SIZE = {"known": "p_size < 30", "changed": "p_size >= 20"}
_BY_SUPPLIER = {"known": "s_acctbal < 5000", "changed": "s_acctbal >= 0"}
_BY_CUSTOMER = {"known": "c_acctbal < 5000", "changed": "c_acctbal >= 0"}

_DAY = "'2024-03-05T10:11:12-03:00'"
_DAY_TS = "TIMESTAMP '2024-03-05 10:11:12'"

_EVENT_FIELDS = {
    "id": "event_id",
    "title": "concat(event_type, ' ', '$v')",
    "description": "props",
    "owner_id": "user_id",
    "creator_id": "cast(user_id as string)",
    "targetable_type": "'Deal'",
    "targetable_id": "event_id",
    "created_at": _DAY,
    "updated_at": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX\")",
}
_EVENT_EXPECT = {
    "id": "event_id",
    "title": "event_type || ' ' || v",
    "description": "props",
    "owner_id": "user_id",
    "creator_id": "user_id",
    "targetable_type": "'Deal'",
    "targetable_id": "event_id",
    "created_at": _DAY_TS,
    "updated_at": "date_trunc('second', ts)",
    "is_deleted": "false",
}

SOURCES: dict[str, Source] = {
    "deals": Source(
        table="orders",
        key="o_orderkey",
        **_BY_DATE,
        fields={
            "id": "o_orderkey",
            "name": "concat(o_orderpriority, ' ', '$v')",
            "amount": "cast(o_totalprice as string)",
            "expected_close": "date_format(o_orderdate, 'MM/dd/yyyy')",
            "stage_updated_time": _DAY,
            "probability": "cast(50.0 as double)",
            "updated_at": "date_format(o_orderdate, \"yyyy-MM-dd'T'23:59:58'-03:00'\")",
            "deal_pipeline_id": "o_custkey",
            "deal_stage_id": "o_orderkey",
            "is_deleted": "if(o_orderstatus = 'F', true, null)",
            "contacts": "if(o_orderstatus = 'O', array(), array(named_struct('id', o_custkey)))",
            "products": "array(named_struct('id', o_orderkey, 'product_id', o_custkey, 'total', o_totalprice, "
            "'name', o_orderpriority, 'quantity', 2, 'unit_price', '1.5', 'discount', 0.25, 'description', 'line $v'))",
        },
        custom={
            "cf_icp_confirmado": "case o_orderstatus when 'F' then 'SÍ' when 'O' then 'no' end",
            "cf_acv": "cast(cast(o_totalprice as decimal(18,2)) as string)",
            "cf_nro_de_meses": "12",
            "cf_fecha_fin_contrato": "date_format(o_orderdate, 'yyyy-MM-dd')",
            "cf_pais": "o_orderpriority",
        },
        expect={
            "id": "o_orderkey",
            "name": "o_orderpriority || ' ' || v",
            "amount": "o_totalprice",
            "expected_close": "strftime(o_orderdate, '%Y-%m-%d')",
            "stage_updated_time": _DAY_TS,
            "probability": "50",
            "updated_at": "CAST(o_orderdate AS TIMESTAMP) + INTERVAL 86398 SECOND",
            "deal_pipeline_id": "o_custkey",
            "deal_stage_id": "o_orderkey",
            "pipeline_name": "(SELECT c_name FROM customer WHERE c_custkey = o_custkey)",
            "is_deleted": "o_orderstatus = 'F'",
            "has_products": "false",
            "contact_id": "CASE WHEN o_orderstatus <> 'O' THEN o_custkey END",
            "cf_icp_confirmado": "CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END",
            "cf_acv": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)",
            "cf_nro_de_meses": "12",
            "cf_fecha_fin_contrato": "strftime(o_orderdate, '%Y-%m-%d')",
            "cf_pais": "o_orderpriority",
        },
    ),
    "contacts": Source(
        table="customer",
        key="c_custkey",
        **_BY_CUSTOMER,
        fields={
            "id": "c_custkey",
            "first_name": "'Customer'",
            "display_name": "concat(c_name, ' ', '$v')",
            "email": "concat(lower(c_name), '@example.com')",
            "owner_id": "c_nationkey",
            "updated_at": _DAY,
            "is_deleted": "c_acctbal < 0",
            "tags": "array(c_mktsegment, 'lead')",
        },
        custom={"cf_contacto_principal": "if(c_mktsegment = 'BUILDING', '1', '0')", "cf_mensaje": "c_name"},
        expect={
            "id": "c_custkey",
            "first_name": "'Customer'",
            "display_name": "c_name || ' ' || v",
            "email": "lower(c_name) || '@example.com'",
            "owner_id": "c_nationkey",
            "updated_at": _DAY_TS,
            "is_deleted": "c_acctbal < 0",
            "cf_contacto_principal": "c_mktsegment = 'BUILDING'",
            "cf_mensaje": "c_name",
            "tags": "c_mktsegment || ',lead'",
        },
    ),
    "sales_accounts": Source(
        table="supplier",
        key="s_suppkey",
        **_BY_SUPPLIER,
        fields={
            "id": "s_suppkey",
            "name": "concat(s_name, ' ', '$v')",
            "annual_revenue": "s_acctbal",
            "number_of_employees": "s_nationkey",
            "created_at": "'2024-03-05T23:59:59Z'",
            "updated_at": "'not a date'",
        },
        custom={"cf_segmento": "'A'"},
        expect={
            "id": "s_suppkey",
            "name": "s_name || ' ' || v",
            "annual_revenue": "s_acctbal",
            "number_of_employees": "s_nationkey",
            "created_at": "'2024-03-05'",
            "updated_at": "NULL",
            "is_deleted": "false",
            "cf_segmento": "'A'",
        },
    ),
    "leads": Source(
        table="customer",
        key="c_custkey",
        **_BY_CUSTOMER,
        fields={
            "id": "c_custkey",
            "last_name": "c_name",
            "job_title": "concat('v', '$v')",
            "address": "c_mktsegment",
            "company_name": "c_mktsegment",
            "lead_stage_id": "c_nationkey",
            "updated_at": _DAY,
        },
        expect={
            "id": "c_custkey",
            "last_name": "c_name",
            "job_title": "'v' || v",
            "address": "c_mktsegment",
            "company_name": "c_mktsegment",
            "lead_stage_id": "c_nationkey",
            "updated_at": _DAY_TS,
            "is_deleted": "false",
        },
    ),
    "tasks": Source(
        table="events",
        key="event_id",
        **_BY_VALUE,
        fields={**_EVENT_FIELDS, "status": "event_type", "due_date": "date_format(ts, 'yyyy-MM-dd hh:mm a')"},
        expect={**_EVENT_EXPECT, "status": "event_type", "due_date": "date_trunc('minute', ts)"},
    ),
    "appointments": Source(
        table="events",
        key="event_id",
        **_BY_VALUE,
        fields={**_EVENT_FIELDS, "location": "event_type", "from_date": _DAY, "end_date": "''", "time_zone": "'UTC'"},
        expect={**_EVENT_EXPECT, "location": "event_type", "from_date": _DAY_TS, "end_date": "NULL", "time_zone": "'UTC'"},
    ),
    "sales_activities": Source(
        table="events",
        key="event_id",
        **_BY_VALUE,
        fields={**_EVENT_FIELDS, "notes": "props", "activity_type": "event_type", "sales_activity_type_id": "user_id"},
        expect={**_EVENT_EXPECT, "notes": "props", "activity_type": "event_type", "sales_activity_type_id": "user_id"},
    ),
    "products": Source(
        table="part",
        key="p_partkey",
        **_BY_SIZE,
        fields={
            "id": "p_partkey",
            "name": "concat(p_name, ' ', '$v')",
            "category": "p_type",
            "base_currency_amount": "p_retailprice",
            "currency": "'EUR'",
            "sku_number": "p_brand",
            "updated_at": _DAY,
        },
        expect={
            "id": "p_partkey",
            "name": "p_name || ' ' || v",
            "category": "p_type",
            "price": "p_retailprice",
            "sku_number": "p_brand",
            "updated_at": _DAY_TS,
            "is_deleted": "false",
        },
    ),
    "users": Source(
        table="supplier",
        key="s_suppkey",
        **_BY_SUPPLIER,
        fields={
            "id": "s_suppkey",
            "display_name": "concat(s_name, ' ', '$v')",
            "is_active": "if(s_acctbal < 1000, false, null)",
        },
        expect={"id": "s_suppkey", "display_name": "s_name || ' ' || v", "is_active": "s_acctbal >= 1000"},
    ),
    "teams": Source(
        table="part",
        key="p_partkey",
        known="p_size < 45",
        changed="p_size >= 20",
        fields={
            "id": "p_partkey",
            "name": "concat(p_name, ' ', '$v')",
            "user_ids": "if(p_size >= 40 AND $v = 2, array(), array(p_partkey, p_size, p_size))",
        },
        expect={"id": "p_partkey", "name": "p_name || ' ' || v"},
    ),
    "pipelines": Source(
        table="supplier",
        key="s_suppkey",
        **_BY_SUPPLIER,
        fields={
            "id": "s_suppkey",
            "name": "concat(s_name, ' ', '$v')",
            "is_default": "if(s_nationkey = 0, true, null)",
            "created_at": _DAY,
        },
        expect={
            "id": "s_suppkey",
            "name": "s_name || ' ' || v",
            "is_default": "s_nationkey = 0",
            "created_at": _DAY_TS,
        },
    ),
    "stages": Source(
        table="part",
        key="p_partkey",
        **_BY_SIZE,
        fields={
            "id": "p_partkey",
            "name": "concat(p_name, ' ', '$v')",
            "deal_pipeline_id": "p_size",
            "position": "p_size",
            "forecast_type": "p_type",
        },
        expect={
            "id": "p_partkey",
            "name": "p_name || ' ' || v",
            "pipeline_id": "p_size",
            "position": "p_size",
            "type": "p_type",
        },
    ),
    "forecast_categories": Source(
        table="part",
        key="p_partkey",
        **_BY_SIZE,
        fields={"id": "p_partkey", "value": "concat(p_name, ' ', '$v')", "position": "p_size", "is_default": "p_size - 25"},
        expect={"id": "p_partkey", "name": "p_name || ' ' || v", "position": "p_size", "is_default": "p_size <> 25"},
    ),
    "deal_predictions": Source(
        table="part",
        key="p_partkey",
        **_BY_SIZE,
        fields={"id": "p_partkey", "value": "concat(p_name, ' ', '$v')", "position": "p_size", "is_default": "if(p_size < 9, '', 'x')"},
        expect={"id": "p_partkey", "name": "p_name || ' ' || v", "position": "p_size", "is_default": "p_size >= 9"},
    ),
}


FIRST, AGAIN = (datetime.fromisoformat(t) for t in (FIRST_TS, RUN_TS))
# Before any change of the borrowed tables.
LONG_AGO = datetime(1970, 1, 2)


def _filled(name: str) -> tuple[dict[str, str], dict[str, str], dict[str, str]]:
    """Record fields, custom fields and expected columns, with a value for every column of the spec."""
    spec, source = REGISTRY[name], SOURCES[name]
    fields, custom, expect = dict(source.fields), dict(source.custom), dict(source.expect)
    # Read from the text, since the SQL is wanted before there is a session.
    for i, (column, kind, length) in enumerate(re.findall(r"(\w+) ([A-Z_]+)(?:\((\d+)[\d,]*\))?(?: NOT NULL)?\s*(?:,|$)", spec.ddl)):
        if column in expect:
            continue
        if column in spec.defaults:
            expect[column] = str(spec.defaults[column]).lower()
            continue
        if column in spec.lookups or column in spec.always_null or column in spec.first_of:
            expect[column] = "NULL"
            continue
        if kind in ("STRING", "VARCHAR"):
            most = length or 1000
            value, want = f"left(concat('{column} ', {source.key}), {most})", f"left('{column} ' || {source.key}, {most})"
        elif kind == "TIMESTAMP_NTZ":
            value, want = "'Tue, 05 Mar 2024 10:11:12 GMT'", _DAY_TS
        elif kind == "DATE":
            value, want = "'25/12/2023'", "'2023-12-25'"
        elif kind == "BOOLEAN":
            value, want = "'yes'", "true"
        else:
            value, want = f"cast({source.key} + {i} as string)", f"{source.key} + {i}"
        (custom if column.startswith("cf_") else fields)[spec.sources.get(column, column)] = value
        expect[column] = want
    return fields, custom, expect


def _record(name: str, version: int):
    fields, custom, _ = _filled(name)

    def made(sql: str, alias: str):
        return F.expr(sql.replace("$v", str(version))).alias(alias)

    parts = [made(sql, alias) for alias, sql in fields.items()]
    if custom:
        parts.append(F.struct(*[made(sql, alias) for alias, sql in custom.items()]).alias("custom_field"))
    return F.struct(*parts)


def landing(spark, sf, name: str, rows: str, version: int):
    """An entity's records, landed as pages for its scan rule.

    Nested records come twice in one parent, a stale copy first; an option list is followed
    by a second one of the same name, which does not count.
    """
    spec, source = REGISTRY[name], SOURCES[name]
    record, wrap = _record(name, version), None
    if spec.nested_in:
        stale = record.withField("name", F.lit("stale"))
        record = F.struct(F.array(stale, record).alias(spec.nested_in[1]))
    if spec.option_of:

        def wrap(choices):
            field = lambda c: F.struct(F.lit(spec.option_of).alias("name"), c.alias("choices"))
            return F.array(field(choices), field(F.transform(choices, lambda c: c.withField("value", F.lit("other")))))

    served = table(spark, sf, source.table).filter(rows)
    view = 1 if spec.needs_view else None
    return land(
        served, spec.landed_as, spec.page_key, source.key, record, view, spec.scan == P.UNTIL_EMPTY, spec.scan == P.SINGLE, wrap, dense=True
    )


def house_for(spark, name: str) -> Warehouse:
    mark = uuid4().hex
    return Warehouse(spark, f"{shared_dir(spark)}/load-{name}-{mark}", f"load_{name}_{mark}")


def loaded(spark, sf, name: str) -> Warehouse:
    """The known rows in a full load, then the changed ones in an incremental load, as a run does it."""
    spec, source, house = REGISTRY[name], SOURCES[name], house_for(spark, name)
    ensure_tables(house, [spec])
    if name == "deals":
        people = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
        house.replace(people, "pipelines", "id")
    views = {name: [1]} if spec.needs_view else {}
    for rows, version, at, mode in ((source.known, 1, FIRST, C.FULL), (source.changed, 2, AGAIN, C.INCREMENTAL)):
        done = load_entity(Job(house, landing(spark, sf, name, rows, version), at, views), spec, mode, LONG_AGO)
        if done.status != C.SUCCESS:
            raise RuntimeError(f"{name}: {done.error}")
    return house


def action():
    """What the last load did to a row, by its bookkeeping times."""
    now = F.lit(RUN_TS).cast("timestamp_ntz")
    return F.when(F.col("etl_created_at") == now, "INSERT").when(F.col("etl_updated_at") == now, "UPDATE").otherwise("KEEP").alias("_action")


def shown(df):
    """Dates and decimals as their texts, so that no digit is lost in a comparison."""
    return [F.col(c).cast("string" if t == "date" or t.startswith("decimal") else t).alias(c) for c, t in df.dtypes]


def load(spark, sf, name: str):
    rows = loaded(spark, sf, name).read(name)
    return rows.select(*shown(rows), action())


def load_sql(name: str) -> str:
    source, (_, _, expect) = SOURCES[name], _filled(name)
    columns = ", ".join(f"{sql} AS {column}" for column, sql in expect.items())
    return f"""
        SELECT {columns},
               CASE WHEN _known THEN TIMESTAMP '{FIRST_TS}' ELSE TIMESTAMP '{RUN_TS}' END AS etl_created_at,
               CASE WHEN _changed THEN TIMESTAMP '{RUN_TS}' ELSE TIMESTAMP '{FIRST_TS}' END AS etl_updated_at,
               CASE WHEN NOT _changed THEN 'KEEP' WHEN _known THEN 'UPDATE' ELSE 'INSERT' END AS _action
        FROM (SELECT *, ({source.known}) AS _known, ({source.changed}) AS _changed,
                     CASE WHEN {source.changed} THEN '2' ELSE '1' END AS v FROM {source.table})
        WHERE _known OR _changed
    """


for _name in SOURCES:
    query(load_sql(_name), f"load_{_name}")(partial(load, name=_name))


@query(f"""
    SELECT o_orderkey AS source_line_id, o_orderkey AS deal_id, o_custkey AS product_id, o_orderpriority AS product_name,
           2.0::DOUBLE AS quantity, 1.5::DOUBLE AS unit_price, o_totalprice AS total_price, 0.25::DOUBLE AS discount,
           'line ' || CASE WHEN {_BY_DATE["changed"]} THEN '2' ELSE '1' END AS description
    FROM orders WHERE {_BY_DATE["known"]} OR {_BY_DATE["changed"]}
""")
def load_deal_products(spark, sf):
    return loaded(spark, sf, "deals").read("deal_products").drop("id", "etl_created_at", "etl_updated_at")


@query("""
    SELECT p_partkey AS team_id, p_partkey AS user_id FROM part WHERE p_size < 40
    UNION SELECT p_partkey, p_size FROM part WHERE p_size < 40
""")
def load_team_users(spark, sf):
    """Teams of the changed copy whose list is empty lose the members they had."""
    return loaded(spark, sf, "teams").read("team_users").select("team_id", "user_id")


_PARTS = "SELECT p_partkey AS id, p_name || ' {v}' AS name FROM part"


def parts_job(spark, sf, house, rows: str, version: int, at: datetime, **options) -> Job:
    return Job(house, landing(spark, sf, "products", rows, version), at, **options)


@query(f"""
    SELECT p.*, 1 AS audited, 1 AS inserting_runs FROM ({_PARTS.format(v=1)}) p
""")
def load_run_twice(spark, sf):
    """The same run started twice, as a scheduler does after a timeout; the table is that of one run."""
    house = house_for(spark, "twice")
    job = parts_job(spark, sf, house, "p_size > 0", 1, FIRST)
    for _ in range(2):
        run(job, "products")
    audit = house.read(AUDIT_TABLE).filter("entity_name = 'products'")
    told = audit.agg(F.count("*").cast("int").alias("audited"), F.count_if(F.col("records_inserted") > 0).cast("int").alias("inserting_runs"))
    # One row.
    return house.read("products").select("id", "name").crossJoin(F.broadcast(told))


@query("""
    SELECT p_partkey AS id, p_name || CASE WHEN p_size >= 45 THEN ' 2' ELSE ' 1' END AS name,
           CASE WHEN p_size >= 45 THEN 'UPDATE' ELSE 'KEEP' END AS _action, 'skipped_no_sweep' AS reconcile, 0 AS deleted
    FROM part
""")
def load_incremental_landing(spark, sf):
    """Only changed rows are landed and no sweep is given, so nothing may be deleted."""
    house, spec = house_for(spark, "landing"), REGISTRY["products"]
    ensure_tables(house, [spec])
    load_entity(parts_job(spark, sf, house, "p_size > 0", 1, FIRST), spec)
    done = load_entity(parts_job(spark, sf, house, "p_size >= 45", 2, AGAIN), spec, C.INCREMENTAL, LONG_AGO)
    return house.read("products").select("id", "name", action(), F.lit(done.reconcile).alias("reconcile"), F.lit(done.deleted).alias("deleted"))


@query("""
    SELECT p_partkey AS id, p_name || ' 2' AS name, 'applied' AS reconcile,
           (SELECT count(*) FROM part WHERE p_size >= 45) AS deleted, (SELECT count(*) FROM part WHERE p_size < 45) AS active
    FROM part WHERE p_size < 45
""")
def load_full_reconcile(spark, sf):
    """A full load deletes what it no longer finds, against the ids it just read."""
    house, spec = house_for(spark, "full"), REGISTRY["products"]
    ensure_tables(house, [spec])
    load_entity(parts_job(spark, sf, house, "p_size > 0", 1, FIRST), spec)
    done = load_entity(parts_job(spark, sf, house, "p_size < 45", 2, AGAIN, force_full=True), spec)
    told = {"reconcile": done.reconcile, "deleted": done.deleted, "active": done.active}
    return house.read("products").select("id", "name", *[F.lit(v).alias(k) for k, v in told.items()])


_LONG = "c_acctbal < 0"


def partly_rejected(spark, sf, house) -> Job:
    """All contacts; the job titles of some are longer than their column."""
    spec = REGISTRY["contacts"]
    fields = {"id": F.col("c_custkey"), "last_name": F.col("c_name"), "job_title": F.expr(f"if({_LONG}, repeat('long ', 100), c_mktsegment)")}
    record = F.struct(*[value.alias(name) for name, value in fields.items()])
    pages = land(table(spark, sf, "customer"), "contacts", spec.page_key, "c_custkey", record, 1, dense=True)
    return Job(house, pages, FIRST, {"contacts": [1]})


@query(f"""
    SELECT 'contacts' AS entity_name, TIMESTAMP '{FIRST_TS}' AS rejected_at, 'job_title:too_long' AS reasons, c_custkey AS id, c_name AS last_name,
           (SELECT count(*) FROM customer WHERE NOT {_LONG}) AS loaded
    FROM customer WHERE {_LONG}
""")
def load_quarantine(spark, sf):
    """Rows that break a rule are set aside with their reasons and whole records; the others are loaded."""
    house, spec = house_for(spark, "quarantine"), REGISTRY["contacts"]
    ensure_tables(house, [spec])
    done = load_entity(partly_rejected(spark, sf, house), spec)
    if (done.status, done.reconcile) != (C.SUCCESS, R.LOAD_FAILED):
        raise RuntimeError(f"contacts: {done}")
    field = lambda name: F.get_json_object("record", f"$.{name}").alias(name)
    kept = house.read(QUARANTINE_TABLE)
    told = kept.select("entity_name", "rejected_at", F.array_join("reasons", ",").alias("reasons"), field("id").cast("bigint").alias("id"), field("last_name"))
    return told.withColumn("loaded", F.lit(house.read("contacts").count()))


@query(f"""
    SELECT c_custkey AS id, c_name AS last_name, CASE WHEN {_LONG} THEN 'mended' ELSE c_mktsegment END AS job_title FROM customer
""")
def load_quarantine_replayed(spark, sf):
    """Rejected records, read from the quarantine table, mended, landed again and loaded as all others."""
    house, spec = house_for(spark, "replayed"), REGISTRY["contacts"]
    ensure_tables(house, [spec])
    load_entity(partly_rejected(spark, sf, house), spec)
    mended = quarantined(house, spec).select(F.col("rec.id").cast("bigint").alias("id"), F.col("rec").withField("job_title", F.lit("mended")).alias("rec"))
    pages = land(mended, "contacts", spec.page_key, "id", F.col("rec"), 1, dense=True)
    done = load_entity(Job(house, pages, AGAIN, {"contacts": [1]}), spec, C.INCREMENTAL, LONG_AGO)
    if done.status != C.SUCCESS:
        raise RuntimeError(f"contacts: {done.error}")
    return house.read("contacts").select("id", "last_name", "job_title")
