"""One entity from landed pages to its published table, and a run over all entities."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemirror.functions import quality as Q
from tidemirror.functions.normalize import parse_ts
from tidemirror.operators import control as C
from tidemirror.operators import reconcile as R
from tidemirror.operators.align import align
from tidemirror.operators.children import replace_children, replace_relations
from tidemirror.operators.reports import run_steps
from tidemirror.operators.upsert import ACTION, CREATED, action_metrics, surrogate_keys, upsert
from tidemirror.plans.entities import REGISTRY, ChildSpec, EntitySpec, select_entities, stored_type
from tidemirror.plans.project import RECORD, UNREADABLE, envelope_type, project, project_children, record_type, unwrap
from tidemirror.session import long_rows
from tidemirror.sources import pages as P
from tidemirror.warehouse import Pending, Warehouse

AUDIT_TABLE = "etl_control"
QUARANTINE_TABLE = "etl_quarantine"
QUARANTINE_SCHEMA = "entity_name STRING, rejected_at TIMESTAMP_NTZ, reasons ARRAY<STRING>, record STRING"
# The table property that holds the highest surrogate key given so far.
TOP = "mirror.top"


@dataclass
class Outcome:
    """What happened to one entity in one run.

    ``active`` is the number of ids the sweep found, ``pages`` that of the landed pages,
    ``unreadable`` that of times that were told but could not be read.
    """

    entity: str
    at: datetime
    status: str = C.SUCCESS
    extracted: int = 0
    inserted: int = 0
    updated: int = 0
    failed: int = 0
    deleted: int = 0
    cascade_deleted: int = 0
    error: str | None = None
    seconds: int = 0
    reconcile: str | None = None
    active: int | None = None
    pages: int = 0
    unreadable: int = 0

    def row(self) -> tuple:
        return (
            self.entity, self.at, self.status, self.extracted, self.inserted, self.updated,
            self.failed, self.error, self.seconds, self.deleted, self.cascade_deleted, "entity",
            self.active, self.pages, self.reconcile,
        )


@dataclass
class Job:
    """Inputs of a run.

    ``views`` lists each view entity's view ids in reading order. ``sweep_pages`` holds the
    pages of an id sweep without a date filter; an incremental load deletes nothing without
    them. A full load needs none: what it reads is all there is. ``deletable`` names the
    tables that may lose rows.
    """

    warehouse: Warehouse
    pages: DataFrame
    run_ts: datetime
    views: dict[str, list[int]] = field(default_factory=dict)
    sweep_pages: DataFrame | None = None
    force_full: bool = False
    steps: list = field(default_factory=list)
    deletable: set[str] = field(default_factory=lambda: set(REGISTRY))


def ensure_tables(warehouse: Warehouse, specs: list[EntitySpec] | None = None) -> None:
    """Create what is missing: the entities' tables, their child tables, new columns, the audit and the quarantine table."""
    for spec in REGISTRY.values() if specs is None else specs:
        warehouse.create(spec.name, spec.table_schema, spec.key)
        for child in spec.children:
            warehouse.create(child.table, _child_schema(child), child.parent_column)
    warehouse.create(AUDIT_TABLE, T.StructType.fromDDL(C.AUDIT_SCHEMA))
    warehouse.create(QUARANTINE_TABLE, T.StructType.fromDDL(QUARANTINE_SCHEMA))


def run(job: Job, entity: str | None = None) -> DataFrame:
    """Load the chosen entities in order, then run the steps; the outcome rows.

    Every outcome is appended to the audit table. The audit time is the start of the run, so
    rows that change while it runs are read again next time. A run that is started again with
    the same time leaves out the entities that succeeded and tells their outcome as audited.
    """
    spark = job.warehouse.spark
    specs = select_entities(entity)
    ensure_tables(job.warehouse, specs)
    known = spark.createDataFrame([(s.name, s.incremental) for s in specs], "entity_name STRING, incremental BOOLEAN")
    audit = job.warehouse.read(AUDIT_TABLE)
    # One row per selected entity, twice.
    modes = {r["entity_name"]: r for r in C.load_modes(known, audit, job.force_full).collect()}
    done_before = audit.filter((F.col("last_execution_date") == F.lit(str(job.run_ts)).cast("timestamp_ntz")) & (F.col("execution_status") == C.SUCCESS))
    earlier = {r["entity_name"]: r for r in done_before.join(known, "entity_name", "left_semi").dropDuplicates(["entity_name"]).collect()}
    rows = []
    for spec in specs:
        if spec.name not in earlier:
            rows.append(load_entity(job, spec, modes[spec.name]["mode"], modes[spec.name]["watermark"]).row())
    outcomes = C.audit_rows(spark, rows, C.OUTCOME_SCHEMA)
    if job.steps:
        outcomes = outcomes.unionByName(run_steps(spark, job.steps))
    if rows or job.steps:
        job.warehouse.append(outcomes.select(*audit.columns), AUDIT_TABLE)
    if earlier:
        told = [(*(r[c] for c in audit.columns), None, None, "entity", None, None, None) for r in earlier.values()]
        outcomes = outcomes.unionByName(C.audit_rows(spark, told, C.OUTCOME_SCHEMA))
    return outcomes


def load_entity(job: Job, spec: EntitySpec, mode: str = C.FULL, watermark: datetime | None = None) -> Outcome:
    """Read, project, upsert, replace children and reconcile one entity.

    All rows are read, projected and checked before the first table changes, so an error there
    leaves every table as it was; it is told in the outcome. Should the job die between two
    tables, the next run reads the same changes and repeats them.
    """
    began = time.monotonic()
    done = Outcome(spec.name, job.run_ts)
    try:
        _load(job, spec, mode, watermark, done)
    except Exception as error:
        done.status, done.error = C.ERROR, str(error)
    done.seconds = int(time.monotonic() - began)
    return done


def _heads(house: Warehouse, pages: DataFrame, spec: EntitySpec, name: str) -> tuple[DataFrame, int]:
    """Heads without bodies, written once, and their number; whatever asks about pages reads these."""
    count = Observation()
    with long_rows(house.spark):
        heads = house.stage(P.page_heads(pages, spec.page_key).observe(count, F.count("*").alias("pages")), f"{spec.name}-{name}")
    return heads, count.get["pages"]


def _whole(ends: DataFrame, views: list[int] | None) -> bool:
    # One row per configured view of this entity.
    state = ends.agg(F.count("*").alias("views"), F.count_if(~F.col("is_complete")).alias("broken")).first()
    return state["broken"] == 0 and state["views"] >= len(views or [None])


def _load(job: Job, spec: EntitySpec, mode: str, watermark, done: Outcome) -> None:
    house, views = job.warehouse, job.views.get(spec.name)
    pages = _pages_of(job.pages, spec, views)
    heads, done.pages = _heads(house, pages, spec, "heads")
    ends = P.view_ends(heads, spec.scan)
    whole = _whole(ends, views)

    read = unwrap(P.read_pages(pages, spec.page_key, envelope_type(spec), spec.scan, ends), spec)
    if spec.date_field and mode == C.INCREMENTAL:
        read = P.since(read, parse_ts(f"rec.`{spec.date_field}`"), watermark, keep_unknown=True)
    # Written once: pages are parsed for this alone.
    with long_rows(house.spark):
        records = house.stage(_last_copies(read, spec, views), f"{spec.name}-records")

    dimensions = {d: house.read_or_none(d) for d, _ in spec.lookups.values()}
    # Written once: the checks, the merge and the reconcile all read these rows.
    seen = Observation()
    rows = project(records, spec, dimensions).observe(
        seen,
        F.count("*").alias("rows"),
        F.count_if(F.size(Q.ERRORS) > 0).alias("bad"),
        F.coalesce(F.sum(UNREADABLE), F.lit(0)).alias("unreadable"),
        F.first(F.when(F.size(Q.ERRORS) > 0, F.col(Q.ERRORS)), ignorenulls=True).alias("example"),
    )
    checked = house.stage(rows, f"{spec.name}-rows")
    counted = seen.get
    done.extracted, done.failed, done.unreadable = counted["rows"], counted["bad"], counted["unreadable"]
    if done.failed:
        _set_aside(job, spec, checked)
        if spec.strict:
            raise Q.RejectedBatch(f"{spec.name}: bad rows in a strict batch, first errors {counted['example']}")
    good, _ = Q.split(checked.drop(UNREADABLE, RECORD))
    if done.extracted:
        counts = Observation()
        merged = house.change(spec.name, good, partial(_merge, job, spec, counts))
        changes = [merged, *[_replaced(job, spec, child, records) for child in spec.children]]
        for change in changes:
            change.commit()
        if merged.touched:
            done.inserted, done.updated = counts.get["inserted"], counts.get["updated"]
    if not whole:
        done.status, done.error = C.ERROR, "incomplete pages"
    _reconcile(job, spec, mode, whole, views, records, done)


def _set_aside(job: Job, spec: EntitySpec, checked: DataFrame) -> None:
    """Rejected records with their reasons, for ``quarantined`` to read again."""
    bad = checked.filter(F.size(Q.ERRORS) > 0)
    told = bad.select(F.lit(spec.name).alias("entity_name"), F.lit(str(job.run_ts)).cast("timestamp_ntz").alias("rejected_at"), F.col(Q.ERRORS).alias("reasons"), F.col(RECORD).alias("record"))
    job.warehouse.append(told, QUARANTINE_TABLE)


def quarantined(warehouse: Warehouse, spec: EntitySpec, since: datetime | None = None) -> DataFrame:
    """Rejected records of an entity as ``project`` takes them, with ``rejected_at`` and ``reasons``.

    Landed again as a page, mended ones are loaded like all others.
    """
    kept = warehouse.read(QUARANTINE_TABLE).filter(F.col("entity_name") == spec.name)
    if since:
        kept = kept.filter(F.col("rejected_at") >= F.lit(str(since)).cast("timestamp_ntz"))
    return kept.select(F.from_json("record", record_type(spec)).alias("rec"), "rejected_at", "reasons")


def _last_copies(read: DataFrame, spec: EntitySpec, views: list[int] | None) -> DataFrame:
    """One record per id, the copy read last; records without id stay, to be told as errors."""
    place = F.concat_ws("/", "view_id", "page", "pos", "item")
    keyed = read.withColumn("_id", F.coalesce(F.col(f"rec.{spec.key}"), F.concat(F.lit("at "), place)))
    return P.dedup_views(keyed, "_id", views, ("page", "pos", "item")).select("rec")


def _merge(job: Job, spec: EntitySpec, counts: Observation, part: DataFrame, batch: DataFrame) -> DataFrame:
    target = align(part, spec.table_schema, extra=True)
    merged = upsert(target, batch, spec.key, run_ts=str(job.run_ts))
    return merged.observe(counts, *action_metrics()).drop(ACTION)


def _pages_of(pages: DataFrame, spec: EntitySpec, views: list[int] | None) -> DataFrame:
    mine = pages.filter(F.col("entity") == spec.landed_as)
    return mine.filter(F.col("view_id").isin(views)) if views else mine


def _replaced(job: Job, spec: EntitySpec, child: ChildSpec, records: DataFrame) -> Pending:
    """Old rows that stay keep their surrogate keys; the batch's rows are numbered after them."""
    house, parent = job.warehouse, child.parent_column
    new = project_children(records, spec, child)
    if child.unique:
        new = new.dropDuplicates(list(child.unique))
    stamped = new.withColumn(CREATED, F.lit(str(job.run_ts)).cast("timestamp_ntz"))
    top = int(house.marks(child.table).get(TOP, 0))
    count = Observation()
    numbered = surrogate_keys(stamped, None, start=top, column=child.surrogate).observe(count, F.count("*").alias("rows"))
    rows = house.stage(numbered, f"{child.table}-rows")
    # Taken before the rows are published: a number is never given twice.
    house.mark(child.table, **{TOP: top + count.get["rows"]})
    everyone = child.replace == "all"
    parents = records.select(F.col(f"rec.{spec.key}").cast("bigint").alias(parent)) if everyone else rows.select(parent)

    def swap(part: DataFrame, touched: DataFrame) -> DataFrame:
        new = house.spread(rows, child.table)
        if everyone:
            return replace_relations(part, new, touched, parent)
        return replace_children(part, new, parent, run_ts=str(job.run_ts))

    return house.change(child.table, parents.distinct(), swap)


def _reconcile(job: Job, spec: EntitySpec, mode: str, whole: bool, views, records: DataFrame, done: Outcome) -> None:
    """Delete what the source no longer has: against the ids just read, or those of a sweep."""
    house = job.warehouse
    if mode != C.INCREMENTAL:
        active = records.select(F.col(f"rec.{spec.key}").cast("bigint").alias(spec.key)).filter(f"{spec.key} IS NOT NULL")
    elif job.sweep_pages is None:
        done.reconcile = R.NO_SWEEP
        return
    else:
        swept = _pages_of(job.sweep_pages, spec, views)
        heads, _ = _heads(house, swept, spec, "sweep")
        # The load may be whole where the sweep is not, and the other way round.
        whole = whole and _whole(P.view_ends(heads, spec.scan), views)
        found = P.active_ids(swept, spec.page_key, spec.scan, views, spec.needs_view, heads)
        with long_rows(house.spark):
            active = house.stage(found.select(F.col("id").alias(spec.key)), f"{spec.name}-active")
    done.active = active.count()
    done.reconcile = R.guard(failed=done.failed, complete=whole, active=active, table=spec.name, allowed=job.deletable)
    if done.reconcile != R.APPLIED:
        return
    # Written once; the table and its children are changed only where these ids lie.
    gone = house.stage(R.missing_ids(house.read(spec.name), active, spec.key), f"{spec.name}-gone")
    done.deleted = gone.count()
    if not done.deleted:
        return
    changes = []
    for table, parent in spec.cascades:
        ids = gone.select(F.col(spec.key).alias(parent))
        done.cascade_deleted += house.read(table).join(ids, parent, "left_semi").count()
        changes.append(house.change(table, ids, lambda part, ids, parent=parent: part.join(ids, parent, "left_anti")))
    changes.append(house.change(spec.name, gone, lambda part, ids: part.join(ids, spec.key, "left_anti")))
    for change in changes:
        change.commit()


def _child_schema(child: ChildSpec) -> T.StructType:
    fields = [T.StructField(child.surrogate, T.LongType())] if child.surrogate else []
    fields += [T.StructField(f.name, stored_type(f.dataType)) for f in T.StructType.fromDDL(child.ddl)]
    fields.append(T.StructField("etl_created_at", T.TimestampNTZType()))
    if not child.item_column:
        fields.append(T.StructField("etl_updated_at", T.TimestampNTZType()))
    return T.StructType(fields)


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0, tzinfo=None)
