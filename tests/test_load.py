"""Whole runs from landed pages to published tables."""

import json
from datetime import datetime
from uuid import uuid4

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pyspark.sql import types as T

from tidemirror.catalog import registry
from tidemirror.operators import control as C
from tidemirror.operators import reconcile as R
from tidemirror.operators.upsert import upsert
from tidemirror.plans import load as L
from tidemirror.plans.entities import REGISTRY, select_entities
from tidemirror.plans.load import AUDIT_TABLE, Job, ensure_tables, load_entity, run
from tidemirror.session import long_rows
from tidemirror.sources.pages import PAGE_SCHEMA
from tidemirror.warehouse import SLICE, Layout, Pending, Warehouse, slice_of

VIEWS = {"deals": [30, 10], "contacts": [1], "sales_accounts": [1], "leads": [1]}


def envelope(key, records, total=1):
    return json.dumps({key: records, "meta": {"total_pages": total}})


def deal(i, updated="2024-01-05T10:00:00-03:00", **more):
    return {"id": i, "name": f"deal {i}", "updated_at": updated, "deal_pipeline_id": 1, "deal_stage_id": 2, **more}


def source(deals, more_deals=(), deal_total=1, **changes):
    """Every entity's pages."""
    line = lambda i: {"id": i, "product_id": 5, "name": "P", "quantity": 2, "unit_price": 3.0, "total": 6.0}
    for d in (*deals, *more_deals):
        d.setdefault("products", [line(900 + d["id"])])
    bodies = {
        "pipelines": [(None, 1, envelope("deal_pipelines", [
            {"id": 1, "name": "P1", "is_default": True, "deal_stages": [
                {"id": 2, "name": "S", "deal_pipeline_id": 1, "position": 1, "probability": 50, "forecast_type": "Open"}]}]))],
        "deal_fields": [(None, 1, envelope("fields", [
            {"name": "forecast_category", "choices": [{"id": 1, "value": "Commit", "position": 1}]},
            {"name": "deal_prediction", "choices": [{"id": 3, "value": "Good", "position": 1, "is_default": True}]}]))],
        "users": [(None, 1, envelope("users", [{"id": 4, "display_name": "U"}, {"id": 5, "is_active": False}]))],
        "teams": [(None, 1, envelope("teams", [{"id": 3, "name": "T", "user_ids": [4, 5, 5]}, {"id": 6, "name": "E", "user_ids": []}]))],
        "sales_accounts": [(1, 1, envelope("sales_accounts", [{"id": 7, "name": "A", "created_at": "2024-01-01T00:00:00Z"}]))],
        "contacts": [(1, 1, envelope("contacts", [{"id": 8, "tags": ["a", "b"]}, {"id": 9, "tags": ["a", None]}, {"tags": []}]))],
        "products": [(None, 1, envelope("products", [{"id": 5, "name": "P", "base_currency_amount": 9.5}]))],
        "deals": [(30, 1, envelope("deals", list(deals), deal_total)), (10, 1, envelope("deals", list(more_deals)))],
        "tasks": [(None, 1, envelope("tasks", [{"id": 11}])), (None, 2, envelope("tasks", []))],
        "appointments": [(None, 1, envelope("appointments", []))],
        "sales_activities": [(None, 1, envelope("sales_activities", [{"id": 12, "title": "call"}])), (None, 2, envelope("sales_activities", []))],
    }
    bodies.update(changes)
    return [(entity, view, number, body) for entity, pages in bodies.items() for view, number, body in pages]


@pytest.fixture()
def house(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "house"), f"run_{uuid4().hex}", Layout(slices=2, buckets=2))


def job(spark, house, rows, day, sweep=False, **options):
    pages = spark.createDataFrame(rows, PAGE_SCHEMA)
    return Job(house, pages, datetime(2024, 1, day, 2), VIEWS, sweep_pages=pages if sweep else None, **options)


def outcomes(df):
    return {r["entity_name"]: r for r in df.collect()}


def test_first_and_next_run(spark, house):
    first = outcomes(run(job(spark, house, source([deal(1), deal(2), deal(3)], [deal(3, amount=7.5)]), 10)))
    assert {e: r["execution_status"] for e, r in first.items()} == {s.name: "SUCCESS" for s in select_entities()}
    assert (first["deals"]["records_inserted"], first["deals"]["records_updated"]) == (3, 0)
    # One contact with a null tag and one without id are set aside.
    assert (first["contacts"]["records_inserted"], first["contacts"]["records_failed"]) == (1, 2)

    deals = house.read("deals")
    assert deals.columns == REGISTRY["deals"].table_schema.names
    third = deals.filter("id = 3").first()
    assert (third["amount"], third["pipeline_name"], third["stage_name"]) == (7.5, "P1", "S")
    assert third["updated_at"] == datetime(2024, 1, 5, 10)
    assert house.read("deal_products").count() == 3
    assert {tuple(r) for r in house.read("team_users").select("team_id", "user_id").collect()} == {(3, 4), (3, 5)}
    assert {(r["id"], r["is_active"]) for r in house.read("users").collect()} == {(4, True), (5, False)}
    assert house.read("deal_predictions").first()["is_default"] is True
    assert house.read("forecast_categories").first()["name"] == "Commit"
    assert house.read("stages").first()["type"] == "Open"
    assert house.read(AUDIT_TABLE).count() == len(first)

    # Deal 1 unchanged and not read again, deal 2 gone, deal 3 changed, deal 4 new.
    changed = [deal(1), deal(3, "2024-01-11T00:00:00Z", name="new", products=[]), deal(4, "2024-01-12T00:00:00Z")]
    second = outcomes(run(job(spark, house, source(changed), 20, sweep=True), "deals"))
    row = second["deals"]
    assert (row["records_extracted"], row["records_inserted"], row["records_updated"]) == (2, 1, 1)
    assert (row["records_deleted"], row["records_cascade_deleted"]) == (1, 1)
    assert (row["records_active"], row["reconcile"]) == (3, R.APPLIED)
    ids = {r["id"]: r for r in house.read("deals").collect()}
    assert set(ids) == {1, 3, 4}
    assert ids[3]["name"] == "new"
    assert (ids[3]["etl_created_at"], ids[3]["etl_updated_at"]) == (datetime(2024, 1, 10, 2), datetime(2024, 1, 20, 2))
    assert ids[1]["etl_updated_at"] == datetime(2024, 1, 10, 2)
    # An emptied product list keeps the old lines; the deleted deal's line is gone.
    lines = house.read("deal_products").collect()
    assert {r["deal_id"] for r in lines} == {1, 3, 4}
    assert len({r["id"] for r in lines}) == 3


def test_incomplete_pages_neither_delete_nor_move_the_watermark(spark, house):
    run(job(spark, house, source([deal(1), deal(2)]), 10), "deals")
    broken = outcomes(run(job(spark, house, source([deal(1, "2024-01-11T00:00:00Z")], deal_total=2), 20, sweep=True), "deals"))["deals"]
    assert (broken["execution_status"], broken["records_updated"], broken["records_deleted"]) == ("ERROR", 1, 0)
    assert house.read("deals").count() == 2
    # The same change is read again by the next run.
    again = outcomes(run(job(spark, house, source([deal(1, "2024-01-11T00:00:00Z")]), 21, sweep=True), "deals"))["deals"]
    assert (again["execution_status"], again["records_updated"], again["records_deleted"]) == ("SUCCESS", 1, 1)


def test_bad_row_fails_a_strict_entity_and_leaves_its_table(spark, house):
    run(job(spark, house, source([deal(1)]), 10), "deals")
    bad = outcomes(run(job(spark, house, source([deal(1, name="x"), deal(2, amount="a lot")]), 20, force_full=True), "deals"))["deals"]
    assert bad["execution_status"] == "ERROR" and "amount" in bad["error_message"]
    assert [r["rec"]["id"] for r in L.quarantined(house, REGISTRY["deals"]).collect()] == ["2"]
    assert [r["name"] for r in house.read("deals").collect()] == ["deal 1"]


def test_failed_rows_and_empty_sweeps_delete_nothing(spark, house):
    run(job(spark, house, source([deal(1)]), 10), "users")
    empty = job(spark, house, source([deal(1)], users=[(None, 1, envelope("users", []))]), 20)
    done = load_entity(empty, REGISTRY["users"])
    assert (done.reconcile, done.deleted) == (R.EMPTY, 0)
    assert house.read("users").count() == 2
    ensure_tables(house, [REGISTRY["contacts"]])
    contacts = load_entity(job(spark, house, source([deal(1)]), 21), REGISTRY["contacts"])
    assert (contacts.failed, contacts.reconcile) == (2, R.LOAD_FAILED)


def test_relations_of_emptied_teams_go_and_others_keep_their_keys(spark, house):
    page = lambda *teams: [(None, 1, envelope("teams", [{"id": i, "name": "T", "user_ids": u} for i, u in teams]))]
    run(job(spark, house, source([deal(1)], teams=page((3, [4, 5]), (6, []), (7, [8]))), 10), "teams")
    before = {(r["team_id"], r["user_id"]): r["id"] for r in house.read("team_users").collect()}
    assert set(before) == {(3, 4), (3, 5), (7, 8)}
    load_entity(job(spark, house, source([deal(1)], teams=page((3, []), (6, [9]))), 20), REGISTRY["teams"])
    after = {(r["team_id"], r["user_id"]): r["id"] for r in house.read("team_users").collect()}
    assert set(after) == {(6, 9), (7, 8)}
    assert after[(7, 8)] == before[(7, 8)] and after[(6, 9)] > max(before.values())


def test_steps_are_audited_and_unknown_entities_refused(spark, house):
    steps = [("good", lambda: house.read("users").count()), ("bad", lambda: 1 / 0)]
    done = outcomes(run(job(spark, house, source([deal(1)]), 10, steps=steps), "users"))
    assert (done["good"]["execution_status"], done["bad"]["execution_status"]) == ("SUCCESS", "ERROR")
    assert house.read(AUDIT_TABLE).filter("entity_name = 'bad' and error_message like '%zero%'").count() == 1
    with pytest.raises(KeyError):
        run(job(spark, house, [], 11), "nope")


def test_new_columns_are_added_to_existing_tables(spark, house):
    narrow = spark.createDataFrame([(1, "old", "mine")], "id BIGINT, name STRING, extra STRING")
    house.replace(narrow, "products", "id")
    ensure_tables(house, [REGISTRY["products"]])
    row = house.read("products").first()
    assert (row["name"], row["price"], row["extra"]) == ("old", None, "mine")
    # A load changes the columns it knows and leaves the others.
    assert load_entity(job(spark, house, source([], products=[(None, 1, envelope("products", [{"id": 1, "name": "new"}]))]), 9), REGISTRY["products"]).error is None
    row = house.read("products").first()
    assert (row["name"], row["extra"]) == ("new", "mine")


def test_widening_twice_keeps_every_row(spark, house):
    house.replace(spark.range(1000), "t", "id")
    for name in ("a", "b"):
        house.create("t", T.StructType([T.StructField("id", T.LongType()), T.StructField(name, T.StringType())]), "id")
    got = house.read("t")
    assert got.columns == ["id", "a", "b"] and got.count() == 1000


def test_a_repeated_run_changes_nothing(spark, house):
    same = job(spark, house, source([deal(1), deal(2)]), 10)
    first, again = outcomes(run(same, "users")), outcomes(run(same, "users"))
    assert first["users"]["records_inserted"] == again["users"]["records_inserted"] == 2
    assert house.read("users").count() == 2
    assert house.read(AUDIT_TABLE).filter("entity_name = 'users'").count() == 1


def test_the_same_load_twice_does_not_duplicate(spark, house):
    """As after a crash between the publication and the audit row."""
    same = job(spark, house, source([deal(1), deal(2)]), 10)
    ensure_tables(house, [REGISTRY["deals"]])
    for _ in range(2):
        assert load_entity(same, REGISTRY["deals"]).error is None
    assert house.read("deals").count() == 2 and house.read("deal_products").count() == 2


def test_a_crash_between_two_publications_is_repaired_by_the_next_run(spark, house, monkeypatch):
    run(job(spark, house, source([deal(1)]), 10), "deals")
    changed = [deal(1, "2024-01-11T00:00:00Z", name="new", products=[{"id": 5, "product_id": 6}])]
    publish, done = Pending.commit, []

    def once(self):
        done.append(self.table)
        if len(done) == 2:
            raise RuntimeError("killed")
        publish(self)

    monkeypatch.setattr(Pending, "commit", once)
    broken = outcomes(run(job(spark, house, source(changed), 20), "deals"))["deals"]
    assert (broken["execution_status"], broken["error_message"]) == ("ERROR", "killed")
    monkeypatch.setattr(Pending, "commit", publish)
    assert {r["source_line_id"] for r in house.read("deal_products").collect()} == {901}
    run(job(spark, house, source(changed), 21), "deals")
    assert [r["name"] for r in house.read("deals").collect()] == ["new"]
    assert [r["source_line_id"] for r in house.read("deal_products").collect()] == [5]


def test_an_incremental_landing_without_a_sweep_deletes_nothing(spark, house):
    run(job(spark, house, source([deal(1), deal(2), deal(3)]), 10), "deals")
    row = outcomes(run(job(spark, house, source([deal(2, "2024-01-11T00:00:00Z", name="x")]), 20), "deals"))["deals"]
    assert (row["execution_status"], row["records_updated"], row["records_deleted"], row["reconcile"]) == ("SUCCESS", 1, 0, R.NO_SWEEP)
    assert house.read("deals").count() == 3


def test_a_full_load_reconciles_against_what_it_read(spark, house):
    run(job(spark, house, source([deal(1), deal(2)]), 10), "deals")
    row = outcomes(run(job(spark, house, source([deal(2)]), 20, force_full=True), "deals"))["deals"]
    assert (row["records_deleted"], row["records_cascade_deleted"], row["records_active"]) == (1, 1, 1)
    assert [r["id"] for r in house.read("deals").collect()] == [2]


def test_a_table_that_may_not_lose_rows_is_left_alone(spark, house):
    run(job(spark, house, source([deal(1), deal(2)]), 10), "deals")
    row = outcomes(run(job(spark, house, source([deal(2)]), 20, force_full=True, deletable={"users"}), "deals"))["deals"]
    assert (row["records_deleted"], row["reconcile"]) == (0, R.NOT_ALLOWED)


def test_nested_copies_and_option_lists(spark, house):
    stage = lambda name: {"id": 2, "name": name, "deal_pipeline_id": 1}
    twice = envelope("deal_pipelines", [{"id": 1, "name": "P", "deal_stages": [stage("old"), stage("new")]}])
    lists = [{"name": "forecast_category", "choices": [{"id": i, "value": v}]} for i, v in ((1, "first"), (2, "second"))]
    rows = source([], pipelines=[(None, 1, twice)], deal_fields=[(None, 1, envelope("fields", lists))])
    ensure_tables(house, [REGISTRY[n] for n in ("stages", "forecast_categories")])
    for name in ("stages", "forecast_categories"):
        assert load_entity(job(spark, house, rows, 10), REGISTRY[name]).error is None
    assert [r["name"] for r in house.read("stages").collect()] == ["new"]
    assert [r["name"] for r in house.read("forecast_categories").collect()] == ["first"]


def test_unreadable_times_are_counted(spark, house):
    ensure_tables(house, [REGISTRY["tasks"]])
    tasks = [{"id": 1, "due_date": "soon"}, {"id": 2, "due_date": "15 Jan 2024"}, {"id": 3, "due_date": ""}]
    pages = [(None, 1, envelope("tasks", tasks)), (None, 2, envelope("tasks", []))]
    done = load_entity(job(spark, house, source([], tasks=pages), 10), REGISTRY["tasks"])
    assert (done.unreadable, done.failed, done.inserted) == (1, 0, 3)


def test_counters_and_messages_have_no_cap(spark, house):
    done = L.Outcome("deals", datetime(2024, 1, 1), extracted=3_000_000_000, error="x" * 100_000)
    row = C.audit_rows(spark, [done.row()], C.OUTCOME_SCHEMA).first()
    assert row["records_extracted"] == 3_000_000_000 and len(row["error_message"]) == 100_000


def files_of(house, table):
    return {r[0] for r in house.read(table).select("_metadata.file_path").distinct().collect()}


def slice_in(path):
    return int(path.split(f"{SLICE}=")[1].split("/")[0])


def test_a_merge_reads_and_writes_touched_slices_only(spark, house):
    house.layout = Layout(slices=16, buckets=4)
    house.replace(spark.range(10_000).withColumn("v", F.lit(1)), "t", "id")
    before = files_of(house, "t")
    assert {slice_in(f) for f in before} == set(range(16))
    batch = spark.createDataFrame([(3, 2), (100_000, 2)], "id BIGINT, v INT")
    change = house.change("t", batch, lambda part, changed: upsert(part, changed, "id"))
    touched = {r[0] for r in batch.select(slice_of("id", 16)).collect()}
    assert change.touched == touched and house.read("t").filter("v = 2").isEmpty()
    text = change.rows._jdf.queryExecution().executedPlan().toString()
    # Other slices are no part of the scan, and the table is joined as its buckets lie: the
    # batch's rows and, for the check, its keys are exchanged, the table is not.
    scan = next(line for line in text.split("\n") if "FileScan" in line)
    assert "Bucketed: true" in scan and f"PartitionFilters: [{SLICE}#" in scan and f"InMemoryFileIndex({len(touched)} paths)" in scan
    assert "FullOuter" in text and text.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in text
    target = text[text.index("FullOuter") :]
    target = target[: target.index("FileScan")]
    assert "Exchange" not in target
    change.commit()
    after = files_of(house, "t")
    assert {slice_in(f) for f in before ^ after} == touched
    assert len(after) == len(before)
    assert house.read("t").count() == 10_001 and house.read("t").filter("v = 2").count() == 2


def test_slices_are_replaced_whatever_the_session_says(spark, house):
    house.replace(spark.range(100), "t", "id")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        house.change("t", spark.range(100, 101), lambda part, new: part.unionByName(new)).commit()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert house.read("t").count() == 101


def test_an_emptied_slice_loses_its_rows(spark, house):
    house.replace(spark.range(4), "t", "id")
    house.change("t", spark.range(3), lambda part, ids: part.join(ids, "id", "left_anti")).commit()
    assert [r["id"] for r in house.read("t").collect()] == [3]
    house.change("t", spark.range(4), lambda part, ids: part.join(ids, "id", "left_anti")).commit()
    assert house.read("t").isEmpty()


def test_a_failed_merge_leaves_the_table(spark, house):
    house.replace(spark.range(3), "t", "id")
    broken = house.change("t", spark.range(3), lambda part, new: part.select(F.when(F.col("id") >= 0, F.raise_error(F.lit("no"))).cast("bigint").alias("id")))
    with pytest.raises(Exception, match="no"):
        broken.commit()
    assert house.read("t").count() == 3


def test_a_session_with_another_catalog_finds_the_tables_again(spark, house):
    house.replace(spark.range(50), "t", "id")
    schema = house.read("t").schema
    spark.sql(f"DROP TABLE {house.name('t')}")
    other = Warehouse(spark, house.root, f"{house.database}_again", house.layout)
    other.create("t", schema, "id")
    assert other.read("t").count() == 50
    other.change("t", spark.range(60, 61), lambda part, new: part.unionByName(new)).commit()
    assert other.read("t").count() == 51


def test_keys_are_read_as_the_table_s_type(spark, house):
    house.replace(spark.range(50), "t", "id")
    house.change("t", spark.range(50).selectExpr("cast(id as int) as id"), lambda part, ids: part.join(ids, "id", "left_anti")).commit()
    assert house.read("t").isEmpty()


BATCH = "spark.sql.parquet.columnarReaderBatchSize"


def test_pages_are_read_few_rows_at_a_time(spark, house, monkeypatch):
    """Bodies are hundreds of KB; the reader's usual 4,096 rows of them do not fit an executor."""
    seen, stage, usual = {}, Warehouse.stage, spark.conf.get(BATCH)

    def staged(self, df, name):
        seen[name] = int(spark.conf.get(BATCH))
        return stage(self, df, name)

    monkeypatch.setattr(Warehouse, "stage", staged)
    for day in (10, 20):
        outcomes(run(job(spark, house, source([deal(1, f"2024-01-{day - 1}T00:00:00Z")]), day, sweep=True), "deals"))
    reading = {name: seen.pop(name) for name in ("deals-heads", "deals-records", "deals-sweep", "deals-active")}
    assert max(reading.values()) <= 64, reading
    assert set(seen.values()) == {int(usual)} and spark.conf.get(BATCH) == usual


def test_the_reader_is_as_before_after_an_error(spark):
    usual = spark.conf.get(BATCH)
    with pytest.raises(ZeroDivisionError), long_rows(spark):
        assert int(spark.conf.get(BATCH)) < int(usual)
        1 / 0  # noqa: B018
    assert spark.conf.get(BATCH) == usual


def test_a_writer_gives_up_large_dictionaries_early(spark, house, tmp_path):
    """A hundred columns with a dictionary of 1 MB each, several times that as objects, are too much for a task."""
    rows = spark.range(20_000).selectExpr("id", "concat('one of many texts ', id % 10000) AS name").coalesce(1)
    house.stage(rows, "unlike")
    house.create("unlike", rows.schema)
    house.append(rows, "unlike")
    files = [*(tmp_path / "house").rglob("part-*.parquet")]
    assert len(files) == 2
    for file in files:
        column = pq.ParquetFile(file).metadata.row_group(0).column(1)
        assert column.path_in_schema == "name" and not any("DICTIONARY" in e for e in column.encodings), column


def test_long_pages_are_written_in_groups_that_several_tasks_read(spark, tmp_path, monkeypatch):
    text = "array_join(transform(sequence(1, 64), i -> sha2(concat(id, ':', i), 256)), '')"
    rows = spark.range(12_000).withColumn("text", F.expr(text)).coalesce(1)
    written = []
    monkeypatch.setattr(registry, "landed", lambda spark, path, kind: written.append(path))
    monkeypatch.setattr(registry, "shared_dir", lambda spark: str(tmp_path))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        registry.land(rows, "texts", "texts", "id", F.struct("id", "text"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    files = [pq.ParquetFile(f).metadata for f in tmp_path.rglob("part-*.parquet")]
    assert sum(f.num_rows for f in files) == 120
    # Two files' worth of tasks at least for what is 50 MB in one file.
    assert sum(f.num_row_groups for f in files) > len(files)
