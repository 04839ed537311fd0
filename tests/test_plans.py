"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tidemirror.catalog import QUERIES
from tidemirror.operators.align import align
from tidemirror.operators.upsert import upsert
from tidemirror.plans.entities import REGISTRY
from tidemirror.plans.project import project, record_type
from tidemirror.warehouse import Warehouse

# These run their loads or streams when they are called.
EAGER = ("rate_limit_stream", "rate_limit_stream_restarted", "stream_upsert")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(EAGER)))
def test_no_python_and_no_cross_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    if name != "load_run_twice":
        # That one adds a single row of counts.
        assert "BroadcastNestedLoopJoin" not in text, text
    assert not re.search(r"Python|Pandas|ArrowEval|CartesianProduct", text), text


def test_incremental_filter_reaches_the_files(spark, sf):
    text = plan(QUERIES["incremental_filter"](spark, sf))
    assert "GreaterThan(ts," in text
    assert "user_id" not in text and "props" not in text


def test_reconcile_reads_only_ids(spark, sf):
    text = plan(QUERIES["reconcile_ids"](spark, sf))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["o_orderkey:bigint", "l_orderkey:bigint"]
    assert "LeftAnti" in text


def test_lookup_broadcasts_the_dimension(spark, sf):
    assert plan(QUERIES["enrich_lookup"](spark, sf)).count("BroadcastHashJoin") == 2


def test_dedup_drops_copies_before_the_shuffle(spark, sf):
    text = plan(QUERIES["dedup_multi_view"](spark, sf))
    assert text.count("WindowGroupLimit") == 2


def test_fact_sums_lines_before_it_joins(spark, sf):
    text = plan(QUERIES["fact_deal_products"](spark, sf))
    assert text.index("Join") < text.index("HashAggregate")


def test_merge_shuffles_the_batch_once_and_checks_its_keys_without_a_sort(spark, tmp_path):
    spec = REGISTRY["products"]
    rows = spark.range(10).select(F.format_string('{"id":%s,"name":"a"}', F.col("id").cast("string")).alias("b"))
    rows.select(F.from_json("b", record_type(spec)).alias("rec")).write.parquet(str(tmp_path / "records"))
    batch = project(spark.read.parquet(str(tmp_path / "records")), spec).drop("_errors", "_unreadable")
    target = align(spark.createDataFrame([], spec.table_schema), spec.table_schema)
    text = plan(upsert(target, batch, "id", run_ts="2024-01-01 00:00:00"))
    assert "SortAggregate" not in text
    # Rows and, for the check, keys of the batch; the target is empty here.
    assert text.count("Exchange hashpartitioning") <= 3


def test_a_load_parses_each_page_once_for_heads_and_once_for_records(spark, sf, tmp_path, monkeypatch):
    seen = []
    stage = Warehouse.stage

    def staged(self, df, name):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        seen.append((name, text.count("from_json(")))
        return stage(self, df, name)

    monkeypatch.setattr(Warehouse, "stage", staged)
    QUERIES["load_tasks"](spark, sf)
    parses = {}
    for name, n in seen:
        parses.setdefault(name, n)
    assert parses["tasks-heads"] >= 1 and parses["tasks-records"] >= 1
    assert all(n == 0 for name, n in parses.items() if name not in ("tasks-heads", "tasks-records")), parses
