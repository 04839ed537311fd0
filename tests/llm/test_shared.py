from tidemirror.llm.shared import stored


def test_a_stored_table_is_read_without_a_job_for_its_schema(spark):
    spark.sparkContext.setJobGroup("stored-once", "")
    try:
        out = stored(spark.range(3, numPartitions=2), "numbers")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("stored-once")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r["id"] for r in out.collect()) == [0, 1, 2] and out.columns == ["id"]
