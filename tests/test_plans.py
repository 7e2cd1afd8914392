"""Physical plans: one main shuffle, no Python workers, no cross joins, narrow scans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pulsegrid.operators.monitor import recent_means
from pulsegrid.schemas import VITALS
from pulsegrid.streaming.commits import Committed, read_committed

SF = "/root/testdata/sf0.001"
BATCH = ["grid_downsample", "grid_fill_gaps", "trim_quarters", "case_means", "mean_impute", "clinical_lookup",
         "prepared_samples", "publish_route", "json_roundtrip", "enrich_cast_float", "risk_share", "trend_tumbling",
         "trend_sliding", "ml_features", "confusion_matrix"]


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("PythonEvaluation", "EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin",
                     "SortAggregate"):
        assert operator not in plan


def test_preparation_shuffles_the_readings_once(spark):
    plan = final_plan(entry.queries()["prepared_samples"](spark, SF))
    main = re.findall(r"(?<!ReusedExchange )Exchange hashpartitioning\(caseid#\d+, block#\d+L, slot#\d+L", plan)
    reused = re.findall(r"ReusedExchange \[caseid#\d+, block#\d+L, slot#\d+L", plan)
    assert len(reused) == 1 and len([m for m in main]) - len(reused) == 1


def test_first_clinical_row_is_chosen_before_the_shuffle(spark):
    plan = final_plan(entry.queries()["clinical_lookup"](spark, SF))
    assert re.search(r"WindowGroupLimit .* row_number\(\), 1, Partial", plan)


def test_scans_read_only_what_they_need(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = entry.queries()["round_modes"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan
    plan = entry.queries()["trim_quarters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(user_id)" in plan


def test_without_broadcast_samples_meet_case_values_by_block(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = entry.queries()["prepared_samples"](spark, SF)
        plan = final_plan(df)
        assert re.search(r"SortMergeJoin \[caseid#\d+, block#\d+L, stay#\d+L\]", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_recent_rows_are_read_by_date(spark, tmp_path):
    rows = spark.range(10).select(F.lit("1").alias("caseid"), F.timestamp_seconds(F.col("id") * 86400).alias("event_ts"),
                                  *[F.col("id").cast("float").alias(c) for c in VITALS])
    Committed(str(tmp_path), run="a", by_date=True)(rows, 0)
    stored = read_committed(spark, str(tmp_path)).where("event_date >= DATE '1970-01-08'")
    plan = recent_means(stored, 86400)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*event_date#\d+ >= 1970-01-08", plan) and stored.count() == 3


def test_sliding_means_aggregate_means_only(spark):
    plan = entry.queries()["trend_sliding"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(Heart" not in plan and "partial_max(Heart" not in plan


def test_labels_are_joined_before_texts_are_counted(spark):
    plan = entry.queries()["ml_features"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("translate(") < plan.index("Join Inner") and "regexp" not in plan.replace("split", "")
