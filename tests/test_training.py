import random
import re

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from pulsegrid.operators.labels import hash_split, index_labels
from pulsegrid.operators.metrics import confusion_matrix, quality
from pulsegrid.plans.scoring import score_enriched
from pulsegrid.plans import training as fitting
from pulsegrid.plans.training import (WEIGHT, complete_rows, evaluate, fit_risk_model, fit_sample, importances, labels_of, left_out,
                                      preview, spread, train_and_test, unseen_counts)
from pulsegrid.schemas import ENCODED_LABEL, FEATURES, HIGH_RISK, LABEL, LOW_RISK, SCORED_COLUMNS, TRAINING_SCHEMA
from pulsegrid.sources.models import load_model, save_model


def training(spark, n=400, high_share=0.3, seed=5):
    rnd, rows = random.Random(seed), []
    for i in range(n):
        high = rnd.random() < high_share
        heart = rnd.randint(110, 150) if high else rnd.randint(60, 95)
        rows.append((i, heart, 14, 36.6, 97.0, rnd.randint(100, 130), rnd.randint(60, 80), rnd.randint(20, 80), "F",
                     70.0, 1.7, 24.2, HIGH_RISK if high else LOW_RISK))
    return spark.createDataFrame(rows, TRAINING_SCHEMA)


@pytest.fixture(scope="module")
def fitted(spark):
    return train_and_test(training(spark), ["Patient ID"], trees=10)


def patients(spark):
    base = {c: 1.0 for c in SCORED_COLUMNS if c not in ("caseid", "Gender", "timestamp", "Risk Predicted")}
    values = {**base, "Respiratory Rate": 14.0, "Body Temperature": 36.6, "Oxygen Saturation": 97.0, "Age": 50.0,
              "Systolic Blood Pressure": 115.0, "Diastolic Blood Pressure": 70.0, "Derived_BMI": 24.2}
    rows = [{**values, "caseid": c, "Gender": "F", "timestamp": "t", "Heart Rate": h} for c, h in
            (("calm", 70.0), ("fast", 140.0), ("lost", None))]
    schema = ", ".join(f"`{c}` " + ("string" if c in ("caseid", "Gender", "timestamp") else "float")
                       for c in SCORED_COLUMNS if c != "Risk Predicted")
    return spark.createDataFrame([tuple(r[c] for c in SCORED_COLUMNS if c != "Risk Predicted") for r in rows], schema)


@pytest.mark.parametrize("high_share", [0.3, 0.7])
def test_label_text_does_not_depend_on_label_frequency(spark, high_share):
    model = fit_risk_model(training(spark, high_share=high_share), trees=10)
    assert labels_of(model)[0] == (HIGH_RISK if high_share > 0.5 else LOW_RISK)
    scored = score_enriched(patients(spark), model)
    assert scored.columns == SCORED_COLUMNS
    assert {r.caseid: r["Risk Predicted"] for r in scored.collect()} == {"calm": LOW_RISK, "fast": HIGH_RISK}


def test_saved_model_predicts_the_same(spark, fitted, tmp_path):
    model, predictions = fitted
    save_model(model, str(tmp_path / "m"))
    save_model(model, str(tmp_path / "m"))
    key = lambda rows: sorted((r["Patient ID"], r.prediction) for r in rows.collect())
    again = load_model(str(tmp_path / "m")).transform(predictions.drop("features", "rawPrediction", "probability",
                                                                       "prediction", ENCODED_LABEL))
    assert key(again) == key(predictions)


def test_same_seed_and_rows_give_the_same_model(spark):
    rows = training(spark, 200).repartition(3)
    models = [train_and_test(rows, ["Patient ID"], trees=5)[0] for _ in range(2)]
    assert models[0].stages[-1].toDebugString.split("\n")[1:] == models[1].stages[-1].toDebugString.split("\n")[1:]


def test_metrics_equal_the_evaluator(spark, fitted):
    noise = random.Random(2)
    rows = [(float(noise.choice([0, 0, 1, 2])), float(noise.choice([0, 1, 1, 3]))) for _ in range(500)]
    frame = spark.createDataFrame(rows, [ENCODED_LABEL, "prediction"])
    for predictions in (frame, fitted[1]):
        ours = evaluate(predictions).first()
        for name, metric in (("accuracy", "accuracy"), ("weighted_precision", "weightedPrecision"),
                             ("weighted_recall", "weightedRecall")):
            evaluator = MulticlassClassificationEvaluator(labelCol=ENCODED_LABEL, metricName=metric)
            assert ours[name] == pytest.approx(evaluator.evaluate(predictions), abs=1e-12)
        assert ours.weighted_recall == pytest.approx(ours.accuracy)


def test_quality_of_known_counts(spark):
    rows = spark.createDataFrame([(0, 0, 6), (0, 1, 2), (1, 1, 2)], "label int, prediction int, n bigint")
    row = quality(rows).first()
    assert (row.accuracy, row.weighted_recall) == (0.8, 0.8)
    assert row.weighted_precision == pytest.approx(0.8 * 1.0 + 0.2 * 0.5)


def test_confusion_counts(spark):
    rows = spark.createDataFrame([(0.0, 1.0), (0.0, 1.0), (1.0, 1.0)], ["l", "prediction"])
    assert sorted(tuple(r) for r in confusion_matrix(rows, "l").collect()) == [(0, 1, 2), (1, 1, 1)]


def test_split_does_not_depend_on_partitioning(spark):
    rows = spark.range(5000)
    parts = [{r.id for r in hash_split(rows.repartition(n), ["id"])[0].collect()} for n in (1, 5)]
    assert parts[0] == parts[1] and 0.67 < len(parts[0]) / 5000 < 0.73
    other_seed = {r.id for r in hash_split(rows, ["id"], seed=1)[0].collect()}
    assert other_seed != parts[0]


def test_rows_without_label_or_input_are_counted_and_left_out(spark):
    rows = training(spark, 60)
    holes = (rows.withColumn(LABEL, F.when(F.col("Patient ID") > 2, F.col(LABEL)))
             .withColumn("Age", F.when(F.col("Patient ID") != 10, F.col("Age"))))
    assert tuple(left_out(holes).first()) == (60, 3, 1)
    assert fit_risk_model(holes, trees=2).stages[0].labels


def test_label_order(spark):
    rows = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], [LABEL])
    assert {r[0]: r[1] for r in index_labels(rows).collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_importances_and_preview(spark, fitted):
    model, predictions = fitted
    rows = importances(spark, model).collect()
    assert [r.feature for r in rows] == FEATURES and sum(r.importance for r in rows) == pytest.approx(1)
    assert max(rows, key=lambda r: r.importance).feature == "Heart Rate"
    ids = [r[0] for r in preview(predictions, ["Patient ID", "prediction"], ["Patient ID"]).collect()]
    assert len(ids) == 10 and ids == sorted(ids)


def test_the_sample_of_a_fit_is_bounded_and_keeps_class_shares(spark):
    rows = training(spark, 1000)
    all_rows = fit_sample(rows)
    assert all_rows.count() == 1000 and all_rows.select(WEIGHT).distinct().collect() == [(1.0,)]
    some = fit_sample(rows, rows_per_class=50)
    counts = {r[LABEL]: (r.n, r.w) for r in some.groupBy(LABEL).agg(F.count("*").alias("n"), F.sum(WEIGHT).alias("w")).collect()}
    whole = {r[LABEL]: r["count"] for r in rows.groupBy(LABEL).count().collect()}
    assert {k: n for k, (n, _) in counts.items()} == {HIGH_RISK: 50, LOW_RISK: 50}
    assert all(w == pytest.approx(whole[k]) for k, (_, w) in counts.items())
    again = fit_sample(rows.repartition(9), rows_per_class=50)
    assert sorted(some.collect()) == sorted(again.collect())
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .* row_number\(\), 50, Partial", plan)


def test_no_task_of_the_sample_gets_a_class(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    try:
        some = fit_sample(training(spark, 1000), rows_per_class=200)
        by_task = some.groupBy(LABEL, F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {sum(r["count"] for r in by_task if r[LABEL] == c) for c in (HIGH_RISK, LOW_RISK)} == {200}
    assert max(r["count"] for r in by_task) < 150


def test_a_fit_reads_no_more_than_its_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(fitting, "spread", lambda sample, parts: seen.append((sample.count(), parts)) or spread(sample, parts))
    monkeypatch.setattr(fitting, "PART_ROWS", 10)
    monkeypatch.setattr(fitting, "LEAST_PARTS", 2)
    fit_risk_model(training(spark, 500), trees=2, rows_per_class=40)
    assert seen == [(80, 8)]


def test_a_fit_sees_all_rows_however_many_they_are(spark, monkeypatch):
    n, seen = (1 << 20) + 5000, []
    number = F.col("id").cast("double")
    risk = F.when(F.col("id") % 1000 == 0, HIGH_RISK).otherwise(LOW_RISK)
    rows = spark.range(n).select(*[F.lit(1.0).alias(c) for c in FEATURES[1:]], number.alias(FEATURES[0]), risk.alias(LABEL))
    monkeypatch.setattr(fitting, "spread", lambda sample, parts: seen.append(sample.agg(F.count("*"), F.sum(WEIGHT)).first()) or spread(sample, parts))
    fit_risk_model(rows, trees=1)
    assert [tuple(r) for r in seen] == [(n, float(n))]


def test_held_out_labels_that_no_training_row_has_are_counted(spark):
    rows = training(spark, 200)
    odd = rows.withColumn(LABEL, F.when(F.col("Patient ID") < 20, F.concat(F.lit("rare "), "Patient ID")).otherwise(F.col(LABEL)))
    model, predictions = train_and_test(odd, ["Patient ID"], trees=2)
    lacking = unseen_counts(odd, model, ["Patient ID"])
    _, test = hash_split(complete_rows(odd), ["Patient ID"])
    assert lacking.count() > 0 and lacking.agg(F.sum("n")).first()[0] + predictions.count() == test.count()


def test_the_model_does_not_depend_on_the_cluster(spark, tmp_path):
    rows = complete_rows(training(spark, 300))
    rows.write.parquet(str(tmp_path / "rows"))
    given, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for tasks, source in (("2", rows), ("9", spark.read.parquet(str(tmp_path / "rows")).repartition(7))):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        model = fit_risk_model(source, trees=10)
        found.append(sorted((r[0], tuple(r.probability)) for r in model.transform(rows).select("Patient ID", "probability").collect()))
    spark.conf.set("spark.sql.shuffle.partitions", given)
    assert found[0] == found[1]
