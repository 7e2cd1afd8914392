import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyarrow.parquet import ParquetFile
from pyspark.sql import functions as F

from pulsegrid.operators.enrich import enrich
from pulsegrid.operators.messages import decode, encode
from pulsegrid.operators.monitor import with_event_time
from pulsegrid.operators.quarantine import quarantined, scorable
from pulsegrid.operators.routing import in_case_order, routed, union_inputs, unrouted
from pulsegrid.plans import publish as publishing
from pulsegrid.plans.publish import publish
from pulsegrid.streaming.commits import read_committed
from pulsegrid.schemas import FLOAT_COLUMNS, MESSAGE_COLUMNS

GOOD = {"caseid": "7", "Age": "77", "Gender": "M", "Height": 1.602, "Weight": "67.5", "Diastolic Blood Pressure": 61,
        "Systolic Blood Pressure": 118, "Heart Rate": 70, "Body Temperature": 36.2, "Respiratory Rate": 14,
        "Oxygen Saturation": 98, "timestamp": "2025-02-11T10:00:06.123Z"}


def envelope(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    return spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast("binary"))


def changed(**values):
    return {**GOOD, **values}


def test_decode_and_enrich(spark):
    row = enrich(decode(envelope(spark, changed(extra="ignored")))).first()
    assert (row.Derived_Pulse_Pressure, round(row.Derived_BMI, 4), row.Derived_MAP) == (57.0, 26.3, 80.0)
    assert row["timestamp"] == GOOD["timestamp"] and "extra" not in row.asDict()
    types = dict(enrich(decode(envelope(spark, GOOD))).dtypes)
    assert {types[c] for c in FLOAT_COLUMNS} == {"float"}


def test_what_cannot_be_scored_is_set_aside(spark):
    lacking = {k: v for k, v in GOOD.items() if k != "Heart Rate"}
    rows = enrich(decode(envelope(spark, GOOD, changed(Height=0), changed(**{"Diastolic Blood Pressure": "x"}), "not json",
                                  lacking)))
    assert scorable(rows).count() == 1
    assert sorted(r.reason for r in quarantined(rows).collect()) == [
        "missing: Derived_BMI", "missing: Diastolic Blood Pressure", "missing: Heart Rate", "undecodable"]


def test_every_row_is_scored_or_set_aside(spark):
    none = spark.createDataFrame([(None,)], "value binary")
    rows = enrich(decode(envelope(spark, GOOD, "[]", "{}", "", changed(Age="NaN"), changed(Age=None)).union(none)))
    assert scorable(rows).count() + quarantined(rows).count() == 7
    assert scorable(rows).count() == 1


def test_a_message_is_parsed_once(spark):
    for rows in (scorable, quarantined):
        plan = rows(enrich(decode(envelope(spark, GOOD))))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 300), st.integers(1, 300)), min_size=1, max_size=20))
def test_relations_between_pressures(spark, pairs):
    bodies = [changed(**{"Systolic Blood Pressure": s, "Diastolic Blood Pressure": d}) for s, d in pairs]
    for r in enrich(decode(envelope(spark, *bodies))).collect():
        high, low = r["Systolic Blood Pressure"], r["Diastolic Blood Pressure"]
        assert r.Derived_Pulse_Pressure == high - low
        assert min(high, low) - 0.01 <= r.Derived_MAP <= max(high, low) + 0.01


def test_encode_keeps_all_fields(spark):
    rows = decode(envelope(spark, changed(Weight=None)))
    message = encode(rows).first()
    assert list(json.loads(bytes(message.value))) == MESSAGE_COLUMNS and bytes(message.key) == b"7"
    assert json.loads(bytes(message.value))["Weight"] is None


def test_routes(spark):
    rows = encode(decode(envelope(spark, GOOD)))
    other = encode(decode(envelope(spark, GOOD)), tag="other.tag")
    both = union_inputs(rows, other)
    assert [r.topic for r in routed(both, {"patient.vitals": "ward"}).collect()] == ["ward"]
    assert [r.tag for r in unrouted(both).collect()] == ["other.tag"]


@pytest.mark.parametrize("parts", [1, 3])
def test_time_order_inside_a_case(spark, parts):
    rows = spark.range(300).select(
        F.concat(F.lit("c"), F.col("id") % 3).cast("binary").alias("key"),
        F.format_string("%05d", (F.col("id") * 7919) % 300).alias("timestamp")).repartition(parts)
    seen = {}
    for row in in_case_order(rows).withColumn("p", F.spark_partition_id()).collect():
        seen.setdefault(bytes(row.key), []).append(row.timestamp)
    assert all(times == sorted(times) and len(times) == 100 for times in seen.values())


def test_blocks_of_time_are_published_in_turn(spark, tmp_path):
    rows = spark.range(200).select(
        (F.col("id") % 5).cast("string").alias("caseid"), *[F.lit("1").alias(c) for c in MESSAGE_COLUMNS[1:-1]],
        F.date_format(F.timestamp_seconds(F.col("id") * 60), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"))
    path, aside = str(tmp_path / "topic"), str(tmp_path / "aside")
    odd = rows.limit(3).withColumn("timestamp", F.lit("soon"))
    with pytest.raises(ValueError):
        publish(rows.unionByName(odd), "parquet", path=path)
    publish(rows.unionByName(odd), "parquet", path=path, aside=aside, block_seconds=3600)
    files = spark.read.parquet(path).select("timestamp", F.col("_metadata.file_modification_time").alias("written")).groupBy(
        F.floor(F.unix_seconds("timestamp") / 3600).alias("block")).agg(F.min("written").alias("a"), F.max("written").alias("b"))
    blocks = files.orderBy("block").collect()
    assert len(blocks) == 4 and all(x.b <= y.a for x, y in zip(blocks, blocks[1:]))
    assert [r.reason for r in read_committed(spark, aside).collect()] == ["unreadable timestamp"] * 3


def hourly(spark, n=200):
    return spark.range(n).select(
        (F.col("id") % 5).cast("string").alias("caseid"), *[F.lit("1").alias(c) for c in MESSAGE_COLUMNS[1:-1]],
        F.date_format(F.timestamp_seconds(F.col("id") * 60), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"))


def test_a_publish_that_stops_goes_on_behind_the_last_block(spark, tmp_path, monkeypatch):
    rows, path, progress = hourly(spark), str(tmp_path / "topic"), str(tmp_path / "progress")
    calls, real = [], publishing.write_topic

    def stops(messages, fmt, options, place, mode):
        calls.append(place)
        real(messages, fmt, options, place, mode)
        if len(calls) == 3:
            raise ConnectionError("away, though the block was written")

    monkeypatch.setattr(publishing, "write_topic", stops)
    with pytest.raises(RuntimeError, match="progress="):
        publish(rows, "parquet", path=path, progress=progress, tries=1)
    monkeypatch.setattr(publishing, "write_topic", lambda *a: (calls.append(a[3]), real(*a)))
    empty = rows.limit(0)  # messages are staged already
    assert publish(empty, "parquet", path=path, progress=progress) == (2, 2)
    assert publish(empty, "parquet", path=path, progress=progress) == (0, 4)
    assert len(calls) == 5 and calls[2] == calls[3]
    sent = decode(spark.read.parquet(path))
    assert sent.count() == 200 and sent.select("timestamp").distinct().count() == 200
    with pytest.raises(ValueError):
        publish(rows, "parquet", path=path, progress=progress, block_seconds=60)


def test_a_failing_write_is_tried_again(spark, tmp_path, monkeypatch):
    failures, real = [1, 1], publishing.write_topic

    def flaky(*args):
        if failures:
            failures.pop()
            raise ConnectionError("away")
        real(*args)

    monkeypatch.setattr(publishing, "write_topic", flaky)
    assert publish(hourly(spark), "parquet", path=str(tmp_path / "topic"), pause_seconds=0) == (4, 0)
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 200


def test_blocks_may_be_written_together(spark, tmp_path):
    path = str(tmp_path / "topic")
    assert publish(hourly(spark), "parquet", path=path, blocks_per_job=3) == (4, 0)
    assert spark.read.parquet(path).select("block").distinct().count() == 2 and spark.read.parquet(path).count() == 200
    publish(hourly(spark, 50), "parquet", path=path)
    assert spark.read.parquet(path).count() == 250


def test_staged_files_are_bounded(spark, tmp_path):
    progress = str(tmp_path / "progress")
    publish(hourly(spark).repartition(30), "parquet", path=str(tmp_path / "topic"), progress=progress)
    files = [f for f in (tmp_path / "progress").rglob("*.parquet") if "/messages/" in str(f)]
    assert 4 <= len(files) <= 4 * publishing.BLOCK_PARTS


def test_files_of_a_topic_follow_from_the_messages_not_the_cluster(spark, tmp_path, monkeypatch):
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as if a block were large
    try:
        publish(hourly(spark), "parquet", path=str(tmp_path / "topic"))
        monkeypatch.setattr(publishing, "FILE_MESSAGES", 20)
        publish(hourly(spark), "parquet", path=str(tmp_path / "small"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert len(list((tmp_path / "topic").rglob("*.parquet"))) == 4
    small = spark.read.parquet(str(tmp_path / "small"))
    assert 4 < len(small.inputFiles()) <= 3 * 3 + 1 and small.count() == 200


def test_a_file_of_a_topic_can_be_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publishing, "ROW_GROUP", {"parquet.block.size": 1 << 14})
    publish(hourly(spark, 20_000), "parquet", path=str(tmp_path / "topic"), block_seconds=10 ** 9)
    file, = (tmp_path / "topic").rglob("*.parquet")
    assert ParquetFile(file).num_row_groups > 1 and spark.read.parquet(str(tmp_path / "topic")).count() == 20_000


def test_numbers_that_are_not_finite_count_as_missing(spark):
    rows = enrich(decode(envelope(spark, changed(**{"Heart Rate": "NaN"}), changed(**{"Heart Rate": "Infinity"}), changed(**{"Heart Rate": "1e12"}))))
    assert [r.hr is None for r in rows.select(F.col("Heart Rate").alias("hr")).collect()] == [True, True, False]
