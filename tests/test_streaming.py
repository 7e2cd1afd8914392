import datetime as dt
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from pulsegrid import session
from pulsegrid.catalog import QUERIES
from pulsegrid.operators.clinical import first_per_case
from pulsegrid.operators import rollup
from pulsegrid.operators.enrich import enrich
from pulsegrid.operators.messages import decode
from pulsegrid.operators.monitor import sliding_means, trend, with_event_time
from pulsegrid.plans import dashboard
from pulsegrid.plans.scoring import score
from pulsegrid.plans.training import fit_risk_model
from pulsegrid.schemas import CLINICAL_SCHEMA, ENVELOPE_SCHEMA, MESSAGE_COLUMNS, VITALS
from pulsegrid.sources.topics import read_topic
from pulsegrid.streaming import arrivals, commits, delivery, monitor, replay, scoring, watch

from .test_messages import GOOD
from .test_training import training

NOW = {"availableNow": True}
BASE = "2025-02-11 10:00:00.123987"
START = dt.datetime(2025, 2, 11, 10, 0, 0, 123000)


def message(case, second, **values):
    stamp = (START + dt.timedelta(seconds=second)).isoformat(timespec="milliseconds") + "Z"
    return json.dumps({**GOOD, "caseid": case, "timestamp": stamp, **values})


def publish(spark, path, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "value string").select(F.col("value").cast("binary"))
    rows.coalesce(1).write.mode("append").parquet(path)


@pytest.fixture
def topic(spark, tmp_path):
    path = str(tmp_path / "topic")

    def send(*texts):
        publish(spark, path, texts)
        return read_topic(spark, "parquet", path=path)

    return send


@pytest.fixture(scope="module")
def model(spark):
    return fit_risk_model(training(spark, 200), trees=5)


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, topic, model, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    first = [message(str(c), s, **{"Heart Rate": 70 + 60 * (c % 2)}) for c in range(4) for s in range(0, 20, 2)]
    second = [message("9", s) for s in range(0, 10, 2)] + ["not json"]
    for texts in (first, second):
        scoring.start_scoring(topic(*texts), model, "parquet", progress, path=out, trigger=NOW).awaitTermination()
    rows = spark.createDataFrame([(t,) for t in first + second], "value string")
    want = score(decode(rows), model)
    got = spark.read.parquet(out)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.count() == 45 and got.select("Risk Predicted").distinct().count() == 2


def test_quarantine_stream(spark, topic, tmp_path):
    stream = topic(message("1", 0), "not json", message("2", 0, Height=0))
    scoring.start_quarantine(stream, str(tmp_path / "q"), str(tmp_path / "p"), trigger=NOW).awaitTermination()
    got = {r.reason: r._corrupt_record for r in spark.read.parquet(str(tmp_path / "q")).collect()}
    assert got == {"undecodable": "not json", "missing: Derived_BMI": None}


def test_scoring_stream_has_no_shuffle(spark, topic, model):
    plan = score(decode(topic(message("1", 0))), model)._jdf.queryExecution().logical().toString()
    assert "Aggregate" not in plan and "Join" not in plan and "Repartition" not in plan


def test_repeats_are_dropped(spark, topic, tmp_path):
    topic(message("1", 0), message("1", 2))
    stream = topic(message("1", 0), message("1", 0), message("2", 0))
    once = arrivals.drop_repeats(arrivals.decoded_with_time(stream), "1 hour").select("caseid", "timestamp")
    delivery.start_append(once, "parquet", str(tmp_path / "p"), path=str(tmp_path / "o"), trigger=NOW).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).groupBy("caseid").count().orderBy("caseid").collect() == [("1", 2), ("2", 1)]


def test_clinical_rows_join_a_stream(spark, topic, tmp_path):
    clinical = spark.createDataFrame([("1", "40", "M", "170", "80"), ("1", "39", "M", "170", "80")], CLINICAL_SCHEMA)
    rows = arrivals.attach_clinical(decode(topic(message("1", 0), message("2", 0))).select("caseid"), first_per_case(clinical))
    delivery.start_append(rows, "parquet", str(tmp_path / "p"), path=str(tmp_path / "o"), trigger=NOW).awaitTermination()
    assert [(r.caseid, r.age) for r in spark.read.parquet(str(tmp_path / "o")).collect()] == [("1", "39")]


@pytest.fixture
def many_shuffle_parts(spark):
    name = "spark.sql.shuffle.partitions"
    given = spark.conf.get(name)
    spark.conf.set(name, "64")
    yield lambda: spark.conf.get(name)
    spark.conf.set(name, given)


def state_parts_in(progress):
    return len([n for n in os.listdir(f"{progress}/state/0") if n.isdigit()])


def test_state_of_dropped_repeats_is_dealt_by_cores_not_by_shuffles(spark, many_shuffle_parts, topic, tmp_path):
    out, progress = str(tmp_path / "o"), str(tmp_path / "p")
    for second in (0, 2):
        stream = topic(*[message(str(c), s) for c in range(40) for s in (second, second)])
        once = arrivals.drop_repeats(arrivals.decoded_with_time(stream), "1 hour").select("caseid", "timestamp")
        delivery.start_append(once, "parquet", progress, path=out, trigger=NOW, stateful=True).awaitTermination()
    assert delivery.state_parts(spark) == state_parts_in(progress) == 24 and many_shuffle_parts() == "64"
    rows = spark.read.parquet(out)
    assert rows.count() == rows.distinct().count() == 80


def updates_over_two_batches(spark, windows, tmp_path):
    """(windows of a stream with a restart, the same rows as a batch, the folder of its progress)."""
    path, out, progress = (str(tmp_path / n) for n in ("topic", "out", "progress"))
    texts = [message(str(c), s, **{"Heart Rate": 60 + s % 50}) for s in range(0, 240, 2) for c in range(4)]
    for part in range(2):
        publish(spark, path, texts[part::2])
        rows = with_event_time(enrich(decode(read_topic(spark, "parquet", path=path))))
        monitor.start_updates(windows(rows), out, progress, NOW).awaitTermination()
    batch = with_event_time(enrich(decode(spark.createDataFrame([(t,) for t in texts], "value string"))))
    return monitor.latest_updates(spark, out, ["caseid", "window_start", "vital"]), batch, progress


def test_state_of_the_gauge_is_dealt_by_cores_not_by_shuffles(spark, many_shuffle_parts, tmp_path):
    got, batch, progress = updates_over_two_batches(
        spark, lambda rows: monitor.gauge_stream(rows, "2 minutes", "1 minute", "1 hour"), tmp_path)
    want = sliding_means(batch, "2 minutes", "1 minute")
    assert state_parts_in(progress) == 24 and many_shuffle_parts() == "64"
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_state_of_the_trend_is_dealt_by_cores_not_by_shuffles(spark, many_shuffle_parts, tmp_path):
    got, batch, progress = updates_over_two_batches(spark, lambda rows: monitor.trend_stream(rows, "1 minute", "1 hour"), tmp_path)
    want = trend(batch, "1 minute")
    assert state_parts_in(progress) == 24 and many_shuffle_parts() == "64"
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_trend_stream_over_several_batches_equals_batch(spark, tmp_path):
    path, out, progress = (str(tmp_path / n) for n in ("topic", "out", "progress"))
    texts = [message(str(c), s, **{"Heart Rate": 60 + s % 50}) for s in range(0, 240, 2) for c in range(2)]
    for part in range(4):
        publish(spark, path, texts[part::4])
        rows = with_event_time(enrich(decode(read_topic(spark, "parquet", path=path))))
        monitor.start_updates(monitor.trend_stream(rows, "1 minute", "1 hour"), out, progress, NOW).awaitTermination()
    keys = ["caseid", "window_start", "vital"]
    got = monitor.latest_updates(spark, out, keys)
    batch = with_event_time(enrich(decode(spark.createDataFrame([(t,) for t in texts], "value string"))))
    want = trend(batch, "1 minute")
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_late_rows_stay_out_of_closed_windows_and_are_counted(spark, tmp_path):
    path, out, progress = (str(tmp_path / n) for n in ("topic", "out", "progress"))
    listener = monitor.DroppedRows()
    spark.streams.addListener(listener)
    try:
        for texts in ([message("1", 0)], [message("1", 7200)], [message("1", 1)]):
            publish(spark, path, texts)
            rows = with_event_time(enrich(decode(read_topic(spark, "parquet", path=path))))
            stream = monitor.gauge_stream(rows, "1 minute", "1 minute", "10 minutes")
            query = monitor.start_updates(stream, out, progress, NOW)
            query.awaitTermination()
        deadline = time.time() + 20
        while time.time() < deadline and not listener.dropped.get(str(query.id)):
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    updates = commits.read_committed(spark, out)
    assert updates.where("vital = 'Heart Rate'").count() == 2 and listener.dropped[str(query.id)] > 0


def test_a_new_checkpoint_keeps_what_another_run_wrote(spark, topic, tmp_path):
    out = str(tmp_path / "out")
    for run in range(2):
        stream = topic(*[message(str(run), s) for s in range(0, 10, 2)])
        for _ in range(2):
            sink = commits.Committed(out)
            delivery.start_foreach_batch(stream, sink, str(tmp_path / f"p{run}"), trigger=NOW).awaitTermination()
    log = commits.commits(spark, out)
    assert log.count() == 2 and log.select("run").distinct().count() == 2
    assert commits.read_committed(spark, out).count() == 5 + 10


def test_a_failed_attempt_is_not_read_and_a_committed_batch_not_written_again(spark, tmp_path, monkeypatch):
    rows, out = spark.range(10), str(tmp_path / "out")
    sink = commits.Committed(out, run="a")
    monkeypatch.setattr(sink, "note", lambda *a: (_ for _ in ()).throw(IOError("log away")))
    with pytest.raises(IOError):
        sink(rows, 0)
    assert commits.commits(spark, out).count() == 0
    for _ in range(2):
        commits.Committed(out, run="a")(rows, 0)
    commits.Committed(out, run="b")(rows, 0)
    assert spark.read.parquet(out).count() == 30
    assert commits.read_committed(spark, out).count() == 20 and commits.read_committed(spark, out, rows.schema).count() == 20
    before = sorted(commits.commits(spark, out).collect())
    assert commits.compact_log(spark, out, 3) == 0 and commits.compact_log(spark, out, 2) == 2
    assert sorted(commits.commits(spark, out).collect()) == before and commits.read_committed(spark, out).count() == 20
    assert len(list((tmp_path / "out" / commits.LOG).glob("part-*"))) == 1


def test_only_folders_in_the_log_are_opened(spark, tmp_path):
    out, sink = str(tmp_path / "out"), commits.Committed(str(tmp_path / "out"), run="a")
    for batch in range(4):
        sink(spark.range(5).withColumn("b", F.lit(batch)), batch)
    log = commits.commits(spark, out)
    rows = commits.read_committed(spark, out, log=log.where("batch = 2"))
    assert {r.b for r in rows.collect()} == {2}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_batch_begun_in_parts_is_not_written_whole(spark, tmp_path):
    sink = commits.Committed(str(tmp_path / "out"), run="a")
    sink(spark.range(5), 0, "2-1")
    for part in ("", "1-1"):
        with pytest.raises(ValueError):
            sink(spark.range(5), 0, part)
    for part in ("1-0", "2-3", "2-1"):
        sink(spark.range(5), 0, part)
    assert commits.read_committed(spark, str(tmp_path / "out")).count() == 15


def test_of_a_document_that_two_runs_wrote_the_later_one_counts(spark, tmp_path):
    out = str(tmp_path / "out")
    for value, run in (("old", "b"), ("new", "a")):
        rows = spark.createDataFrame([("1|t", value)] + ([("2|t", "old")] if run == "b" else []), "document_id string, value string")
        commits.Committed(out, run=run)(rows, 0)
        time.sleep(0.01)
    once = commits.one_per_document(commits.read_committed(spark, out), commits.commits(spark, out))
    assert {(r.document_id, r.value) for r in once.collect()} == {("1|t", "new"), ("2|t", "old")}


def test_bounded_retry_then_dead_letters(spark, topic, tmp_path):
    calls, dead, out = [], str(tmp_path / "dead"), str(tmp_path / "out")
    sink = commits.Committed(out)

    def flaky(rows, batch_id, part):
        calls.append(part)
        if len(calls) < 3:
            raise ConnectionError("broker away")
        sink(rows, batch_id, part)

    stream = topic(message("1", 0), message("2", 0))
    run = delivery.deliver(flaky, dead, pause_seconds=0)
    delivery.start_foreach_batch(stream, run, str(tmp_path / "p1"), trigger=NOW).awaitTermination()
    assert calls == ["", "", ""] and commits.read_committed(spark, out).count() == 2

    def broken(rows, batch_id, part):
        calls.append(part)
        raise ConnectionError("broker away")

    for n, most in ((1, delivery.MOST_FAILURES), (2, 1)):
        calls.clear()
        run = delivery.deliver(broken, dead, pause_seconds=0, most_failures=most)
        delivery.start_foreach_batch(stream, run, str(tmp_path / f"p{n + 1}"), trigger=NOW).awaitTermination()
        letters = commits.read_committed(spark, dead)
        assert calls[:5] == [""] * 5 and letters.count() == 2 * n
        assert {r.reason for r in letters.collect()} == {"ConnectionError: broker away"}


def test_bad_records_are_found_and_sent_again_later(spark, topic, tmp_path):
    dead, out = str(tmp_path / "dead"), str(tmp_path / "out")
    texts = [message(str(c), s) for c in range(20) for s in range(0, 10, 2)]
    bad = {texts[7], texts[55]}

    def refuses(sink, bad_ones):
        def write(rows, batch_id, part):
            if rows.where(F.col("value").cast("string").isin(list(bad_ones))).count():
                raise ValueError("bad record")
            sink(rows, batch_id, part)
        return write

    run = delivery.deliver(refuses(commits.Committed(out), bad), dead, tries=2, pause_seconds=0)
    delivery.start_foreach_batch(topic(*texts), run, str(tmp_path / "p"), trigger=NOW).awaitTermination()
    letters = commits.read_committed(spark, dead)
    assert {r.value.decode() for r in letters.collect()} == bad and commits.read_committed(spark, out).count() == 98
    again = refuses(commits.Committed(out, run="again"), {texts[55]})
    assert delivery.redeliver(spark, dead, again, tries=1) == (2, 1)
    assert commits.read_committed(spark, out).count() == 99
    assert delivery.redeliver(spark, dead, refuses(commits.Committed(out, run="again"), set()), tries=1) == (1, 0)
    assert delivery.redeliver(spark, dead, again, tries=1) == (0, 0)
    assert sorted(r.value.decode() for r in commits.read_committed(spark, out).collect()) == sorted(texts)


def refusing(bad, sent, calls):
    """A sink that takes a piece into ``sent`` as a whole, or not at all if it holds a bad record."""
    def write(rows, batch_id, part):
        values = [r.value.decode() for r in rows.collect()]
        calls.append(part)
        if set(values) & bad:
            raise ValueError("bad record")
        sent.extend(values)
    return write


def test_all_failing_records_are_found_however_many_they_are(spark, topic, tmp_path):
    texts = [message(str(c), s) for c in range(20) for s in range(0, 20, 2)]
    bad, sent, calls, dead = set(texts[::2]), [], [], str(tmp_path / "dead")
    run = delivery.deliver(refusing(bad, sent, calls), dead, tries=1)
    delivery.start_foreach_batch(topic(*texts), run, str(tmp_path / "p"), trigger=NOW).awaitTermination()
    letters = commits.read_committed(spark, dead)
    assert sorted(r.value.decode() for r in letters.collect()) == sorted(bad)
    assert sorted(sent) == sorted(set(texts) - bad)
    assert commits.commits(spark, dead).count() == len(bad)


def test_a_sink_that_is_away_sets_no_record_aside(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(delivery, "PROBE_EVERY", 10)
    texts = [message(str(c), s) for c in range(4) for s in range(0, 16, 2)]
    stream, sent, dead = topic(*texts), [], str(tmp_path / "dead")

    def away(rows, batch_id, part):
        raise ConnectionError("broker away")

    def job(write):
        return delivery.start_foreach_batch(stream, delivery.deliver(write, dead, tries=1), str(tmp_path / "p"), trigger=NOW)

    with pytest.raises(Exception, match="a write of no rows: ConnectionError: broker away"):
        job(away).awaitTermination()
    assert commits.commits(spark, dead).count() == 0
    job(refusing(set(texts), sent, [])).awaitTermination()
    assert sent == [] and sorted(r.value.decode() for r in commits.read_committed(spark, dead).collect()) == sorted(texts)


def test_a_write_of_no_rows_hinders_no_piece(spark, tmp_path):
    sink = commits.Committed(str(tmp_path / "out"), run="a")
    sink(spark.range(5).limit(0), 0, "none-1f")
    for part in ("1-0", "3-5"):
        sink(spark.range(5), 0, part)
    assert commits.read_committed(spark, str(tmp_path / "out"), spark.range(5).schema).count() == 10


def test_a_piece_inside_a_written_one_is_not_written_again(spark, tmp_path):
    sink = commits.Committed(str(tmp_path / "out"), run="a")
    sink(spark.range(5), 0, "2-1")
    for part in ("3-1", "3-5", "40-" + str(2 ** 39 + 1)):
        sink(spark.range(5), 0, part)
    sink(spark.range(5), 0, "3-3")
    sink(spark.range(5), 1)
    commits.Committed(str(tmp_path / "out"), run="a")(spark.range(5), 1, "1-0")
    assert commits.read_committed(spark, str(tmp_path / "out")).count() == 15


def dead_letters_of(spark, topic, tmp_path, texts):
    """A folder of dead letters, each of the texts a commit of its own, and others that were sent."""
    dead = str(tmp_path / "dead")
    run = delivery.deliver(refusing(set(texts), [], []), dead, tries=1)
    others = [message("99", s) for s in range(0, 20, 2)]
    delivery.start_foreach_batch(topic(*texts, *others), run, str(tmp_path / "p"), trigger=NOW).awaitTermination()
    return dead


def test_dead_letters_are_sent_again_in_one_write(spark, topic, tmp_path):
    texts, sent, calls = [message(str(c), 0) for c in range(6)], [], []
    dead = dead_letters_of(spark, topic, tmp_path, texts)
    assert commits.commits(spark, dead).count() == 6
    assert delivery.redeliver(spark, dead, refusing(set(), sent, calls)) == (6, 0)
    assert calls == [""] and sorted(sent) == sorted(texts)


def test_a_redelivery_that_ends_early_goes_on_without_a_row_twice(spark, topic, tmp_path, monkeypatch):
    texts, out = [message(str(c), 0) for c in range(3)], str(tmp_path / "out")
    dead = dead_letters_of(spark, topic, tmp_path, texts)
    note_all = commits.Committed.note_all

    def log_away(self, spark, entries):
        if self.path.endswith("_redelivered") and entries[0][1] != delivery.BEGUN:
            raise IOError("log away")
        note_all(self, spark, entries)

    with monkeypatch.context() as patch:
        patch.setattr(commits.Committed, "note_all", log_away)
        with pytest.raises(IOError):
            delivery.redeliver(spark, dead, commits.Committed(out, run="again"))
    assert delivery.redeliver(spark, dead, commits.Committed(out, run="again")) == (3, 0)
    assert sorted(r.value.decode() for r in commits.read_committed(spark, out).collect()) == sorted(texts)


def test_a_piece_of_a_batch_is_read_from_its_folders(spark):
    rows = spark.range(20000)
    with delivery.in_pieces(rows, delivery.code_of("id")) as pieces:
        assert pieces.bits == 3
        for depth, number in ((0, 0), (2, 3), (3, 5), (10, 77)):
            want = rows.where(F.pmod(F.xxhash64("id"), F.lit(2 ** depth)) == number)
            assert sorted(pieces.rows(depth, number).collect()) == sorted(want.collect())
        low = {r.code % 2 ** 64 for r in want.select(F.xxhash64("id").alias("code")).collect()}
        assert pieces.codes(0, 0) is None and pieces.codes(10, 77) == sorted(low)
        plan = pieces.rows(10, 77)._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*delivery_folder#\d+ = 101", plan)


def test_one_failing_record_of_many_takes_few_writes(spark, tmp_path):
    rows, calls, lost = spark.range(20000), [], []

    def write(some, batch_id, part):
        calls.append(part)
        if some.where("id = 4321").count():
            raise ValueError("bad record")

    with delivery.in_pieces(rows, delivery.code_of("id")) as pieces:
        lost = delivery.failing_records(write, pieces, 0, "bad", 1, 0)
        assert [r.id for p in lost for r in pieces.rows(p.depth, p.number).collect()] == [4321]
    assert len(calls) <= 2 * 16 and len(set(calls)) == len(calls)


def test_the_live_monitor_keeps_or_sets_aside_every_row(spark, tmp_path):
    path, out, progress = (str(tmp_path / n) for n in ("topic", "out", "progress"))
    clinical = spark.createDataFrame([("1", "40", "M", "170", "80")], CLINICAL_SCHEMA)
    sends = [[message("1", 0), message("1", 2), message("7", 0)], [message("1", 7200), message("1", 7200), "not json"],
             [message("1", 4), message("1", 7000), message("1", 2, timestamp="noon")], [message("1", 7202)]]
    for texts in sends:
        publish(spark, path, texts)
        for query in watch.watch(read_topic(spark, "parquet", path=path), out, progress, 600, clinical=clinical, trigger=NOW):
            assert query.exception() is None
    aside = commits.read_committed(spark, f"{out}/{watch.ASIDE}")
    assert sorted(r.reason for r in aside.collect()) == ["behind the watermark", "no clinical row", "undecodable", "unreadable timestamp"]
    kept = spark.read.schema(watch.ROW_SCHEMA).parquet(f"{out}/{watch.ONCE}")
    stamps = sorted((r.event_ts - kept.agg(F.min("event_ts")).first()[0]).total_seconds() for r in kept.collect())
    assert stamps == [0, 2, 7000, 7200, 7202] and {r.Age for r in kept.collect()} == {40.0}
    trend_rows = monitor.latest_updates(spark, f"{out}/{watch.TREND}", ["caseid", "window_start", "vital"])
    assert trend_rows.where("vital = 'Heart Rate'").agg(F.sum("n")).first()[0] == 5


def test_the_clinical_table_is_computed_once_for_all_batches(spark, topic, tmp_path):
    met = spark.sparkContext.accumulator(0)

    def count(case):
        met.add(1)
        return case

    one = spark.createDataFrame([("1", "40", "M", "170", "80")], CLINICAL_SCHEMA).coalesce(1)
    clinical = one.withColumn("caseid", F.udf(count, "string").asNondeterministic()("caseid"))
    for second in (0, 2, 4):
        topic(message("1", second))
    stream = read_topic(spark, "parquet", {"maxFilesPerTrigger": 1}, str(tmp_path / "topic"))
    query = watch.start_front(stream, str(tmp_path / "out"), 600, str(tmp_path / "p"), clinical, NOW)
    query.awaitTermination()
    assert len(query.recentProgress) >= 3 and 1 <= met.value <= 2
    assert commits.read_committed(spark, str(tmp_path / "out" / watch.ON_TIME)).count() == 3


def test_the_scoring_job_reads_a_batch_once_and_leaves_no_copy(spark, topic, model, tmp_path):
    made, at = list(session._made), {n: str(tmp_path / n) for n in ("scored", "aside", "dead", "p")}
    stream = topic(message("1", 0), message("1", 2), message("1", 4, **{"Heart Rate": "none"}), "not json")
    query = scoring.start_scoring_job(stream, model, commits.Committed(at["scored"]), at["aside"], at["dead"], at["p"], NOW)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 4
    assert session._made == made and not [n for n in os.listdir(session.shared_dir(spark)) if n.startswith("batch-")]
    assert commits.read_committed(spark, at["scored"]).count() == 2
    reasons = commits.read_committed(spark, at["aside"]).select("reason").collect()
    assert sorted(r.reason for r in reasons) == ["missing: Heart Rate", "undecodable"]


def test_the_front_reads_a_batch_once_and_leaves_no_copy(spark, topic, tmp_path):
    made = list(session._made)
    stream = topic(message("1", 0), message("1", 2), message("1", 4), "not json")
    query = watch.start_front(stream, str(tmp_path / "out"), 600, str(tmp_path / "p"), trigger=NOW)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 4
    assert session._made == made and not [n for n in os.listdir(session.shared_dir(spark)) if n.startswith("front-")]
    kept, aside = (commits.read_committed(spark, str(tmp_path / "out" / n)).count() for n in (watch.ON_TIME, watch.ASIDE))
    assert (kept, aside) == (3, 1)


def test_the_high_water_mark_goes_on_after_a_restart():
    known = {(0, ""): {"high": 5}, (1, ""): {"high": None}, (2, ""): {"high": 9}}
    assert watch.high_water(known, 2) == 5 and watch.high_water(known, 3) == 9 and watch.high_water({}, 0) is None


def test_a_refresh_opens_only_dates_with_new_documents(spark, tmp_path):
    scored, out = str(tmp_path / "scored"), str(tmp_path / "out")

    def documents(first, n, level, case="1"):
        day = F.timestamp_seconds(F.col("id") * 43200 + 60)
        rows = spark.range(first, n).select(F.lit(case).alias("caseid"), day.alias("event_ts"), F.lit("Low Risk").alias("Risk Predicted"),
                                            *[F.lit(level).cast("float").alias(c) for c in VITALS])
        return rows.withColumn("document_id", F.concat_ws("|", "caseid", F.col("event_ts").cast("string")))

    commits.Committed(scored, run="a", by_date=True)(documents(0, 8, 70.0).unionByName(documents(0, 2, 50.0, "2")), 0)
    assert len(dashboard.refresh(spark, scored, out, reach_seconds=86400)) == 4
    assert dashboard.refresh(spark, scored, out, reach_seconds=86400) == []
    written = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "out" / "rollup").rglob("*.parquet")}
    commits.Committed(scored, run="b", by_date=True)(documents(6, 10, 90.0), 0)  # two of the last day again, two new ones
    new = dashboard.new_commits(spark, scored, out)
    assert {r.run for r in new.collect()} == {"r-b"}
    dates = dashboard.refresh(spark, scored, out, reach_seconds=86400)
    assert [str(d) for d in dates] == ["1970-01-04", "1970-01-05"]
    plan = dashboard.documents_of(spark, scored, dates)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*event_date#\d+ IN \(1970-01-04,1970-01-05\)", plan)
    kept = {f for f in written if "event_date=1970-01-04" not in f}
    assert kept and all((tmp_path / f).stat().st_mtime_ns == written[f] for f in kept)
    rates = spark.read.parquet(f"{out}/trend").where("vital = 'Heart Rate' AND caseid = '1'").orderBy("window_start").collect()
    assert [(r["mean"], r.n) for r in rates] == [(70.0, 1)] * 6 + [(90.0, 1)] * 4
    gauge = spark.read.parquet(f"{out}/gauge").where("vital = 'Heart Rate'")
    assert {(r.caseid, r["mean"], r.band) for r in gauge.collect()} == {("1", 90.0, "green"), ("2", 50.0, "yellow")}
    near = dashboard.gauges(spark, spark.read.parquet(f"{out}/rollup"), dates, out, 86400)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in near.split("\n") if "FileScan" in line and "grain" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^]]*event_date#\d+ (>=|IN)", line) for line in scans)
    assert {(r.caseid, r.n, r.share) for r in spark.read.parquet(f"{out}/risk_share").collect()} == {("1", 10, 1.0), ("2", 2, 1.0)}


def test_a_rollup_of_dealt_rows_is_not_shuffled_again_and_gauges_read_the_last_days(spark, tmp_path):
    texts = [message(str(c), day * 86400 + s) for c in range(3) for day in range(12) for s in range(0, 60, 20)]
    rows = with_event_time(enrich(decode(spark.createDataFrame([(t,) for t in texts], "value string"))))
    dated = rows.withColumn("event_date", F.to_date("event_ts"))
    dealt = rollup.vital_rollup(dashboard._dealt(dated), 60, dealt=dashboard.DEALT)
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    plain = rollup.vital_rollup(rows, 60)
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
    trend_rows = rollup.trend_of(dashboard._dealt(plain), "1 day", dashboard.DEALT)
    assert trend_rows._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # one is that of ``plain``
    assert sorted(map(tuple, trend_rows.drop("event_date").collect())) == sorted(map(tuple, rollup.trend_of(plain, "1 day").collect()))

    path = str(tmp_path / "rollup")
    plain.write.partitionBy("event_date").parquet(path)
    stored = spark.read.parquet(path)
    dates = sorted(r.event_date for r in stored.select("event_date").distinct().collect())
    gauge = dashboard.gauges(spark, stored, dates, str(tmp_path), 3600)
    assert f">= {max(dates) - dt.timedelta(days=1)}" in gauge._jdf.queryExecution().optimizedPlan().toString()
    want = rollup.gauge_of(plain, 3600)
    assert sorted(map(tuple, gauge.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_replay_sets_aside_what_has_no_tick(spark, tmp_path):
    rows = spark.createDataFrame([(b"1", b"v", "2025-02-11T10:00:02Z"), (b"1", b"v", "soon"), (b"1", b"v", "2025-02-11T09:00:00Z")],
                                 "key binary, value binary, timestamp string")
    table, unsent = str(tmp_path / "t"), str(tmp_path / "u")
    with pytest.raises(ValueError):
        replay.write_replay_table(rows, table, "2025-02-11 10:00:00")
    replay.write_replay_table(rows, table, "2025-02-11 10:00:00", unsent=unsent)
    assert spark.read.parquet(table).count() == 1
    assert {r.reason for r in spark.read.parquet(unsent).collect()} == {"unreadable timestamp", "before the first tick"}


def test_replay_sends_one_record_per_case_and_tick_in_order(spark, tmp_path):
    table = str(tmp_path / "replay")
    decoded = decode(spark.createDataFrame([(message(str(c), 2 * i),) for i in range(6) for c in range(3)], "value string"))
    replay.write_replay_table(decoded.select(F.col("caseid").alias("key"), *MESSAGE_COLUMNS), table, BASE,
                              ticks_per_block=4)
    sent = []

    def send(rows, batch_id):
        sent.append(sorted((r.tick, r.caseid) for r in rows.collect()))

    def run_until(n):
        query = replay.start_replay(spark, table, send, str(tmp_path / "p"), pause_seconds=0, ticks_per_block=4)
        deadline = time.time() + 60
        while len(sent) < n and time.time() < deadline and query.isActive:
            time.sleep(0.05)
        query.stop()
        assert query.exception() is None

    run_until(2)
    run_until(6)
    ticks = [batch for batch in sent if batch]
    assert [t for t in range(6)] == sorted({t for batch in ticks for t, _ in batch})
    assert all([c for _, c in batch] == ["0", "1", "2"] for batch in ticks)
    order = [batch[0][0] for batch in ticks]
    assert order == sorted(order)


def test_a_clock_that_is_moved_by_hand(spark, tmp_path):
    table, clock, out = (str(tmp_path / n) for n in ("replay", "clock", "out"))
    decoded = decode(spark.createDataFrame([(message(str(c), 2 * i),) for i in range(6) for c in range(3)], "value string"))
    replay.write_replay_table(decoded.select(F.col("caseid").alias("key"), "caseid", "timestamp"), table, BASE, ticks_per_block=4)
    for first, last, total in ((0, 1, 6), (2, 4, 15), (5, 9, 18)):
        replay.move_clock(spark, clock, first, last)
        replay.start_replay(spark, table, commits.Committed(out), str(tmp_path / "p"), ticks_per_block=4,
                            clock=replay.file_clock(spark, clock), trigger=NOW).awaitTermination()
        rows = commits.read_committed(spark, out)
        assert rows.count() == total and rows.agg(F.max("tick")).first()[0] == min(last, 5)


def test_document_ids_name_a_record(spark):
    rows = decode(spark.createDataFrame([(message("1", 0),), (message("1", 0),), (message("1", 2),)], "value string"))
    assert delivery.document_id(rows).select("document_id").distinct().count() == 2


def test_topic_schema_is_the_envelope():
    assert ENVELOPE_SCHEMA.names[:3] == ["key", "value", "topic"]


def test_redelivery_leaves_the_shape_of_a_topic_alone(spark):
    names = list(ENVELOPE_SCHEMA.names)
    QUERIES["stream_bad_record"](spark, "/root/testdata/sf0.001")
    assert ENVELOPE_SCHEMA.names == names and "reason" not in names
