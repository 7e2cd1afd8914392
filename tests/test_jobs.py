"""The command line, from a training file to dashboard tables."""

import os
import types

import pytest

from pulsegrid.__main__ import main, parser
from pulsegrid.sources.files import write_training
from pulsegrid.streaming.monitor import latest_updates
from pulsegrid.schemas import TRACK_COLUMNS
from pulsegrid.session import LOCAL_STATE, job_dir, remove_made, stored

from .test_prepare import readings_of, reading
from .test_training import training


def test_all_jobs_in_turn(spark, tmp_path, monkeypatch, capsys):
    at = lambda name: str(tmp_path / name)
    monkeypatch.setenv("MODEL_PATH", at("model"))
    monkeypatch.setenv("PATIENT_IDS", "1,2")
    write_training(training(spark, 200), at("training"))
    levels = dict(zip(TRACK_COLUMNS, (70, 115, 75, 36.6, 14, 98)))
    rows = [reading(str(c), track, 2 * i, i, level + 65.0 * (c == 2 and track == "Solar8000/HR"))
            for c in (1, 2, 3) for i in range(40) for track, level in levels.items()]
    readings_of(spark, rows).write.parquet(at("readings"))
    (tmp_path / "cases.csv").write_text("caseid,age,sex,height,weight\n1,50,F,170,70\n2,50,F,170,70\n3,50,F,170,70\n")

    main(["train", at("training")])
    assert "weighted_precision" in capsys.readouterr().out
    main(["publish", at("readings"), at("cases.csv"), "--base", "2025-02-11 10:00:00", "--path", at("topic")])
    main(["score", "--topic-path", at("topic"), "--path", at("scored"), "--quarantine", at("aside"),
          "--checkpoint", at("progress"), "--once"])
    for _ in range(2):
        main(["monitor", at("scored"), at("dashboard")])
    assert "dates done again: 1\ndates done again: 0" in capsys.readouterr().out

    main(["watch", at("live"), "--topic-path", at("topic"), "--clinical", at("cases.csv"), "--delay-seconds", "3600", "--checkpoint",
          at("watching"), "--once"])
    assert "dropped behind a watermark: 0" in capsys.readouterr().out
    live = latest_updates(spark, at("live/trend"), ["caseid", "window_start", "vital"])
    assert live.where("vital = 'Heart Rate'").agg({"n": "sum"}).first()[0] == 40
    main(["redeliver", "--topic-path", at("topic"), "--path", at("scored"), "--quarantine", at("aside"), "--dead-letters", at("dead")])
    assert "dead letters handled: 0" in capsys.readouterr().out

    shares = {(r.caseid, r["Risk Predicted"]): (r.n, r.share) for r in spark.read.parquet(at("dashboard/risk_share")).collect()}
    assert shares == {("1", "Low Risk"): (20, 1.0), ("2", "High Risk"): (20, 1.0)}
    gauges = spark.read.parquet(at("dashboard/gauge")).where("vital = 'Heart Rate'").collect()
    assert {(r.caseid, r["mean"], r.band) for r in gauges} == {("1", 75.0, "green"), ("2", 140.0, "red")}
    assert spark.read.parquet(at("dashboard/trend")).where("vital = 'Heart Rate'").count() == 2


@pytest.mark.parametrize("job", ["train", "publish", "replay", "score", "redeliver", "watch", "monitor"])
def test_every_job_has_help(job, capsys):
    with pytest.raises(SystemExit) as stop:
        parser().parse_args([job, "--help"])
    assert stop.value.code == 0 and "usage" in capsys.readouterr().out


def test_intermediate_tables_go_with_the_job(spark):
    mine = stored(spark.range(3), "mine")
    path = mine.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(path) and mine.count() == 3
    remove_made(spark)
    assert not os.path.exists(path)


class Unset:
    """A session on a local master without ``spark.checkpoint.dir``."""

    conf = {}
    sparkContext = types.SimpleNamespace(master="local[2]", applicationId="x")


def test_what_jobs_keep_outlasts_a_local_session(spark, monkeypatch, tmp_path):
    monkeypatch.chdir(tmp_path)
    assert job_dir(spark, "score-dead", "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert job_dir(Unset, "score-dead", "x").startswith(f"{tmp_path}/{LOCAL_STATE}/score-dead-")
