import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators.monitor import (DEFAULT_BANDS, colour_band, recent_means, risk_share, sliding_means, trend,
                                         with_bands, with_event_time)

START = dt.datetime(2025, 2, 11, 10, 0, 0)
ONE = ["Heart Rate"]


def rows_of(spark, rows):
    return spark.createDataFrame([(c, START + dt.timedelta(seconds=s), v) for c, s, v in rows],
                                 "caseid string, event_ts timestamp, `Heart Rate` double")


def test_recent_mean_equals_the_definition(spark):
    rnd = random.Random(4)
    rows = [(str(c), s, float(rnd.randint(40, 140))) for c in range(3) for s in rnd.sample(range(3000), 400)]
    got = {r.caseid: (r.latest, r["mean"]) for r in recent_means(rows_of(spark, rows), 300, ONE).collect()}
    for case in ("0", "1", "2"):
        own = [(s, v) for c, s, v in rows if c == case]
        last = max(s for s, _ in own)
        values = [v for s, v in own if s > last - 300]
        assert got[case][0] == START + dt.timedelta(seconds=last)
        assert got[case][1] == pytest.approx(sum(values) / len(values), abs=1e-9)


def test_recent_mean_excludes_the_far_edge(spark):
    got = recent_means(rows_of(spark, [("1", 0, 10.0), ("1", 1, 20.0), ("1", 300, 40.0)]), 300, ONE).first()
    assert got["mean"] == 30.0


def test_trend_shows_what_a_mean_hides(spark):
    rows = rows_of(spark, [("1", 0, 60.0), ("1", 30, 180.0), ("1", 59, 60.0), ("1", 60, None)])
    got = trend(rows, "1 minute", columns=ONE).collect()
    assert [(r.vital, r["mean"], r.low, r.high, r.n) for r in got] == [("Heart Rate", 100.0, 60.0, 180.0, 3)]


def test_sliding_windows_overlap(spark):
    rows = rows_of(spark, [("1", 0, 60.0), ("1", 60, 80.0)])
    got = sliding_means(rows, "2 minutes", "1 minute", ONE).orderBy("window_start").collect()
    assert [r["mean"] for r in got] == [60.0, 70.0, 80.0]


def test_bands(spark):
    values = [55.0, 60.0, 100.0, 100.5, 121.0, None]
    rows = spark.createDataFrame([("Heart Rate", v) for v in values] + [("Unlisted", 1.0)], "vital string, mean double")
    assert [r.band for r in with_bands(rows).collect()] == ["yellow", "green", "green", "yellow", "red", None, None]
    own = {"Unlisted": (0.0, 2.0, 0.0, 2.0)}
    assert rows.select(colour_band(F.col("vital"), F.col("mean"), own).alias("b")).where("b = 'green'").count() == 1
    assert len(DEFAULT_BANDS) == 6


def test_shares_sum_to_one(spark):
    rows = spark.createDataFrame([("1", "High Risk"), ("1", "Low Risk"), ("1", "Low Risk"), ("2", "Low Risk")],
                                 ["caseid", "Risk Predicted"])
    per_case = risk_share(rows).groupBy("caseid").agg(F.sum("share")).collect()
    assert all(r[1] == pytest.approx(1) for r in per_case)
    assert {r["Risk Predicted"]: (r.n, r.share) for r in risk_share(rows, ()).collect()} == {
        "High Risk": (1, 0.25), "Low Risk": (3, 0.75)}


def test_unreadable_time_is_null(spark):
    rows = with_event_time(spark.createDataFrame([("2025-02-11T10:00:06.123Z",), ("noon",)], ["timestamp"]))
    assert [str(r.event_ts) for r in rows.collect()] == ["2025-02-11 10:00:06.123000", "None"]
