import math
import random

import pytest
from pyspark.sql import functions as F

from pulsegrid.functions import (as_double, as_int, body_mass_index, event_time, iso_millis, mean_arterial_pressure,
                                 metres, pulse_pressure, risk_label, risk_label_by_position, round_half_up,
                                 round_to_int, round_to_tenth, slot_of, slot_start)


def test_tenth_is_pythons_round(spark):
    halves = [k / 100 for k in range(-500, 60_000, 5)]
    noise = random.Random(7)
    others = [noise.uniform(-50, 500) for _ in range(2000)] + [math.nextafter(36.45, 0), math.nextafter(36.45, 99), 0.0,
                                                               1e12 + 0.25, 123456789.05]
    values = halves + others
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", round_to_tenth(F.col("x")).alias("y"))
    wrong = [(r.x, r.y, round(r.x, 1)) for r in rows.collect() if r.y != round(r.x, 1)]
    assert wrong == []


@pytest.mark.parametrize("x, whole", [(2.5, 2), (3.5, 4), (2.4, 2), (-2.5, -2), (None, None)])
def test_whole_number_halves_go_to_even(spark, x, whole):
    assert spark.createDataFrame([(x,)], "x double").select(round_to_int(F.col("x"))).first()[0] == whole


def test_half_up_to_two_places(spark):
    got = spark.createDataFrame([(26.296,), (0.125,)], "x double").select(round_half_up(F.col("x"))).collect()
    assert [r[0] for r in got] == [26.3, 0.13]


def test_derived_vitals(spark):
    row = spark.createDataFrame([("118", "61", "67.5", "160.2")], ["s", "d", "w", "h"]).select(
        pulse_pressure(as_double("s"), as_double("d")).alias("pp"),
        body_mass_index(as_double("w"), metres(F.col("h"))).alias("bmi"),
        mean_arterial_pressure(as_double("s"), as_double("d")).alias("map"),
        body_mass_index(as_double("w"), F.lit(0.0)).alias("flat")).first()
    assert (row.pp, row.bmi, row.map, row.flat) == (57.0, 26.3, 80.0, None)


def test_unreadable_text_is_null(spark):
    row = spark.createDataFrame([("x", "12", "")], ["a", "b", "c"]).select(
        as_double("a"), as_int("b"), as_int("c")).first()
    assert tuple(row) == (None, 12, None)


def test_iso_text_cuts_to_milliseconds(spark):
    row = spark.sql("SELECT timestamp'2025-02-11 10:00:06.123987' AS t, 'x' AS bad").select(
        iso_millis(F.col("t")).alias("text"), event_time(iso_millis(F.col("t"))).cast("string").alias("back"),
        event_time(F.col("bad")).alias("bad")).first()
    assert tuple(row) == ("2025-02-11T10:00:06.123Z", "2025-02-11 10:00:06.123", None)


def test_slots_also_before_1970(spark):
    rows = spark.sql("SELECT explode(array(timestamp'1969-12-31 23:59:59', timestamp'1970-01-01 00:00:01.999999', "
                     "timestamp'1970-01-01 00:00:02')) AS t")
    got = rows.select(slot_of(F.col("t"), 2).alias("s")).withColumn("start", slot_start(F.col("s"), 2).cast("string"))
    assert [tuple(r) for r in got.collect()] == [
        (-1, "1969-12-31 23:59:58"), (0, "1970-01-01 00:00:00"), (1, "1970-01-01 00:00:02")]


def test_risk_text(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,)], "p double").select(
        risk_label(F.col("p"), ["Low Risk", "High Risk"]), risk_label_by_position(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [("Low Risk", "High Risk"), ("High Risk", "Low Risk"), ("Unknown", "High Risk"),
                                        ("Unknown", "High Risk")]
