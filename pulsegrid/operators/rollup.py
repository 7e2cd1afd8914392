"""Rollups that can be merged: sums, counts and extremes per case, grain of time and vital, and counts of risk texts per day.

A grain's row is enough for every mean, low and high over whole grains, so trends, gauges and shares read rollups and not documents.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schemas import VITALS
from .impute import summable

GRAIN_SECONDS = 60
DAY = 86400


def grain_of(time, seconds):
    return F.timestamp_seconds(F.unix_seconds(time) - F.pmod(F.unix_seconds(time), F.lit(seconds)))


def vital_rollup(rows, seconds=GRAIN_SECONDS, columns=VITALS, dealt=()):
    """(caseid, grain, event_date, vital, total, n, low, high); ``total`` is a decimal, so merging is exact in any order.

    ``dealt`` names columns that follow from case and day; rows dealt by them are not shuffled again.
    """
    if DAY % seconds:
        raise ValueError("a grain must divide a day")
    aggregates = [a for c in columns for a in (
        F.sum(summable(F.col(c))).alias(f"total {c}"), F.count(summable(F.col(c))).alias(f"n {c}"),
        F.min(c).cast("double").alias(f"low {c}"), F.max(c).cast("double").alias(f"high {c}"))]
    wide = rows.where(F.col("event_ts").isNotNull()).groupBy(
        "caseid", grain_of(F.col("event_ts"), seconds).alias("grain"), *dealt).agg(*aggregates)
    per_vital = [F.struct(F.lit(c).alias("vital"), *[F.col(f"{s} {c}").alias(s) for s in ("total", "n", "low", "high")]) for c in columns]
    return (wide.select("caseid", "grain", F.to_date("grain").alias("event_date"), F.inline(F.array(*per_vital)))
            .where("n > 0"))


def risk_rollup(scored):
    """(caseid, event_date, Risk Predicted, n)."""
    return scored.groupBy("caseid", F.to_date("event_ts").alias("event_date"), "Risk Predicted").agg(F.count("*").alias("n"))


def _merged():
    return [F.try_divide(F.sum("total").cast("double"), F.sum("n")).alias("mean")]


def trend_of(rollup, bucket, dealt=()):
    """(caseid, window_start, vital, mean, low, high, n) per tumbling window of whole grains; ``dealt`` as in ``vital_rollup``."""
    return rollup.groupBy("caseid", F.window("grain", bucket).alias("w"), "vital", *dealt).agg(
        *_merged(), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).select(
        "caseid", F.col("w.start").alias("window_start"), "vital", "mean", "low", "high", "n",
        *[c for c in dealt if c == "event_date"])


def latest_of(rollup, touched=None):
    """(caseid, latest): the latest grain of each case; with ``touched``, a condition, of the cases of which a row meets it."""
    latest = rollup.groupBy("caseid").agg(F.max("grain").alias("latest"), F.max(F.lit(True) if touched is None else touched).alias("touched"))
    return latest.where("touched").drop("touched")


def gauge_of(rollup, reach_seconds, latest=None):
    """(caseid, latest, vital, mean) over the last ``reach_seconds`` of each case, up to the end of its latest grain.

    As in ``monitor.recent_means``, rows meet the latest grain by (case, block of time), so older ones find no partner. ``latest`` is
    a part of ``latest_of``, for the cases in it.
    """
    block = F.floor(F.unix_seconds("grain") / reach_seconds)
    latest = latest_of(rollup) if latest is None else latest
    last = F.floor(F.unix_seconds("latest") / reach_seconds)
    near = latest.withColumn("block", F.explode(F.array(last - 1, last)))
    return (rollup.withColumn("block", block).join(near, ["caseid", "block"])
            .where(F.unix_seconds("latest") - F.unix_seconds("grain") < reach_seconds)
            .groupBy("caseid", "latest", "vital").agg(*_merged()))


def share_of(risks, keys=("caseid",)):
    """Count and share of each risk text, per case or (with no keys) over all records."""
    counts = risks.groupBy(*keys, "Risk Predicted").agg(F.sum("n").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))
