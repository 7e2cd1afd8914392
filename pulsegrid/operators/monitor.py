"""Dashboard numbers: trends, recent means with colour bands, risk shares.

Input rows carry ``caseid``, numeric vitals and ``event_ts``. All functions but ``recent_means`` and ``risk_share``
also run on a stream.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import event_time
from ..schemas import VITALS
from .impute import exact_mean, summable

# (green from, green to, yellow from, yellow to); outside yellow is red. Our choice of limits, to be replaced by
# the ward's own.
DEFAULT_BANDS = {
    "Heart Rate": (60.0, 100.0, 50.0, 120.0),
    "Respiratory Rate": (12.0, 20.0, 9.0, 24.0),
    "Body Temperature": (36.1, 37.5, 35.0, 38.5),
    "Oxygen Saturation": (95.0, 100.0, 90.0, 100.0),
    "Systolic Blood Pressure": (100.0, 130.0, 90.0, 160.0),
    "Diastolic Blood Pressure": (60.0, 85.0, 50.0, 100.0),
}


def with_event_time(rows):
    """Adds ``event_ts`` beside the timestamp text."""
    return rows.withColumn("event_ts", event_time(F.col("timestamp")))


def _one_row_per_vital(wide, keys, columns, stats):
    """Turns "<stat> <vital>" columns into one row per vital, after the aggregation has made the data small."""
    per_vital = [F.struct(F.lit(c).alias("vital"), *[F.col(f"{s} {c}").alias(s) for s in stats])
                 for c in columns]
    return (wide.select(*keys, F.explode(F.array(*per_vital)).alias("v")).select(*keys, "v.*")
            .where(F.col("mean").isNotNull()))


def trend(rows, width, slide=None, columns=VITALS):
    """(caseid, window_start, vital, mean, low, high, n) per tumbling or sliding window."""
    windows = F.window("event_ts", width, slide) if slide else F.window("event_ts", width)
    aggregates = []
    for c in columns:
        aggregates += [exact_mean(F.col(c)).alias(f"mean {c}"),
                       F.min(c).cast("double").alias(f"low {c}"),
                       F.max(c).cast("double").alias(f"high {c}"), F.count(summable(F.col(c))).alias(f"n {c}")]
    wide = rows.groupBy("caseid", windows.alias("w")).agg(*aggregates)
    wide = wide.withColumn("window_start", F.col("w.start"))
    return _one_row_per_vital(wide, ["caseid", "window_start"], columns, ["mean", "low", "high", "n"])


def sliding_means(rows, width, slide, columns=VITALS):
    """(caseid, window_start, vital, mean): the gauge value at every slide step. Only means are aggregated."""
    wide = rows.groupBy("caseid", F.window("event_ts", width, slide).alias("w")).agg(
        *[exact_mean(F.col(c)).alias(f"mean {c}") for c in columns])
    return _one_row_per_vital(wide.withColumn("window_start", F.col("w.start")), ["caseid", "window_start"], columns, ["mean"])


def recent_means(rows, interval_seconds, columns=VITALS):
    """(caseid, latest, vital, mean) over each case's last ``interval_seconds``, its latest row included.

    The interval reaches into at most two time blocks of its own length. Rows are matched by (caseid, block),
    so older rows find no partner and a long case is not gathered under one key.
    """
    length = int(interval_seconds * 1_000_000)
    block = F.floor(F.unix_micros("event_ts") / length)
    rows = rows.where(F.col("event_ts").isNotNull())
    latest = rows.groupBy("caseid").agg(F.max("event_ts").alias("latest"))
    last_block = F.floor(F.unix_micros("latest") / length)
    reach = latest.withColumn("block", F.explode(F.array(last_block - 1, last_block)))
    age = F.unix_micros("latest") - F.unix_micros("event_ts")
    wide = (
        rows.select("caseid", "event_ts", *columns, block.alias("block"))
        .join(reach, ["caseid", "block"]).where(age < length)
        .groupBy("caseid", "latest").agg(*[exact_mean(F.col(c)).alias(f"mean {c}") for c in columns])
    )
    return _one_row_per_vital(wide, ["caseid", "latest"], columns, ["mean"])


def colour_band(vital, value, bands=None):
    """green, yellow or red; NULL for a vital without limits or without a value."""
    colour = F.lit(None).cast("string")
    for name, (green_from, green_to, yellow_from, yellow_to) in (bands or DEFAULT_BANDS).items():
        here = (F.when(value.between(green_from, green_to), "green")
                .when(value.between(yellow_from, yellow_to), "yellow")
                .when(value.isNotNull(), "red"))
        colour = F.when(vital == name, here).otherwise(colour)
    return colour


def with_bands(gauges, bands=None):
    return gauges.withColumn("band", colour_band(F.col("vital"), F.col("mean"), bands))


def risk_share(scored, keys=("caseid",)):
    """Count and share of each risk text, per case or (with no keys) over all records."""
    counts = scored.groupBy(*keys, "Risk Predicted").agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))
