"""The live monitor: a topic to trends and gauges, with every row that takes no part in a table of its own.

A front query reads the topic. It knows the latest event time so far, keeps it in the log of its commits, and sets aside what lies
behind it by more than ``delay``, what has no readable time and what cannot be decoded. The others go to the table ``on_time``, batch by
batch. The stateful queries read that table. Their watermark never is ahead of the front's, which counts the batch it looks at as
well, so they drop nothing: kept, repeated and set-aside rows sum to those sent.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clinical import first_per_case, select_cases
from ..operators.enrich import enrich
from ..operators.messages import CORRUPT, decode
from ..operators.monitor import with_event_time
from ..schemas import FLOAT_COLUMNS, MESSAGE_COLUMNS
from ..session import stored, stored_meanwhile
from .arrivals import drop_repeats
from .commits import Committed
from .delivery import start_append, start_foreach_batch
from .monitor import gauge_stream, start_updates, trend_stream

ASIDE, ON_TIME, ONCE, TREND, GAUGE = "aside", "on_time", "once", "trend", "gauge"

ROW_SCHEMA = T.StructType([
    T.StructField(c, T.FloatType() if c in FLOAT_COLUMNS else T.StringType()) for c in [*MESSAGE_COLUMNS, *FLOAT_COLUMNS[-3:]]
] + [T.StructField("event_ts", T.TimestampType())])


def _at(path, name):
    return f"{path.rstrip('/')}/{name}"


def high_water(known, batch_id):
    """The latest event time, in microseconds, that the batches before this one have seen; ``known`` are a run's commits."""
    seen = [notes["high"] for (batch, _), notes in known.items() if batch < batch_id and notes.get("high") is not None]
    return max(seen, default=None)


def start_front(envelope, path, delay_seconds, checkpoint, clinical=None, trigger=None):
    """Topic rows to ``on_time`` and ``aside`` (message, event_ts, reason) below ``path``.

    Rows are late if they lie more than ``delay_seconds`` behind the latest time of all batches up to their own. With a
    ``clinical`` table the attributes of each case are taken from there, and rows of cases without one are set aside.
    A batch is decoded and joined once, and stored for the passes over it.
    """
    on_time, aside = Committed(_at(path, ON_TIME)), Committed(_at(path, ASIDE))
    per_case = None if clinical is None else stored(first_per_case(select_cases(clinical)), "clinical")  # every batch meets it

    def split(batch, batch_id):
        known = on_time.committed(batch.sparkSession)
        if (batch_id, "") in known:
            return
        rows = with_event_time(decode(batch))
        if per_case is not None:
            rows = _with_attributes(rows, per_case)
        with stored_meanwhile(rows, "front") as ready:  # three passes: the latest time, what is set aside, what is kept
            deal(ready, batch_id, high_water(known, batch_id))

    def deal(rows, batch_id, before):
        here = rows.agg(F.max(F.unix_micros("event_ts"))).first()[0]
        high = max((x for x in (before, here) if x is not None), default=None)
        late = F.lit(False) if high is None else F.unix_micros("event_ts") < F.lit(high - int(delay_seconds * 1_000_000))
        reason = (F.when(F.col(CORRUPT).isNotNull(), "undecodable").when(F.col("event_ts").isNull(), "unreadable timestamp")
                  .when(late, "behind the watermark"))
        if per_case is not None:
            reason = F.when(F.col(CORRUPT).isNull() & ~F.col("known_case"), "no clinical row").otherwise(reason)
        marked = rows.withColumn("reason", reason)
        aside(marked.where("reason IS NOT NULL").select(*MESSAGE_COLUMNS, CORRUPT, "event_ts", "reason"), batch_id)
        kept = enrich(marked.where("reason IS NULL")).select(*ROW_SCHEMA.names)
        on_time(kept, batch_id, notes={"high": high})

    return start_foreach_batch(envelope, split, checkpoint, trigger=trigger)


def _with_attributes(rows, per_case):
    """Clinical attributes from the table; it has one row per case, the batch many, so a large case is split by adaptive joins."""
    named = per_case.select("caseid", F.lit(True).alias("known_case"), F.col("age").alias("Age"), F.col("sex").alias("Gender"),
                            (F.col("height").try_cast("double") / 100).cast("string").alias("Height"), F.col("weight").alias("Weight"))
    joined = rows.drop("Age", "Gender", "Height", "Weight").join(named, "caseid", "left")
    return joined.withColumn("known_case", F.coalesce("known_case", F.lit(False)))


def on_time_rows(spark, path):
    return spark.readStream.schema(ROW_SCHEMA).parquet(_at(path, ON_TIME)).select(*ROW_SCHEMA.names)


def start_once(spark, path, delay, checkpoint, trigger=None):
    """Rows in time, each once, as the table ``once``."""
    return start_append(drop_repeats(on_time_rows(spark, path), delay), "parquet", checkpoint, path=_at(path, ONCE), trigger=trigger,
                        stateful=True)


def once_rows(spark, path):
    return spark.readStream.schema(ROW_SCHEMA).parquet(_at(path, ONCE))


def start_trend(spark, path, bucket, delay, checkpoint, trigger=None):
    return start_updates(trend_stream(once_rows(spark, path), bucket, delay), _at(path, TREND), checkpoint, trigger)


def start_gauge(spark, path, reach, slide, delay, checkpoint, trigger=None):
    return start_updates(gauge_stream(once_rows(spark, path), reach, slide, delay), _at(path, GAUGE), checkpoint, trigger)


def watch(envelope, path, progress, delay_seconds, bucket="1 minute", reach="5 minutes", slide="1 minute", clinical=None, trigger=None):
    """All queries of the live monitor, in order. With the trigger ``availableNow`` each ends before the next one starts."""
    spark, delay = envelope.sparkSession, f"{delay_seconds} seconds"
    places = {n: _at(progress, n) for n in ("front", ONCE, TREND, GAUGE)}
    starts = [
        lambda: start_front(envelope, path, delay_seconds, places["front"], clinical, trigger),
        lambda: start_once(spark, path, delay, places[ONCE], trigger),
        lambda: start_trend(spark, path, bucket, delay, places[TREND], trigger),
        lambda: start_gauge(spark, path, reach, slide, delay, places[GAUGE], trigger)]
    for first in (f"{ON_TIME}/run=r-none/batch=-1/attempt=t-none", f"{ONCE}/_made"):  # what the next query reads must be there
        spark.createDataFrame([], ROW_SCHEMA).write.mode("ignore").parquet(_at(path, first))
    queries = []
    for start in starts:
        queries.append(start())
        if trigger and trigger.get("availableNow"):
            queries[-1].awaitTermination()
    return queries
