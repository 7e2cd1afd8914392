"""Trends and gauges on a stream."""

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.monitor import sliding_means, trend
from .commits import PLACE, Committed, commits, read_committed
from .delivery import start_foreach_batch


def trend_stream(rows, width, delay):
    """Tumbling windows; the watermark bounds the state. ``delay`` must cover how far arrival may lag behind event time."""
    return trend(rows.withWatermark("event_ts", delay), width)


def gauge_stream(rows, width, slide, delay):
    return sliding_means(rows.withWatermark("event_ts", delay), width, slide)


def start_updates(aggregates, path, checkpoint, trigger=None):
    """Every changed window of each micro-batch, so open windows are readable too; see ``latest_updates``."""
    return start_foreach_batch(aggregates, Committed(path), checkpoint, "update", trigger, stateful=True)


def latest_updates(spark, path, keys, schema=None):
    """The last state of every window; each task keeps one row per key before the shuffle."""
    rows = read_committed(spark, path, schema).join(commits(spark, path).select(*PLACE, "at"), PLACE)
    newest = Window.partitionBy(*keys).orderBy(F.desc("at"), F.desc("batch"))
    return rows.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") == 1).drop("rank", "at", *PLACE)


class DroppedRows(StreamingQueryListener):
    """Rows that queries dropped because they came behind a watermark, summed by query over all batches.

    A query's own ``recentProgress`` has the last hundred batches only. Register it with ``spark.streams.addListener``.
    """

    def __init__(self):
        self.dropped, self.batches = {}, {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress, query = event.progress, str(event.progress.id)
        self.batches[query] = self.batches.get(query, 0) + 1
        self.dropped[query] = self.dropped.get(query, 0) + sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
