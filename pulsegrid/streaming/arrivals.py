"""Decoded message streams: event time, repeats, clinical attributes."""

from pyspark.sql import functions as F

from ..operators.messages import decode
from ..operators.monitor import with_event_time


def decoded_with_time(envelope):
    return with_event_time(decode(envelope))


def drop_repeats(rows, delay):
    """One row per case and event time: a record that was sent again within ``delay`` is dropped.

    ``delay`` must cover how far arrival may lag behind event time, a block of ``publish`` at least: rows behind the
    watermark are dropped too, and counted by ``monitor.DroppedRows``. Rows without an event time are left out. ``watch.start_front``
    sets both aside before.
    """
    rows = rows.where(rows["event_ts"].isNotNull())
    return rows.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["caseid", "event_ts"])


#: Parts that a case's rows are dealt into when they meet the clinical table.
PARTS = 8


def attach_clinical(rows, clinical_per_case, parts=PARTS):
    """Stream-static join with the clinical table, one row per case.

    Streams have no adaptive handling of large keys, so a case's rows are dealt into ``parts`` and the small table repeated.
    """
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    repeated = clinical_per_case.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    return dealt.join(repeated, ["caseid", "part"]).drop("part")
