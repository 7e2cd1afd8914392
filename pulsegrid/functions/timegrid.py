"""Slots of a regular time grid, and event time as text."""

from pyspark.sql import functions as F

MICROS = 1_000_000


def slot_of(t, step_seconds):
    """Number of the grid slot that holds ``t``, counted from 1970-01-01 UTC."""
    step = F.lit(int(step_seconds * MICROS))
    micros = F.unix_micros(t)
    return ((micros - F.pmod(micros, step)) / step).cast("bigint")


def slot_start(slot, step_seconds):
    return F.timestamp_micros(slot * F.lit(int(step_seconds * MICROS)))


def iso_millis(ts):
    """``2025-02-11T10:00:06.123Z``; finer digits are cut off. Needs the session zone UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def event_time(text):
    """Event time of a message; NULL when the text is no timestamp."""
    return text.try_cast("timestamp")
