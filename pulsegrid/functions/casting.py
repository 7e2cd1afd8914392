"""Text to number: unreadable text becomes NULL, also with ANSI mode on."""

from pyspark.sql import functions as F


def as_double(c):
    return F.col(c).try_cast("double") if isinstance(c, str) else c.try_cast("double")


def as_float(c):
    return F.col(c).try_cast("float") if isinstance(c, str) else c.try_cast("float")


def as_int(c):
    return F.col(c).try_cast("int") if isinstance(c, str) else c.try_cast("int")


def blank_nan(c):
    """NaN marks a missing reading; Spark's NULL takes its place."""
    return F.when(~F.isnan(c), c)


def finite(c):
    """NULL for NaN and the infinities, which are no measured values."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
