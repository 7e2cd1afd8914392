"""Monitor readings and the clinical table to prepared samples.

The order matters: trim before the means, means before rounding, time stamps last.
"""

from pyspark.sql import functions as F

from ..functions import iso_millis, metres, round_to_int, round_to_tenth, slot_of
from ..operators.clinical import NO_ROW, case_key, first_per_case, only_cases, select_cases
from ..operators.columns import fractional_columns, keys_first, rename_columns
from ..operators.grid import (FAR, attach_case_values, block_of, case_extent, grid_rows, keep_middle, measured, resample,
                              unusable_reason, with_stay)
from ..operators.impute import case_means, fill_with_means
from ..schemas import MESSAGE_COLUMNS, VITALS

SAMPLE_SECONDS = 2


def trimmed_samples(readings, step_seconds=SAMPLE_SECONDS):
    """(samples, kept): the complete grid of the middle half of each stay, and its slot ranges."""
    kept = keep_middle(case_extent(readings, step_seconds))
    return resample(readings, step_seconds, grid_rows(kept)), kept


def round_vitals(samples):
    """Body temperature to tenths, the other vitals to whole numbers; weight and height stay as they are."""
    whole = fractional_columns(samples, leave_out=["Body Temperature", "Weight", "Height"])
    return samples.withColumns({
        "Body Temperature": round_to_tenth(F.col("Body Temperature")),
        **{c: round_to_int(F.col(c)) for c in whole},
    })


def sample_time(base, step_seconds=SAMPLE_SECONDS):
    """``base`` for a case's first kept row, one step more for each row after it, on through all its stays."""
    step = F.lit(int(step_seconds * 1_000_000))
    start = F.unix_micros(F.lit(base).cast("timestamp"))
    return F.timestamp_micros(start + (F.col("slot") - F.col("origin")) * step)


def prepare(readings, clinical, base, step_seconds=SAMPLE_SECONDS, case_ids=None):
    """Message-ready samples of all cases that have readings and a clinical row.

    Means and clinical attributes are joined to each other first, one row per case, so that the samples are
    joined once.
    """
    readings = only_cases(readings, case_ids).withColumn("caseid", case_key(F.col("caseid")))
    samples, kept = trimmed_samples(readings, step_seconds)
    attributes = first_per_case(select_cases(clinical, case_ids))
    case_values = kept.join(case_means(samples, VITALS), ["caseid", "stay"]).join(attributes, "caseid")
    filled = fill_with_means(attach_case_values(samples, case_values), VITALS)
    named = rename_columns(filled).withColumn("Height", metres(F.col("Height")))
    stamped = (round_vitals(named)
               .withColumn("timestamp", iso_millis(sample_time(base, step_seconds))))
    return keys_first(stamped.select(*MESSAGE_COLUMNS))


PREPARED = "prepared"


def fates(readings, clinical, step_seconds=SAMPLE_SECONDS, case_ids=None):
    """Every reading of a wanted track that has a value, once, with its ``fate``: why it is not prepared, or that it is.

    Reasons are looked for in this order: no case, no time, a value out of range, a time far from the case, no clinical row. Empty
    values and NaN are gaps, not readings. Readings of the trimmed quarters count as prepared: they make the grid. With ``case_ids`` only
    those cases are looked at, and readings without a case are nobody's.
    """
    rows = only_cases(readings, case_ids).withColumn("caseid", case_key(F.col("caseid")))
    rows = rows.where(measured()).select("caseid", "track", "t", "seq", "value", unusable_reason().alias("unusable"))
    placed = rows.withColumn("slot", F.when(F.col("unusable").isNull(), slot_of(F.col("t"), step_seconds)))
    placed = with_stay(placed.withColumn("block", block_of(F.col("slot"))), case_extent(rows, step_seconds), "left")
    known = select_cases(clinical, case_ids).select("caseid").distinct().withColumn("known", F.lit(True))
    fate = (F.when(F.col("unusable").isNotNull(), F.col("unusable")).when(F.col("stay").isNull(), FAR)
            .when(F.col("known").isNull(), NO_ROW).otherwise(PREPARED))
    return placed.join(known, "caseid", "left").select("caseid", "track", "t", "seq", "value", fate.alias("fate"))


def set_aside(readings, clinical, step_seconds=SAMPLE_SECONDS, case_ids=None):
    """(readings, cases) that ``prepare`` uses for nothing, with ``reason``: readings of wanted tracks that cannot be placed, and
    cases without a clinical row, which keep their number of usable readings. Both are parts of one classification, ``fates``."""
    rows = fates(readings, clinical, step_seconds, case_ids).withColumnRenamed("fate", "reason")
    unknown = rows.where(F.col("reason") == NO_ROW).groupBy("caseid", "reason").agg(F.count("*").alias("n_readings"))
    return rows.where(~F.col("reason").isin(NO_ROW, PREPARED)), unknown
