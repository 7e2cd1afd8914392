"""Readings on a regular time grid, and the trim of unstable first and last quarters.

A case has one stay or, where it has no reading for long, several. The grid of a stay is complete: every slot from its first to its
last reading has one row. The position of a row is therefore ``slot - first_slot``, and "drop the first and last quarter" is a
slot range that follows from the stay's first and last slot. No window over a case is needed, so a case that holds a large share
of all rows is spread over tasks by slot like all others.

Where rows must meet per-case values they are matched by (caseid, block). A block is ``BLOCK_SLOTS`` slots, so
no join key holds more than that many rows, however long a case is.
"""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import slot_of
from ..schemas import TRACK_COLUMNS

BLOCK_SLOTS = 1 << 16
#: Seconds without a reading (12 days) that part a case into stays; each has a grid, a trim and means of its own.
SPAN_SECONDS = 1 << 20
#: A part of a case with no more readings is no stay, if the case has a larger one: its times are wrong.
LONE_READINGS = 8
FAR = "time far from the case"
#: No vital is that large; such a reading is set aside.
MOST_VALUE = 1e9


def block_of(slot):
    return F.floor(slot / BLOCK_SLOTS)


def _placed(readings, step_seconds):
    """Usable readings of wanted tracks and known cases with their slot; ``unusable_reason`` says why others have none.

    The NULL tests are those that a join on (caseid, block) brings along. With them here, a plan that uses the
    samples twice, for the means and for the rows, has equal branches and shuffles the readings once.
    """
    rows = readings.select("caseid", slot_of(F.col("t"), step_seconds).alias("slot"), "track", "seq", "value")
    return rows.where(usable("slot"))


def usable(time="t"):
    """A measured value of a wanted track with a case and a time; NaN is a gap, not a value."""
    measured = F.col("track").isin(list(TRACK_COLUMNS)) & (F.abs("value") < MOST_VALUE)
    return measured & F.col("caseid").isNotNull() & F.col(time).isNotNull()


def measured():
    """A reading of a wanted track; an empty value and NaN are gaps, not readings."""
    return F.col("track").isin(list(TRACK_COLUMNS)) & F.col("value").isNotNull() & ~F.isnan("value")


def unusable_reason():
    """Why a measured reading has no place in any grid; NULL if it may have one."""
    return (F.when(F.col("caseid").isNull(), "no case").when(F.col("t").isNull(), "no time")
            .when(~(F.abs("value") < MOST_VALUE), "value out of range"))


def case_parts(readings, step_seconds, span_seconds=SPAN_SECONDS):
    """(caseid, part, first_slot, last_slot, n): the parts of a case between stretches without a reading longer than ``span_seconds``.

    Readings are combined on the map side to stretches no longer than the span, so that a gap that parts never lies inside
    one; the windows see stretches only.
    """
    width = max(1, int(span_seconds // step_seconds))
    rows = _placed(readings, step_seconds).select("caseid", "slot", F.floor(F.col("slot") / width).alias("stretch"))
    stretches = rows.groupBy("caseid", "stretch").agg(
        F.min("slot").alias("low"), F.max("slot").alias("high"), F.count("*").alias("n"))
    by_time = Window.partitionBy("caseid").orderBy("stretch")
    gap = (F.col("low") - F.lag("high").over(by_time)) * F.lit(step_seconds)
    parted = stretches.withColumn("parted", F.coalesce(gap > span_seconds, F.lit(False)).cast("long"))
    return parted.withColumn("part", F.sum("parted").over(by_time)).groupBy("caseid", "part").agg(
        F.min("low").alias("first_slot"), F.max("high").alias("last_slot"), F.sum("n").alias("n"))


def case_extent(readings, step_seconds, span_seconds=SPAN_SECONDS, lone_readings=LONE_READINGS):
    """(caseid, stay, first_slot, last_slot): a row per stay of a case, numbered from 0 in order of time.

    A stay is a part of a case with more than ``lone_readings`` readings, however long, or the largest part if there is none with so
    many (of equals the first). What lies elsewhere are lone readings with a wrong time, which would have a grid of their own; see
    ``outlying_readings``.
    """
    parts = case_parts(readings, step_seconds, span_seconds)
    by_size = Window.partitionBy("caseid").orderBy(F.desc("n"), "part")
    stays = parts.withColumn("place", F.row_number().over(by_size)).where((F.col("place") == 1) | (F.col("n") > lone_readings))
    by_time = Window.partitionBy("caseid").orderBy("part")
    return stays.select("caseid", (F.row_number().over(by_time) - 1).cast("long").alias("stay"), "first_slot", "last_slot")


def with_stay(rows, extent, how):
    """``rows`` (caseid, block, slot, ...) joined with the stay that holds them, by case and block; ``stay`` names it."""
    covered = by_block(extent).select(F.col("caseid").alias("case"), F.col("block").alias("case_block"), "stay",
                                      "first_slot", "last_slot")
    on_grid = ((F.col("caseid") == F.col("case")) & (F.col("block") == F.col("case_block"))
               & F.col("slot").between(F.col("first_slot"), F.col("last_slot")))
    joined = rows.join(covered, on_grid, how)
    return joined if how == "left_anti" else joined.drop("case", "case_block", "first_slot", "last_slot")


def outlying_readings(readings, step_seconds, span_seconds=SPAN_SECONDS, lone_readings=LONE_READINGS):
    """Usable readings too far from the stays of their case to be put on a grid, with ``reason``."""
    rows = _placed(readings, step_seconds).withColumn("block", block_of(F.col("slot")))
    far = with_stay(rows, case_extent(readings, step_seconds, span_seconds, lone_readings), "left_anti")
    return far.drop("block").withColumn("reason", F.lit(FAR))


def keep_middle(extent, dropped_share=0.25):
    """Per stay the slot range that is left when this share of its rows is dropped at both ends, and the row count before.

    ``origin`` is the slot that a case's samples are counted from: the first kept one, in later stays less the rows kept before.
    """
    n = F.col("last_slot") - F.col("first_slot") + 1
    cutoff = F.floor(n * F.lit(dropped_share))
    kept = extent.select(
        "caseid", "stay", (F.col("first_slot") + cutoff).alias("first_slot"),
        (F.col("last_slot") - cutoff).alias("last_slot"), n.alias("n_slots"),
    )
    earlier = Window.partitionBy("caseid").orderBy("stay").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("last_slot") - F.col("first_slot") + 1).over(earlier), F.lit(0))
    return kept.withColumn("origin", F.col("first_slot") - before)


def by_block(extent):
    """One row per case and block of its slot range; the other columns are repeated."""
    blocks = F.sequence(block_of(F.col("first_slot")), block_of(F.col("last_slot")))
    return extent.withColumn("block", F.explode(blocks))


def grid_rows(extent):
    """(caseid, slot, stay, origin): every slot of every stay; without ``origin`` slots count from the stay's first.

    Blocks are spread before they are unfolded; the partition number is given so that the small input is not
    merged back into few tasks.
    """
    spark = extent.sparkSession
    extent = extent if "origin" in extent.columns else extent.withColumn("origin", F.col("first_slot"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low = F.greatest(F.col("first_slot"), F.col("block") * BLOCK_SLOTS)
    high = F.least(F.col("last_slot"), F.col("block") * BLOCK_SLOTS + (BLOCK_SLOTS - 1))
    return (
        by_block(extent).repartition(tasks, "caseid", "block")
        .select("caseid", F.explode(F.sequence(low, high)).alias("slot"), "stay", "origin")
    )


def _last_reading(track, name):
    return F.expr(f"max_by(value, seq) FILTER (WHERE track = '{track}')").alias(name)


def resample(readings, step_seconds, grid=None):
    """One row per case and slot, one column per track, the last reading of the slot winning.

    Without ``grid`` only slots with a reading appear. With ``grid`` (see ``grid_rows``) exactly the grid's slots
    appear, empty ones as NULL: readings and grid rows are united and meet in the same aggregation, so
    resampling, trimming and gap filling take one shuffle. ``seq`` orders the readings of a case and track; it is a
    plain number, so that the aggregation stays a hash aggregation, and should not repeat with differing values.
    """
    rows = _placed(readings, step_seconds)
    vitals = [_last_reading(track, name) for track, name in TRACK_COLUMNS.items()]
    if grid is None:
        any_track = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in TRACK_COLUMNS.values()])
        return rows.groupBy("caseid", "slot").agg(*vitals).where(any_track)
    rows = rows.unionByName(grid, allowMissingColumns=True).withColumn("block", block_of(F.col("slot")))
    rows = rows.where(F.col("block").isNotNull())
    on_grid = [F.max(c).alias(c) for c in ("stay", "origin")]
    return (rows.groupBy("caseid", "block", "slot").agg(*vitals, *on_grid)
            .where(F.col("stay").isNotNull() & F.col("origin").isNotNull()))  # both, so that branches of a plan stay equal


def attach_case_values(samples, case_values):
    """Values of a stay onto every sample of it.

    ``case_values`` has one row per stay with ``first_slot`` and ``last_slot``. Both sides are keyed by (caseid, block, stay).
    Catalyst broadcasts the side of the stays only where its measured size is below the session's limit.
    """
    values = by_block(case_values).drop("first_slot", "last_slot", "origin")
    return samples.join(values, ["caseid", "block", "stay"]).drop("block")
