"""Dashboard tables that follow a folder of scored documents: only dates with new commits are read and written again."""

from pyspark.sql import functions as F

from ..operators.monitor import with_bands
from ..operators.rollup import GRAIN_SECONDS, gauge_of, latest_of, risk_rollup, share_of, trend_of, vital_rollup
from ..schemas import VITALS
from ..session import stored
from ..streaming.commits import Committed, commits, one_per_document, read_committed

#: Dates that are named one by one in a filter; a refresh of more reads all of them.
MOST_DATES = 1000


def new_commits(spark, scored, out):
    """The commits of ``scored`` that no refresh of ``out`` has seen."""
    seen = read_committed(spark, f"{out}/_sources", _sources(spark).schema).select("source") if commits(
        spark, f"{out}/_sources").take(1) else _sources(spark)
    return commits(spark, scored).join(seen, F.col("attempt") == F.col("source"), "left_anti")


def _sources(spark):
    return spark.createDataFrame([], "source string")


def dates_of(spark, scored, log):
    """The dates that the commits in ``log`` have documents of."""
    return sorted(r.event_date for r in read_committed(spark, scored, log=log).select("event_date").distinct().collect() if r.event_date)


def documents_of(spark, scored, dates):
    """Each document of these dates once, the one committed last."""
    rows = read_committed(spark, scored)
    if len(dates) <= MOST_DATES:
        rows = rows.where(F.col("event_date").isin(dates))
    needed = ["document_id", "caseid", "event_ts", "Risk Predicted", *VITALS]
    return one_per_document(rows.select(*needed, "event_date", "run", "batch", "attempt"), commits(spark, scored))


#: Rows of a date are dealt by case into so many parts. Both columns follow from case and day, as do grains and windows, so rows that
#: are dealt once can be aggregated and written without another shuffle.
DATE_PARTS, DEALT = 64, ("event_date", "part")


def _dealt(rows):
    return rows.withColumn("part", F.pmod(F.xxhash64("caseid"), F.lit(DATE_PARTS))).repartition(*DEALT)


def _replace(rows, path):
    """Replaces the dates that ``rows`` has, and no others."""
    rows.write.partitionBy("event_date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def exists(spark, path):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def gauges(spark, rollup, dates, out, reach_seconds):
    """The gauge of every case: anew for those with rows on these dates, as it was for the others.

    A case that has rows on one of the dates has its latest row then or later, so no date before the first of them, less the reach, is
    opened.
    """
    days = F.expr(f"INTERVAL {-(-reach_seconds // 86400)} DAYS")
    near = rollup.where(F.col("event_date") >= (F.lit(min(dates)) - days).cast("date"))
    touched = F.col("event_date").isin(dates) if len(dates) <= MOST_DATES else F.lit(True)
    latest = stored(latest_of(near, touched), "latest")
    earliest = latest.agg(F.to_date(F.min("latest"))).first()[0]  # what lies further back is in no gauge
    if earliest is not None:
        near = near.where(F.col("event_date") >= (F.lit(earliest) - days).cast("date"))
    fresh = with_bands(gauge_of(near, reach_seconds, latest))
    if not exists(spark, f"{out}/gauge"):
        return fresh
    return spark.read.parquet(f"{out}/gauge").join(latest.select("caseid"), "caseid", "left_anti").select(*fresh.columns).unionByName(fresh)


def refresh(spark, scored, out, bucket="1 minute", reach_seconds=300, grain_seconds=GRAIN_SECONDS):
    """Brings ``rollup``, ``risks``, ``trend``, ``gauge`` and ``risk_share`` below ``out`` up to date; the dates that were done again.

    Rollups and trends lie by date. Of documents, only the dates that new commits touch are read. Gauges are made anew for the cases
    with rows on these dates, from rollups of these dates and later ones; shares sum the small table of counts per case and day. The
    commits are noted last, so a refresh that ended early is done again. ``bucket`` must divide a day.
    """
    out, scored = out.rstrip("/"), scored.rstrip("/")
    new = stored(new_commits(spark, scored, out).select("run", "batch", "attempt", "at"), "new-commits")
    first = new.agg(F.min("attempt")).first()[0]
    if first is None:
        return []
    dates = dates_of(spark, scored, new)
    if dates:
        rows = documents_of(spark, scored, dates)
        _replace(vital_rollup(_dealt(rows), grain_seconds, dealt=DEALT), f"{out}/rollup")
        _replace(_dealt(risk_rollup(rows)).drop("part"), f"{out}/risks")
        rollup = spark.read.parquet(f"{out}/rollup")
        changed = rollup.where(F.col("event_date").isin(dates)) if len(dates) <= MOST_DATES else rollup
        _replace(trend_of(_dealt(changed), bucket, DEALT), f"{out}/trend")
        stored(gauges(spark, rollup, dates, out, reach_seconds), "gauge").write.mode("overwrite").parquet(f"{out}/gauge")
        share_of(spark.read.parquet(f"{out}/risks")).write.mode("overwrite").parquet(f"{out}/risk_share")
    Committed(f"{out}/_sources", run="refresh-" + first)(new.select(F.col("attempt").alias("source")).coalesce(1), 0)
    return dates
