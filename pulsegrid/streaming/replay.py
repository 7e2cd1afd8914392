"""Paced replay of published messages: one record per case and step, in time order, like a live device."""

from pyspark.sql import functions as F

TICKS_PER_BLOCK = 1800


def write_replay_table(messages, path, base, step_seconds=2, ticks_per_block=TICKS_PER_BLOCK, unsent=None):
    """Messages by tick, partitioned by block of ticks, so that a micro-batch reads one partition.

    Large blocks are split over tasks by (tick, key). Messages without a tick, because their time cannot be read or lies
    before ``base``, go to the table ``unsent`` with a reason, or are an error if there is none.
    """
    start = F.unix_micros(F.lit(base).cast("timestamp"))
    now = F.unix_micros(F.col("timestamp").try_cast("timestamp"))
    tick = F.round((now - start) / F.lit(step_seconds * 1_000_000)).cast("bigint")
    placed = messages.withColumn("tick", tick)
    lost = placed.where("tick IS NULL OR tick < 0").withColumn(
        "reason", F.when(F.col("tick").isNull(), "unreadable timestamp").otherwise("before the first tick"))
    if unsent:
        lost.drop("tick").write.mode("overwrite").parquet(unsent)
    elif not lost.isEmpty():
        raise ValueError("messages without a tick; name a table to set them aside")
    (placed.where("tick >= 0")
     .withColumn("tick_block", F.floor(F.col("tick") / ticks_per_block))
     .repartitionByRange("tick_block", "tick", "key")
     .write.mode("overwrite").partitionBy("tick_block").parquet(path))


def device_clock(spark, step_seconds=2):
    """One tick per trigger, from 0 on; the place is kept in the checkpoint."""
    return (spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1)
            .option("advanceMillisPerBatch", int(step_seconds * 1000)).load().select("value"))


def file_clock(spark, folder, per_trigger=None):
    """A clock that is moved by hand: the ticks in the files of ``folder``, see ``move_clock``."""
    reader = spark.readStream.schema("value long")
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(folder)


def move_clock(spark, folder, first, last):
    """Lets a ``file_clock`` go on from tick ``first`` to ``last``, both included."""
    spark.range(first, last + 1).select(F.col("id").alias("value")).coalesce(1).write.mode("append").parquet(folder)


def start_replay(spark, path, write, checkpoint, step_seconds=2, pause_seconds=None,
                 ticks_per_block=TICKS_PER_BLOCK, clock=None, trigger=None):
    """The messages of the ticks that ``clock`` has come to, one tick per trigger with the device's own clock.

    ``write(rows, batch_id)`` sends a tick's messages, which keep their ``tick``.
    """
    pause = step_seconds if pause_seconds is None else pause_seconds
    ticks = device_clock(spark, step_seconds) if clock is None else clock

    def send(batch, batch_id):
        reach = batch.agg(F.min("value").alias("first"), F.max("value").alias("last")).first()
        if reach["first"] is None:
            return
        blocks = F.col("tick_block").between(reach["first"] // ticks_per_block, reach["last"] // ticks_per_block)
        due = spark.read.parquet(path).where(blocks & F.col("tick").between(reach["first"], reach["last"]))
        write(due.drop("tick_block").sortWithinPartitions("tick"), batch_id)

    return (ticks.writeStream.foreachBatch(send).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{pause} seconds"})).start())
