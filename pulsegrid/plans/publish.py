"""Prepared samples to a message topic."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import event_time
from ..operators.messages import encode
from ..operators.routing import in_case_order, route, routed
from ..session import new_dir
from ..sources.topics import write_topic
from ..streaming.commits import Committed
from ..streaming.delivery import attempt

#: Messages of so much time are sent before the next ones.
BLOCK_SECONDS = 3600
#: Files of a block among the staged messages.
BLOCK_PARTS = 8
#: Messages of a file of a file topic, about. Readers may take a file per micro-batch, and each costs the same whatever it holds, so the
#: number of files follows from the messages and not from the cluster.
FILE_MESSAGES = 1 << 20
#: Files are large, so they have row groups of so many (compressed) bytes, which tasks read side by side.
ROW_GROUP = {"parquet.block.size": 1 << 21}


def stage(samples, progress, block_seconds=BLOCK_SECONDS):
    """(name, messages by block of time), computed once for a ``progress`` folder: a publish that is started again finds them there.

    A block's messages are dealt by key into a bounded number of files, whatever the number of tasks.
    """
    spark = samples.sparkSession
    staged = Committed(f"{progress}/staged", run="stage")
    known = staged.committed(spark).get((0, ""))
    if known is None:
        at = F.unix_seconds(event_time(F.col("timestamp")))
        messages = encode(samples).withColumn("block", F.floor(at / block_seconds))
        known = {"name": f"p-{uuid.uuid4().hex}", "block_seconds": block_seconds}
        part = F.pmod(F.xxhash64("key"), F.lit(BLOCK_PARTS))
        messages.repartition("block", part).write.partitionBy("block").parquet(f"{progress}/messages/{known['name']}")
        staged.note(spark, 0, notes=known)
    if known["block_seconds"] != block_seconds:
        raise ValueError(f"{progress} holds messages staged by blocks of {known['block_seconds']} seconds")
    kept = T.StructType([*encode(samples).schema.fields, T.StructField("block", T.LongType())])
    return known["name"], spark.read.schema(kept).parquet(f"{progress}/messages/{known['name']}")


def publish(samples, fmt="kafka", options=None, path=None, routes=None, aside=None, block_seconds=BLOCK_SECONDS, progress=None,
            blocks_per_job=1, tries=5, pause_seconds=2.0):
    """One block of time after the other, all cases of a block together, so that arrival follows event time; (sent, skipped) blocks.

    A topic's reader may then set a watermark of a block or two without losing a case; with ``blocks_per_job`` files of so many
    blocks are written at once, and the watermark must cover them. A block is spread by key and in time order inside a key; in a file
    topic it has a file per ``FILE_MESSAGES`` messages.

    Staged messages and a log of the blocks sent lie in ``progress``. A publish that ended early and is started again with the same
    folder goes on behind the last block sent. In a file topic the folder of a block is named after the publish and the block and is
    replaced, so each message is there once; to Kafka the block that was under way is sent again (see ``arrivals.drop_repeats``).
    A failing write is tried up to ``tries`` times. What has no route or no readable time is not sent; it goes to the table ``aside``
    with a reason, or is an error if there is none.
    """
    spark = samples.sparkSession
    progress = (progress or new_dir(spark, "publish")).rstrip("/")
    name, rows = stage(samples, progress, block_seconds)
    reason = F.when(F.col("block").isNull(), "unreadable timestamp").when(F.col("topic").isNull(), "no route")
    lost = route(rows, routes).withColumn("reason", reason).where("reason IS NOT NULL").drop("block", "topic")
    if aside:
        Committed(aside, run=name)(lost, 0)
    elif not lost.isEmpty():
        raise ValueError("messages without a route or a readable time; name a table to set them aside")
    log = Committed(f"{progress}/sent", run=name)
    last = max((notes["last"] for notes in log.committed(spark).values()), default=None)
    sizes = dict(rows.where("block IS NOT NULL").groupBy("block").count().collect())  # two numbers per block of time
    blocks = sorted(sizes)
    due = [b for b in blocks if last is None or b > last]
    for start in range(0, len(due), blocks_per_job):
        group = due[start:start + blocks_per_job]
        files = None if fmt == "kafka" else -(-sum(sizes[b] for b in group) // FILE_MESSAGES)
        ready = in_case_order(routed(rows.where(F.col("block").between(group[0], group[-1])), routes), files)
        place, mode = (path, "append") if fmt == "kafka" else (f"{path.rstrip('/')}/publish={name}/block={group[0]}", "overwrite")
        given = options if fmt == "kafka" else {**ROW_GROUP, **(options or {})}
        failed = attempt(lambda: write_topic(ready, fmt, given, place, mode), tries, pause_seconds)
        if failed is not None:
            raise RuntimeError(f"blocks {group[0]} to {group[-1]} were not sent, start again with progress={progress!r}: {failed}")
        log.note(spark, group[0], notes={"last": group[-1]})
    return len(due), len(blocks) - len(due)
