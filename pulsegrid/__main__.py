"""Command line: ``spark-submit`` or ``python -m pulsegrid <job> ...``.

    train    training CSV -> saved model, metrics, importances
    publish  readings + clinical CSV -> topic (Kafka, or files with --path)
    replay   file topic -> topic, one record per case every two seconds, until stopped
    score    topic -> scored documents (search index, or files with --path), until stopped or --once
    redeliver  dead letters of the scoring job -> scored documents, once more
    watch    topic -> live trends and gauges, rows that come too late aside, until stopped or --once
    monitor  scored documents in files -> trend, gauge and risk_share tables; only dates with new documents are done again
"""

import argparse

from pyspark.sql import SparkSession

from .operators.messages import decode, encode
from .operators.routing import routed
from .plans.dashboard import refresh
from .plans.prepare import prepare, set_aside
from .plans.publish import publish
from .plans.training import evaluate, importances, left_out, preview, train_and_test, unseen_counts
from .schemas import ENCODED_LABEL, ENVELOPE_SCHEMA, LABEL
from .session import job_dir, new_dir, remove_made, use_utc
from .settings import JobSettings
from .sources.files import read_clinical, read_readings, read_training, require_rows
from .sources.models import load_model, save_model
from .sources.topics import kafka_options, read_topic, write_topic
from .streaming.commits import Committed, compact_log
from .streaming.delivery import UPSERT, deliver, redeliver
from .streaming.monitor import DroppedRows
from .streaming.replay import start_replay, write_replay_table
from .streaming.scoring import scored_writer, start_scoring_job
from .streaming.watch import ASIDE, watch

INDEX_FORMAT = "org.elasticsearch.spark.sql"


def train(spark, settings, args):
    rows = require_rows(read_training(spark, args.training), args.training)
    left_out(rows).show()
    model, predictions = train_and_test(rows, ["Patient ID"] + args.key)
    evaluate(predictions).show(truncate=False)
    unseen_counts(rows, model, ["Patient ID"] + args.key).show(truncate=False)
    preview(predictions, ["Patient ID", LABEL, ENCODED_LABEL, "prediction"], ["Patient ID"]).show()
    importances(spark, model).show(truncate=False)
    save_model(model, settings.model_path)


def publish_samples(spark, settings, args):
    readings = read_readings(spark, args.readings)
    clinical = read_clinical(spark, args.clinical)
    samples = prepare(readings, clinical, args.base, case_ids=settings.case_ids)
    routes = {"patient.vitals": settings.topic}
    aside = args.aside or job_dir(spark, "publish-aside", args.readings, args.path or settings.topic)
    unplaced, unknown = set_aside(readings, clinical, case_ids=settings.case_ids)
    progress = args.progress or job_dir(spark, "publish-progress", args.readings, args.clinical, args.base, args.path or settings.topic)
    unplaced.write.mode("overwrite").parquet(f"{aside}/readings")
    unknown.write.mode("overwrite").parquet(f"{aside}/cases")
    where = {"fmt": "parquet", "path": args.path} if args.path else {
        "fmt": "kafka", "options": {"kafka.bootstrap.servers": settings.kafka_servers}}
    sent, skipped = publish(samples, **where, routes=routes, aside=f"{aside}/messages", progress=progress, blocks_per_job=args.blocks_per_job)
    print(f"blocks sent: {sent}, sent before: {skipped}")
    print(f"set aside: {aside}")


def replay(spark, settings, args):
    table = new_dir(spark, "replay")
    messages = decode(spark.read.schema(ENVELOPE_SCHEMA).parquet(args.topic_path))
    unsent = args.unsent or job_dir(spark, "replay-unsent", args.topic_path, args.path or settings.topic)
    write_replay_table(encode(messages), table, args.base, unsent=unsent)
    kafka = {"kafka.bootstrap.servers": settings.kafka_servers}

    to_files = Committed(args.path) if args.path else None

    def send(rows, batch_id, part=""):
        rows = routed(rows, {"patient.vitals": settings.topic})
        if to_files:
            to_files(rows.drop("tag", "tick", "timestamp"), batch_id, part)
        else:
            write_topic(rows, "kafka", kafka)

    dead = args.dead_letters or job_dir(spark, "replay-dead", args.topic_path, args.path or settings.topic)
    progress = args.checkpoint or job_dir(spark, "replay-progress", args.topic_path, args.path or settings.topic)
    start_replay(spark, table, deliver(send, dead), progress).awaitTermination()


def envelope_of(spark, settings, args):
    if args.topic_path:
        return read_topic(spark, "parquet", path=args.topic_path)
    return read_topic(spark, "kafka", kafka_options(
        settings.kafka_servers, settings.topic, settings.fail_on_data_loss, settings.starting_offsets))


def score_places(spark, settings, args):
    names = (args.topic_path or settings.topic, args.path or settings.index)
    return (args.quarantine or job_dir(spark, "score-quarantine", *names), args.dead_letters or job_dir(spark, "score-dead", *names),
            args.checkpoint or job_dir(spark, "score-progress", *names))


def document_writer(settings, args, run=None):
    def to_index(rows, batch_id, part=""):
        rows.write.format(INDEX_FORMAT).options(**settings.index_options(), **UPSERT).mode("append").save()

    return Committed(args.path, run, by_date=True) if args.path else to_index


def score_topic(spark, settings, args):
    quarantine, dead, progress = score_places(spark, settings, args)
    trigger = {"availableNow": True} if args.once else None
    print(f"set aside: {quarantine}, {dead}")
    start_scoring_job(envelope_of(spark, settings, args), load_model(settings.model_path), document_writer(settings, args),
                      quarantine, dead, progress, trigger).awaitTermination()


def redeliver_scored(spark, settings, args):
    quarantine, dead, _ = score_places(spark, settings, args)
    again = "redelivered"
    write = scored_writer(load_model(settings.model_path), document_writer(settings, args, again), Committed(quarantine, again))
    sent, left = redeliver(spark, dead, write)
    print(f"dead letters handled: {sent}, failed again: {left}")


def watch_topic(spark, settings, args):
    progress = args.checkpoint or job_dir(spark, "watch-progress", args.topic_path or settings.topic, args.out)
    clinical = read_clinical(spark, args.clinical) if args.clinical else None
    listener = DroppedRows()
    spark.streams.addListener(listener)
    queries = watch(envelope_of(spark, settings, args), args.out, progress, args.delay_seconds, args.bucket, args.reach, args.slide,
                    clinical, {"availableNow": True} if args.once else None)
    if not args.once:
        spark.streams.awaitAnyTermination()
    print(f"set aside: {args.out}/{ASIDE}; dropped behind a watermark: {sum(listener.dropped.values())}")
    spark.streams.removeListener(listener)
    for query in queries:
        if query.exception():
            raise query.exception()


def monitor(spark, settings, args):
    dates = refresh(spark, args.scored, args.out, args.bucket, args.recent_seconds)
    compact_log(spark, args.scored)
    print(f"dates done again: {len(dates)}")


def parser():
    root = argparse.ArgumentParser(prog="pulsegrid", description=__doc__,
                                   formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = root.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("train")
    job.add_argument("training")
    job.add_argument("--key", nargs="*", default=[], help="further columns that tell rows of a patient apart")
    job.set_defaults(run=train)
    job = jobs.add_parser("publish")
    job.add_argument("readings")
    job.add_argument("clinical")
    job.add_argument("--base", required=True, help="time of the first sample, UTC")
    job.add_argument("--path", help="write files instead of Kafka")
    job.add_argument("--aside", help="folder for rejected cases, readings and messages")
    job.add_argument("--progress", help="shared folder of staged messages and blocks sent; by default one that follows from the inputs")
    job.add_argument("--blocks-per-job", type=int, default=1, help="blocks of an hour that are written at once")
    job.set_defaults(run=publish_samples)
    job = jobs.add_parser("replay")
    job.add_argument("topic_path")
    job.add_argument("--base", required=True, help="time of the first sample, UTC")
    job.add_argument("--path", help="write files instead of Kafka")
    job.add_argument("--unsent", help="folder for messages without a place in the replay")
    job.add_argument("--dead-letters", help="folder for what could not be sent")
    job.add_argument("--checkpoint", help="shared folder; by default one that follows from topic and sink")
    job.set_defaults(run=replay)
    job = jobs.add_parser("score")
    job.add_argument("--topic-path", help="read files instead of Kafka")
    job.add_argument("--path", help="write files instead of the search index")
    job.add_argument("--quarantine", help="folder for the rows that cannot be scored")
    job.add_argument("--dead-letters", help="folder for batches that could not be written")
    job.add_argument("--checkpoint", help="shared folder; by default one that follows from topic and sink")
    job.add_argument("--once", action="store_true", help="stop when all present messages are scored")
    job.set_defaults(run=score_topic)
    job = jobs.add_parser("redeliver")
    job.add_argument("--topic-path", help="topic of the scoring job, if files")
    job.add_argument("--path", help="files of the scoring job instead of the search index")
    job.add_argument("--quarantine", help="as for the scoring job")
    job.add_argument("--dead-letters", help="as for the scoring job")
    job.add_argument("--checkpoint", help="as for the scoring job")
    job.set_defaults(run=redeliver_scored)
    job = jobs.add_parser("watch")
    job.add_argument("out")
    job.add_argument("--topic-path", help="read files instead of Kafka")
    job.add_argument("--clinical", help="clinical CSV to take each case's attributes from")
    job.add_argument("--delay-seconds", type=int, default=7200, help="how far arrival may lag behind event time")
    job.add_argument("--bucket", default="1 minute", help="width of a trend bucket")
    job.add_argument("--reach", default="5 minutes", help="reach of the gauge")
    job.add_argument("--slide", default="1 minute", help="time between two values of the gauge")
    job.add_argument("--checkpoint", help="shared folder; by default one that follows from topic and output")
    job.add_argument("--once", action="store_true", help="stop when all present messages are handled")
    job.set_defaults(run=watch_topic)
    job = jobs.add_parser("monitor")
    job.add_argument("scored")
    job.add_argument("out")
    job.add_argument("--bucket", default="1 minute", help="width of a trend bucket; it must divide a day")
    job.add_argument("--recent-seconds", type=int, default=300, help="reach of the gauge")
    job.set_defaults(run=monitor)
    return root


def main(argv=None):
    args = parser().parse_args(argv)
    spark = use_utc(SparkSession.builder.appName(f"pulsegrid-{args.job}").getOrCreate())
    try:
        args.run(spark, JobSettings.from_env(), args)
    finally:
        remove_made(spark)


if __name__ == "__main__":
    main()
