"""One query per operator over the given tables; ``QUERIES`` maps its name to ``(spark, sf_dir) -> DataFrame``."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .functions import as_double, as_float, as_int, round_half_up, round_to_int, round_to_tenth, slot_start
from .functions import risk as R
from .operators import clinical as C
from .operators import grid as G
from .operators import impute as I
from .operators import labels as L
from .operators import messages as M
from .operators import metrics as Q
from .operators import monitor as V
from .operators.columns import keys_first, numeric_columns, rename_columns
from .operators.enrich import derive, enrich
from .operators.quarantine import quarantined
from .operators.routing import union_inputs
from .plans import dashboard
from .plans import prepare as P
from .plans import training as T
from .plans.publish import publish
from .plans.scoring import score_enriched
from .schemas import (ENCODED_LABEL, ENVELOPE_SCHEMA, FLOAT_COLUMNS, HIGH_RISK, LABEL, LOW_RISK, MESSAGE_COLUMNS,
                      SCORED_COLUMNS, TRAINING_SCHEMA, VITALS)
from .session import new_dir, stored, use_utc
from .sources import standins as S
from .sources.files import read_clinical, read_readings, read_training, write_training
from .sources.models import load_model, save_model
from .sources.topics import read_topic
from .streaming import arrivals, delivery, monitor, replay, scoring, watch
from .streaming.commits import Committed, commits, read_committed

QUERIES = {}
TRIGGER = {"availableNow": True}


def query(build):
    def run(spark, sf_dir):
        return build(use_utc(spark), sf_dir)

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return run


# ---- Inputs ----

def readings(spark, sf_dir):
    return S.event_readings(S.table(spark, sf_dir, "events"))


def clinical(spark, sf_dir):
    return S.customer_clinical(S.table(spark, sf_dir, "customer"))


def samples(spark, sf_dir):
    return P.prepare(readings(spark, sf_dir), clinical(spark, sf_dir), S.BASE, S.STEP_SECONDS)


def enriched(spark, sf_dir):
    return enrich(samples(spark, sf_dir))


def timed(spark, sf_dir):
    return V.with_event_time(enriched(spark, sf_dir))


def documents(spark, sf_dir):
    return S.labelled_documents(S.table(spark, sf_dir, "documents"), S.table(spark, sf_dir, "labels"))


def rule_predictions(spark, sf_dir):
    rows = S.rule_predictions(S.table(spark, sf_dir, "documents"), S.table(spark, sf_dir, "labels"))
    return L.index_labels(rows)


#: Messages of two days are published together; a stream waits for as long, and a window more.
TOPIC_BLOCK_SECONDS = 2 * 86400
DELAY = "3 days"
ONE_FILE = {"maxFilesPerTrigger": 1}


def topic(spark, sf_dir, options=None, times=1):
    """All prepared samples as a published topic, read as a stream; ``times`` over, if asked for."""
    return topic_of(stored(samples(spark, sf_dir), "samples"), options, times)


def topic_of(rows, options=None, times=1):
    path = new_dir(rows.sparkSession, "topic")
    for _ in range(times):
        publish(rows, "parquet", path=path, block_seconds=TOPIC_BLOCK_SECONDS)
    return read_topic(rows.sparkSession, "parquet", options, path)


def vital_model(rows):
    return T.fit_risk_model(S.training_rows(rows))


def scored_table(spark, sf_dir):
    """Enriched samples with event time as a stored table, which is what a dashboard reads."""
    return stored(timed(spark, sf_dir), "documents")


def at_slot(rows, *columns):
    """Slot number to its start time, without zone so that it compares as written."""
    start = slot_start(F.col("slot"), S.STEP_SECONDS).cast("timestamp_ntz")
    return rows.select("caseid", start.alias("slot_start"), *columns)


def finish(streaming_query):
    streaming_query.awaitTermination()


# ---- Prepare ----

@query
def grid_downsample(spark, sf_dir):
    """Last reading per case, slot and track."""
    return at_slot(G.resample(readings(spark, sf_dir), S.STEP_SECONDS), *VITALS)


@query
def grid_fill_gaps(spark, sf_dir):
    """The complete grid of each case, empty slots included."""
    rows = readings(spark, sf_dir)
    grid = G.grid_rows(G.case_extent(rows, S.STEP_SECONDS))
    return at_slot(G.resample(rows, S.STEP_SECONDS, grid), *VITALS)


@query
def trim_quarters(spark, sf_dir):
    """The middle half of each case, with its row count before the trim."""
    rows, kept = P.trimmed_samples(readings(spark, sf_dir), S.STEP_SECONDS)
    return at_slot(G.attach_case_values(rows, kept), "n_slots", *VITALS)


@query
def case_means(spark, sf_dir):
    """Mean of each vital over the trimmed rows of a case."""
    rows, _ = P.trimmed_samples(readings(spark, sf_dir), S.STEP_SECONDS)
    return I.case_means(rows, VITALS).drop("stay")


@query
def mean_impute(spark, sf_dir):
    """Gaps in numeric columns filled with the case's mean."""
    rows, kept = P.trimmed_samples(readings(spark, sf_dir), S.STEP_SECONDS)
    columns = numeric_columns(rows, leave_out=["slot", "stay", "origin", "block"])
    case_values = kept.join(I.case_means(rows, columns), ["caseid", "stay"])
    return at_slot(I.fill_with_means(G.attach_case_values(rows, case_values), columns), *VITALS)


@query
def round_modes(spark, sf_dir):
    """The three roundings."""
    value = F.col("value")
    return S.table(spark, sf_dir, "events").select(
        "event_id", round_to_tenth(value).alias("tenth"), round_to_int(value).alias("whole"),
        round_half_up(value / 3).alias("hundredth"))


@query
def sequence_stamp(spark, sf_dir):
    """Time stamps from a base, one step per kept row."""
    rows, _ = P.trimmed_samples(readings(spark, sf_dir), S.STEP_SECONDS)
    text = P.iso_millis(P.sample_time(S.BASE, S.STEP_SECONDS))
    return at_slot(rows, text.alias("timestamp"))


@query
def clinical_lookup(spark, sf_dir):
    """Clinical attributes on every sample of the case."""
    rows, kept = P.trimmed_samples(readings(spark, sf_dir), S.STEP_SECONDS)
    attributes = C.first_per_case(C.select_cases(clinical(spark, sf_dir)))
    return at_slot(G.attach_case_values(rows, kept.join(attributes, "caseid")), "age", "sex", "height", "weight")


@query
def unknown_case_anti(spark, sf_dir):
    """Monitored cases without a clinical row; here the supplier table plays the clinical table."""
    known = S.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("caseid"))
    return C.unknown_cases(readings(spark, sf_dir), known)


@query
def rename_reorder(spark, sf_dir):
    """Readable names, key columns first."""
    customer = S.table(spark, sf_dir, "customer")
    rows = S.customer_clinical(customer).select("weight", "height", "sex", "age", "caseid")
    return keys_first(rename_columns(rows))


@query
def prepared_samples(spark, sf_dir):
    """The whole preparation: message-ready samples."""
    return samples(spark, sf_dir)


# ---- Odd inputs ----

def odd_readings(spark, sf_dir):
    """Readings with NaN, values no vital has, and a few wrong years."""
    n = F.col("seq") % 50
    pulse = F.col("track") == "Solar8000/HR"
    value = (F.when(pulse & (n == 1), F.lit(float("nan"))).when(pulse & (n == 2), 1e12).when(pulse & (n == 3), 3e9)
             .otherwise(F.col("value")))
    t = F.when(F.col("seq") % 400 == 7, F.col("t") - F.expr("INTERVAL 60 YEARS")).otherwise(F.col("t"))
    return readings(spark, sf_dir).withColumns({"value": value, "t": t})


@query
def prepare_with_bad_values(spark, sf_dir):
    """The preparation over readings of which some are NaN, far too large or sixty years early."""
    rows = odd_readings(spark, sf_dir)
    return P.prepare(rows, clinical(spark, sf_dir), S.BASE, S.STEP_SECONDS)


@query
def trend_with_bad_values(spark, sf_dir):
    """Daily trends of messages whose heart rate is, for some cases, NaN or a huge number."""
    n = F.col("caseid").cast("long") % 5
    pulse = F.when(n == 0, "NaN").when(n == 1, "1e12").when(n == 2, "3e9").otherwise(F.col("Heart Rate"))
    rows = M.decode(M.encode(samples(spark, sf_dir))).withColumn("Heart Rate", pulse)
    return zoneless(V.trend(V.with_event_time(enrich(rows)), "1 day"), "window_start")


@query
def grid_outlier_times(spark, sf_dir):
    """Rows of each case's grid and its readings set aside, where some readings are sixty years early."""
    rows = odd_readings(spark, sf_dir)
    extent = G.case_extent(rows, S.STEP_SECONDS)
    far = G.outlying_readings(rows, S.STEP_SECONDS).groupBy("caseid").agg(F.count("*").alias("n_far"))
    n = F.col("last_slot") - F.col("first_slot") + 1
    return extent.join(far, "caseid", "left").select("caseid", n.alias("n_slots"), F.coalesce("n_far", F.lit(0)).alias("n_far"))


@query
def row_accounting(spark, sf_dir):
    """Readings by what became of them, out of one classification; the parts sum to all readings with a value."""
    known = clinical(spark, sf_dir).where(F.col("caseid").cast("long") % 7 != 0)
    return P.fates(odd_readings(spark, sf_dir), known, S.STEP_SECONDS).groupBy("fate").agg(F.count("*").alias("n"))


def two_stays(spark, sf_dir):
    """Readings of which every case has a second stay, four hundred days after the first one."""
    later = F.when(F.col("seq") % 2 == 0, F.col("t") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("t"))
    return readings(spark, sf_dir).withColumn("t", later)


@query
def grid_two_stays(spark, sf_dir):
    """Cases with two stays: each has its own grid, trim and means, and time stamps go on from one to the next."""
    rows, kept = P.trimmed_samples(two_stays(spark, sf_dir), S.STEP_SECONDS)
    values = kept.join(I.case_means(rows, VITALS), ["caseid", "stay"])
    text = P.iso_millis(P.sample_time(S.BASE, S.STEP_SECONDS))
    filled = I.fill_with_means(G.attach_case_values(rows, values), VITALS)
    return at_slot(filled, "stay", "n_slots", text.alias("timestamp"), *VITALS)


@query
def two_stays_accounting(spark, sf_dir):
    """Nothing of a case with two stays is set aside but single readings with a wrong year."""
    early = F.when(F.col("seq") % 400 == 7, F.col("t") - F.expr("INTERVAL 60 YEARS")).otherwise(F.col("t"))
    rows = P.fates(two_stays(spark, sf_dir).withColumn("t", early), clinical(spark, sf_dir), S.STEP_SECONDS)
    return rows.groupBy("caseid", "fate").agg(F.count("*").alias("n"))


@query
def clinical_csv_lookup(spark, sf_dir):
    """Clinical rows from a folder of files with ids like 007 and repeats, for the cases that have readings."""
    rows = clinical(spark, sf_dir)
    path = new_dir(spark, "clinical-csv")
    padded = rows.withColumn("caseid", F.lpad("caseid", 9, "0"))
    later = rows.where(F.col("caseid").cast("long") % 3 == 0).withColumn("age", F.lit("99"))
    for part in (padded, later):
        part.repartition(3).write.option("header", True).mode("append").csv(path)
    asked = S.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("caseid"))
    return C.first_per_case(C.select_cases(read_clinical(spark, path), asked))


@query
def read_tracks(spark, sf_dir):
    """A long table with other tracks and NaN, read as readings."""
    path = new_dir(spark, "tracks")
    rows = readings(spark, sf_dir)
    other = rows.where(F.col("seq") % 3 == 0).withColumn("track", F.lit("Solar8000/OTHER"))
    nan = F.when(F.col("seq") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    rows.withColumn("value", nan).unionByName(other).write.parquet(path)
    return read_readings(spark, path).groupBy("caseid", "track").agg(
        F.count("*").alias("n"), F.count("value").alias("n_values"), F.max("value").alias("high"))


# ---- Publish and decode ----

@query
def publish_route(spark, sf_dir):
    """Messages published to files, read back with their place: the block of time and the position inside the case."""
    path = new_dir(spark, "topic")
    publish(samples(spark, sf_dir), "parquet", path=path, block_seconds=TOPIC_BLOCK_SECONDS)
    sent = spark.read.schema(ENVELOPE_SCHEMA).parquet(path)
    rows = M.decode(sent).select(*MESSAGE_COLUMNS)
    place = Window.partitionBy("caseid").orderBy("timestamp")
    return rows.withColumn("position", F.row_number().over(place) - 1)


@query
def multi_patient_union(spark, sf_dir):
    """Several inputs with differing column order as one."""
    rows = readings(spark, sf_dir)
    oxygen = F.col("track") == "Solar8000/PLETH_SPO2"
    first = rows.where(~oxygen)
    second = rows.where(oxygen).select("value", "seq", "t", "track", "caseid")
    return union_inputs(first, second).groupBy("caseid").agg(
        F.count("*").alias("n_readings"), F.min("t").cast("timestamp_ntz").alias("first_t"),
        F.max("t").cast("timestamp_ntz").alias("last_t"), F.max("value").alias("high"))


@query
def json_roundtrip(spark, sf_dir):
    """Samples to JSON messages and back to text columns."""
    return M.decode(M.encode(samples(spark, sf_dir))).select(*MESSAGE_COLUMNS)


@query
def scan_csv_roundtrip(spark, sf_dir):
    """Training rows written as a header CSV and read with the declared types."""
    path = new_dir(spark, "training-csv")
    write_training(S.training_rows(enriched(spark, sf_dir)), path)
    return read_training(spark, path).select(*TRAINING_SCHEMA.names)


@query
def safe_cast(spark, sf_dir):
    """Text to number, unreadable text as NULL."""
    key = F.get_json_object("props", "$.k")
    return S.table(spark, sf_dir, "events").select(
        "event_id", as_int(key).alias("k_int"), as_double(key).alias("k_double"),
        as_double(F.col("props")).alias("props_double"), as_int(F.col("event_type")).alias("type_int"),
        as_float(F.col("value").cast("string")).alias("value_float"))


# ---- Enrich ----

@query
def derived_vitals(spark, sf_dir):
    """Pulse pressure, body-mass index and mean arterial pressure."""
    return derive(samples(spark, sf_dir)).select(
        "caseid", "timestamp", "Derived_Pulse_Pressure", "Derived_BMI", "Derived_MAP")


@query
def enrich_cast_float(spark, sf_dir):
    """Twelve columns as FLOAT after the derivation."""
    return enriched(spark, sf_dir).select("caseid", "Gender", "timestamp", *FLOAT_COLUMNS)


@query
def quarantine_reasons(spark, sf_dir):
    """Rows that cannot be scored, each with its reason; gaps are left unfilled here."""
    rows, kept = P.trimmed_samples(readings(spark, sf_dir), S.STEP_SECONDS)
    attributes = C.first_per_case(C.select_cases(clinical(spark, sf_dir)))
    rows = rename_columns(G.attach_case_values(rows, kept.join(attributes, "caseid")))
    rows = rows.withColumn("timestamp", P.iso_millis(P.sample_time(S.BASE, S.STEP_SECONDS)))
    decoded = M.decode(M.encode(rows))
    return quarantined(enrich(decoded)).select("caseid", "timestamp", "reason")


# ---- Train and evaluate ----

@query
def label_index(spark, sf_dir):
    """Label position by falling frequency."""
    risk = F.when(F.col("quality") == 1, LOW_RISK).when(F.col("quality") == 0, HIGH_RISK)
    rows = S.table(spark, sf_dir, "labels").select("doc_id", risk.alias(LABEL))
    return L.index_labels(L.with_label(rows)).select("doc_id", LABEL, ENCODED_LABEL)


@query
def hash_split(spark, sf_dir):
    """Training and test rows by a hash of the key."""
    training, test = L.hash_split(S.table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])
    return (training.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


@query
def ml_features(spark, sf_dir):
    """The assembled feature vector, element by element."""
    vectors = T.assembler(S.TEXT_FEATURES).transform(documents(spark, sf_dir))
    values = vector_to_array(F.col("features"))
    return vectors.select("doc_id", *[values[i].alias(c) for i, c in enumerate(S.TEXT_FEATURES)])


@query
def confusion_matrix(spark, sf_dir):
    """Counts per label and prediction."""
    return Q.confusion_matrix(rule_predictions(spark, sf_dir), ENCODED_LABEL)


@query
def ml_metrics(spark, sf_dir):
    """Accuracy, weighted precision and weighted recall."""
    row = T.evaluate(rule_predictions(spark, sf_dir))
    return row.select(*[F.round(c, 9).alias(c) for c in row.columns])


@query
def topk_preview(spark, sf_dir):
    """The first ten predictions."""
    return T.preview(rule_predictions(spark, sf_dir), ["doc_id", LABEL, ENCODED_LABEL, "prediction"], ["doc_id"])


@query
def ml_score_batch(spark, sf_dir):
    """Fit on the training rows, save, load, score the held-out rows, and compare with the model that was saved."""
    rows = T.complete_rows(stored(documents(spark, sf_dir), "training"), S.TEXT_FEATURES)
    training, test = L.hash_split(rows, ["doc_id"])
    path = new_dir(spark, "model")
    fitted = T.fit_risk_model(training, S.TEXT_FEATURES)
    save_model(fitted, path)
    model = load_model(path)
    before = fitted.transform(test).select("doc_id", F.col("prediction").alias("before"))
    scored = model.transform(test).join(before, "doc_id")
    text = R.risk_label(F.col("prediction"), T.labels_of(model))
    return scored.select("doc_id", LABEL, text.isin(*T.labels_of(model)).alias("known_label"),
                         (F.col("prediction") == F.col("before")).alias("same_as_before_saving"))


@query
def ml_importances(spark, sf_dir):
    """Importance of each model input: all are named, none is negative, and they sum to one."""
    model, _ = T.train_and_test(documents(spark, sf_dir), ["doc_id"], S.TEXT_FEATURES)
    found = T.importances(spark, model, S.TEXT_FEATURES)
    total = F.round(F.sum("importance").over(Window.partitionBy()), 9)
    return found.select("feature", (F.col("importance") >= 0).alias("valid"), total.alias("total"))


# ---- Score ----

@query
def risk_label(spark, sf_dir):
    """Prediction to risk text, by label order and by position."""
    value = F.col("value")
    prediction = F.when(value < 50, 0.0).when(value < 100, 1.0).when(value < 200, 2.0)
    return S.table(spark, sf_dir, "events").select(
        "event_id", R.risk_label(prediction, [HIGH_RISK, LOW_RISK]).alias("risk"),
        R.risk_label_by_position(prediction).alias("risk_by_position"))


# ---- Monitor ----

def ruled(spark, sf_dir):
    """Risk text from a fixed rule in the place of a model."""
    rule = F.when(F.col("Derived_MAP") > 50, HIGH_RISK).when(F.col("Derived_MAP").isNotNull(), LOW_RISK)
    return enriched(spark, sf_dir).withColumn("Risk Predicted", rule)


@query
def risk_share(spark, sf_dir):
    """Count and share of each risk text per case."""
    return V.risk_share(ruled(spark, sf_dir))


@query
def risk_share_overall(spark, sf_dir):
    """Count and share of each risk text over all records."""
    return V.risk_share(ruled(spark, sf_dir), keys=())


def zoneless(rows, *columns):
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query
def gauge_recent_mean(spark, sf_dir):
    """Mean of each vital over each case's last two days."""
    return zoneless(V.recent_means(scored_table(spark, sf_dir), 2 * 86400), "latest")


@query
def gauge_bands(spark, sf_dir):
    """The same with its colour."""
    return zoneless(V.with_bands(V.recent_means(scored_table(spark, sf_dir), 2 * 86400)), "latest")


@query
def trend_tumbling(spark, sf_dir):
    """Mean, low, high and count of each vital per day."""
    return zoneless(V.trend(timed(spark, sf_dir), "1 day"), "window_start")


@query
def trend_sliding(spark, sf_dir):
    """Mean of each vital over a day, every 12 hours."""
    return zoneless(V.sliding_means(timed(spark, sf_dir), "1 day", "12 hours"), "window_start")


# ---- Streams ----

@query
def stream_decode_enrich(spark, sf_dir):
    """A topic decoded and enriched as a stream."""
    rows = enrich(M.decode(topic(spark, sf_dir)))
    path = new_dir(spark, "enriched")
    finish(delivery.start_append(rows, "parquet", new_dir(spark, "progress"), path=path, trigger=TRIGGER))
    return spark.read.schema(rows.schema).parquet(path).select("caseid", "Gender", "timestamp", *FLOAT_COLUMNS)


def plain_scored(rows):
    """Scored documents with, in the place of the model's text, whether it is one of the two labels."""
    return rows.select(*SCORED_COLUMNS[:-1], F.col("Risk Predicted").isin(HIGH_RISK, LOW_RISK).alias("known_label"))


@query
def stream_restart_scores_once(spark, sf_dir):
    """A scoring job that is stopped, finds new files and starts again: every document once, by its id."""
    rows = stored(samples(spark, sf_dir), "samples")
    model = vital_model(stored(enrich(rows), "training"))
    at = {name: new_dir(spark, name) for name in ("topic", "scored", "aside", "dead", "progress")}
    for half in (0, 1):
        publish(rows.where(F.col("caseid").cast("long") % 2 == half), "parquet", path=at["topic"],
                block_seconds=TOPIC_BLOCK_SECONDS)
        for _ in range(2):
            finish(scoring.start_scoring_job(
                read_topic(spark, "parquet", path=at["topic"]), model, Committed(at["scored"]), at["aside"],
                at["dead"], at["progress"], TRIGGER))
    return scored_documents(spark, at["scored"])


def scored_documents(spark, path):
    return read_committed(spark, path).select("document_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))


@query
def stream_new_checkpoint_keeps_documents(spark, sf_dir):
    """Two scoring jobs with checkpoints of their own, each restarted, write to the same folders: all documents stay, each once."""
    rows = stored(samples(spark, sf_dir), "samples")
    model = vital_model(stored(enrich(rows), "training"))
    at = {name: new_dir(spark, name) for name in ("scored", "aside", "dead")}
    for half in (0, 1):
        stream, progress = topic_of(rows.where(F.col("caseid").cast("long") % 2 == half)), new_dir(spark, "progress")
        for _ in range(2):
            finish(scoring.start_scoring_job(stream, model, Committed(at["scored"], by_date=True), at["aside"], at["dead"],
                                             progress, TRIGGER))
    return scored_documents(spark, at["scored"])


@query
def stream_bad_record(spark, sf_dir):
    """A sink that refuses some records: these alone go to the dead letters, and are delivered again when it takes them."""
    at = {name: new_dir(spark, name) for name in ("sent", "dead", "progress")}
    refused = (F.col("caseid").cast("long") % 500 == 7) & F.col("timestamp").startswith("2025-02-11T10:00:00")

    def writer(refuses, run=None):
        sink = Committed(at["sent"], run)
        error = F.when(refused & F.lit(refuses), F.raise_error(F.lit("record refused"))).otherwise(F.col("caseid"))

        def write(batch, batch_id, part=""):
            rows = M.decode(batch).select("caseid", "timestamp")
            sink(rows.withColumn("caseid", error), batch_id, part)

        return write

    finish(delivery.start_foreach_batch(topic(spark, sf_dir), delivery.deliver(writer(True), at["dead"], 1, 0), at["progress"],
                                        trigger=TRIGGER))
    before = stored(commits(spark, at["sent"]), "commits")
    first = read_committed(spark, at["sent"], log=before).select("caseid", "timestamp", F.lit("delivered").alias("fate"))
    delivery.redeliver(spark, at["dead"], writer(False, "redelivered"), StructType([*ENVELOPE_SCHEMA.fields, StructField("reason", StringType())]), 1, 0)
    later = commits(spark, at["sent"]).join(before.select("attempt"), "attempt", "left_anti")
    again = read_committed(spark, at["sent"], first.select("caseid", "timestamp").schema, later)
    return first.unionByName(again.select("caseid", "timestamp", F.lit("redelivered").alias("fate")))


@query
def replay_ticks(spark, sf_dir):
    """Messages replayed along a clock that is moved by hand: each at its tick, in order of its place in the case."""
    at = {name: new_dir(spark, name) for name in ("replay", "clock", "sent", "progress")}
    replay.write_replay_table(M.encode(samples(spark, sf_dir)), at["replay"], S.BASE, S.STEP_SECONDS, ticks_per_block=16)
    last = spark.read.parquet(at["replay"]).agg(F.max("tick")).first()[0]
    sink = Committed(at["sent"])
    for first in range(0, last + 1, 16):
        replay.move_clock(spark, at["clock"], first, first + 15)
        finish(replay.start_replay(spark, at["replay"], sink, at["progress"], S.STEP_SECONDS, ticks_per_block=16,
                                   clock=replay.file_clock(spark, at["clock"]), trigger=TRIGGER))
    rows = read_committed(spark, at["sent"]).select(F.col("key").cast("string").alias("caseid"), "tick", "batch")
    return rows.select("caseid", "tick", (F.row_number().over(Window.partitionBy("caseid").orderBy("batch", "tick")) - 1).alias("place"))


@query
def stream_score_append(spark, sf_dir):
    """A topic scored as a stream and appended to a table."""
    rows = stored(samples(spark, sf_dir), "samples")
    model = vital_model(stored(enrich(rows), "training"))
    path = new_dir(spark, "scored")
    finish(scoring.start_scoring(topic_of(rows), model, "parquet", new_dir(spark, "progress"), path=path,
                                 trigger=TRIGGER))
    return plain_scored(spark.read.parquet(path))


def _updates(spark, aggregates, keys):
    path = new_dir(spark, "updates")
    finish(monitor.start_updates(aggregates, path, new_dir(spark, "progress"), TRIGGER))
    return monitor.latest_updates(spark, path, keys)


@query
def stream_trend(spark, sf_dir):
    """Daily trend of a topic, a file per micro-batch."""
    rows = V.with_event_time(enrich(M.decode(topic(spark, sf_dir, ONE_FILE))))
    latest = _updates(spark, monitor.trend_stream(rows, "1 day", DELAY), ["caseid", "window_start", "vital"])
    return zoneless(latest, "window_start")


@query
def stream_gauge(spark, sf_dir):
    """Sliding mean of a topic, a file per micro-batch."""
    rows = V.with_event_time(enrich(M.decode(topic(spark, sf_dir, ONE_FILE))))
    latest = _updates(spark, monitor.gauge_stream(rows, "1 day", "12 hours", DELAY), ["caseid", "window_start", "vital"])
    return zoneless(latest, "window_start")


@query
def stream_drop_repeats(spark, sf_dir):
    """A topic in which every message was sent twice, in differing micro-batches, each kept once."""
    once = arrivals.drop_repeats(arrivals.decoded_with_time(topic(spark, sf_dir, ONE_FILE, times=2)), DELAY)
    out = new_dir(spark, "once")
    finish(delivery.start_append(once.select(*MESSAGE_COLUMNS), "parquet", new_dir(spark, "progress"), path=out,
                                 trigger=TRIGGER, stateful=True))
    return spark.read.parquet(out)


#: Messages of so long before the end are held back, and come behind the watermark.
HELD_BACK_SECONDS, DELAY_SECONDS = 4 * 86400, 3 * 86400


def watched(spark, sf_dir):
    """(folder, rows): the live monitor over a topic in which old messages of every fourth case come after all others, a file per batch."""
    rows = stored(samples(spark, sf_dir), "samples")
    timed_rows = V.with_event_time(rows)
    end = timed_rows.agg(F.max(F.unix_seconds("event_ts"))).first()[0]
    held = (F.col("caseid").cast("long") % 4 == 0) & (F.unix_seconds("event_ts") < F.lit((end or 0) - HELD_BACK_SECONDS))
    at = {name: new_dir(spark, name) for name in ("topic", "watch", "progress")}
    for part in (~held, held):
        publish(timed_rows.where(part).drop("event_ts"), "parquet", path=at["topic"], block_seconds=TOPIC_BLOCK_SECONDS)
    watch.watch(read_topic(spark, "parquet", ONE_FILE, at["topic"]), at["watch"], at["progress"], DELAY_SECONDS, "1 day", "1 day",
                "12 hours", clinical(spark, sf_dir), TRIGGER)
    return at["watch"], rows


@query
def stream_late_rows(spark, sf_dir):
    """Every message of a topic either kept by the live monitor or set aside as late; together they are all that were sent."""
    path, _ = watched(spark, sf_dir)
    kept = spark.read.schema(watch.ROW_SCHEMA).parquet(f"{path}/{watch.ONCE}").select("caseid", "timestamp", F.lit("kept").alias("fate"))
    late = read_committed(spark, f"{path}/{watch.ASIDE}").select("caseid", "timestamp", F.col("reason").alias("fate"))
    return kept.unionByName(late)


@query
def watch_trend(spark, sf_dir):
    """The live monitor's daily trend, over the messages in time."""
    path, _ = watched(spark, sf_dir)
    return zoneless(monitor.latest_updates(spark, f"{path}/{watch.TREND}", ["caseid", "window_start", "vital"]), "window_start")


def refreshed(spark, sf_dir):
    """Dashboard tables of scored documents that came in two parts, refreshed after each; a third of the cases came twice."""
    rows = stored(V.with_event_time(delivery.document_id(ruled(spark, sf_dir))), "scored")
    scored, out = new_dir(spark, "scored"), new_dir(spark, "dashboard")
    number = F.col("caseid").cast("long")
    for no, part in enumerate((number % 3 != 0, number % 3 != 1)):
        Committed(scored, run=f"part-{no}", by_date=True)(rows.where(part), 0)
        dashboard.refresh(spark, scored, out, "12 hours", 86400, 3600)
    return out


@query
def monitor_rollup(spark, sf_dir):
    """The trend out of rollups, after two refreshes."""
    trend = spark.read.parquet(f"{refreshed(spark, sf_dir)}/trend").drop("event_date")
    return zoneless(trend, "window_start")


@query
def monitor_rollup_now(spark, sf_dir):
    """Gauge and risk share out of rollups, after two refreshes, one row per case, measure and name."""
    out = refreshed(spark, sf_dir)
    gauge = spark.read.parquet(f"{out}/gauge").select("caseid", F.lit("gauge").alias("measure"), F.col("vital").alias("name"), F.col("mean").alias("value"))
    share = spark.read.parquet(f"{out}/risk_share").select("caseid", F.lit("share").alias("measure"), F.col("Risk Predicted").alias("name"),
                                                           F.col("share").alias("value"))
    return gauge.unionByName(share)


@query
def stream_clinical_join(spark, sf_dir):
    """Clinical attributes attached to a topic after publishing."""
    attributes = C.first_per_case(C.select_cases(clinical(spark, sf_dir)))
    rows = arrivals.attach_clinical(M.decode(topic(spark, sf_dir)).select("caseid", "timestamp"), attributes)
    path = new_dir(spark, "attached")
    finish(delivery.start_append(rows, "parquet", new_dir(spark, "progress"), path=path, trigger=TRIGGER))
    return spark.read.parquet(path)


@query
def flagship(spark, sf_dir):
    """Prepare, enrich, train, score, and the risk share of each case."""
    rows = stored(enriched(spark, sf_dir), "enriched")
    return V.risk_share(score_enriched(rows, vital_model(rows)))
