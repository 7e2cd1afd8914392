"""DuckDB counterparts of the queries, written from the definitions and not from the Spark plans: positions by
``row_number``, gaps by ``generate_series`` and a left join, means joined per case."""

DBP, SBP, HR, BT, RR, SPO2 = (
    '"Diastolic Blood Pressure"', '"Systolic Blood Pressure"', '"Heart Rate"', '"Body Temperature"',
    '"Respiratory Rate"', '"Oxygen Saturation"')
VITALS = [DBP, SBP, HR, BT, RR, SPO2]
TRACKS = {"view": DBP, "purchase": SBP, "click": HR, "error": BT, "signup": RR, "oxygen": SPO2}
ALL_VITALS = ", ".join(VITALS)


def exact_mean(c):
    return f"CAST(sum(CAST({c} AS DECIMAL(18,9))) AS DOUBLE) / nullif(count({c}), 0)"


def prefixed(prefix, column):
    return f'"{prefix} {column[1:]}'


def each(template, sep=", "):
    return sep.join(template.format(c=c, m=prefixed("mean", c)) for c in VITALS)


READINGS = """
readings AS (
  SELECT CAST(user_id AS VARCHAR) AS caseid, event_id AS seq, ts AS t, event_type AS track, value FROM events
  UNION ALL
  SELECT CAST(user_id AS VARCHAR), event_id, ts, 'oxygen', TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)
  FROM events)"""

WIDE = READINGS + """,
wide AS (
  SELECT caseid, time_bucket(INTERVAL 6 HOUR, t) AS slot_start, """ + ", ".join(
    f"arg_max(value, seq) FILTER (WHERE track = '{t}') AS {c}" for t, c in TRACKS.items()) + """
  FROM readings GROUP BY ALL)"""

FILLED = WIDE + f""",
grid AS (
  SELECT caseid, unnest(generate_series(min(slot_start), max(slot_start), INTERVAL 6 HOUR)) AS slot_start
  FROM wide GROUP BY caseid),
filled AS (SELECT caseid, slot_start, {ALL_VITALS} FROM grid LEFT JOIN wide USING (caseid, slot_start))"""

TRIMMED = FILLED + f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY caseid ORDER BY slot_start) AS rn,
         count(*) OVER (PARTITION BY caseid) AS n_slots FROM filled),
trimmed AS (
  SELECT caseid, slot_start, n_slots, {ALL_VITALS},
         row_number() OVER (PARTITION BY caseid ORDER BY slot_start) - 1 AS i
  FROM numbered WHERE rn > floor(n_slots * 0.25) AND rn <= n_slots - floor(n_slots * 0.25))"""

MEANS = TRIMMED + """,
means AS (SELECT caseid, """ + ", ".join(
    f"{exact_mean(c)} AS {prefixed('mean', c)}" for c in VITALS) + """ FROM trimmed GROUP BY caseid)"""

IMPUTED = MEANS + f""",
imputed AS (
  SELECT caseid, slot_start, i, {each('coalesce({c}, {m}) AS {c}')} FROM trimmed JOIN means USING (caseid))"""

STAMP = """strftime(TIMESTAMP '2025-02-11 10:00:00.123987' + to_hours(CAST(6 * i AS INTEGER)),
           '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"""

CLINICAL = """
clinical AS (
  SELECT CAST(c_custkey AS VARCHAR) AS caseid, CAST(18 + c_custkey % 80 AS VARCHAR) AS age,
         CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'F' ELSE 'M' END AS sex,
         CAST(150 + c_custkey % 50 AS VARCHAR) AS height,
         CAST(CAST(c_acctbal AS DECIMAL(12,2)) * CAST(0.001 AS DECIMAL(4,3)) + 60 AS VARCHAR) AS weight
  FROM customer)"""

PREPARED = IMPUTED + "," + CLINICAL + f""",
prepared AS (
  SELECT caseid, age AS "Age", sex AS "Gender", CAST(height AS DOUBLE) / 100 AS "Height", weight AS "Weight",
         {', '.join(f'CAST(round_even({c}, 0) AS INTEGER) AS {c}' for c in (DBP, SBP, HR))},
         CAST(format('{{:.1f}}', {BT}) AS DOUBLE) AS {BT},
         {', '.join(f'CAST(round_even({c}, 0) AS INTEGER) AS {c}' for c in (RR, SPO2))},
         {STAMP} AS "timestamp"
  FROM imputed JOIN clinical USING (caseid))"""

DERIVED = PREPARED + f""",
derived AS (
  SELECT *, round(CAST({SBP} AS DOUBLE) - CAST({DBP} AS DOUBLE), 2) AS "Derived_Pulse_Pressure",
         round(CAST("Weight" AS DOUBLE) / nullif(pow("Height", 2), 0), 2) AS "Derived_BMI",
         round(CAST({DBP} AS DOUBLE) + (CAST({SBP} AS DOUBLE) - CAST({DBP} AS DOUBLE)) / 3, 2) AS "Derived_MAP"
  FROM prepared)"""

FLOATS = [HR, RR, BT, SPO2, SBP, DBP, '"Age"', '"Weight"', '"Height"', '"Derived_Pulse_Pressure"', '"Derived_BMI"',
          '"Derived_MAP"']

ENRICHED = DERIVED + f""",
enriched AS (
  SELECT caseid, "Gender", "timestamp", {', '.join(f'CAST({c} AS FLOAT) AS {c}' for c in FLOATS)},
         strptime("timestamp", '%Y-%m-%dT%H:%M:%S.%gZ') AS event_ts FROM derived)"""

MESSAGE = f'caseid, "Age", "Gender", "Height", "Weight", {ALL_VITALS}, "timestamp"'


def unpivot(source, extra=""):
    """One row per vital from columns of ``source`` (float columns widened to double)."""
    return " UNION ALL ".join(
        f"SELECT caseid, event_ts{extra}, '{c[1:-1]}' AS vital, CAST({c} AS DOUBLE) AS value FROM {source}" for c in VITALS)


LONG = ENRICHED + f", vital_rows AS ({unpivot('enriched')})"

GAUGE = LONG + f""",
latest_rows AS (SELECT caseid, max(event_ts) AS latest FROM enriched GROUP BY caseid),
gauge AS (
  SELECT caseid, latest, vital, {exact_mean('value')} AS mean
  FROM vital_rows JOIN latest_rows USING (caseid) WHERE event_ts > latest - INTERVAL 2 DAY
  GROUP BY ALL HAVING count(value) > 0)"""

BANDS = {HR: (60, 100, 50, 120), RR: (12, 20, 9, 24), BT: (36.1, 37.5, 35, 38.5), SPO2: (95, 100, 90, 100),
         SBP: (100, 130, 90, 160), DBP: (60, 85, 50, 100)}
BAND_CASE = "CASE " + " ".join(
    f"WHEN vital = '{c[1:-1]}' THEN CASE WHEN mean BETWEEN CAST({a} AS DOUBLE) AND CAST({b} AS DOUBLE) THEN 'green' "
    f"WHEN mean BETWEEN CAST({d} AS DOUBLE) AND CAST({e} AS DOUBLE) THEN 'yellow' ELSE 'red' END"
    for c, (a, b, d, e) in BANDS.items()) + " END"

TUMBLING = f"""WITH {LONG}
SELECT caseid, time_bucket(INTERVAL 1 DAY, event_ts) AS window_start, vital, {exact_mean('value')} AS mean,
       min(value) AS low, max(value) AS high, count(value) AS n
FROM vital_rows GROUP BY ALL HAVING count(value) > 0"""

SLIDING = f"""WITH {LONG},
copies AS (SELECT *, unnest([time_bucket(INTERVAL 12 HOUR, event_ts),
                             time_bucket(INTERVAL 12 HOUR, event_ts) - INTERVAL 12 HOUR]) AS window_start FROM vital_rows)
SELECT caseid, window_start, vital, {exact_mean('value')} AS mean
FROM copies GROUP BY ALL HAVING count(value) > 0"""

FLOAT_ROWS = f'WITH {ENRICHED} SELECT caseid, "Gender", "timestamp", {", ".join(FLOATS)} FROM enriched'

SCORABLE = ['"Age"', HR, RR, BT, SPO2, SBP, DBP, '"Derived_BMI"']

# Readings of the odd inputs that are no measured values.
BAD_VALUE = "(track = 'click' AND seq % 50 IN (1, 2, 3))"


def without_bad(ctes):
    """The same definitions over readings that have a measured value and a right year."""
    return ctes.replace("readings AS (", "all_readings AS (", 1).replace(
        "wide AS (", f"readings AS (SELECT * FROM all_readings WHERE NOT {BAD_VALUE} AND seq % 400 <> 7),\nwide AS (", 1)


# Every case with a second stay 400 days later; each stay is numbered, filled, trimmed and averaged for itself.
TWO_STAYS = READINGS + """,
moved AS (SELECT caseid, seq, track, value, 1 - seq % 2 AS stay, t + to_days(CAST(400 * (1 - seq % 2) AS INTEGER)) AS t FROM readings),
wide AS (
  SELECT caseid, stay, time_bucket(INTERVAL 6 HOUR, t) AS slot_start, """ + ", ".join(
    f"arg_max(value, seq) FILTER (WHERE track = '{t}') AS {c}" for t, c in TRACKS.items()) + f"""
  FROM moved GROUP BY ALL),
grid AS (
  SELECT caseid, stay, unnest(generate_series(min(slot_start), max(slot_start), INTERVAL 6 HOUR)) AS slot_start
  FROM wide GROUP BY caseid, stay),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY caseid, stay ORDER BY slot_start) AS rn,
         count(*) OVER (PARTITION BY caseid, stay) AS n_slots FROM grid LEFT JOIN wide USING (caseid, stay, slot_start)),
stamped AS (
  SELECT *, row_number() OVER (PARTITION BY caseid ORDER BY slot_start) - 1 AS i
  FROM numbered WHERE rn > floor(n_slots * 0.25) AND rn <= n_slots - floor(n_slots * 0.25)),
means AS (SELECT caseid, stay, """ + ", ".join(
    f"{exact_mean(c)} AS {prefixed('mean', c)}" for c in VITALS) + """ FROM stamped GROUP BY ALL)"""

TRACK_NAME = ("CASE track WHEN 'view' THEN 'Solar8000/ART_DBP' WHEN 'purchase' THEN 'Solar8000/ART_SBP' "
              "WHEN 'click' THEN 'Solar8000/HR' WHEN 'error' THEN 'Solar8000/BT' WHEN 'signup' THEN 'Solar8000/VENT_RR' "
              "ELSE 'Solar8000/PLETH_SPO2' END")

RISK = "CASE WHEN quality = 1 THEN 'Low Risk' WHEN quality = 0 THEN 'High Risk' END"

RULED = f"""
ruled AS (
  SELECT doc_id, {RISK} AS risk, CASE WHEN n_chars >= 400 THEN 0 ELSE 1 END AS prediction
  FROM documents JOIN labels USING (doc_id)),
places AS (SELECT risk, row_number() OVER (ORDER BY count(*) DESC, risk) - 1 AS place FROM ruled GROUP BY risk),
indexed AS (SELECT doc_id, risk, place, prediction FROM ruled JOIN places USING (risk)),
counts AS (SELECT place, prediction, count(*) AS n FROM indexed GROUP BY ALL)"""

RISK_RULE = """CASE WHEN "Derived_MAP" > 50 THEN 'High Risk' WHEN "Derived_MAP" IS NOT NULL THEN 'Low Risk' END"""

# Messages that are sent after all others.
HELD = """marked AS (SELECT *, CAST(caseid AS BIGINT) % 4 = 0
    AND epoch_ms(event_ts) // 1000 < (SELECT max(epoch_ms(event_ts) // 1000) FROM enriched) - 4 * 86400 AS held FROM enriched)"""

QUARANTINE_NAMES = ["Heart Rate", "Respiratory Rate", "Body Temperature", "Oxygen Saturation",
                    "Systolic Blood Pressure", "Diastolic Blood Pressure"]

ORACLES = {
    "grid_downsample": f"WITH {WIDE} SELECT * FROM wide WHERE coalesce({ALL_VITALS}) IS NOT NULL",
    "grid_fill_gaps": f"WITH {FILLED} SELECT * FROM filled",
    "trim_quarters": f"WITH {TRIMMED} SELECT * EXCLUDE (i) FROM trimmed",
    "case_means": f"WITH {MEANS} SELECT * FROM means",
    "mean_impute": f"WITH {IMPUTED} SELECT * EXCLUDE (i) FROM imputed",
    "round_modes": """SELECT event_id, CAST(format('{:.1f}', value) AS DOUBLE) AS tenth,
        CAST(round_even(value, 0) AS INTEGER) AS whole, round(value / 3, 2) AS hundredth FROM events""",
    "sequence_stamp": f'WITH {TRIMMED} SELECT caseid, slot_start, {STAMP} AS "timestamp" FROM trimmed',
    "clinical_lookup": f"""WITH {TRIMMED}, {CLINICAL}
        SELECT caseid, slot_start, age, sex, height, weight FROM trimmed JOIN clinical USING (caseid)""",
    "unknown_case_anti": f"""WITH {READINGS}
        SELECT caseid, count(*) AS n_readings, 'no clinical row' AS reason FROM readings
        WHERE caseid NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier) GROUP BY caseid""",
    "rename_reorder": f"""WITH {CLINICAL} SELECT caseid, age AS "Age", sex AS "Gender", height AS "Height",
        weight AS "Weight" FROM clinical""",
    "prepared_samples": f"WITH {PREPARED} SELECT {MESSAGE} FROM prepared",
    "publish_route": f"""WITH {PREPARED} SELECT caseid, "Age", "Gender", CAST("Height" AS VARCHAR) AS "Height",
        "Weight", {each('CAST({c} AS VARCHAR) AS {c}')}, "timestamp",
        row_number() OVER (PARTITION BY caseid ORDER BY "timestamp") - 1 AS position FROM prepared""",
    "prepare_with_bad_values": f"WITH {without_bad(PREPARED)} SELECT {MESSAGE} FROM prepared",
    "trend_with_bad_values": f"""WITH {LONG}, odd AS (SELECT caseid, event_ts, vital, CASE
          WHEN vital <> 'Heart Rate' OR CAST(caseid AS BIGINT) % 5 > 2 THEN value
          WHEN CAST(caseid AS BIGINT) % 5 = 1 THEN CAST(CAST(1e12 AS FLOAT) AS DOUBLE)
          WHEN CAST(caseid AS BIGINT) % 5 = 2 THEN 3e9 END AS value FROM vital_rows)
        SELECT caseid, time_bucket(INTERVAL 1 DAY, event_ts) AS window_start, vital,
          CAST(sum(CAST(value AS DECIMAL(28,9))) AS DOUBLE) / nullif(count(value), 0) AS mean,
          min(value) AS low, max(value) AS high, count(value) AS n
        FROM odd GROUP BY ALL HAVING count(value) > 0""",
    "grid_outlier_times": f"""WITH {READINGS}, good AS (SELECT * FROM readings WHERE NOT {BAD_VALUE}),
        near AS (SELECT caseid, min(time_bucket(INTERVAL 6 HOUR, t)) AS a, max(time_bucket(INTERVAL 6 HOUR, t)) AS b
          FROM good WHERE seq % 400 <> 7 GROUP BY caseid),
        far AS (SELECT caseid, count(*) AS n_far FROM good WHERE seq % 400 = 7 GROUP BY caseid)
        SELECT caseid, CAST(date_diff('hour', a, b) / 6 + 1 AS BIGINT) AS n_slots, coalesce(n_far, 0) AS n_far
        FROM near LEFT JOIN far USING (caseid)""",
    "row_accounting": f"""WITH {READINGS}, r AS (SELECT * FROM readings WHERE NOT (track = 'click' AND seq % 50 = 1))
        SELECT CASE WHEN {BAD_VALUE} THEN 'value out of range' WHEN seq % 400 = 7 THEN 'time far from the case'
          WHEN CAST(caseid AS BIGINT) % 7 = 0
          OR caseid NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) THEN 'no clinical row'
          ELSE 'prepared' END AS fate, count(*) AS n FROM r GROUP BY ALL""",
    "two_stays_accounting": f"""WITH {READINGS}
        SELECT caseid, CASE WHEN seq % 400 = 7 THEN 'time far from the case'
          WHEN caseid NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer) THEN 'no clinical row'
          ELSE 'prepared' END AS fate, count(*) AS n FROM readings GROUP BY ALL""",
    "grid_two_stays": f"""WITH {TWO_STAYS}
        SELECT caseid, slot_start, CAST(stay AS BIGINT) AS stay, n_slots, {STAMP} AS "timestamp",
          {each('coalesce({c}, {m}) AS {c}')} FROM stamped JOIN means USING (caseid, stay)""",
    "clinical_csv_lookup": f"""WITH {CLINICAL}, rows_of_both AS (SELECT * FROM clinical UNION ALL
          SELECT caseid, '99', sex, height, weight FROM clinical WHERE CAST(caseid AS BIGINT) % 3 = 0)
        SELECT caseid, min(age) AS age, any_value(sex) AS sex, any_value(height) AS height, any_value(weight) AS weight
        FROM rows_of_both WHERE CAST(caseid AS BIGINT) IN (SELECT user_id FROM events) GROUP BY caseid""",
    "read_tracks": f"""WITH {READINGS}, n AS (SELECT caseid, {TRACK_NAME} AS track,
          CASE WHEN seq % 11 <> 0 THEN value END AS value FROM readings)
        SELECT caseid, track, count(*) AS n, count(value) AS n_values, max(value) AS high FROM n GROUP BY ALL""",
    "ml_score_batch": f"""SELECT doc_id, {RISK} AS "Risk Category", true AS known_label, true AS same_as_before_saving
        FROM labels WHERE CAST('0x' || substr(md5('1234:' || doc_id), 1, 8) AS BIGINT) / 4294967296.0 >= 0.7""",
    "ml_importances": """SELECT unnest(['characters', 'words', 'newlines', 'digits', 'capitals', 'punctuation',
        'distinct_words', 'white_space']) AS feature, true AS valid, CAST(1 AS DOUBLE) AS total""",
    "stream_score_append": f"""WITH {ENRICHED} SELECT caseid, "Gender", "timestamp", {", ".join(FLOATS)}, true AS known_label
        FROM enriched WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SCORABLE)}""",
    "stream_restart_scores_once": f"""WITH {ENRICHED} SELECT caseid || '|' || "timestamp" AS document_id, event_ts
        FROM enriched WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SCORABLE)}""",
    "stream_new_checkpoint_keeps_documents": f"""WITH {ENRICHED} SELECT caseid || '|' || "timestamp" AS document_id, event_ts
        FROM enriched WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SCORABLE)}""",
    "stream_bad_record": f"""WITH {PREPARED} SELECT caseid, "timestamp", CASE WHEN CAST(caseid AS BIGINT) % 500 = 7
          AND starts_with("timestamp", '2025-02-11T10:00:00') THEN 'redelivered' ELSE 'delivered' END AS fate FROM prepared""",
    "replay_ticks": f"WITH {TRIMMED}, {CLINICAL} SELECT caseid, i AS tick, i AS place FROM trimmed JOIN clinical USING (caseid)",
    "stream_late_rows": f"""WITH {ENRICHED}, {HELD} SELECT caseid, "timestamp",
          CASE WHEN held THEN 'behind the watermark' ELSE 'kept' END AS fate FROM marked""",
    "watch_trend": f"""WITH {ENRICHED}, {HELD}, on_time AS (SELECT * FROM marked WHERE NOT held), vital_rows AS ({unpivot('on_time')})
        SELECT caseid, time_bucket(INTERVAL 1 DAY, event_ts) AS window_start, vital, {exact_mean('value')} AS mean,
               min(value) AS low, max(value) AS high, count(value) AS n
        FROM vital_rows GROUP BY ALL HAVING count(value) > 0""",
    "monitor_rollup": TUMBLING.replace("INTERVAL 1 DAY", "INTERVAL 12 HOUR"),
    "monitor_rollup_now": f"""WITH {LONG},
        hours AS (SELECT *, time_bucket(INTERVAL 1 HOUR, event_ts) AS grain FROM vital_rows WHERE value IS NOT NULL),
        ends AS (SELECT caseid, max(grain) AS latest FROM hours GROUP BY caseid),
        r AS (SELECT caseid, {RISK_RULE} AS risk FROM enriched), c AS (SELECT caseid, risk, count(*) AS n FROM r GROUP BY ALL)
        SELECT caseid, 'gauge' AS measure, vital AS name, {exact_mean('value')} AS value
        FROM hours JOIN ends USING (caseid) WHERE grain > latest - INTERVAL 1 DAY GROUP BY caseid, vital
        UNION ALL SELECT caseid, 'share', risk, n / sum(n) OVER (PARTITION BY caseid) FROM c""",
    "multi_patient_union": f"""WITH {READINGS} SELECT caseid, count(*) AS n_readings, min(t) AS first_t,
        max(t) AS last_t, max(value) AS high FROM readings GROUP BY caseid""",
    "json_roundtrip": f"""WITH {PREPARED} SELECT caseid, "Age", "Gender", CAST("Height" AS VARCHAR) AS "Height",
        "Weight", {each('CAST({c} AS VARCHAR) AS {c}')}, "timestamp" FROM prepared""",
    "scan_csv_roundtrip": f"""WITH {ENRICHED} SELECT CAST(caseid AS INTEGER) AS "Patient ID",
        CAST({HR} AS INTEGER) AS {HR}, CAST({RR} AS INTEGER) AS {RR}, {BT}, {SPO2}, CAST({SBP} AS INTEGER) AS {SBP},
        CAST({DBP} AS INTEGER) AS {DBP}, CAST("Age" AS INTEGER) AS "Age", "Gender", "Weight", "Height", "Derived_BMI",
        CASE WHEN {HR} > {SBP} THEN 'High Risk' ELSE 'Low Risk' END AS "Risk Category" FROM enriched""",
    "safe_cast": """SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k_int,
        TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k_double, TRY_CAST(props AS DOUBLE) AS props_double,
        TRY_CAST(event_type AS INTEGER) AS type_int, CAST(value AS FLOAT) AS value_float FROM events""",
    "derived_vitals": f"""WITH {DERIVED} SELECT caseid, "timestamp", "Derived_Pulse_Pressure", "Derived_BMI",
        "Derived_MAP" FROM derived""",
    "enrich_cast_float": FLOAT_ROWS,
    "quarantine_reasons": f"""WITH {TRIMMED}, {CLINICAL}
        SELECT caseid, {STAMP} AS "timestamp", 'missing: ' || concat_ws(', ', {', '.join(
            f"CASE WHEN {chr(34)}{c}{chr(34)} IS NULL THEN '{c}' END" for c in QUARANTINE_NAMES)}) AS reason
        FROM trimmed JOIN clinical USING (caseid)
        WHERE {' OR '.join(f'{c} IS NULL' for c in VITALS)}""",
    "label_index": f"""WITH l AS (SELECT doc_id, {RISK} AS risk FROM labels),
        places AS (SELECT risk, row_number() OVER (ORDER BY count(*) DESC, risk) - 1 AS place FROM l GROUP BY risk)
        SELECT doc_id, risk AS "Risk Category", CAST(place AS DOUBLE) AS "Risk_Category_Encoded"
        FROM l JOIN places USING (risk)""",
    "hash_split": """SELECT doc_id, CASE WHEN CAST('0x' || substr(md5('1234:' || doc_id), 1, 8) AS BIGINT)
        / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END AS part FROM labels""",
    "ml_features": r"""WITH t AS (SELECT doc_id, text, string_split_regex(trim(text), '[ \t\n\r]+') AS w
          FROM documents JOIN labels USING (doc_id))
        SELECT doc_id, CAST(length(text) AS DOUBLE) AS characters, CAST(len(w) AS DOUBLE) AS words,
          CAST(len(regexp_extract_all(text, '\n')) AS DOUBLE) AS newlines,
          CAST(len(regexp_extract_all(text, '[0-9]')) AS DOUBLE) AS digits,
          CAST(len(regexp_extract_all(text, '[A-Z]')) AS DOUBLE) AS capitals,
          CAST(len(regexp_extract_all(text, '[!-/:-@\[-`{-~]')) AS DOUBLE) AS punctuation,
          CAST(len(list_distinct(w)) AS DOUBLE) AS distinct_words,
          CAST(len(regexp_extract_all(text, '[ \t\n\r]')) AS DOUBLE) AS white_space FROM t""",
    "confusion_matrix": f"""WITH {RULED} SELECT CAST(place AS INTEGER) AS label, CAST(prediction AS INTEGER) AS prediction, n
        FROM counts""",
    "ml_metrics": f"""WITH {RULED},
        classes AS (SELECT place AS c, sum(n) AS support, sum(n) FILTER (WHERE place = prediction) AS hits
                    FROM counts GROUP BY place),
        guesses AS (SELECT prediction AS c, sum(n) AS predicted FROM counts GROUP BY prediction)
        SELECT round(CAST(sum(coalesce(hits, 0)) AS DOUBLE) / sum(support), 9) AS accuracy,
          round(sum(coalesce(CAST(hits AS DOUBLE) / predicted, 0) * support) / sum(support), 9) AS weighted_precision,
          round(sum(coalesce(CAST(hits AS DOUBLE) / support, 0) * support) / sum(support), 9) AS weighted_recall
        FROM classes LEFT JOIN guesses USING (c)""",
    "topk_preview": f"""WITH {RULED} SELECT doc_id, risk AS "Risk Category", CAST(place AS DOUBLE) AS "Risk_Category_Encoded",
        CAST(prediction AS DOUBLE) AS prediction FROM indexed ORDER BY doc_id LIMIT 10""",
    "risk_label": """SELECT event_id,
        CASE WHEN value < 50 THEN 'High Risk' WHEN value < 100 THEN 'Low Risk' ELSE 'Unknown' END AS risk,
        CASE WHEN value >= 50 AND value < 100 THEN 'Low Risk' ELSE 'High Risk' END AS risk_by_position FROM events""",
    "risk_share": f"""WITH {ENRICHED}, r AS (SELECT caseid, {RISK_RULE} AS risk FROM enriched),
        c AS (SELECT caseid, risk, count(*) AS n FROM r GROUP BY ALL)
        SELECT caseid, risk AS "Risk Predicted", n, n / sum(n) OVER (PARTITION BY caseid) AS share FROM c""",
    "risk_share_overall": f"""WITH {ENRICHED}, r AS (SELECT {RISK_RULE} AS risk FROM enriched),
        c AS (SELECT risk, count(*) AS n FROM r GROUP BY ALL)
        SELECT risk AS "Risk Predicted", n, n / sum(n) OVER () AS share FROM c""",
    "gauge_recent_mean": f"WITH {GAUGE} SELECT * FROM gauge",
    "gauge_bands": f"WITH {GAUGE} SELECT *, {BAND_CASE} AS band FROM gauge",
    "trend_tumbling": TUMBLING,
    "trend_sliding": SLIDING,
    "stream_decode_enrich": FLOAT_ROWS,
    "stream_trend": TUMBLING,
    "stream_gauge": SLIDING,
    "stream_drop_repeats": f"""WITH {PREPARED} SELECT caseid, "Age", "Gender", CAST("Height" AS VARCHAR) AS "Height",
        "Weight", {each('CAST({c} AS VARCHAR) AS {c}')}, "timestamp" FROM prepared""",
    "stream_clinical_join": f"""WITH {PREPARED} SELECT prepared.caseid, "timestamp", clinical.age, clinical.sex, clinical.height, clinical.weight
        FROM prepared JOIN clinical USING (caseid)""",
}
