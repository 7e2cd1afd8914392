import datetime as dt
import math

import pytest

from pulsegrid.schemas import READING_SCHEMA, TRAINING_SCHEMA
from pulsegrid.settings import JobSettings
from pulsegrid.sources.files import read_clinical, read_readings, read_text_csv, read_training
from pulsegrid.sources.topics import kafka_options, read_topic, write_topic


def test_clinical_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "cases.csv"
    path.write_bytes("﻿caseid,subjectid,age,sex,height,weight\n1,9,77,M,160.2,67.5\n".encode())
    row = read_clinical(spark, str(path)).first()
    assert (row.caseid, row.age, row.height) == ("1", "77", "160.2")


def test_empty_input_is_an_error(spark, tmp_path):
    path = tmp_path / "cases.csv"
    path.write_text("caseid,age,sex,height,weight\n")
    with pytest.raises(ValueError, match="no rows"):
        read_clinical(spark, str(path))


def test_training_csv_goes_by_header_name(spark, tmp_path):
    names = list(reversed(TRAINING_SCHEMA.names))
    values = {n: "1" for n in names} | {"Gender": "F", "Risk Category": "Low Risk", "Body Temperature": "36.5",
                                        "Heart Rate": "x", "Patient ID": "12"}
    path = tmp_path / "t.csv"
    path.write_text(",".join([*names, "other"]) + "\n" + ",".join([*[values[n] for n in names], "z"]) + "\n")
    rows = read_training(spark, str(path))
    assert rows.schema == TRAINING_SCHEMA
    row = rows.first()
    assert (row["Patient ID"], row["Heart Rate"], row["Body Temperature"], row.Gender) == (12, None, 36.5, "F")


def test_readings_keep_known_tracks_and_no_nan(spark, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    at = dt.datetime(2024, 1, 1)
    rows = [("1", "Solar8000/HR", at, 1, 60.0), ("1", "Solar8000/HR", at, 2, math.nan), ("1", "Other/X", at, 3, 1.0),
            ("1", "Solar8000/BT", at, 4, None)]
    spark.createDataFrame(rows, READING_SCHEMA).write.parquet(str(tmp_path / "r"))
    table = read_readings(spark, str(tmp_path / "r"))
    assert sorted((r.seq, r.value) for r in table.collect()) == [(1, 60.0), (2, None)]
    plain = spark.createDataFrame([(1, "Solar8000/HR", at, 60.0)], "caseid int, track string, t timestamp, value double")
    plain.write.parquet(str(tmp_path / "plain"))
    assert tuple(read_readings(spark, str(tmp_path / "plain")).first()) == (
        "1", "Solar8000/HR", at, 1704067200000000, 60.0)
    plan = table._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "In(track" in pushed and "IsNotNull(value)" in pushed


def test_settings_come_from_the_environment():
    settings = JobSettings.from_env({"KAFKA_SERVER": "k:1", "PATIENT_IDS": "1,4,31", "ELASTIC_PASSWORD": "p",
                                     "FAIL_ON_DATA_LOSS": "false"})
    assert (settings.kafka_servers, settings.case_ids, settings.index_port) == ("k:1", (1, 4, 31), "9243")
    assert "p'" not in repr(settings) and settings.index_options()["es.net.http.auth.pass"] == "p"
    assert "es.nodes" not in settings.index_options()
    assert JobSettings.from_env({}).fail_on_data_loss and JobSettings.from_env({"PATIENT_ID": "7"}).case_ids == (7,)
    assert kafka_options("k:1", "vitals", settings.fail_on_data_loss)["failOnDataLoss"] == "false"


def test_file_topic_has_the_shape_of_the_broker_source(spark, tmp_path):
    rows = spark.sql("SELECT cast('1' AS binary) AS key, cast('{}' AS binary) AS value, 'vitals' AS topic, "
                     "'2025-02-11T10:00:06.123Z' AS timestamp")
    write_topic(rows, "parquet", path=str(tmp_path / "t"))
    stream = read_topic(spark, "parquet", path=str(tmp_path / "t"))
    assert stream.isStreaming and stream.columns == ["key", "value", "topic", "partition", "offset", "timestamp",
                                                     "timestampType"]


def test_files_with_differing_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("caseid,age,sex,height,weight\n1,50,F,170,70\n")
    (tmp_path / "b.csv").write_text("age,caseid,sex,height,weight\n50,2,F,170,70\n")
    with pytest.raises(Exception, match="header"):
        read_text_csv(spark, str(tmp_path)).select("caseid", "age").collect()
