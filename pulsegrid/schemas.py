"""Field lists and schemas shared by the batch and the streaming jobs."""

from pyspark.sql import types as T

# ---- Fixed values: names a message, a training file or a scored document must carry. ----

# Monitor track -> column name, in message order.
TRACK_COLUMNS = {
    "Solar8000/ART_DBP": "Diastolic Blood Pressure",
    "Solar8000/ART_SBP": "Systolic Blood Pressure",
    "Solar8000/HR": "Heart Rate",
    "Solar8000/BT": "Body Temperature",
    "Solar8000/VENT_RR": "Respiratory Rate",
    "Solar8000/PLETH_SPO2": "Oxygen Saturation",
}

# Clinical CSV columns that are kept, and the names they get in a message.
CLINICAL_COLUMNS = ["caseid", "age", "sex", "height", "weight"]
CLINICAL_RENAMES = {"age": "Age", "sex": "Gender", "height": "Height", "weight": "Weight"}

# Leading columns of a prepared sample.
KEY_COLUMNS = ["caseid", "Age", "Gender", "Height", "Weight"]

# Columns of a decoded row that become FLOAT after the derived vitals are computed.
FLOAT_COLUMNS = [
    "Heart Rate", "Respiratory Rate", "Body Temperature", "Oxygen Saturation",
    "Systolic Blood Pressure", "Diastolic Blood Pressure", "Age", "Weight", "Height",
    "Derived_Pulse_Pressure", "Derived_BMI", "Derived_MAP",
]

# Model inputs, in vector order.
FEATURES = [
    "Age", "Heart Rate", "Respiratory Rate", "Body Temperature", "Oxygen Saturation",
    "Systolic Blood Pressure", "Diastolic Blood Pressure", "Derived_BMI",
]

# Columns of a scored document, in order.
SCORED_COLUMNS = [
    "caseid", "Age", "Gender", "Height", "Weight", "Heart Rate", "Respiratory Rate",
    "Body Temperature", "Oxygen Saturation", "Systolic Blood Pressure",
    "Diastolic Blood Pressure", "Derived_Pulse_Pressure", "Derived_BMI", "Derived_MAP",
    "timestamp", "Risk Predicted",
]

LABEL = "Risk Category"
ENCODED_LABEL = "Risk_Category_Encoded"
HIGH_RISK = "High Risk"
LOW_RISK = "Low Risk"
UNKNOWN_RISK = "Unknown"

# Training file, in declared order.
TRAINING_SCHEMA = T.StructType([
    T.StructField("Patient ID", T.IntegerType()),
    T.StructField("Heart Rate", T.IntegerType()),
    T.StructField("Respiratory Rate", T.IntegerType()),
    T.StructField("Body Temperature", T.FloatType()),
    T.StructField("Oxygen Saturation", T.FloatType()),
    T.StructField("Systolic Blood Pressure", T.IntegerType()),
    T.StructField("Diastolic Blood Pressure", T.IntegerType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Weight", T.FloatType()),
    T.StructField("Height", T.FloatType()),
    T.StructField("Derived_BMI", T.FloatType()),
    T.StructField("Risk Category", T.StringType()),
])

# ---- Derived from the lists above. ----

VITALS = list(TRACK_COLUMNS.values())
INTEGER_VITALS = [v for v in VITALS if v != "Body Temperature"]
MESSAGE_COLUMNS = KEY_COLUMNS + VITALS + ["timestamp"]

# A message is decoded as text only; numbers are cast afterwards, value by value.
MESSAGE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in MESSAGE_COLUMNS])

CLINICAL_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CLINICAL_COLUMNS])

# Long table of monitor readings. ``seq`` orders the readings of one case and track.
READING_SCHEMA = T.StructType([
    T.StructField("caseid", T.StringType()),
    T.StructField("track", T.StringType()),
    T.StructField("t", T.TimestampType()),
    T.StructField("seq", T.LongType()),
    T.StructField("value", T.DoubleType()),
])

# Row shape of Spark's Kafka source.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])
