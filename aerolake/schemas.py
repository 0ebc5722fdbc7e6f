"""Explicit schemas: nothing in the library infers a schema from JSON."""

from pyspark.sql import types as T

S, I, D = T.StringType(), T.IntegerType(), T.DoubleType()

# Request message, as declared by the scoring job (A1 in FIXTURES.md).
REQUEST = T.StructType([
    T.StructField("Origin", S),
    T.StructField("FlightNum", S),
    T.StructField("DayOfWeek", I),
    T.StructField("DayOfYear", I),
    T.StructField("DayOfMonth", I),
    T.StructField("Dest", S),
    T.StructField("DepDelay", D),
    T.StructField("Prediction", S),
    T.StructField("Timestamp", T.TimestampType()),
    T.StructField("FlightDate", T.DateType()),
    T.StructField("Carrier", S),
    T.StructField("UUID", S),
    T.StructField("Distance", D),
    T.StructField("Carrier_index", D),
    T.StructField("Origin_index", D),
    T.StructField("Dest_index", D),
    T.StructField("Route_index", D),
])

CORRUPT_COLUMN = "_corrupt_record"
REQUEST_WITH_CORRUPT = T.StructType(REQUEST.fields + [T.StructField(CORRUPT_COLUMN, S)])

# Fields the scoring job keeps after parsing (the input Prediction is dropped,
# FlightNum is kept; see SURVEY 7.5-3/4).
FLATTENED_FIELDS = [
    "Origin", "FlightNum", "DayOfWeek", "DayOfYear", "DayOfMonth", "Dest", "DepDelay",
    "Timestamp", "FlightDate", "Carrier", "UUID", "Distance",
    "Carrier_index", "Origin_index", "Dest_index", "Route_index",
]

# Response message value (A2): field order as sent on the response topic.
RESPONSE_FIELDS = [
    "Origin", "DayOfWeek", "DayOfYear", "DayOfMonth", "Dest", "DepDelay",
    "prediction", "Timestamp", "FlightDate", "Carrier", "UUID", "Distance",
]
RESPONSE = T.StructType([
    T.StructField("Origin", S), T.StructField("DayOfWeek", I), T.StructField("DayOfYear", I),
    T.StructField("DayOfMonth", I), T.StructField("Dest", S), T.StructField("DepDelay", D),
    T.StructField("prediction", D), T.StructField("Timestamp", T.TimestampType()),
    T.StructField("FlightDate", T.DateType()), T.StructField("Carrier", S),
    T.StructField("UUID", S), T.StructField("Distance", D),
])

# Route dimension written by the rollup and read back as JSON Lines.
ROUTE_DISTANCE = T.StructType([
    T.StructField("Origin", S), T.StructField("Dest", S), T.StructField("Distance", D),
])

# Scoring task as stored by the batch path (A1 without UUID and index fields).
TASK = T.StructType([
    T.StructField("DepDelay", D), T.StructField("Carrier", S), T.StructField("FlightDate", T.DateType()),
    T.StructField("Dest", S), T.StructField("FlightNum", S), T.StructField("Origin", S),
    T.StructField("Distance", D), T.StructField("DayOfYear", I), T.StructField("DayOfMonth", I),
    T.StructField("DayOfWeek", I), T.StructField("Timestamp", S),
])

# Topic record shape (key/value bytes plus broker time), as a stream source gives it.
TOPIC = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
])

