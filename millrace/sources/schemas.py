"""Declared schemas of the known record types (fixed values)."""

SENSOR_READING = (
    "sensor_id STRING, timestamp STRING, temperature DOUBLE, humidity DOUBLE, pressure DOUBLE, status STRING"
)
TRANSACTION = (
    "transaction_id STRING, timestamp STRING, user_id STRING, amount DOUBLE, merchant STRING, category STRING"
)
EVENT_DOCUMENT = (
    "userId INT, eventType STRING, timestamp DOUBLE, value INT, sessionId STRING, "
    "metadata STRUCT<device: STRING, country: STRING, browser: STRING>, lastUpdate DOUBLE"
)
STUDENT = "student_id INT, name STRING, age INT, major STRING, gpa DOUBLE"
DEPARTMENT = "major STRING, department_name STRING"
CARD_TRANSACTION = (
    "row_key INT, card_type STRING, website STRING, product STRING, "
    "txn_ts TIMESTAMP, amount DECIMAL(10,2), city STRING, country STRING"
)
