import datetime
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import distinct_services, top_error_services
from millrace.sources import (
    CARD_TRANSACTION,
    DEPARTMENT,
    EVENT_DOCUMENT,
    SENSOR_READING,
    STUDENT,
    TRANSACTION,
    decode_json,
    harmonise_union,
    log_fields,
    log_time,
    read_csv,
    read_documents,
    read_drifting,
    read_logs,
    read_table,
    register_view,
    rejected_csv,
    rejected_documents,
    rejected_json,
    rejected_lines,
)


@pytest.fixture
def monthly(spark, tmp_path):
    frames = {
        "m1": spark.createDataFrame([(1, 10.0), (2, 20.0)], "passengers INT, fare DOUBLE"),
        "m2": spark.createDataFrame([(1.0, 30.0, "x"), (None, 5.0, "y")], "passengers DOUBLE, fare DOUBLE, extra STRING"),
        "m3": spark.createDataFrame([(40.0, 2)], "fare DOUBLE, passengers BIGINT"),
        "m4": spark.createDataFrame([(3, 50.0)], "passengers INT, fare DOUBLE"),
        "bad": spark.createDataFrame([(1,)], "passengers INT"),
    }
    for name, df in frames.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}")
    return lambda *names: [f"{tmp_path}/{n}" for n in names]


def test_drifting_files_become_one_table(spark, monthly):
    df = read_drifting(spark, monthly("m1", "m2", "m3", "m4"), {"passengers": "double"})
    assert df.dtypes == [("passengers", "double"), ("fare", "double")]
    rows = sorted(df.collect(), key=lambda r: r.fare)
    assert [tuple(r) for r in rows] == [
        (None, 5.0),
        (1.0, 10.0),
        (2.0, 20.0),
        (1.0, 30.0),
        (2.0, 40.0),
        (3.0, 50.0),
    ]


def test_drifting_files_of_one_schema_share_a_scan(spark, monthly, plan):
    df = read_drifting(spark, monthly("m1", "m4", "m3"), {"passengers": "double"})
    assert plan(df).count("FileScan parquet") == 2


def test_a_path_given_twice_counts_twice(spark, monthly):
    assert read_drifting(spark, monthly("m3", "m3", "m1"), {"passengers": "double"}).count() == 4


def test_missing_column_is_an_error(spark, monthly):
    with pytest.raises(AnalysisException):
        read_drifting(spark, monthly("m1", "bad"), {"passengers": "double"})


def test_union_follows_the_first_frame(spark, monthly):
    frames = [read_table(spark, p) for p in monthly("m3", "m2")]
    assert harmonise_union(frames, {"passengers": "double"}).columns == ["fare", "passengers"]


def test_filter_reaches_every_drifting_scan(spark, monthly, plan):
    df = read_drifting(spark, monthly("m1", "m2"), {"passengers": "double"}).filter("fare > 15").select("fare")
    text = plan(df)
    assert text.count("GreaterThan(fare,15.0)") == 2
    assert text.count("ReadSchema: struct<fare:double>") == 2


def test_csv_with_header(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "student_id,name,age,major,gpa\n1,Ann,20,Biology,3.5\n2,Ben,22,History,3.1\n3,Cem,21,Law,3.9\n"
    )
    (tmp_path / "d.csv").write_text("major,department_name\nBiology,Life Sciences\nLaw,Law School\n")
    students = read_csv(spark, f"{tmp_path}/s.csv", STUDENT)
    departments = read_csv(spark, f"{tmp_path}/d.csv", DEPARTMENT)
    assert students.agg(F.round(F.avg("gpa"), 2)).first()[0] == 3.5
    joined = students.join(departments, "major").select("name", "department_name")
    assert sorted(map(tuple, joined.collect())) == [("Ann", "Life Sciences"), ("Cem", "Law School")]


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "7,Visa,shop.example,Pen,2020-01-02 03:04:05,6.99,Oslo,Norway\n"
        "8,MasterCard,shop.example,Ink,2020-01-02 03:19:05,12.50,Bergen,Norway"
    )
    df = read_csv(spark, f"{tmp_path}/t.csv", CARD_TRANSACTION, header=False)
    rows = df.orderBy("row_key").collect()
    assert len(rows) == 2
    assert str(df.agg(F.sum("amount")).first()[0]) == "19.49"
    assert rows[0].txn_ts == datetime.datetime(2020, 1, 2, 3, 4, 5)


def test_documents_with_a_late_field(spark, tmp_path):
    docs = [
        {"userId": 1, "eventType": "view", "timestamp": 1.5, "value": 3, "metadata": {"device": "mobile"}},
        {"userId": 1, "eventType": "view", "timestamp": 2.5, "value": 4, "lastUpdate": 9.5},
    ]
    (tmp_path / "docs.json").write_text("\n".join(map(json.dumps, docs)))
    df = read_documents(spark, str(tmp_path), EVENT_DOCUMENT).orderBy("timestamp")
    rows = df.select("value", "metadata.device", "lastUpdate", "sessionId").collect()
    assert [tuple(r) for r in rows] == [(3, "mobile", None, None), (4, None, 9.5, None)]


def test_register_view(spark):
    register_view(spark.range(3), "three")
    assert spark.sql("SELECT sum(id) FROM three").first()[0] == 3


LOG = """\
Jan  2 03:04:05 host1 cron[12]: job ERROR: disk full
Jan 12 03:04:06 host1 cron[13]: job done
Jan 12 03:04:07 host2 kernel: I/O Error on sda
not a log line with error
Jan 12 03:04:08 host2 net-mgr[7]: ready
Jan 12 03:04:09 host2 cron[14]: another error
2024-01-12T03:04:10.5+00:00 host3 audio server[15]: it plays
"""


def test_logs(spark, tmp_path):
    (tmp_path / "syslog").write_text(LOG)
    logs = read_logs(spark, str(tmp_path / "syslog"))
    assert logs.count() == 6
    iso = logs.filter("service = 'audio server'").select(log_time(year=2023).alias("at"), "message").first()
    assert (iso.at, iso.message) == (datetime.datetime(2024, 1, 12, 3, 4, 10, 500000), "it plays")
    classic = logs.filter("service = 'kernel'").select(log_time(year=2023).alias("at")).first()
    assert classic.at == datetime.datetime(2023, 1, 12, 3, 4, 7)
    lines = spark.createDataFrame([(1, None), (2, ""), (3, "not a log line"), (4, LOG.split("\n")[0])], "n INT, value STRING")
    assert sorted(r.n for r in rejected_lines(lines).collect()) == [1, 2, 3]
    first = logs.filter("service = 'kernel'").first()
    assert tuple(first) == ("Jan 12 03:04:07", "host2", "kernel", "I/O Error on sda")
    assert [tuple(r) for r in top_error_services(logs).collect()] == [("cron", 2), ("kernel", 1)]
    assert [tuple(r) for r in top_error_services(logs, 1).collect()] == [("cron", 2)]
    assert sorted(r[0] for r in distinct_services(logs).collect()) == ["cron", "kernel"]
    only = read_logs(spark, str(tmp_path / "syslog"), containing="Error")
    assert only.count() == 3
    assert top_error_services(only).collect() == top_error_services(logs).collect()


def test_error_ties_go_by_name(spark):
    lines = [(f"Jan 1 00:00:00 h {s}: error",) for s in ("b", "a", "c")]
    logs = log_fields(spark.createDataFrame(lines, "value STRING"))
    assert [r.Service for r in top_error_services(logs, 2).collect()] == ["a", "b"]


def sensor(**fields):
    base = {"sensor_id": "S1", "timestamp": "2024-01-01T00:00:01.250000", "temperature": 20.0, "status": "normal"}
    return json.dumps({**base, **fields})


def test_messages_decode_and_bad_ones_do_not_raise(spark):
    values = [sensor(), sensor(timestamp="2024-01-01T00:00:02"), sensor(timestamp="junk"), "{broken", "[]x"]
    raw = spark.createDataFrame([(i, v.encode()) for i, v in enumerate(values)], "n INT, value BINARY")
    rows = decode_json(raw, SENSOR_READING, keep=("n",)).orderBy("n").collect()
    assert rows[0].event_time == datetime.datetime(2024, 1, 1, 0, 0, 1, 250000)
    assert rows[1].event_time == datetime.datetime(2024, 1, 1, 0, 0, 2)
    assert rows[2].event_time is None and rows[2].sensor_id == "S1"
    assert rows[3].sensor_id is None and rows[3].event_time is None
    assert len(rows) == 5
    rejected = rejected_json(raw, SENSOR_READING).orderBy("n").collect()
    assert [r.n for r in rejected] == [3, 4]
    assert rejected[0].value == b"{broken"


def test_messages_that_are_not_one_value_are_rejects(spark):
    values = [sensor(), "", "  ", None, sensor() + " trailing", sensor() + sensor(), sensor() + "," + sensor()]
    raw = spark.createDataFrame(list(enumerate(values)), "n INT, value STRING")
    assert sorted(r.n for r in rejected_json(raw, SENSOR_READING).collect()) == [1, 2, 3, 4, 5, 6]


def test_header_in_another_order_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("major,name\nphysics,Ann\n")
    assert read_csv(spark, str(tmp_path / "a.csv"), "major STRING, name STRING").first().name == "Ann"
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "a.csv"), "name STRING, major STRING").collect()


def test_rows_and_documents_that_do_not_fit_are_listed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,v\n1,x\ntwo,y\n3\n4,z,w\n")
    bad = rejected_csv(spark, str(tmp_path / "a.csv"), "n INT, v STRING")
    assert sorted(r._bad_row for r in bad.collect()) == ["3", "4,z,w", "two,y"] and bad.count() == 3
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_csv(spark, str(tmp_path / "a.csv"), "n INT, v STRING", mode="FAILFAST").collect()
    (tmp_path / "d.json").write_text('{"n": 1}\n{"n": "x"}\n{broken\n')
    docs = rejected_documents(spark, str(tmp_path / "d.json"), "n INT")
    assert sorted(r._bad_row for r in docs.collect()) == ['{"n": "x"}', "{broken"]


def test_files_of_one_folder_may_drift(spark, tmp_path):
    spark.range(3).selectExpr("CAST(id AS INT) AS k", "'a' AS s").coalesce(1).write.parquet(str(tmp_path / "f"))
    spark.range(3).selectExpr("CAST(id AS DOUBLE) AS k", "'b' AS s").coalesce(1).write.mode("append").parquet(str(tmp_path / "f"))
    both = read_drifting(spark, [str(tmp_path / "f")], {"k": "double"})
    assert both.count() == 6 and both.agg(F.sum("k")).first()[0] == 6.0
    spark.range(3).selectExpr("CAST(id AS DOUBLE) AS k").coalesce(1).write.mode("append").parquet(str(tmp_path / "f"))
    with pytest.raises(Exception, match="(?i)column|resolve"):
        read_drifting(spark, [str(tmp_path / "f")], {"k": "double", "s": "string"}).collect()


def test_transaction_messages(spark):
    text = json.dumps({"transaction_id": "a", "timestamp": "2024-01-01T00:00:01", "amount": 5.25, "category": "Food"})
    row = decode_json(spark.createDataFrame([(text,)], "value STRING"), TRANSACTION).first()
    assert (row.amount, row.category, row.merchant) == (5.25, "Food", None)
