import os

import pytest
from pyspark.sql import functions as F

from clickloom.operators.normalize import stage_events
from clickloom.operators.quality import dq_report
from clickloom.sources import event_files, tables

FULL = "client_id,page_url,referrer,timestamp,event_name,event_data,user_agent"
DRIFTED = "page_url,clientId,referrer,timestamp,event_name,event_data,user_agent"
BLIND = "page_url,clientId,timestamp,event_name,event_data,user_agent"
PAYLOAD = '"{""transaction_id"": ""T1"", ""value"": 5.5}"'


@pytest.fixture
def folder(tmp_path):
    files = {
        "events_20250223.csv": [FULL, f"a,/x,https://g.co,2025-02-23T10:00:00Z,purchase,{PAYLOAD},UA", "NA,/x,,2025-02-23T11:00:00Z,page_viewed,{},UA"],
        "events_20250227.csv": [DRIFTED, f"/y,b,https://g.co,2025-02-27T10:00:00Z,purchase,{PAYLOAD},UA"],
        "events_20250304.csv": [BLIND, "/z,c,2025-03-04T10:00:00Z,page_viewed,{},UA"],
        "other.csv": ["a,b", "1,2"],
    }
    for name, lines in files.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    return str(tmp_path)


def test_headers_are_united_by_name(spark, folder):
    rows = event_files.read_event_files(spark, f"{folder}/events_*.csv").orderBy("timestamp").collect()
    assert [(r.file, r.client_id, r.clientId, r.page_url, r.referrer) for r in rows] == [
        ("events_20250223.csv", "a", None, "/x", "https://g.co"),
        ("events_20250223.csv", None, None, "/x", None),
        ("events_20250227.csv", None, "b", "/y", "https://g.co"),
        ("events_20250304.csv", None, "c", "/z", None),
    ]
    assert rows[0].event_data == '{"transaction_id": "T1", "value": 5.5}'


def test_one_read_over_all_headers_fails(spark, folder):
    reader = spark.read.option("header", True).option("enforceSchema", False)
    everything = reader.schema(", ".join(f"{c} string" for c in FULL.split(","))).csv(f"{folder}/events_*.csv")
    with pytest.raises(Exception, match="CSV header"):
        everything.collect()


def test_report_from_files(spark, folder):
    events = event_files.read_event_files(spark, f"{folder}/events_*.csv")
    report = {r.file[7:15]: r for r in dq_report(events).collect()}
    assert report["20250223"].alerts == ["HIGH_NULLS: 50.0%"]
    assert report["20250227"].alerts == ["SCHEMA_DRIFT: clientId -> client_id"]
    assert report["20250304"].alerts == ["SCHEMA_DRIFT: clientId -> client_id", "MISSING_COL: referrer"]
    assert [report[d].status for d in sorted(report)] == ["CRITICAL", "WARNING", "CRITICAL"]
    assert sorted(r.user_id for r in stage_events(events).collect()) == ["a", "b", "c"]


def test_unreadable_line_fails_its_file_only(spark, folder):
    with open(f"{folder}/events_20250223.csv", "a") as f:
        f.write("short,line\n")
    events = event_files.read_event_files(spark, f"{folder}/events_*.csv")
    report = {r.file[7:15]: r for r in dq_report(events).collect()}
    assert (report["20250223"].status, report["20250223"].rows) == ("ERROR", None)
    assert report["20250227"].status == "WARNING"
    assert event_files.unreadable(events).count() == 1 and event_files.readable(events).count() == 4


def test_fallback_and_missing_files(spark, folder):
    found = event_files.read_event_files(spark, f"{folder}/data/events_*.csv", f"{folder}/events_*.csv")
    assert found.count() == 4
    empty = event_files.read_event_files(spark, f"{folder}/data/events_*.csv")
    assert empty.count() == 0 and dq_report(empty).count() == 0
    with pytest.raises(event_files.NoEventFiles):
        event_files.read_event_files(spark, f"{folder}/data/events_*.csv", required=True)


def test_partition_overwrite_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(10).select("id", F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("event_date"))
    tables.overwrite_partitions(days, path)
    late = days.where("event_date = DATE '2025-01-02'").withColumn("id", F.col("id") + 100)
    for _ in range(2):
        tables.overwrite_partitions(late, path)
    ids = sorted(r.id for r in spark.read.parquet(path).collect())
    assert ids == [0, 2, 3, 5, 6, 8, 9, 101, 104, 107]
    assert os.path.isdir(f"{path}/event_date=2025-01-02")


def test_a_copy_in_another_file_is_a_copy_and_unreadable_lines_are_not_staged(spark):
    from clickloom.config import PANDAS
    from clickloom.operators.normalize import stage_events

    columns = "file string, client_id string, timestamp string, event_name string, page_url string, referrer string, event_data string, _corrupt_record string"
    row = ("u1", "2025-03-01T10:00:00Z", "page_viewed", "https://s/p", None, None)
    rows = [("a.csv", *row, None), ("b.csv", *row, None), ("b.csv", "u2", None, None, None, None, None, "u2,")]
    assert [r.user_id for r in stage_events(spark.createDataFrame(rows, columns), PANDAS).collect()] == ["u1"]


def test_a_part_with_another_header_fails_instead_of_shifting_columns(spark, tmp_path):
    (tmp_path / "events_20250101.csv").mkdir()
    for part, lines in enumerate((["client_id,page_url", "a,/x"], ["page_url,client_id", "/y,b"])):
        (tmp_path / "events_20250101.csv" / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="events_20250101.csv/part-1.csv"):
        event_files.read_event_files(spark, f"{tmp_path}/events_*.csv").collect()


def test_days_without_events_are_in_the_report(spark, folder):
    for name, text in (("events_20250305.csv", ""), ("events_20250306.csv", FULL + "\n")):
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    found = f"{folder}/events_*.csv"
    events = event_files.read_event_files(spark, found)
    report = {r.file[7:15]: r for r in dq_report(events, delivered=event_files.delivered_files(spark, found)).collect()}
    assert sorted(report) == ["20250223", "20250227", "20250304", "20250305", "20250306"]
    empty, header = report["20250305"], report["20250306"]
    assert (empty.status, empty.rows, empty.revenue, empty.alerts) == ("ERROR", None, None, ["READ_ERROR: no columns"])
    assert (header.status, header.rows, header.revenue, header.null_rate, header.alerts) == ("PASS", 0, 0.0, None, [])


def test_an_empty_file_is_a_delivered_file(spark, tmp_path):
    (tmp_path / "events_20250101.csv").write_text("")
    found = f"{tmp_path}/events_*.csv"
    assert event_files.read_event_files(spark, found, required=True).count() == 0
    assert [r.status for r in dq_report(event_files.read_event_files(spark, found), delivered=event_files.delivered_files(spark, found)).collect()] == ["ERROR"]
