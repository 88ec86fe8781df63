from datetime import date

import pytest

from clickloom.operators import monitor
from clickloom.operators.checks import Expectations, validation_summary
from clickloom.operators.attribution import attribute_events
from clickloom.operators.normalize import stage_events
from clickloom.operators.sessions import build_sessions

DAY = "2025-03-08"
RAW = "client_id string, timestamp string, page_url string, referrer string"
GOLD = "transaction_id string, revenue double, first_click_channel string, last_click_channel string, conversion_time string"


def raw_rows(per_day, null_ids=0, no_referrer=0):
    """Rows per day of March 2025; the last day has so many rows without id or referrer."""
    rows = []
    for d, n in per_day.items():
        for i in range(n):
            last = d == max(per_day)
            rows.append((
                None if last and i < null_ids else f"u{i}", f"2025-03-{d:02d}T00:00:00Z", "/",
                ("" if i % 2 else None) if last and i < no_referrer else "r",
            ))
    return rows


def codes(spark, raw, gold, day=DAY):
    frames = spark.createDataFrame(raw, RAW), spark.createDataFrame(gold, GOLD)
    status, alerts, _ = monitor.monitor(*frames, day, "2025-03-09")
    return status.first().status, sorted(r.code for r in alerts.collect())


def sale(revenue, channel="Paid Search", day=DAY):
    return ("t", revenue, channel, channel, f"{day}T01:00:00Z")


STEADY = dict.fromkeys(range(1, 9), 100)


@pytest.mark.parametrize(
    ("rows", "gold", "status", "expected"),
    [
        (raw_rows(STEADY), [sale(10.0)], "GREEN", []),
        (raw_rows({1: 5}), [sale(10.0)], "RED", ["NO_DATA"]),
        (raw_rows(STEADY | {8: 150}), [sale(10.0)], "GREEN", []),
        (raw_rows(STEADY | {8: 151}), [sale(10.0)], "RED", ["VOLUME_ANOMALY"]),
        (raw_rows(STEADY | {8: 50}), [sale(10.0)], "GREEN", []),
        (raw_rows(STEADY | {8: 49}), [sale(10.0)], "RED", ["VOLUME_ANOMALY"]),
        (raw_rows(STEADY, null_ids=5), [sale(10.0)], "GREEN", []),
        (raw_rows(STEADY, null_ids=6), [sale(10.0)], "YELLOW", ["GHOST_USERS"]),
        (raw_rows(STEADY, no_referrer=90), [sale(10.0)], "GREEN", []),
        (raw_rows(STEADY, no_referrer=91), [sale(10.0)], "RED", ["REFERRER_BLACKOUT"]),
        (raw_rows(STEADY), [sale(0.0)], "RED", ["ZERO_REVENUE"]),
        (raw_rows(STEADY), [sale(5.0, day="2025-03-07")], "RED", ["ZERO_REVENUE"]),
        (raw_rows(STEADY), [sale(1000.0, "Email")], "GREEN", []),
        (raw_rows(STEADY), [sale(1000.01, "Email")], "RED", ["PAID_BLINDNESS"]),
        (raw_rows(STEADY), [sale(60.0), sale(40.0, "Unattributed")], "GREEN", []),
        (raw_rows(STEADY), [sale(59.0), sale(41.0, "Unattributed")], "YELLOW", ["HIGH_UNATTRIBUTED"]),
        (raw_rows(STEADY, null_ids=6), [sale(0.0)], "RED", ["GHOST_USERS", "ZERO_REVENUE"]),
    ],
)
def test_one_crafted_day_per_code(spark, rows, gold, status, expected):
    assert codes(spark, rows, gold) == (status, expected)


def test_zero_revenue_with_missing_column(spark):
    raw = spark.createDataFrame([("u1", "2025-03-04T00:00:00Z", "/", "a")], RAW)
    gold = spark.createDataFrame([("t1", 0.0, "Organic", "2025-03-04T01:00:00Z")],
                                 "transaction_id string, revenue double, last_click_channel string, conversion_time string")
    status, alerts, volume = monitor.monitor(raw, gold, "2025-03-04", "2025-03-05")
    assert status.first().status == "RED"
    assert {r.code for r in alerts.collect()} == {"ZERO_REVENUE", "MISSING_GOLD_COL"}
    assert volume.collect()[0]["rolling_avg"] is None


def test_all_days_equal_single_days(spark):
    raw = spark.createDataFrame(raw_rows({1: 10, 2: 30, 4: 12, 5: 11}, null_ids=3), RAW)
    gold = spark.createDataFrame([sale(5.0, day="2025-03-02"), sale(2000.0, "Email", "2025-03-05"), sale(1.0, day="2025-03-06")], GOLD)

    def found(check):
        rows = monitor.alert_rows(monitor.checked_days(raw, gold, check), "2025-03-09").collect()
        return {(r.check_date, r.code, r.message) for r in rows}

    days = [date(2025, 3, d) for d in range(1, 7)]
    assert found(monitor.ALL_DATES) == set().union(*[found(d) for d in days])
    assert found(None) == found(days[-1])


def test_validation_summary_of_the_fixture(spark):
    from builders import PIPELINE_ROWS, raw

    staged = stage_events(raw(spark, PIPELINE_ROWS))
    expect = Expectations("user_A", "user_B", "TXN_C_1", "user_D", "TXN_E_1")
    rows = validation_summary(staged, build_sessions(staged), attribute_events(staged), expect).collect()
    results = {r.test_name[0]: (r.result, r.details) for r in rows}
    assert len(rows) == 9
    # The purchase itself carries the shop as referrer, so the last click is a referral.
    assert results.pop("C") == ("FAIL", "first=Organic Search last=Referral")
    assert {r for r, _ in results.values()} == {"PASS"}
    assert results["G"][1] == "raw=425.00 attributed=425.00"
    assert results["B"][1] == "expected=2 actual=2"


def test_a_day_nobody_delivered_is_red(spark):
    from clickloom.operators import monitor as m

    raw = spark.sql("""SELECT concat('2025-02-0', d, 'T00:00:00Z') AS timestamp, 'u' AS client_id, 'p' AS page_url, 'r' AS referrer
        FROM VALUES (1), (4) t(d)""")
    gold = spark.sql("""SELECT 't' AS transaction_id, 5.0D AS revenue, 'Direct' AS first_click_channel, 'Direct' AS last_click_channel,
        to_timestamp(concat('2025-02-0', d, 'T00:00:00Z')) AS conversion_time FROM VALUES (1), (4) t(d)""")
    status = {str(r.check_date): r.status for r in m.status_rows(m.checked_days(raw, gold, m.ALL_DATES)).collect()}
    assert status == {"2025-02-01": "GREEN", "2025-02-02": "RED", "2025-02-03": "RED", "2025-02-04": "GREEN"}
