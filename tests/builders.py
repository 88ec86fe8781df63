"""Small event tables for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

RAW_SCHEMA = (
    "client_id string, clientId string, timestamp string, event_name string, page_url string, "
    "referrer string, event_data string"
)
SHOP = "https://example.com"


def raw_row(user, when, name="page_view", path="/", referrer="", payload="{}", alternate=None):
    return (user, alternate, when, name, f"{SHOP}{path}", referrer, payload)


def purchase(user, when, transaction, value, referrer=""):
    payload = f'{{"transaction_id":"{transaction}","value":{value}}}'
    return raw_row(user, when, "purchase", "/checkout", referrer, payload)


# The twelve rows whose sessions and channels the pipeline checks expect.
PIPELINE_ROWS = [
    raw_row("user_A", "2025-11-01T10:00:00Z", path="/home"),
    raw_row("user_B", "2025-11-02T10:00:00Z", path="/p1", referrer="https://google.com"),
    raw_row("user_B", "2025-11-02T10:10:00Z", path="/p2", referrer="https://google.com"),
    raw_row("user_B", "2025-11-02T10:45:00Z", path="/p3", referrer="https://bing.com"),
    raw_row("user_C", "2025-11-03T09:00:00Z", path="/p", referrer="https://google.com"),
    raw_row("user_C", "2025-11-03T09:05:00Z", "click", "/landing?utm_source=adnetwork&utm_medium=cpc&utm_campaign=camp1",
            "https://adtracker.com"),
    purchase("user_C", "2025-11-03T09:10:00Z", "TXN_C_1", 150.0, SHOP),
    raw_row("user_D", "2025-10-27T08:00:00Z", path="/early", referrer="https://facebook.com"),
    purchase("user_D", "2025-11-03T08:00:00Z", "TXN_D_1", 200.0, SHOP),
    purchase("user_E", "2025-11-05T12:00:00Z", "TXN_E_1", 75.0),
    raw_row(None, "2025-11-04T11:00:00Z", path="/ghost", alternate="clientId_ghost"),
    purchase("user_C", "2025-11-03T09:10:00Z", "TXN_C_1", 150.0, SHOP),
]


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def iso(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def clock(start="2025-01-01T00:00:00", **after) -> str:
    return iso(datetime.fromisoformat(start) + timedelta(**after))
