import random
from datetime import datetime, timedelta

import brute_force
import pytest
from builders import PIPELINE_ROWS, clock, purchase, raw, raw_row
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom import PANDAS, SQL, Settings
from clickloom.operators.attribution import attribute, attribute_events
from clickloom.operators.normalize import stage_events
from clickloom.operators.sessions import build_sessions, flag_session_starts, session_events

# ------------------------------------------------------------------ 12-row fixture


def facts(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_fixture_sessions(spark):
    found = facts(
        build_sessions(stage_events(raw(spark, PIPELINE_ROWS))),
        "user_id", "session_seq", "events", "session_first_channel", "session_last_channel",
    )
    assert found == [
        ("clientId_ghost", 1, 1, "Direct", "Direct"),
        ("user_A", 1, 1, "Direct", "Direct"),
        ("user_B", 1, 2, "Organic Search", "Organic Search"),
        ("user_B", 2, 1, "Organic Search", "Organic Search"),
        ("user_C", 1, 4, "Organic Search", "Referral"),
        ("user_D", 1, 1, "Organic Social", "Organic Social"),
        ("user_D", 2, 1, "Referral", "Referral"),
        ("user_E", 1, 1, "Direct", "Direct"),
    ]


def clicks(df):
    return {r.transaction_id: (r.revenue, r.first_click_channel, r.last_click_channel) for r in df.collect()}


def test_fixture_attribution_sql(spark):
    assert clicks(attribute_events(stage_events(raw(spark, PIPELINE_ROWS)))) == {
        "TXN_C_1": (150.0, "Organic Search", "Referral"),
        "TXN_D_1": (200.0, "Organic Social", "Referral"),
        "TXN_E_1": (75.0, "Direct", "Direct"),
    }


def test_fixture_attribution_pandas(spark):
    staged = stage_events(raw(spark, PIPELINE_ROWS), PANDAS)
    assert clicks(attribute_events(staged, PANDAS)) == {
        "TXN_C_1": (150.0, "Organic Search", "Organic Search"),
        "TXN_D_1": (200.0, "Organic Social", "Organic Social"),
        "TXN_E_1": (75.0, "Unattributed", "Unattributed"),
    }
    per_user = {r.user_id: r.events for r in build_sessions(staged, PANDAS).where("user_id = 'user_C'").collect()}
    assert per_user == {"user_C": 3}


# -------------------------------------------------------------------- boundaries


@pytest.mark.parametrize(
    ("gap", "ge", "gt"),
    [(dict(minutes=30, microseconds=-1), 1, 1), (dict(minutes=30), 2, 1), (dict(minutes=30, microseconds=1), 2, 2)],
)
@pytest.mark.parametrize("start", ["2025-01-01T00:00:00", "2025-01-01T10:17:31.000007", "1969-12-31T23:50:00"])
def test_gap_boundary(spark, gap, ge, gt, start):
    rows = [raw_row("u", clock(start)), raw_row("u", clock(start, **gap))]
    for settings, expected in ((SQL, ge), (PANDAS, gt)):
        assert build_sessions(stage_events(raw(spark, rows), settings), settings).count() == expected


@pytest.mark.parametrize(("early", "inside"), [(0, True), (1, False)])
def test_lookback_start_is_inclusive(spark, early, inside):
    touch = raw_row("u", clock(microseconds=-early), referrer="https://google.com")
    rows = [touch, purchase("u", clock(days=7), "T", 5, "https://x.org")]
    for settings, alone in ((SQL, "Referral"), (PANDAS, "Unattributed")):
        staged = stage_events(raw(spark, rows), settings)
        first = attribute_events(staged, settings).first().first_click_channel
        assert first == ("Organic Search" if inside else alone)


def test_event_after_conversion_counts_for_last_click(spark):
    rows = [
        raw_row("u", clock(), referrer="https://google.com"),
        purchase("u", clock(minutes=5), "T", 5),
        raw_row("u", clock(minutes=9), path="?utm_medium=email"),
    ]
    last = {s: attribute_events(stage_events(raw(spark, rows), s), s).first().last_click_channel for s in (SQL, PANDAS)}
    assert last == {SQL: "Email", PANDAS: "Organic Search"}


def test_shared_transaction_and_zero_value(spark):
    rows = [
        purchase("u", clock(), "T", 5),
        purchase("v", clock(hours=1), "T", 6),
        raw_row("w", clock(), "purchase", payload='{"transaction_id":"T1","value":0,"revenue":12.5}'),
    ]
    both = {}
    for settings in (SQL, PANDAS):
        gold = attribute_events(stage_events(raw(spark, rows), settings), settings)
        both[settings] = sorted((r.transaction_id, r.user_id, r.revenue) for r in gold.collect())
    assert both[SQL] == [("T", "u", 5.0), ("T", "v", 6.0), ("T1", "w", 0.0)]
    assert both[PANDAS] == [("T", "u", 5.0), ("T1", "w", 12.5)]


def test_null_transaction_ids(spark):
    rows = [raw_row(f"u{i}", clock(hours=i), "purchase", payload=f'{{"value":{i + 1}}}') for i in range(5)]
    assert attribute_events(stage_events(raw(spark, rows))).count() == 0
    kept = attribute_events(stage_events(raw(spark, rows), PANDAS), PANDAS).collect()
    assert [(r.transaction_id, r.revenue) for r in kept] == [(None, 1.0)]


def test_session_longer_than_lookback(spark):
    # Twenty minutes apart for nine days: one session that starts outside the window.
    rows = [raw_row("bot", clock(minutes=20 * i), referrer="https://google.com") for i in range(9 * 72)]
    rows.append(purchase("bot", clock(days=8), "T", 5))
    gold = attribute_events(stage_events(raw(spark, rows))).first()
    assert (gold.first_click_channel, gold.last_click_channel) == ("Direct", "Direct")


# -------------------------------------------------- against brute force, skewed


def skewed_events(seed, n=1500):
    """A third of all events belong to one user, in bursts and gaps around the timeout."""
    rng = random.Random(seed)
    clocks = {}
    rows = []
    for key in range(n):
        user = "hot" if rng.random() < 1 / 3 else f"u{rng.randrange(12)}"
        step = rng.choice([0, 1, 60, 1799, 1800, 1801, 3600, 86_400, 7 * 86_400])
        step = timedelta(seconds=step, microseconds=rng.choice([-1, 0, 1]) if step else 0)
        at = clocks.get(user, datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(5000))) + step
        clocks[user] = at
        rows.append((user, at, key, rng.choice(["Email", "Direct", "Referral", "Paid Search"]), rng.random() < 0.3))
    rng.shuffle(rows)
    return rows


STAGED = (
    "user_id string, event_ts timestamp_ntz, event_key long, derived_channel string, buys boolean"
)
CASES = {
    "sql": SQL,
    "pandas": PANDAS,
    "short slices": Settings(slice_seconds=60),
    "long timeout": Settings(timeout_minutes=50, boundary="gt", lookback_days=2),
    "strict": Settings(include_conversion_start=False, last_click_from="first"),
}


@pytest.mark.parametrize("case", CASES)
def test_against_brute_force(spark, case):
    settings = CASES[case]
    rows = skewed_events(case)
    staged = spark.createDataFrame(rows, STAGED).selectExpr(
        "user_id", "cast(event_ts as timestamp) event_ts", "event_key", "derived_channel", "buys", "'page_viewed' event_name",
        "cast(null as string) page_url", "cast(null as string) utm_source", "cast(null as string) utm_medium",
        "cast(null as string) utm_campaign", "cast(null as double) revenue", "cast(null as string) transaction_id",
    )
    expected = brute_force.sessions([r[:4] for r in rows], settings)
    built = build_sessions(staged, settings)
    found = built.selectExpr(
        "user_id", "session_seq", "cast(session_start_ts as timestamp_ntz)", "cast(session_end_ts as timestamp_ntz)",
        "events", "session_first_channel", "session_last_channel",
    )
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)

    starts = {(s[0], s[2]) for s in expected}
    flagged = flag_session_starts(staged, settings).where("is_new_session")
    assert {(r.user_id, r.ts) for r in flagged.selectExpr("user_id", "cast(event_ts as timestamp_ntz) ts").collect()} == starts
    assert session_events(staged, settings).count() == len(rows)
    per_session = session_events(staged, settings).groupBy("session_id").count().collect()
    assert sorted(r["count"] for r in per_session) == sorted(s[4] for s in expected)

    buys = [(f"T{r[2]}", r[0], r[1]) for r in rows if r[4]]
    conversions = spark.createDataFrame(
        [(t, u, at, 1.0) for t, u, at in buys], "transaction_id string, user_id string, conversion_ts timestamp_ntz, revenue double"
    ).selectExpr("transaction_id", "user_id", "cast(conversion_ts as timestamp) conversion_ts", "revenue")
    gold = attribute(conversions, built, settings).collect()
    assert {(r.transaction_id, r.user_id): (r.first_click_channel, r.last_click_channel) for r in gold} == (
        brute_force.attribution(buys, expected, settings)
    )


# -------------------------------------------------------------------------- plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_attribution_plan(spark, sf_dir):
    from clickloom.plans.sample_events import raw_events

    text = plan(attribute_events(stage_events(raw_events(spark, sf_dir))))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert node not in text


def test_session_scan_is_pruned(spark, sf_dir):
    from clickloom.plans.sample_events import raw_events

    text = plan(build_sessions(stage_events(raw_events(spark, sf_dir))))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "value" not in scan.split("ReadSchema")[1] and "props" not in scan.split("ReadSchema")[1]
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("settings", [SQL, PANDAS, Settings(slice_seconds=120, lookback_days=1)])
def test_both_ways_of_attribution_agree(spark, sf_dir, settings):
    from clickloom.operators.conversions import conversions
    from clickloom.plans.sample_events import raw_events

    staged = stage_events(raw_events(spark, sf_dir), settings)
    direct = attribute_events(staged, settings)
    by_table = attribute(conversions(staged, settings), build_sessions(staged, settings), settings)
    assert direct.exceptAll(by_table).count() == 0 and direct.count() == by_table.count() > 0


@pytest.mark.parametrize("settings", [SQL, PANDAS])
def test_session_starts_over_many_ranges(spark, settings):
    r, rows, key = random.Random(11), [], 0
    for user, n in [("hot", 3000), ("warm", 400), *[(f"u{i}", r.randrange(1, 6)) for i in range(200)]]:
        at = 0
        for _ in range(n):
            at += r.choice((0, 1, 60, 1799, 1800, 1801, 7200))
            key += 1
            rows.append((user, at, key))
    events = spark.createDataFrame(rows, "user_id string, at long, event_key long").select(
        "user_id", F.timestamp_seconds("at").alias("event_ts"), "event_key"
    )
    line = Window.partitionBy("user_id").orderBy("event_ts", "event_key")
    wanted = events.withColumn("prev_ts", F.lag("event_ts").over(line))
    gap = F.unix_seconds("event_ts") - F.unix_seconds("prev_ts")
    new = F.col("prev_ts").isNull() | (gap >= 1800 if settings.boundary == "ge" else gap > 1800)
    wanted = wanted.withColumn("is_new_session", new).withColumn("session_seq", F.sum(new.cast("long")).over(line))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = flag_session_starts(events, settings).drop("session_id").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    columns = found[0].__fields__
    assert sorted(map(tuple, found)) == sorted(map(tuple, wanted.select(*columns).collect()))
