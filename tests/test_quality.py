from builders import raw_row
from pyspark.sql import functions as F

from clickloom.functions import fields
from clickloom.operators import contract, quality
from clickloom.operators.duplicates import duplicate_rows, duplicate_transaction_count
from clickloom.operators.metrics import conversion_rates, period_totals
from clickloom.sources.quarantine import replay, route

# Fourteen reported days (file date, status, drift, no referrer, null rate,
# rows, revenue, purchases, changes of revenue and rows).
GOLDEN = [
    ("20250223", "PASS", False, False, 0.005405, 4070, 20408.0, 21, None, None),
    ("20250224", "PASS", False, False, 0.014593, 3769, 25457.6, 26, 0.247432, -0.073956),
    ("20250225", "PASS", False, False, 0.009798, 3470, 13543.0, 16, -0.468017, -0.079331),
    ("20250226", "PASS", False, False, 0.014479, 3177, 18629.0, 15, 0.375545, -0.084438),
    ("20250227", "WARNING", True, False, 0.010021, 3393, 18148.0, 21, -0.025820, 0.067989),
    ("20250228", "WARNING", True, False, 0.008275, 3263, 18669.0, 19, 0.028708, -0.038314),
    ("20250301", "WARNING", True, False, 0.006592, 3489, 33183.0, 29, 0.777439, 0.069261),
    ("20250302", "CRITICAL", True, False, 0.158016, 4335, 28221.0, 22, -0.149534, 0.242476),
    ("20250303", "WARNING", True, False, 0.086838, 4042, 20504.8, 24, -0.273421, -0.067589),
    ("20250304", "WARNING", True, True, 0.084794, 3538, 12415.0, 20, -0.394532, -0.124691),
    ("20250305", "WARNING", True, True, 0.079139, 2881, 20714.0, 20, 0.668466, -0.185698),
    ("20250306", "WARNING", True, True, 0.082801, 3442, 21754.0, 23, 0.050208, 0.194724),
    ("20250307", "WARNING", True, True, 0.083051, 3251, 18331.0, 16, -0.157350, -0.055491),
    ("20250308", "CRITICAL", True, True, 0.142597, 3843, 24484.0, 22, 0.335661, 0.182098),
]
GOLDEN_SCHEMA = (
    "file string, status string, drift boolean, no_referrer boolean, null_rate double, rows long, revenue double, "
    "purchases long, revenue_change double, volume_change double"
)


def test_golden_changes_and_status(spark):
    golden = spark.createDataFrame(GOLDEN, GOLDEN_SCHEMA)
    checks = (F.col("drift"), F.col("no_referrer"), F.col("null_rate"))
    found = quality.with_day_over_day(golden).withColumns(
        {"found": quality.file_status(*checks), "alerts": quality.file_alerts(*checks)}
    )
    for r in found.collect():
        assert r.found == r.status
        for value, expected in ((r.revenue_dod_pct, r.revenue_change), (r.vol_dod_pct, r.volume_change)):
            assert value is expected is None or abs(value - expected) < 1e-6
        assert (r.null_rate > 0.05) == any(a.startswith("HIGH_NULLS") for a in r.alerts)
    worst = {r.file: r.s for r in golden.select("file", quality.file_status(*checks, "max").alias("s")).collect()}
    assert worst["20250304"] == "CRITICAL"


def test_golden_totals(spark):
    totals = spark.createDataFrame(GOLDEN, GOLDEN_SCHEMA).agg(F.sum("rows"), F.sum("purchases"), F.sum("revenue")).first()
    assert totals[0] == 49_963 and totals[1] == 294 and abs(totals[2] - 294_461.40) < 1e-6


def test_published_rates(spark):
    counts = {"page_viewed": 45_974, "product_added_to_cart": 2_307, "checkout_started": 836, "checkout_completed": 294}
    names = F.explode(F.flatten(F.array(*[F.array_repeat(F.lit(n), c) for n, c in counts.items()])))
    rates = conversion_rates(spark.range(1).select(names.alias("event_name"))).first()
    assert [round(100 * r, 2) for r in rates] == [0.64, 5.02, 35.17]


PAYLOADS = [
    None, "", " ", "{", "[1]", "3", "null", "{}", '{"revenue":1.5}', '{"revenue":"1.50","x":null}', '{"revenue":{"a":1}}',
    '{"revenue":"abc"}', '{"revenue":true}', '{"value":0,"total":-2}', '{"revenue":null,"value":"7"}', '{"revenue":1e3,"transaction_id":""}',
    '{"transaction_id":"t1","revenue":12345678901234567890}', '{"transaction_id":17,"revenue":0.0}', '{"é":"\\u00e9","revenue":"é"}', '{"transaction_id":"t1"} x',
]


def test_a_parsed_payload_reads_like_its_text(spark):
    events, parsed = fields.with_parsed(spark.createDataFrame([(p, 1) for p in PAYLOADS], "event_data string, Payload int"))
    assert parsed not in ("payload", "Payload") and events.columns == ["event_data", "Payload", parsed]
    payload = F.col("event_data")
    same = [
        F.col(parsed).isNull().eqNullSafe(F.try_parse_json(payload).isNull()),
        F.sort_array(fields.parsed_keys(F.col(parsed))).eqNullSafe(F.sort_array(F.json_object_keys(payload))),
    ]
    for key in ("revenue", "value", "transaction_id"):
        text = F.get_json_object(payload, f"$.{key}")
        number = fields.as_number(fields.parsed_text(F.col(parsed), key))
        same.append(number.eqNullSafe(fields.as_number(text)) & (F.col(parsed).isNull() | text.isNull().eqNullSafe(fields.parsed_text(F.col(parsed), key).isNull())))
    assert [r for r in events.select("event_data", *[c.alias(f"same{i}") for i, c in enumerate(same)]).collect() if not all(r[1:])] == []


def test_payload_parsed_once_a_row(spark):
    events = day([raw_row("a", "2025-03-01T10:00:00Z", "purchase", payload=p) for p in PAYLOADS], spark)

    def parses(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return max(line.count("parseJson(") for line in plan.splitlines()), "get_json_object" in plan

    assert parses(contract.row_violations(events)) == (1, False)
    assert parses(contract.contract_violations(events)) == (1, False)
    assert parses(quality.file_profile(events, "event_date")) == (1, False)
    assert parses(contract.tag_rows(events).where(contract.must_quarantine(F.col("findings")))) == (1, False)
    assert parses(route(events)) == (1, False)


def day(rows, spark, date="2025-03-01"):
    schema = "client_id string, clientId string, timestamp string, event_name string, page_url string, referrer string, event_data string"
    return spark.createDataFrame(rows, schema).withColumn("file", F.lit(f"events_{date}.csv")).withColumn(
        "event_date", F.lit(date).cast("date")
    )


def test_report_of_broken_and_overwritten_days(spark):
    fine = [raw_row(f"u{i}", "2025-03-01T00:00:00Z", referrer="https://a.b") for i in range(20)]
    broken = day([*fine, raw_row("x", "2025-03-02T00:00:00Z", payload="{")], spark, "2025-03-02")
    word = day([*fine, raw_row("x", "2025-03-03T00:00:00Z", "purchase", payload='{"value":"much"}')], spark, "2025-03-03")
    blind = [(None, a, t, n, p, None, d) for a, _, t, n, p, _, d in fine]
    lost = day([*blind, (None, None, "2025-03-04T00:00:00Z", "page_view", "/", None, "{}"),
                (None, None, "2025-03-04T00:00:01Z", "page_view", "/", None, "{}")], spark, "2025-03-04")
    report = {r.file: r for r in quality.dq_report(day(fine, spark).union(broken).union(word).union(lost)).collect()}
    ok, b, w, n = (report[f"events_2025-03-0{i}.csv"] for i in range(1, 5))
    assert (ok.status, ok.alerts, ok.rows, ok.duplicate_rows) == ("PASS", [], 20, 0)
    assert b.status == w.status == "ERROR" and b.rows == 21 and b.revenue is None and b.event_breakdown is None
    # Drift, no referrer (critical) and 2 of 22 without identity: the null rate has the last word.
    assert n.status == "WARNING" and [a.split(":")[0] for a in n.alerts] == ["SCHEMA_DRIFT", "MISSING_COL", "HIGH_NULLS"]
    assert n.alerts[2] == "HIGH_NULLS: 9.1%"


def test_duplicates_with_colliding_hashes(spark):
    rows = day([raw_row("u", "2025-03-01T00:00:00Z")] * 3 + [raw_row("v", "2025-03-01T00:00:00Z")], spark)
    assert [r.duplicate_rows for r in duplicate_rows(rows, "file", rows.columns).collect()] == [2]
    assert duplicate_transaction_count(rows, "file").first()[0] == 0


def test_truthiness_chain(spark):
    payloads = {
        '{"value":0,"revenue":12.5}': 12.5,
        '{"value":"","total":"3"}': 3.0,
        '{"value":null,"revenue":0,"total":7}': 7.0,
        '{"value":4,"revenue":9}': 4.0,
        '{"value":0}': 0.0,
    }
    for payload, expected in payloads.items():
        rows = day([raw_row("u", "2025-03-01T00:00:00Z", "purchase", payload=payload)], spark)
        assert period_totals(rows).first().revenue == expected


def rules(df):
    return {(r.rule, r.key): (r.severity, r.n) for r in df.collect()}


def test_contract_rules(spark):
    rows = [
        raw_row("u", "junk", "page_viewed"),
        raw_row("u", "2025-03-01T00:00:00Z", "checkout_completed", payload='{"transaction_id":"T","revenue":"x"}'),
        raw_row("u", "2025-03-01T00:00:00Z", "checkout_completed", payload='{"transaction_id":"T","revenue":-1}'),
        raw_row("u", "2025-03-01T00:00:00Z", "product_added_to_cart", payload='{"item_id":"I","colour":"red"}'),
        raw_row("u", "2025-03-01T00:00:00Z", "checkout_started", payload="{}"),
        raw_row("u", "2025-03-09T00:00:00Z", "page_viewed", payload="{]"),
        raw_row(None, "2025-03-01T00:00:00Z", "page_viewed", alternate="u"),
    ]
    found = rules(contract.contract_violations(day(rows, spark).withColumn("ingest_date", F.lit("2025-03-01").cast("date"))))
    assert found == {
        ("R1_required_column", "user_agent"): ("CRITICAL", 1),
        ("P3_alternate_column", "clientId"): ("WARNING", 1),
        ("R2_timestamp", "timestamp"): ("CRITICAL", 1),
        ("R4_payload_empty", "checkout_started"): ("WARNING", 1),
        ("R4_payload_json", "page_viewed"): ("CRITICAL", 1),
        ("R5_required_key", "item_name"): ("CRITICAL", 1),
        ("R5_required_key", "step"): ("CRITICAL", 1),
        ("R6_unknown_key", "colour"): ("INFO", 1),
        ("R7_revenue_numeric", "revenue"): ("CRITICAL", 1),
        ("R11_revenue_positive", "revenue"): ("CRITICAL", 2),
        ("R12_timestamp_range", "timestamp"): ("WARNING", 1),
        ("R9_duplicate_transaction", "T"): ("CRITICAL", 2),
        ("R10_purchase_follows_checkout", "checkout_completed"): ("CRITICAL", 1),
        ("R14_column_type", "timestamp"): ("WARNING", 1),
        ("R14_column_type", "event_data"): ("WARNING", 1),
    }


def test_quarantine_and_replay(spark):
    good = raw_row("u", "2025-03-01T00:00:00Z", "page_viewed")
    bad = raw_row("u", "2025-03-01T00:00:00Z", "page_viewed", payload="{]")
    routed = route(day([good, good, good, bad], spark))
    zones = {(r.zone, tuple(r.reasons)): r["rows"] for r in routed.collect()}
    assert zones == {("clean", ()): 1, ("quarantine", ("R8_duplicate_row",)): 2, ("quarantine", ("R4_payload_json",)): 1}
    held = routed.where("zone = 'quarantine' AND array_contains(reasons, 'R4_payload_json')")
    assert [r.zone for r in replay(held).collect()] == ["quarantine"]
    repaired = held.withColumn("event_data", F.lit("{}"))
    assert [r.zone for r in replay(repaired).collect()] == ["clean"]


def test_a_repeat_stays_held_on_replay(spark):
    good = raw_row("u", "2025-03-01T00:00:00Z", "page_viewed")
    bad = raw_row("u", "2025-03-01T00:00:00Z", "page_viewed", payload="{]")
    held = route(day([good, good, good, bad, bad], spark)).where("zone = 'quarantine'")
    again = {(r.zone, tuple(r.reasons)): r["rows"] for r in replay(held).collect()}
    assert again == {
        ("quarantine", ("R8_duplicate_row",)): 2,
        ("quarantine", ("R4_payload_json",)): 1,
        ("quarantine", ("R4_payload_json", "R8_duplicate_row")): 1,
    }


def test_payloads_without_the_required_keys_are_held(spark):
    when = "2025-03-01T00:00:00Z"
    rows = [raw_row(str(i), when, "purchase", payload=p) for i, p in enumerate((None, "[1]", "{ }", " ", "{]", "3"))]
    sound = raw_row("s", when, "purchase", payload='{"transaction_id":"T","revenue":1}')
    assert {r.client_id: r.zone for r in route(day([*rows, sound], spark)).collect()} == {
        **dict.fromkeys("012345", "quarantine"), "s": "clean"}
    found = rules(contract.row_violations(day(rows, spark)))
    assert found["R4_payload_empty", "purchase"] == ("WARNING", 3)
    assert found["R4_payload_json", "purchase"] == ("CRITICAL", 4)
    assert found["R5_required_key", "revenue"] == ("CRITICAL", 6)


def test_order_ids_are_no_transactions_of_the_contract(spark):
    rows = [raw_row("u", "2025-03-01T00:00:00Z", "purchase", payload='{"order_id":"O"}')] * 2
    assert contract.repeated_transactions(day(rows, spark)).count() == 0


def test_range_and_volume(spark):
    events = spark.sql("""
        SELECT date_add(DATE '2025-03-01', day) AS event_date, concat('events_', date_format(date_add(DATE '2025-03-01', day), 'yyyyMMdd'), '.csv') AS file,
          if(day = 2 AND n = 0, '2025-03-09T00:00:00Z', concat('2025-03-0', day + 1, 'T00:00:00Z')) AS timestamp,
          'u' AS client_id, 'page_viewed' AS event_name, '{}' AS event_data, CAST(n AS STRING) AS page_url
        FROM (SELECT CAST(id AS INT) AS day, explode(sequence(0, if(id = 3, 30, 9))) AS n FROM range(4))""")
    found = {(r.rule, str(r.event_date), r.n) for r in contract.contract_violations(events).where("rule LIKE 'R12%' OR rule LIKE 'R15%'").collect()}
    assert found == {("R12_timestamp_range", "2025-03-03", 1), ("R15_volume", "2025-03-04", 31)}
