"""The event contract: row and group rules compiled to columns, and their violations."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import fields
from clickloom.operators.duplicates import duplicate_rows, duplicate_transactions
from clickloom.operators.monitor import VOLUME_DAYS, VOLUME_DEVIATION
from clickloom.operators.normalize import ALIASES, PROVENANCE, fill_missing, fold_aliases, is_conversion


@dataclass(frozen=True)
class EventRule:
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    may_be_empty: bool = False
    numeric_revenue: bool = False


# The contract's required columns, per-event keys, thresholds and the codes
# and severities that are worth a notification.
REQUIRED_COLUMNS = (
    "client_id", "page_url", "referrer", "timestamp", "event_name", "event_data", "user_agent",
)
EVENT_RULES = {
    "checkout_completed": EventRule(
        ("transaction_id", "revenue"), ("currency", "items", "coupon"), numeric_revenue=True
    ),
    "purchase": EventRule(("transaction_id", "revenue")),
    "product_added_to_cart": EventRule(("item_id", "item_name"), ("quantity", "price")),
    "checkout_started": EventRule(("step",), ("cart_value",)),
    "page_viewed": EventRule((), ("title", "query_params"), may_be_empty=True),
}
NULL_WARNING = 0.05
NULL_CRITICAL = 0.2
INGEST_DAYS = 3
FILE_DAY = r"(\d{8})\.csv"
TRANSACTION_KEYS = ("transaction_id",)
NOTIFY_CODES = (
    "schema_drift", "high_client_id_nulls", "missing_event_payloads", "duplicate_transaction",
    "malformed_timestamp", "volume_anomaly",
)
NOTIFY_SEVERITIES = ("WARNING", "CRITICAL")


@dataclass(frozen=True)
class Contract:
    required_columns: tuple[str, ...] = REQUIRED_COLUMNS
    aliases: dict[str, str] = field(default_factory=lambda: dict(ALIASES))
    event_rules: dict[str, EventRule] = field(default_factory=lambda: dict(EVENT_RULES))
    null_warning: float = NULL_WARNING
    critical_null_rate: float = NULL_CRITICAL
    ingest_days: int = INGEST_DAYS
    transaction_keys: tuple[str, ...] = TRANSACTION_KEYS


DEFAULT = Contract()


def _lookup(contract: Contract, pick) -> Column:
    """Array of keys an event's rule names; NULL for events the contract does not know."""
    pairs = [(F.lit(name), F.array(*map(F.lit, pick(rule))).cast("array<string>"))
             for name, rule in contract.event_rules.items()]
    return F.create_map(*[column for pair in pairs for column in pair])[F.col("event_name")]


def _names(contract: Contract, test) -> list[str]:
    return [name for name, rule in contract.event_rules.items() if test(rule)]


def _finding(rule: str, severity: str, code: str, key: Column | str) -> Column:
    key = F.lit(key) if isinstance(key, str) else key
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        F.lit(code).alias("code"),
        key.cast("string").alias("key"),
    )


def ingest_day(events: DataFrame) -> Column | None:
    """The day an event was delivered: ``ingest_date``, else the day in its file's name; None if neither is known."""
    if "ingest_date" in events.columns:
        return F.to_date("ingest_date")
    if "file" in events.columns:
        return F.try_to_timestamp(F.regexp_extract("file", FILE_DAY, 1), F.lit("yyyyMMdd")).cast("date")
    return None


def row_findings(events: DataFrame, parsed: Column, contract: Contract = DEFAULT) -> Column:
    """Array of findings for one raw event, its payload parsed; empty for a clean one."""
    payload = F.col("event_data")
    # Keys of an object; NULL for a missing payload, broken JSON and JSON that is no object.
    keys = fields.parsed_keys(parsed)
    nothing = F.array().cast("array<string>")
    moment = fields.instant(events, "timestamp")
    bare = (F.trim(F.coalesce(payload, F.lit(""))) == "") | F.coalesce(F.size(keys) == 0, F.lit(False))
    revenue = fields.parsed_text(parsed, "revenue")
    amount = F.coalesce(*[fields.parsed_text(parsed, k) for k in ("revenue", "value", "total")])
    number = fields.as_number(amount)
    single = [
        (
            F.col("timestamp").isNotNull() & moment.isNull(),
            _finding("R2_timestamp", "CRITICAL", "malformed_timestamp", "timestamp"),
        ),
        (
            bare & ~F.coalesce(F.col("event_name").isin(*_names(contract, lambda r: r.may_be_empty)), F.lit(False)),
            _finding("R4_payload_empty", "WARNING", "missing_event_payloads", F.col("event_name")),
        ),
        (
            payload.isNotNull() & keys.isNull(),
            _finding("R4_payload_json", "CRITICAL", "missing_event_payloads", F.col("event_name")),
        ),
        (
            F.col("event_name").isin(*_names(contract, lambda r: r.numeric_revenue))
            & revenue.isNotNull()
            & fields.as_number(revenue).isNull(),
            _finding("R7_revenue_numeric", "CRITICAL", "revenue_not_numeric", "revenue"),
        ),
        (
            is_conversion() & amount.isNotNull() & (number.isNull() | (number <= 0)),
            _finding("R11_revenue_positive", "CRITICAL", "revenue_not_positive", "revenue"),
        ),
    ]
    arrived = ingest_day(events)
    if arrived is not None:
        apart = F.abs(F.datediff(F.to_date(moment), arrived))
        single.append(
            (
                apart > contract.ingest_days,
                _finding("R12_timestamp_range", "WARNING", "timestamp_out_of_range", "timestamp"),
            )
        )
    fixed = F.array(*[F.when(test, finding) for test, finding in single])
    required = F.array_except(_lookup(contract, lambda r: r.required), F.coalesce(keys, nothing))
    unknown = F.array_except(keys, _lookup(contract, lambda r: r.required + r.optional))
    absent = F.transform(
        F.coalesce(required, nothing), lambda k: _finding("R5_required_key", "CRITICAL", "missing_key", k)
    )
    extra = F.transform(F.coalesce(unknown, nothing), lambda k: _finding("R6_unknown_key", "INFO", "unknown_key", k))
    return F.concat(F.filter(fixed, lambda f: f.isNotNull()), absent, extra)


def tag_rows(raw: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """Raw events (aliases folded, absent columns NULL) with their ``findings``.

    Unfolding an array of one makes the findings the output of a generator, below which no
    filter on them can be pushed, so the payload is not parsed again for it.
    """
    events = fill_missing(fold_aliases(raw, contract.aliases), ("client_id", "event_data"))
    with_payload, parsed = fields.with_parsed(events)
    findings = F.explode(F.array(row_findings(with_payload, F.col(parsed), contract)))
    return with_payload.select(*[F.col(c) for c in events.columns if c != "findings"], findings.alias("findings"))


def must_quarantine(findings: Column) -> Column:
    return F.exists(findings, lambda f: f["severity"] == "CRITICAL")


def row_violations(raw: DataFrame, day: str = "event_date", contract: Contract = DEFAULT) -> DataFrame:
    """Counts of row findings per rule, day and key: one scan, combined before the shuffle."""
    return (
        tag_rows(raw, contract)
        .select(F.col(day).alias("event_date"), F.explode("findings").alias("f"))
        .groupBy("f.rule", "f.severity", "f.code", "event_date", "f.key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _labels(rule: str, severity: str, code: str) -> list[Column]:
    return [F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), F.lit(code).alias("code")]


def _folded(raw: DataFrame, name: str, contract: Contract) -> Column:
    """A column under its expected name, alternates included; NULL if there is none."""
    names = [n for n in (name, *[a for a, to in contract.aliases.items() if to == name]) if n in raw.columns]
    return F.coalesce(*names) if names else F.lit(None).cast("string")


def day_flags(raw: DataFrame, contract: Contract = DEFAULT, parsed: Column | None = None) -> dict[str, Column]:
    """What each event adds to its day: conditions whose counts the rules about a whole day need."""
    moment = fields.instant(raw, "timestamp")
    parsed = F.try_parse_json("event_data") if parsed is None else parsed

    def present(name: str) -> Column:
        if "header" in raw.columns:
            accepted = (name, *[a for a, to in contract.aliases.items() if to == name])
            return fields.either([F.array_contains("header", n) for n in accepted])
        return _folded(raw, name, contract).isNotNull()

    return {
        "total": F.lit(True),
        **{f"present_{c}": present(c) for c in contract.required_columns},
        **{f"alternate_{a}": F.col(a).isNotNull() for a in contract.aliases if a in raw.columns},
        "null_ids": _folded(raw, "client_id", contract).isNull(),
        "completed": F.col("event_name") == "checkout_completed",
        "started": F.col("event_name") == "checkout_started",
        "bad_timestamp": F.col("timestamp").isNotNull() & moment.isNull(),
        "bad_event_data": F.col("event_data").isNotNull() & parsed.isNull(),
    }


def day_profile(raw: DataFrame, day: str = "event_date", contract: Contract = DEFAULT) -> DataFrame:
    """Everything the rules about a whole day need, one row per day from one pass."""
    counts = [F.count_if(test).alias(name) for name, test in day_flags(raw, contract).items()]
    return raw.groupBy(F.col(day).alias("event_date")).agg(*counts)


def day_violations(raw: DataFrame, day: str = "event_date", contract: Contract = DEFAULT) -> DataFrame:
    """Violations of the rules about a whole day; see ``judged_days``."""
    return judged_days(day_profile(raw, day, contract), contract)


def judged_days(profile: DataFrame, contract: Contract = DEFAULT) -> DataFrame:
    """Violations of the rules about a whole day, from its profile.

    R1: a required column the day lacks (one without a single value counts as absent).
    P3: an alternate column name is in use; the events themselves are normalised.
    R3: too many events without identity; above the critical rate ingestion fails.
    R10: more completed than started checkouts; n is the excess.
    R14: values that do not fit the declared column type.
    R15: a row count far from the mean of the days with data before it.
    """

    def found(test: Column, rule: str, severity: Column | str, code: str, key: str, n: Column) -> Column:
        severity = F.lit(severity) if isinstance(severity, str) else severity
        columns = {"rule": F.lit(rule), "severity": severity, "code": F.lit(code), "key": F.lit(key), "n": n.cast("bigint")}
        return F.when(test, F.struct(*[c.alias(name) for name, c in columns.items()]))

    def above_zero(column: str) -> tuple[Column, Column]:
        return F.col(column) > 0, F.col(column)

    # NULL sorts first; ordering the flag puts the rows without a day last.
    before = Window.orderBy(F.col("event_date").isNull(), "event_date").rowsBetween(-VOLUME_DAYS, -1)
    rate = F.try_divide(F.col("null_ids"), F.col("total"))
    excess = F.col("completed") - F.col("started")
    findings = [
        found(F.col(f"present_{c}") == 0, "R1_required_column", "CRITICAL", "schema_drift", c, F.lit(1))
        for c in contract.required_columns
    ]
    for alternate in contract.aliases:
        if f"alternate_{alternate}" in profile.columns:
            test, n = above_zero(f"alternate_{alternate}")
            findings.append(found(test, "P3_alternate_column", "WARNING", "schema_drift", alternate, n))
    findings.append(
        found(
            rate > contract.null_warning,
            "R3_null_identity",
            F.when(rate > contract.critical_null_rate, "CRITICAL").otherwise("WARNING"),
            "high_client_id_nulls",
            "client_id",
            F.col("null_ids"),
        )
    )
    findings.append(
        found(excess > 0, "R10_purchase_follows_checkout", "CRITICAL", "checkout_mismatch", "checkout_completed", excess)
    )
    usual = F.col("usual_total")
    odd = (F.col("total") < usual * (1 - VOLUME_DEVIATION)) | (F.col("total") > usual * (1 + VOLUME_DEVIATION))
    findings.append(found(odd, "R15_volume", "WARNING", "volume_anomaly", "rows", F.col("total")))
    for column in ("timestamp", "event_data"):
        test, n = above_zero(f"bad_{column}")
        findings.append(found(test, "R14_column_type", "WARNING", "column_type", column, n))
    return (
        # The window is unpartitioned, but over one row per day; rows without a day have no place in it.
        profile.withColumn("usual_total", F.when(F.col("event_date").isNotNull(), F.avg("total").over(before)))
        .select("event_date", F.explode(F.filter(F.array(*findings), lambda f: f.isNotNull())).alias("f"))
        .select("f.rule", "f.severity", "f.code", "event_date", "f.key", "f.n")
    )


def repeated_rows(raw: DataFrame, day: str = "event_date") -> DataFrame:
    """R8: exact copies per day."""
    columns = [c for c in raw.columns if c not in (day, *PROVENANCE)]
    return duplicate_rows(raw, day, columns).select(
        *_labels("R8_duplicate_row", "WARNING", "duplicate_row"),
        F.col(day).alias("event_date"),
        F.lit(None).cast("string").alias("key"),
        F.col("duplicate_rows").alias("n"),
    )


def repeated_transactions(raw: DataFrame, day: str = "event_date", contract: Contract = DEFAULT) -> DataFrame:
    """R9: events per day and transaction, for transactions seen more than once."""
    return _transaction_findings(duplicate_transactions(raw, day, contract.transaction_keys).withColumnRenamed(day, "event_date"))


def _transaction_findings(places: DataFrame) -> DataFrame:
    return places.select(
        *_labels("R9_duplicate_transaction", "CRITICAL", "duplicate_transaction"),
        "event_date",
        F.col("transaction").alias("key"),
        F.col("occurrences").alias("n"),
    )


def contract_violations(raw: DataFrame, day: str = "event_date", contract: Contract = DEFAULT) -> DataFrame:
    """(rule, severity, code, event_date, key, n) over all rules, in three passes over the events.

    One pass gives every rule that looks at a row, a day or a transaction: each event is
    unfolded into the facts it adds, and facts are counted with map-side combine.  The
    branches that read these counts share that one exchange: they are told apart by an
    aggregate, which Spark can't push below it.  The other two passes find exact copies.
    """
    events, parsed = fields.with_parsed(raw)
    flags = day_flags(raw, contract, F.col(parsed))
    flagged = events.withColumn("flags", F.struct(*[test.alias(name) for name, test in flags.items()]))
    flagged = fill_missing(fold_aliases(flagged, contract.aliases), ("client_id",))
    tagged = flagged.withColumn("findings", row_findings(flagged, F.col(parsed), contract))
    nothing = F.lit(None).cast("string")
    none = F.lit(None).cast(flagged.schema["flags"].dataType)

    def fact(kind: str, rule=nothing, severity=nothing, code=nothing, key=nothing, own=none) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), rule.alias("rule"), severity.alias("severity"), code.alias("code"), key.alias("key"), own.alias("flags")
        )

    transaction = F.when(is_conversion(), fields.first_truthy_of(F.col(parsed), contract.transaction_keys))
    facts = F.concat(
        F.array(fact("day", own=F.col("flags"))),
        F.filter(F.array(F.when(transaction.isNotNull(), fact("transaction", key=transaction))), lambda f: f.isNotNull()),
        F.transform("findings", lambda f: fact("finding", f["rule"], f["severity"], f["code"], f["key"])),
    )
    keys = ["event_date", "kind", "rule", "severity", "code", "key"]
    counted = (
        tagged.select(F.col(day).alias("event_date"), F.explode(facts).alias("f"))
        .select("event_date", "f.*")
        .groupBy(*keys)
        .agg(F.max("kind").alias("what"), F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"flags.{f}")).alias(f) for f in flags])
    )

    def of(kind: str) -> DataFrame:
        return counted.where(F.col("what") == kind)

    columns = ["rule", "severity", "code", "event_date", "key", "n"]
    placed = of("transaction").select("event_date", F.col("key").alias("transaction"), F.col("n").alias("occurrences"))
    repeated = placed.groupBy("transaction").agg(F.sum("occurrences").alias("all")).where("all > 1").select("transaction")
    parts = [
        judged_days(of("day").select("event_date", *flags), contract),
        of("finding").select(columns),
        repeated_rows(raw, day),
        _transaction_findings(placed.join(repeated, "transaction", "left_semi")),
    ]
    return reduce(DataFrame.unionByName, parts)


def notifiable(violations: DataFrame) -> DataFrame:
    """R13: violations somebody wants to hear about."""
    return violations.where(F.col("code").isin(*NOTIFY_CODES) & F.col("severity").isin(*NOTIFY_SEVERITIES))
