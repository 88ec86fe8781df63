"""Pipeline assertions over staged events, sessions and attribution, as a summary table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.fields import money
from clickloom.operators.normalize import is_conversion


@dataclass(frozen=True)
class Expectations:
    """Which users and transactions the spot checks look at, and what they expect."""

    single_user: str
    boundary_user: str
    mixed_transaction: str
    window_user: str
    direct_transaction: str
    single_sessions: int = 1
    boundary_sessions: int = 2
    mixed_first: str = "Organic Search"
    mixed_last: str = "Paid Search"
    direct: str = "Direct"


def _facts(table: DataFrame, **aggregates: Column) -> DataFrame:
    """One-row aggregates of a table as (fact, value) rows of text."""
    row = table.agg(*[column.cast("string").alias(name) for name, column in aggregates.items()])
    return row.select(F.explode(F.create_map(*[x for n in aggregates for x in (F.lit(n), F.col(n))])).alias("fact", "value"))


def check_facts(staged: DataFrame, sessions: DataFrame, gold: DataFrame, expect: Expectations) -> DataFrame:
    """Everything the checks need, one pass per table, as (fact, value)."""

    def of(column: str, value: str) -> Column:
        return F.col(column) == value

    in_sessions = _facts(
        sessions,
        sessions_a=F.count_if(of("user_id", expect.single_user)),
        start_a=F.min(F.when(of("user_id", expect.single_user), F.col("session_start_ts"))),
        sessions_b=F.count_distinct(F.when(of("user_id", expect.boundary_user), F.col("session_id"))),
        sessions_d=F.count_if(of("user_id", expect.window_user)),
        start_d=F.min(F.when(of("user_id", expect.window_user), F.col("session_start_ts"))),
        bad_sessions=F.count_if(F.col("session_start_ts") > F.col("session_end_ts")),
    )

    def click(transaction: str, which: str) -> Column:
        return F.min(F.when(of("transaction_id", transaction), F.col(f"{which}_click_channel")))

    in_gold = _facts(
        gold,
        first_c=click(expect.mixed_transaction, "first"),
        last_c=click(expect.mixed_transaction, "last"),
        first_e=click(expect.direct_transaction, "first"),
        last_e=click(expect.direct_transaction, "last"),
        attributed=F.count(F.lit(1)),
        revenue_attributed=F.coalesce(F.sum(money(F.col("revenue"))), F.lit(0)),
    )
    in_staging = _facts(staged, null_users=F.count_if(F.col("user_id").isNull()))
    transactions = (
        staged.where(is_conversion() & F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(F.max(money(F.coalesce("revenue", F.lit(0.0)))).alias("revenue"))
    )
    in_raw = _facts(
        transactions,
        raw_transactions=F.count(F.lit(1)),
        revenue_raw=F.coalesce(F.sum("revenue"), F.lit(0)),
    )
    return in_sessions.union(in_gold).union(in_staging).union(in_raw)


def summarize(facts: DataFrame, expect: Expectations) -> DataFrame:
    """(test_name, result, details), one row per check."""
    names = (
        "sessions_a", "start_a", "sessions_b", "first_c", "last_c", "sessions_d", "start_d", "first_e", "last_e",
        "raw_transactions", "attributed", "revenue_raw", "revenue_attributed", "bad_sessions", "null_users",
    )
    row = facts.agg(*[F.max(F.when(F.col("fact") == n, F.col("value"))).alias(n) for n in names])

    def number(name: str) -> Column:
        return F.col(name).cast("bigint")

    def shown(name: str) -> Column:
        return F.coalesce(name, F.lit("none"))

    def both(first: str, first_expected: str, last: str, last_expected: str) -> Column:
        return (F.col(first) == first_expected) & (F.col(last) == last_expected)

    raw_money = F.col("revenue_raw").cast("decimal(38,6)")
    gold_money = F.col("revenue_attributed").cast("decimal(38,6)")
    checks = [
        ("A_first_event_session", number("sessions_a") == expect.single_sessions,
         F.format_string(f"expected={expect.single_sessions} actual=%s start=%s", "sessions_a", shown("start_a"))),
        ("B_session_boundary_30min", number("sessions_b") == expect.boundary_sessions,
         F.format_string(f"expected={expect.boundary_sessions} actual=%s", "sessions_b")),
        ("C_intra_session_first_last", both("first_c", expect.mixed_first, "last_c", expect.mixed_last),
         F.format_string("first=%s last=%s", shown("first_c"), shown("last_c"))),
        ("D_7day_inclusive", number("sessions_d") >= 1,
         F.format_string("min_session_start=%s", shown("start_d"))),
        ("E_direct_when_no_prior", both("first_e", expect.direct, "last_e", expect.direct),
         F.format_string("first=%s last=%s", shown("first_e"), shown("last_e"))),
        ("F_conversion_count_dedupe", number("raw_transactions") == number("attributed"),
         F.format_string("raw=%s attributed=%s", "raw_transactions", "attributed")),
        ("G_revenue_parity", F.round(raw_money - gold_money, 4) == 0,
         F.format_string("raw=%s attributed=%s", raw_money.cast("decimal(38,2)").cast("string"),
                         gold_money.cast("decimal(38,2)").cast("string"))),
        ("H_session_start_before_end", number("bad_sessions") == 0,
         F.format_string("bad_sessions=%s", "bad_sessions")),
        ("I_non_null_user_id_in_staging", number("null_users") == 0,
         F.format_string("null_user_ids=%s", "null_users")),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("test_name"),
            F.when(F.coalesce(passed, F.lit(False)), "PASS").otherwise("FAIL").alias("result"),
            details.alias("details"),
        )
        for name, passed, details in checks
    ]
    return row.select(F.inline(F.array(*rows)))


def validation_summary(staged: DataFrame, sessions: DataFrame, gold: DataFrame, expect: Expectations) -> DataFrame:
    return summarize(check_facts(staged, sessions, gold, expect), expect)
