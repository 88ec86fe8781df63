"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
COMPARISONS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder of tables)."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return build(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            COMPARISONS[name] = sql
        return build

    return register


def crc32_sql(text: str) -> str:
    """CRC-32 of a short ASCII text in SQL, bit by bit."""
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    byte = "list_reduce(list_prepend(xor(c, b), range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"
