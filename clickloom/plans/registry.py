"""Registry of queries and of the SQL each is compared with."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.config import PANDAS, SQL, Settings
from clickloom.operators.attribution import attribute_events
from clickloom.operators.normalize import stage_events
from clickloom.operators.sessions import build_sessions
from clickloom.plans.comparison_sql import COMMON_TABLES
from clickloom.plans.sample_events import CUT_DAY, events_table, raw_events
from clickloom.sources.tables import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
COMPARISONS: dict[str, str] = {}


class Inputs:
    """Lazy inputs of a query: nothing is read until the query's result is."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    @property
    def events(self) -> DataFrame:
        return events_table(self.spark, self.sf_dir)

    @property
    def raw(self) -> DataFrame:
        return raw_events(self.spark, self.sf_dir)

    @property
    def files(self) -> DataFrame:
        """Raw events with the name of the daily file they would have come in."""
        return self.raw.withColumn("file", F.date_format("event_date", "'events_'yyyyMMdd'.csv'"))

    @property
    def mended_files(self) -> DataFrame:
        """The same with cut payloads closed on all days but one: a payload that is no JSON fails a whole file."""
        cut = F.col("event_data").startswith('{"order_id"') & ~F.col("event_data").endswith("}")
        mended = F.when(cut & (F.col("event_date") != F.lit(CUT_DAY).cast("date")), F.concat("event_data", F.lit("}")))
        return self.files.withColumn("event_data", F.coalesce(mended, "event_data"))

    def deliveries(self, part: Column, n: int) -> Iterator[tuple[int, DataFrame]]:
        """Hand the raw events over in ``n`` deliveries, one after the other, as a file stream over all that has come."""
        by_part, landing = shared_folder(self.spark, "deliveries"), shared_folder(self.spark, "landing")
        raw = self.raw
        raw.withColumn("part", part.cast("int")).write.partitionBy("part").parquet(by_part)
        schema = T.StructType([*raw.schema.fields, T.StructField("part", T.IntegerType())])
        for i in range(n):
            delivered = self.spark.read.schema(schema).parquet(by_part).where(F.col("part") == i).select(*raw.columns)
            delivered.write.mode("append").parquet(landing)
            yield i, self.spark.readStream.schema(raw.schema).parquet(landing)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def staged(self, settings: Settings = SQL) -> DataFrame:
        return stage_events(self.raw, settings)

    def sessions(self, settings: Settings = SQL) -> DataFrame:
        return build_sessions(self.staged(settings), settings)

    def gold(self, settings: Settings = SQL) -> DataFrame:
        return attribute_events(self.staged(settings), settings)

    @property
    def lean_gold(self) -> DataFrame:
        return self.gold(PANDAS)


def plain(df: DataFrame) -> DataFrame:
    """Column types both sides of a comparison share."""

    def simple(f: T.StructField):
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.IntegerType | T.ShortType | T.ByteType):
            column = column.cast("bigint")
        elif isinstance(f.dataType, T.ArrayType):
            column = F.array_join(column.cast("array<string>"), "; ")
        elif isinstance(f.dataType, T.MapType):
            column = F.to_json(column)
        return column.alias(f.name)

    return df.select(*[simple(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(build: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(build(Inputs(spark, sf_dir)))
        if sql is not None:
            COMPARISONS[name] = with_tables(sql)
        return build

    return register


def with_tables(sql: str) -> str:
    """Prefix the common tables a statement mentions, directly or through each other."""

    def mentioned(text: str) -> set[str]:
        words = set(re.findall(r"\w+", text))
        return {name for name in COMMON_TABLES if name in words}

    needed, todo = set(), mentioned(sql)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= mentioned(COMMON_TABLES[name]) - needed
    tables = [f"{name} AS ({text})" for name, text in COMMON_TABLES.items() if name in needed]
    return f"WITH {', '.join(tables)} {sql}" if tables else sql
