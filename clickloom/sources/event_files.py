"""Daily event CSV files whose header may differ from day to day."""

from __future__ import annotations

import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.fields import na_to_null

# How a daily file (or the folder a writer made of it) is named, and the
# columns raw events have when there is nothing to read.
FILE_GLOB = "events_*.csv"
FILE_PATTERN = r"(events_[^/]+?\.csv)"
ENTRY_PATTERN = r"^(.*?events_[^/]+?\.csv(?:\.gz)?)"
RAW_COLUMNS = (
    "client_id", "page_url", "referrer", "timestamp", "event_name", "event_data", "user_agent",
)
CORRUPT = "_corrupt_record"
HEADER_READERS = 16


class NoEventFiles(FileNotFoundError):
    """Nothing matched where at least one event file is required."""


def list_files(spark: SparkSession, *globs: str) -> DataFrame:
    """(file, path) of every part under the first glob that matches; empty if none does.

    Listing only: the content column is pruned, so no file is opened.
    """
    for glob in globs:
        try:
            found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(glob)
        except Exception as error:  # the reader's own error for a glob without a match
            if "PATH_NOT_FOUND" in str(error):
                continue
            raise
        part = F.col("path").rlike(r"/[^/]*\.csv(\.gz)?$") & ~F.col("path").rlike(r"/[_.][^/]*$")
        return found.where(part).select(F.regexp_extract("path", FILE_PATTERN, 1).alias("file"), "path")
    return spark.createDataFrame([], "file string, path string")


def daily_listing(spark: SparkSession, *globs: str) -> DataFrame:
    """(file, bytes) of every daily file or folder under the first glob that matches, files without a byte included.

    Spark's own sources skip such files, so the file system is asked.  One row per
    day: its size is the number of days, never the number of events or part files.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for glob in globs:
        path = jvm.org.apache.hadoop.fs.Path(glob)
        system = path.getFileSystem(conf)
        sizes: dict[str, int] = defaultdict(int)
        for entry in system.globStatus(path) or ():
            named = re.search(FILE_PATTERN, entry.getPath().toString())
            if named:
                folder = entry.isDirectory()
                sizes[named[1]] += system.getContentSummary(entry.getPath()).getLength() if folder else entry.getLen()
        if sizes:
            return spark.createDataFrame(sorted(sizes.items()), "file string, bytes long")
    return spark.createDataFrame([], "file string, bytes long")


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("quote", '"').option("escape", '"')


def _columns_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(_csv(spark).csv(path).columns)


def header_groups(spark: SparkSession, files: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Daily files by their header.

    Metadata work on the driver, one line read per daily file: its size is the number of
    days, never the number of events or of part files.  Parts of a day share a header; one
    that does not fails the read (see ``read_group``).
    """
    entry = F.regexp_extract("path", ENTRY_PATTERN, 1).alias("entry")
    daily = files.groupBy(entry).agg(F.min("path").alias("first")).collect()
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        headers = list(pool.map(lambda row: _columns_of(spark, row["first"]), daily))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for row, header in zip(daily, headers, strict=True):
        groups[header].append(row["entry"])
    return groups


def delivered_files(spark: SparkSession, *globs: str) -> DataFrame:
    """(file, bytes, header): every daily file, whether it holds events or not; NULL header for an empty one."""
    headers: dict[str, tuple[str, ...]] = {}
    for header, entries in header_groups(spark, list_files(spark, *globs)).items():
        headers |= {re.search(FILE_PATTERN, entry)[1]: header for entry in entries if header}
    known = spark.createDataFrame([(f, list(h)) for f, h in headers.items()], "file string, header array<string>")
    return daily_listing(spark, *globs).join(known, "file", "left")


def read_group(spark: SparkSession, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """Files of one header, all text, with their name, header and unreadable lines.

    Every part's own header is held against the expected one while it is read, so columns
    are never taken for each other.  The reader cannot check a header with a blank or
    repeated name, since it gives such columns names of its own.
    """
    bases = [c.removesuffix(str(i)).lower() for i, c in enumerate(header)]
    named = "_c" not in bases and len(set(bases)) == len(bases)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, CORRUPT)])
    rows = (
        _csv(spark)
        .schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        # A pruned parse would not look at the fields that make a line unreadable.
        .option("columnPruning", False)
        .option("enforceSchema", not named)
        .csv(sorted(paths))
    )
    # Spark refuses a query that needs nothing but the corrupt column, so that column is
    # given an empty piece of a real field, which keeps the field in every query.
    nothing = F.substring(F.coalesce(F.col(f"`{header[0]}`"), F.lit("")), 1, 0)
    return rows.select(
        F.regexp_extract(F.col("_metadata.file_path"), FILE_PATTERN, 1).alias("file"),
        F.array(*map(F.lit, header)).alias("header"),
        *[na_to_null(F.col(f"`{c}`")).alias(c) for c in header],
        F.concat(CORRUPT, nothing).alias(CORRUPT),
    )


def read_event_files(spark: SparkSession, *globs: str, required: bool = False) -> DataFrame:
    """Events of all files under the first glob that matches, united by column name.

    Reading files of different headers in one go would map columns by position and shift
    them silently; each header group is read with its own schema instead.  Columns a file
    lacks are NULL; ``header`` tells such a column from one without values.
    """
    groups = header_groups(spark, list_files(spark, *globs))
    groups.pop((), None)  # parts without a single line
    if not groups:
        if required and daily_listing(spark, *globs).isEmpty():
            raise NoEventFiles(f"no event files under {', '.join(globs)}")
        columns = [f"{c} string" for c in ("file", *RAW_COLUMNS, CORRUPT)]
        return spark.createDataFrame([], ", ".join(columns) + ", header array<string>")
    parts = [read_group(spark, header, paths) for header, paths in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def readable(events: DataFrame) -> DataFrame:
    """Rows whose line could be parsed."""
    return events.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def unreadable(events: DataFrame) -> DataFrame:
    """(file, line) of the lines that could not be parsed."""
    return events.where(F.col(CORRUPT).isNotNull()).select("file", F.col(CORRUPT).alias("line"))


def write_event_files(events: DataFrame, root: str, file: str = "file") -> None:
    """Write raw events as one CSV folder per daily file, named so the glob finds it."""
    (
        events.hint("rebalance", F.col(file))
        .write.mode("append")
        .partitionBy(file)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(root)
    )
