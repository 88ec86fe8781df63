"""Daily Parquet tables that grow by whole batches, each batch visible all at once or not at all.

A batch writes what it has to say about a day to a folder of its own,
``table/version=<batch>/event_date=<day>``.  It counts from the moment one small file
lists it: for every table and day, whether its rows join the day's earlier ones or
replace them.  So a batch that dies half-way has changed nothing, a batch that runs again
writes the same folders, one that is published already is left alone, and several tables
change together.  A reader opens the folders of the days it asks for and no others.

The list has a row per batch, table and day it touched: it grows with the calendar, not
with the data.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "event_date"
LIST_SCHEMA = "version long, name string, day date, replaces boolean, schema string, note string"


@dataclass(frozen=True)
class Entry:
    """Rows of one table and day (None: rows without a day) that a version adds or puts in place of earlier ones."""

    name: str
    day: date | None
    replaces: bool = False


class DayStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas: dict[tuple[str, int], str] = {}

    # ------------------------------------------------------------------ folders

    def _path(self, text: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(text)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _children(self, folder: str) -> list[str]:
        fs, path = self._path(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _folder(self, name: str, version: int, day: date | None) -> str:
        return f"{self.root}/{name}/version={version}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"

    # ------------------------------------------------------------------ writing

    def stage(self, name: str, df: DataFrame, version: int) -> list[date | None]:
        """Write a version's rows of a table, unseen so far; returns the days they belong to."""
        folder = f"{self.root}/{name}/version={version}"
        even = df.hint("rebalance", F.col(DAY))
        even.write.mode("overwrite").partitionBy(DAY).parquet(folder)
        self.schemas[name, version] = df.schema.json()
        days = [c.partition("=")[2] for c in self._children(folder) if c.startswith(f"{DAY}=")]
        return [None if d.startswith("__") else date.fromisoformat(d) for d in days]

    def staged(self, name: str, version: int, days: Iterable[date | None]) -> DataFrame:
        """Rows of a version that need not be published yet."""
        return self._read(name, T.StructType.fromJson(_loads(self.schemas[name, version])), [(version, d) for d in days])

    def publish(self, version: int, entries: Iterable[Entry], note: str = "") -> None:
        """Make a version visible, all its tables at once; ``note`` is kept with it."""
        rows = [(version, e.name, e.day, e.replaces, self.schemas.get((e.name, version)), None) for e in entries]
        rows.append((version, None, None, False, None, note))
        listed = self.spark.createDataFrame(rows, LIST_SCHEMA).coalesce(1)
        listed.write.mode("overwrite").parquet(f"{self.root}/_published/version={version}")

    # ------------------------------------------------------------------ reading

    def published(self) -> list[T.Row]:
        folder = f"{self.root}/_published"
        versions = [c for c in self._children(folder) if c.startswith("version=")]
        done = [f"{folder}/{v}" for v in versions if "_SUCCESS" in self._children(f"{folder}/{v}")]
        return self.spark.read.schema(LIST_SCHEMA).parquet(*done).collect() if done else []

    def versions(self) -> dict[int, str]:
        """The published versions and their notes."""
        return {r.version: r.note for r in self.published() if r.name is None}

    def days(self, name: str) -> dict[date | None, list[int]]:
        """Every day of a table with the versions that hold its rows."""
        out: dict[date | None, list[int]] = {}
        for r in sorted((r for r in self.published() if r.name == name), key=lambda r: r.version):
            out[r.day] = [r.version] if r.replaces else [*out.get(r.day, []), r.version]
        return out

    def schema(self, name: str) -> T.StructType | None:
        known = [(r.version, r.schema) for r in self.published() if r.name == name and r.schema]
        return T.StructType.fromJson(_loads(max(known)[1])) if known else None

    def read(
        self, name: str, since: date | None = None, days: Iterable[date | None] | None = None, plus: int | None = None
    ) -> DataFrame | None:
        """A table, from a day on, or of some days; None if it has never been published.

        ``plus`` is a version not published yet whose added rows are read too.
        """
        schema = self.schema(name)
        if schema is None and plus is not None:
            schema = T.StructType.fromJson(_loads(self.schemas[name, plus]))
        if schema is None:
            return None
        listed = self.days(name)
        if plus is not None:
            own = self._children(f"{self.root}/{name}/version={plus}")
            for text in (c.partition("=")[2] for c in own if c.startswith(f"{DAY}=")):
                day = None if text.startswith("__") else date.fromisoformat(text)
                listed[day] = [*listed.get(day, []), plus]
        if days is not None:
            wanted = set(days)
            listed = {d: v for d, v in listed.items() if d in wanted}
        elif since is not None:
            listed = {d: v for d, v in listed.items() if d is not None and d >= since}
        return self._read(name, schema, [(v, d) for d, versions in listed.items() for v in versions])

    def _read(self, name: str, schema: T.StructType, places: list[tuple[int, date | None]]) -> DataFrame:
        columns = [F.col(f"`{f.name}`") for f in schema.fields]
        folders = [self._folder(name, v, d) for v, d in places]
        fs, _ = self._path(self.root)
        folders = [f for f in folders if fs.exists(self._path(f)[1])]  # a day replaced by nothing has no folder
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}")
        return reader.parquet(*folders).select(*columns)

    # ------------------------------------------------------------------ clearing

    def vacuum(self) -> list[str]:
        """Delete folders that no reader opens any more: replaced days, and versions that were never published.

        Call it while no batch is being written.
        """
        fs, root = self._path(self.root)
        names = [c for c in self._children(self.root) if not c.startswith("_")]
        gone = []
        for name in names:
            live = {self._folder(name, v, d) for d, versions in self.days(name).items() for v in versions}
            for version in self._children(f"{self.root}/{name}"):
                for day in self._children(f"{self.root}/{name}/{version}"):
                    folder = f"{self.root}/{name}/{version}/{day}"
                    if day.startswith(f"{DAY}=") and folder not in live:
                        fs.delete(self._path(folder)[1], True)
                        gone.append(folder)
        return gone


def _loads(text: str) -> dict:
    import json

    return json.loads(text)
