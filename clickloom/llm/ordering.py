"""Places in an order, and runs of sorted rows, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.shared import written


def numbered(rows: DataFrame, group: str, order: list[str], purpose: str) -> DataFrame:
    """The rows, written, with ``at``, their place in the group from 0, and ``n``, the group's size.

    ``order`` must leave no ties that matter.  Rows are sorted by range, so a group of any
    size is spread over tasks; only the number of its rows in each range goes through a
    window.  ``group`` must not be null.
    """
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # The upper bits of the id are the range, the lower ones the place in it.
    placed = written(sorted_rows.withColumn("place", F.monotonically_increasing_id()), purpose)
    placed = placed.withColumn("part", F.shiftright("place", 33))
    runs = placed.groupBy(group, "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    of_group = Window.partitionBy(group)
    before = F.sum("size").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumns({"before": F.coalesce(before, F.lit(0)), "n": F.sum("size").over(of_group)})
    found = placed.join(runs.drop("size"), [group, "part"])
    return found.withColumn("at", F.col("place") - F.col("first") + F.col("before")).drop("place", "part", "first", "before")


def starts_of(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Index of the first row of every run of equal keys; the keys must not be null."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for key in keys:
        column = table.column(key).combine_chunks()
        if len(column) > 1:
            new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], rows: int = 1 << 15) -> Iterator[pa.Table]:
    """Tables of about so many rows that never cut a run of equal keys."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            cut = int(starts_of(table, keys)[-1])
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                size -= cut
    if size:
        yield pa.Table.from_batches(held).combine_chunks()
