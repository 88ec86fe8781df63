"""Removal of repeated passages: count-min prefilter, then exact grouping of what is left.

A window is ``size`` consecutive words.  Every window has an anchor, the smallest hash
among the ``GRAM``-word runs inside it; equal windows have equal anchors at different
places, so a window repeats only if its anchor does.

1. Every task counts the places of its anchors in a sparse count-min sketch; the sketches
   are merged block by block into two bitmaps, *at least two* and *many*.  A count-min
   count is never too small, so no repeated window is lost.  The bitmaps are the only
   thing broadcast; ``max_cells`` bounds them.  Past that bound more windows pass the
   filter, and the result stays exact.
2. Windows whose anchor is estimated repeated are sent to their anchor, those in a row
   with one anchor together, and ranked within their 128-bit word hash by (document, start).  All but the first are repeats.  A window estimated *many* is
   ranked in salted shares first and then among the winners of the shares, so a passage
   of a third of all documents is no single task's work.
3. Documents meet the starts of their repeated windows and drop the words these cover.

Defined results: null and empty texts have no words; a null ``doc_id`` comes after all
others; rows repeated with the same id and text are one document and all get its result;
texts that share an id are ordered by their hash.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import id_and_text, small_batches, table, written
from clickloom.llm.textcore import chunks, lists, mix, sliding_min, span_hashes, windows, words

SIZE = 20
GRAM = 6
ROWS = 2
BLOCK = 1 << 16
MANY = 1000
SHARES = 64
LEAST_CELLS, MAX_CELLS = 1 << 20, 1 << 29
FLUSH = 1 << 21
# Windows sent together at most: a word said over and over is one anchor however long.
RUN = 64
LAST_ID = (1 << 63) - 1
_U = np.uint64


def cells_for(docs: DataFrame, max_cells: int = MAX_CELLS) -> int:
    """Counters per sketch row: about four for every anchor, a power of two within fixed bounds."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max_cells, max(LEAST_CELLS, 1 << (total // 12).bit_length()))


def anchors(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of the window at each word, whether there is such a window, and the anchors' places."""
    gram = min(GRAM, size)
    grams, inside = windows(hashes, first, gram, 1)
    grams[~inside] = ~_U(0)
    span = size - gram + 1
    least = sliding_min(grams, span)
    end = np.repeat(first[1:], np.diff(first))
    whole = np.arange(len(hashes)) + size <= end
    # A place is an anchor's if some window over it has no smaller run.
    back = np.where(whole, ~least, ~_U(0))[::-1]
    place = (~sliding_min_padded(back, span)[::-1] == grams) & inside
    return least, whole, grams[place]


def sliding_min_padded(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each value and the next ``size - 1``, as far as there are any."""
    return sliding_min(np.r_[values, np.full(size, ~_U(0))], size)[: len(values)]


def cell(anchor: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(anchor + _U(row + 1)) & _U(cells - 1)


def partial_sketches(docs: DataFrame, size: int, cells: int) -> DataFrame:
    """(block, cells, counts): the non-zero counters of each task, 16 bits for the cell and 8 for its count."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        block = found >> _U(16)
        cut = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(found) else np.zeros(1, int)
        low, counts = (found & _U(BLOCK - 1)).astype("<u2"), np.minimum(counts, 255).astype(np.uint8)
        spans = list(zip(cut[:-1], cut[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(block[cut[:-1]].astype(np.int64)),
                pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            names=["block", "cells", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, _, data, starts in chunks(batch.column("text")):
                start, stop, first = words(data, starts)
                *_, places = anchors(span_hashes(data, start, stop), first, size)
                held += [cell(places, row, cells) + _U(row * cells) for row in range(ROWS)]
                n += ROWS * len(places)
                if n > FLUSH:
                    yield flush(held)
                    held, n = [], 0
        if n:
            yield flush(held)

    return docs.select("text").mapInArrow(run, "block long, cells binary, counts binary")


def merged_sketch(docs: DataFrame, size: int, cells: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps of the counters of at least two and of at least ``many``, merged block by block.

    Blocks arrive in order, so a task holds the counters of one block however many tasks
    sent parts of it.
    """

    def bitmaps(block: int, total: np.ndarray) -> pa.RecordBatch:
        bits = [np.packbits(total >= n, bitorder="little").tobytes() for n in (2, many)]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), *[pa.array([b], pa.binary()) for b in bits]], names=["block", "two", "many"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(BLOCK, np.int64)
        for batch in batches:
            for block, low, counts in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if block != now:
                    if now is not None:
                        yield bitmaps(now, total)
                    now, total = block, np.zeros(BLOCK, np.int64)
                total[np.frombuffer(low, "<u2")] += np.frombuffer(counts, np.uint8)
        if now is not None:
            yield bitmaps(now, total)

    parts = partial_sketches(docs, size, cells).repartition("block").sortWithinPartitions("block")
    two, many_bits = (np.zeros(ROWS * cells // 8, np.uint8) for _ in range(2))
    # Bounded by max_cells: two bits for every counter.
    for block, a, b in parts.mapInArrow(run, "block long, two binary, many binary").toLocalIterator():
        at = slice(block * BLOCK // 8, (block + 1) * BLOCK // 8)
        two[at], many_bits[at] = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    return two, many_bits


def estimated(bits: np.ndarray, anchor: np.ndarray, cells: int) -> np.ndarray:
    """Whether all counters of an anchor have their bit set."""
    out = np.ones(len(anchor), bool)
    for row in range(ROWS):
        at = cell(anchor, row, cells) + _U(row * cells)
        out &= (bits[(at >> _U(3)).astype(np.int64)] >> (at & _U(7)).astype(np.uint8) & 1).astype(bool)
    return out


def candidates(docs: DataFrame, size: int, cells: int, bitmaps, shares: int) -> DataFrame:
    """Windows whose anchor is estimated repeated: (anchor, share, doc, tag, start, h1, h2).

    A row is a run of consecutive windows of one anchor, their hashes in a list from
    ``start`` on, so that what they have in common is not sent with each of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two, many = bitmaps.value
        for batch in batches:
            doc, tag = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            for lo, hi, data, starts in chunks(batch.column("text")):
                start, stop, first = words(data, starts)
                hashes = span_hashes(data, start, stop)
                least, whole, _ = anchors(hashes, first, size)
                at = np.flatnonzero(whole)
                at = at[estimated(two, least[at], cells)]
                if not len(at):
                    continue
                row = np.repeat(np.arange(hi - lo), np.diff(first))[at]
                anchor = least[at]
                begins = np.ones(len(at), bool)
                begins[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1])
                begins |= at % RUN == 0
                run_at = np.flatnonzero(begins)
                of, ends = row[run_at], np.append(run_at, len(at))
                hot = estimated(many, anchor[run_at], cells)
                share = mix(doc[lo:hi].astype(_U))[of] % _U(shares) + _U(1)
                h1, h2 = (windows(hashes, first, size, kind)[0][at] for kind in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[run_at].astype(np.int64)),
                        pa.array(np.where(hot, share, _U(0)).astype(np.int32)),
                        pa.array(doc[lo:hi][of]),
                        pa.array(tag[lo:hi][of]),
                        pa.array((at[run_at] - first[of]).astype(np.int32)),
                        lists(h1.astype(np.int64), ends, pa.int64()),
                        lists(h2.astype(np.int64), ends, pa.int64()),
                    ],
                    names=["anchor", "share", "doc", "tag", "start", "h1", "h2"],
                )

    return docs.mapInArrow(
        run, "anchor long, share int, doc long, tag long, start int, h1 array<long>, h2 array<long>"
    )


def repeated_starts(docs: DataFrame, size: int = SIZE, max_cells: int = MAX_CELLS, many: int = MANY) -> DataFrame:
    """(doc, tag, start) of every window whose word sequence also starts earlier."""
    cells = cells_for(docs, max_cells)
    bitmaps = docs.sparkSession.sparkContext.broadcast(merged_sketch(docs, size, cells, many))
    order = ("doc", "tag", "start")
    # Equal windows have equal anchors: one shuffle of the runs brings them together, and the ranking needs none of its own.
    runs = candidates(docs, size, cells, bitmaps, SHARES).repartition("anchor", "share")
    each = runs.select("anchor", "share", "doc", "tag", "start", F.posexplode(F.arrays_zip("h1", "h2")).alias("i", "h"))
    each = each.select("anchor", "share", "doc", "tag", (F.col("start") + F.col("i")).alias("start"), "h.h1", "h.h2")
    ranked = each.withColumn("place", F.rank().over(Window.partitionBy("anchor", "share", "h1", "h2").orderBy(*order)))
    # Winners of shares go on; of other windows only the repeats are of use.
    winner = (F.col("place") == 1) & (F.col("share") > 0)
    ranked = written(
        ranked.where(winner | (F.col("place") > 1)).select(
            *order, F.when(winner, F.col("h1")).alias("h1"), F.when(winner, F.col("h2")).alias("h2")
        ),
        "repeated-windows",
    )
    again = F.rank().over(Window.partitionBy("h1", "h2").orderBy(*order))
    winners = ranked.where(F.col("h1").isNotNull()).withColumn("place", again).where("place > 1")
    return ranked.where(F.col("h1").isNull()).select(*order).unionByName(winners.select(*order))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, doc, tag): ``doc`` orders documents; ``tag`` parts texts that share an id."""
    docs = id_and_text(docs).withColumn("doc", F.coalesce("doc_id", F.lit(LAST_ID)))
    shared = docs.groupBy("doc").count().where("count > 1").select("doc", F.lit(True).alias("shared"))
    if shared.isEmpty():
        return docs.withColumn("tag", F.lit(0).cast("long"))
    tag = F.when(F.col("shared"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return docs.join(shared, "doc", "left").withColumn("tag", tag).drop("shared")


def drop_repeats(
    docs: DataFrame, size: int = SIZE, max_cells: int = MAX_CELLS, many: int = MANY, with_text: bool = True
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]): texts without the words repeated windows cover."""
    small_batches(docs.sparkSession)
    docs = keyed(docs)
    starts = repeated_starts(docs, size, max_cells, many).groupBy("doc", "tag").agg(F.collect_list("start").alias("starts"))
    joined = docs.join(starts, ["doc", "tag"], "left").select("doc_id", "text", "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, digests, texts = [], [], [], []
            found = batch.column("starts")
            for row, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                split = text.split()
                n_words.append(len(split))
                if found[row].is_valid:
                    change = np.zeros(len(split) + 1, np.int32)
                    at = np.unique(found[row].values.to_numpy())
                    np.add.at(change, at, 1)
                    np.add.at(change, at + size, -1)
                    split = [split[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                kept = b" ".join(split)
                n_removed.append(n_words[-1] - len(split))
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text:
                    texts.append(kept.decode())
            columns = [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                       pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array(texts, pa.string()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return joined.mapInArrow(run, schema + (", kept string" if with_text else ""))


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), with_text=False)
