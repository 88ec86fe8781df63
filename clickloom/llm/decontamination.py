"""Benchmark leaks, re-parameterised ones included, by template windows.

Words are lower-cased runs of letters and digits (letters of three UTF-8 bytes or more stay as
they are).  Numbers, units after a number, and
capitalised words inside a sentence become the placeholders of their type; what stood
there is a slot value.  Windows of ``size`` such words are hashed on both sides; one with
fewer than ``literals`` words that are no placeholder goes on until it has them, so text
rich in numbers has windows like other text.  The plain windows, without placeholders, are
hashed too: a text in capitals throughout shows no names.

1. A bitmap of ``BITS`` bits of the benchmark's window hashes, of fixed size, lets through
   the windows of documents that may match.
2. A document that leaks an item has ``share`` of its windows, so it has one of the others
   and one more, whichever are left out.  Those an item shares with most items are left
   out: documents and items meet on the rarest, and a phrase that half the benchmark
   shares brings no pairs by itself.
3. Of the pairs that met all windows are joined on the hash.  Matches of one document and
   item at one distance form an alignment; it counts only if slots are consistent, that is,
   every slot value of the item stands for one value of the document and the other way round.
4. A document leaks an item if consistent alignments cover at least ``share`` of the item's
   windows of one kind.

Defined results: an item of fewer than ``size`` words is one window, left out if fewer than
``literals`` of its words (or than all) are no placeholder; an item without windows with
placeholders is found by plain ones only; null and empty texts match nothing; rows repeated with the same id and text are one document; a null id
is an id of its own.  An empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import id_and_text, packed, small_batches, table, written
from clickloom.llm.textcore import LOWER, chunks, run_hashes, span_hashes, spans

SIZE = 8
LITERALS = 5
SHARE = 0.5
BITS = 1 << 22
# Bytes of text whose words are held as arrays at once, or one longer text.
CHUNK_BYTES = 1 << 19
# Units that make a placeholder when they follow a number.
UNITS = (
    "mm cm m km inch inches ft feet mile miles yd g kg mg lb lbs oz ton tons l ml litre litres liter liters s sec second "
    "seconds min minute minutes h hour hours day days week weeks month months year years usd eur dollar dollars euro euros "
    "cent cents percent degree degrees mph kmh w kw v a hz c f"
).split()
NUMBER, NAME, UNIT = (np.uint64(n) for n in (1, 2, 3))
_BYTES = np.arange(256)
DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
UPPER = (_BYTES >= 65) & (_BYTES <= 90)
SOLID = DIGIT | UPPER | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
JOINT = np.isin(_BYTES, [44, 46])
SENTENCE_END = np.isin(_BYTES, [10, 33, 46, 58, 63])


def lower_codes() -> np.ndarray:
    """The lower case of every character of two UTF-8 bytes at most; itself where that has another size."""
    code = np.arange(1 << 11)
    low = [chr(c).lower() for c in code]
    return np.array([ord(x) if len(x) == 1 and len(x.encode()) == 1 + (c > 127) else c for c, x in zip(code, low, strict=True)])


LOWER_CODES = lower_codes()


def lowered(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case, and which of them begin a capital."""
    out, upper = LOWER[data], UPPER[data]
    lead = np.flatnonzero((data >= 0xC2) & (data <= 0xDF))
    code = (data[lead].astype(np.int64) & 31) << 6 | data[lead + 1] & 63
    low = LOWER_CODES[code]
    out[lead], out[lead + 1] = 0xC0 | low >> 6, 0x80 | low & 63
    upper[lead] = low != code
    return out, upper


def unit_hashes() -> np.ndarray:
    data = np.frombuffer(" ".join(UNITS).encode(), np.uint8)
    start, stop, _ = spans(data != 32, np.array([0, len(data)]))
    return np.sort(span_hashes(data, start, stop))


UNIT_HASHES = unit_hashes()


def templates(data: np.ndarray, starts: np.ndarray):
    """(start, stop, first, hash, hash with placeholders, is placeholder) of every word of a chunk."""
    solid = SOLID[data]
    point = np.zeros(len(data), bool)
    point[1:-1] = JOINT[data[1:-1]] & DIGIT[data[:-2]] & DIGIT[data[2:]]
    rows = np.diff(starts) > 0
    point[starts[:-1][rows]] = False
    point[starts[1:][rows] - 1] = False
    start, stop, first = spans(solid | point, starts)
    low, upper = lowered(data)
    hashes = span_hashes(low, start, stop)
    if not len(start):
        return start, stop, first, hashes, hashes, np.zeros(0, bool)

    def inside(mask: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[b] - total[a]

    number = inside(solid & ~DIGIT[data], start, stop) == 0
    unit = np.zeros(len(start), bool)
    unit[1:] = number[:-1]
    opens = np.zeros(len(start), bool)
    opens[first[:-1][first[:-1] < len(start)]] = True
    unit &= ~opens & np.isin(hashes, UNIT_HASHES)
    second = start + 1 + (data[start] >= 0xC2)
    # One capital and more that are none: words in capitals throughout are no names.
    capital = upper[start] & (second < stop) & ~upper[np.minimum(second, len(data) - 1)]
    gap = np.ones(len(start), np.int64)
    gap[1:] = inside(SENTENCE_END[data], stop[:-1], start[1:])
    name = capital & ~opens & (gap == 0) & ~number & ~unit
    typed = np.where(number, NUMBER, np.where(name, NAME, np.where(unit, UNIT, hashes)))
    return start, stop, first, hashes, typed, number | name | unit


WINDOW = "at int, hash long, slots array<string>, windows int, plain boolean, size int"


def template_windows(rows: DataFrame, keys: list[str], sizes, literals: int, bitmap=None) -> DataFrame:
    """(keys, at, hash, slots, windows, plain, size): windows of every row; ``windows`` says how many of its kind the row has.

    ``sizes``: the window sizes, the largest that of windows proper, the others of items of so
    many words.  Without a bitmap the rows are items: each has windows of one size.  With one
    they are documents, and only windows it may hold are returned.
    """
    longest = max(sizes)
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value if bitmap else None
        for batch in batches:
            for lo, hi, data, starts in chunks(batch.column("text"), CHUNK_BYTES):
                start, stop, first, words, typed, slot = templates(data, starts)
                n = np.diff(first)
                row_of = np.repeat(np.arange(hi - lo), n)
                kinds = ((False, typed, slot), (True, words, np.zeros(len(slot), bool)))
                for size, (plain, hashes, slot) in product(sizes, kinds):
                    held = np.r_[0, np.cumsum(~slot)]
                    begin = np.arange(len(slot))
                    enough = np.searchsorted(held, held[:-1] + min(literals, size)) if size == longest else begin
                    stops = np.maximum(enough, begin + size)
                    at = np.flatnonzero(stops <= np.repeat(first[1:], n))
                    if size < longest:
                        at = at[held[at + size] - held[at] >= min(literals, size)]
                    value = run_hashes(hashes, at, stops[at]) + np.uint64(size + (plain << 8))
                    if bits is None:
                        taken = np.minimum(n[row_of[at]], longest) == size
                    else:
                        taken = bits[(value % np.uint64(BITS)).astype(np.int64)]
                    at, value = at[taken], value[taken]
                    if not len(at):
                        continue
                    count = np.bincount(row_of[at], minlength=hi - lo)
                    slots = [
                        [data[start[i] : stop[i]].tobytes().decode().lower() for i in range(a, stops[a]) if slot[i]]
                        for a in at
                    ]
                    take = pa.array(lo + row_of[at])
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[batch.column(k).take(take) for k in keys],
                            pa.array((at - first[row_of[at]]).astype(np.int32)),
                            pa.array(value.astype(np.int64)),
                            pa.array(slots, pa.list_(pa.string())),
                            pa.array(count[row_of[at]].astype(np.int32)),
                            pa.array(np.full(len(at), plain)),
                            pa.array(np.full(len(at), size, np.int32)),
                        ],
                        names=[*keys, "at", "hash", "slots", "windows", "plain", "size"],
                    )

    return rows.mapInArrow(run, ", ".join([*[f"{k} {types[k]}" for k in keys], WINDOW]))


def probes_of(items: DataFrame, share: float) -> DataFrame:
    """(hash, item) of the windows one of which a document must have to leak the item: its rarest."""
    common = items.groupBy("hash").agg(F.count("*").alias("common"))
    places = items.join(common, "hash").groupBy("item", "plain", "at").agg(
        F.max("common").alias("common"), F.min("windows").alias("windows")
    )
    own = Window.partitionBy("item", "plain")  # no longer than the text of an item
    needed = F.ceil(F.min("windows").over(own) * share - 1e-9)
    ranked = places.withColumns(
        {"rank": F.row_number().over(own.orderBy("common", "at")), "left": F.count("*").over(own) - needed + 1}
    )
    rarest = ranked.where("rank <= left").select("item", "plain", "at")
    return items.join(rarest, ["item", "plain", "at"]).select("hash", "item").distinct()


def leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = SIZE, literals: int = LITERALS, share: float = SHARE
) -> DataFrame:
    """(doc_id, print, item_id, matched, windows, share, reworded): the items each document leaks."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = id_and_text(docs).withColumn("print", F.xxhash64("text"))
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    sizes = list(range(1, size + 1))
    items = written(template_windows(items, ["item_id"], sizes, literals), "benchmark-windows")
    # At most BITS values, whatever the benchmark; sizes are at most ``size``.
    bits = np.zeros(BITS, bool)
    spots = items.select(F.expr(f"cast(hash & {BITS - 1} as int)").alias("spot")).distinct()
    bits[spots.toPandas()["spot"].to_numpy(np.int64)] = True
    used = [r[0] for r in items.where("size < %d" % size).select("size").distinct().collect()]  # fewer than ``size``
    found = template_windows(docs, ["doc_id", "print"], [*used, size], literals, spark.sparkContext.broadcast(bits))
    found = written(found.drop("windows", "plain", "size").withColumn("doc", F.struct("doc_id", "print")).drop("doc_id", "print"), "met-windows")
    items = items.withColumn("item", F.struct("item_id"))  # fields of structs that are null are equal
    met = found.select("doc", "hash").join(probes_of(items, share), "hash").select("doc", "item").distinct()
    theirs = items.select(
        "item", "item_id", F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots"), "windows", "plain"
    )
    matched = found.join(met, "doc").join(theirs, ["item", "hash"]).select("*", "doc.*")
    pairs = F.array_distinct(F.flatten(F.collect_set(F.arrays_zip(F.col("item_slots").alias("x"), F.col("slots").alias("y")))))
    key = ["doc_id", "print", "item_id"]
    aligned = (
        matched.groupBy(*key, "plain", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.collect_set("item_at").alias("spots"), pairs.alias("pairs"), F.max("windows").alias("windows"))
        .withColumn("xs", F.size(F.array_distinct(F.transform("pairs", lambda p: p["x"]))))
        .withColumn("ys", F.size(F.array_distinct(F.transform("pairs", lambda p: p["y"]))))
        .where((F.size("pairs") == F.col("xs")) & (F.size("pairs") == F.col("ys")))
    )
    reworded = F.exists("pairs", lambda p: p["x"] != p["y"])
    # An item's windows bound what is left of a document, however often it repeats the item.
    most = [F.max("windows").cast("long").alias("windows"), F.max("reworded").alias("reworded")]
    covered = aligned.select(*key, "plain", "windows", reworded.alias("reworded"), F.explode("spots").alias("spot"))
    covered = covered.groupBy(*key, "plain", "spot").agg(*most).groupBy(*key, "plain").agg(F.count("*").alias("matched"), *most)
    covered = covered.withColumn("share", F.col("matched") / F.col("windows")).where(F.col("share") >= share)
    # Of both kinds the one that is covered better, else the plain one.
    best = F.max(F.struct("share", "plain", "matched", "windows", "reworded")).alias("best")
    return covered.groupBy(*key).agg(best).select(*key, *[f"best.{c}" for c in ("matched", "windows", "share", "reworded")])


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that leak no item."""
    bad = leaks(docs, benchmark, **options).select(F.col("doc_id").alias("bad_id"), F.col("print").alias("bad_print")).distinct()
    bad = written(bad, "leaking-documents")
    own = packed(docs).withColumn("print", F.xxhash64("text"))
    clean = own.join(bad, [own["id"].eqNullSafe(bad["bad_id"]), own["print"] == bad["bad_print"]], "left_anti")
    return clean.select("row.*")


@query("op9_benchmark_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("print").distinct()
