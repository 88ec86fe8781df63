"""Near-duplicate components by fast similarity sketches, banding and exact verification.

1. Every text gets the set of its distinct ``size``-word shingles and a sketch of ``bins``
   coordinates, filled in rounds.  Round i < bins throws each shingle into a hashed bin
   with a hashed value; a bin keeps its smallest value of the first round that reaches it.
   Round bins + j throws all shingles into bin j.  So every coordinate is filled, and two
   sets agree in a coordinate with probability equal to their similarity, concentrated as
   if coordinates were independent even for sets of a few shingles.  A set is done when its
   bins are full, about bins * ln(bins) throws, instead of a hash per shingle and coordinate.
2. Coordinates are cut into bands; texts that agree in a whole band meet in its bucket.
   Texts with equal sets are one class, so copies are one row from here on.
3. A link is confirmed on full sets.  Only the components are wanted, so a bucket need not
   compare all its pairs: in each of ``STARS`` rounds one member of its largest component
   (first the one that meets others most often) is compared with all members outside it, a
   number of pairs linear in the bucket.
4. What stays apart in a bucket after that is compared in full: every member outside the
   largest component with all members of other components, in blocks of bounded size that
   carry sketches and full sets.  A pair whose sketches agree less often than ``SIGMAS``
   standard deviations below the threshold is not compared further.  No pair of a bucket is
   left out otherwise unless both are in one component already.  A group of m documents of
   which k stay outside its largest component so costs k * m sketch comparisons.

Links need ``100 * intersection >= percent * union``.  At 85 % a pair at the threshold
meets in no band with probability 1.2e-5.

Defined results: A-Z counts as a-z; a text of fewer than ``size`` words is one shingle of
all its words; a null text or one without words has an empty set, is linked with nothing
and is its own component; a null ``doc_id`` names a component only where it is alone;
rows that repeat a ``doc_id`` are documents of their own with that id.  An empty table
gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.near_duplicates import groups_of, printed, shingle_sets
from clickloom.llm.ordering import starts_of, whole_runs
from clickloom.llm.queries import query
from clickloom.llm.shared import table, written
from clickloom.llm.textcore import LOWER, chunks, lists, mix

SIZE = 5
PERCENT = 85
BANDS = 24
WIDTH = 6
STARS = 2
SIGMAS = 5
BLOCK = 512
BLOCK_BYTES = 1 << 24
_U = np.uint64
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(flat: np.ndarray, first: np.ndarray, bins: int) -> np.ndarray:
    """One row of ``bins`` values per set; ``first`` is each set's first index and the end, no set is empty."""
    n = len(first) - 1
    out = np.full((n, bins), _EMPTY, _U)
    cells = out.reshape(-1)
    salt = mix(np.arange(1, 2 * bins + 1, dtype=_U) * _U(0x9E3779B97F4A7C15))
    owner = np.repeat(np.arange(n), np.diff(first))
    for i in range(2 * bins):
        h = mix(flat + salt[i])
        at = owner * bins + (((h >> _U(32)) * _U(bins)) >> _U(32)).astype(np.int64) if i < bins else owner * bins + (i - bins)
        # A bin that an earlier round has reached is settled.
        free = cells[at] >= _U(i << 32)
        np.minimum.at(cells, at[free], (h[free] & _U(0xFFFFFFFF)) | _U(i << 32))
        more = (out == _EMPTY).any(axis=1)[owner]
        if not more.any():
            break
        flat, owner = flat[more], owner[more]
    return out


def lowered_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    for lo, hi, data, starts in chunks(column):
        yield lo, hi, shingle_sets(LOWER[data], starts, size)


SIGNED = "row long, doc_id long, print long, h1 long, h2 long, n long, bands array<long>, sketch binary"


def signed(docs: DataFrame, size: int, bands: int, width: int) -> DataFrame:
    """Of every row: a fingerprint of its set, its bucket in each band, and its sketch at 16 bits a coordinate."""
    bins = bands * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, sets in lowered_sets(batch.column("text"), size):
                filled = [i for i, s in enumerate(sets) if len(s)]
                first, keys = np.zeros(hi - lo + 1, np.int64), np.zeros(0, np.int64)
                h1, h2, short = np.zeros(hi - lo, np.int64), row + np.arange(hi - lo), [None] * (hi - lo)
                if filled:
                    full = [sets[i] for i in filled]
                    values = sketch(np.concatenate(full), np.cumsum([0, *map(len, full)]), bins)
                    grouped, node = values.reshape(len(full), bands, width), np.zeros((len(full), bands), _U)
                    for k in range(width):
                        node = mix(node + grouped[:, :, k] + _U(k + 1))
                    keys = mix(node + np.arange(bands, dtype=_U)).astype(np.int64).ravel()
                    first[np.array(filled) + 1] = bands
                    first = np.cumsum(first)
                    h1[filled] = [int(np.add.reduce(mix(s)).astype(np.int64)) for s in full]
                    h2[filled] = [int(np.bitwise_xor.reduce(mix(s + _U(1))).astype(np.int64)) for s in full]
                    low = mix(values).astype(np.uint16)
                    for i, line in zip(filled, low, strict=True):
                        short[i] = line.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(hi - lo)), batch.column("doc_id")[lo:hi], batch.column("print")[lo:hi],
                        pa.array(h1), pa.array(h2), pa.array([len(s) for s in sets], pa.int64()),
                        lists(keys, first, pa.int64()), pa.array(short, pa.binary()),
                    ],
                    names=[f.split()[0] for f in SIGNED.split(", ")],
                )
                row += hi - lo

    return docs.mapInArrow(run, SIGNED)


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(member, shingles) of classes (member, of_doc, of_print), from the text of one member each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, sets in lowered_sets(batch.column("text"), size):
                first = np.cumsum([0, *map(len, sets)])
                flat = np.concatenate(sets).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("member")[lo:hi], lists(flat, first, pa.int64())], names=["member", "shingles"]
                )

    found = docs.join(wanted, [docs["doc_id"].eqNullSafe(wanted["of_doc"]), docs["print"] == wanted["of_print"]])
    return found.select("member", "text").mapInArrow(run, "member long, shingles array<long>").dropDuplicates(["member"])


def buckets_of(classes: DataFrame) -> DataFrame:
    """(bucket, member, n, weight) of buckets that more than one class meets in; buckets of equal members count once.

    ``weight`` is how often a member meets others in all buckets: a document that others
    were made from meets most.
    """
    rows = classes.where("n > 0").select(F.explode("bands").alias("bucket"), "member", "n")
    met = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.sum(F.hash("member")).alias("who"), F.bit_xor(F.xxhash64("member")).alias("who2")
    )
    once = met.where("members > 1").groupBy("members", "who", "who2").agg(F.min("bucket").alias("bucket"))
    rows = written(rows.join(once.select("bucket", "members"), "bucket"), "bucket-members")
    weights = rows.groupBy("member").agg(F.sum("members").alias("weight"))
    return rows.drop("members").join(weights, "member")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked): the pairs compared on full sets."""
    left, right = sets.toDF("a", "x"), sets.toDF("b", "y")
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.select("a", "b", (100 * shared >= percent * (F.size("x") + F.size("y") - shared)).alias("linked"))


def possible(percent: int, a: str, b: str):
    """Sets whose sizes alone rule a link out are not compared."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def with_components(buckets: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return buckets.withColumn("comp", F.col("member"))
    return buckets.join(labels, "member", "left").withColumn("comp", F.coalesce("label", "member")).drop("label")


def open_buckets(rows: DataFrame, turn: int) -> DataFrame:
    """(bucket, members, largest, leader, leader_n, apart, bytes) of buckets with more than one component."""
    rank = F.struct("weight", "member") if turn == 0 else F.struct(F.xxhash64("member", F.lit(turn)))
    one = F.max_by(F.struct("member", "n"), rank).alias("one")
    parts = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"), one)
    best = F.max_by(F.struct("comp", "one", "size"), F.struct("size", "comp")).alias("best")
    found = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.sum("size").alias("members"), F.sum("n").alias("n"), best)
    return found.where("parts > 1").select(
        "bucket", "members", F.col("best.comp").alias("largest"), F.col("best.one.member").alias("leader"),
        F.col("best.one.n").alias("leader_n"), (F.col("members") - F.col("best.size")).alias("apart"),
        (8 * F.col("n")).alias("bytes"),
    )


def star_pairs(rows: DataFrame, turn: int, percent: int) -> DataFrame:
    """(a, b): the leader of every open bucket with all members outside its component."""
    met = rows.join(open_buckets(rows, turn).select("bucket", "largest", "leader", "leader_n"), "bucket")
    met = met.where((F.col("comp") != F.col("largest")) & possible(percent, "n", "leader_n"))
    return met.select(F.least("member", "leader").alias("a"), F.greatest("member", "leader").alias("b")).distinct()


class Groups:
    """Smallest labels of what has been joined, inside one task."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (above := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(above, above)
        return x

    def join(self, x: int, y: int) -> None:
        x, y = sorted((self.top(x), self.top(y)))
        self.up[y] = x


def links_apart(rows: DataFrame, classes: DataFrame, sets: DataFrame, bands: int, width: int, percent: int, block: int) -> DataFrame:
    """(a, b): links that join what is apart in a bucket; all its pairs across components are compared.

    A task has a block of members outside the largest component and a block of all members,
    with bands, sketches and full sets.  A pair is taken in the first bucket it meets in.
    Pairs whose sketches agree most are confirmed first, and a pair whose components have
    been joined meanwhile needs no comparison, so a task returns fewer links than it has
    members, whatever the number of its pairs.
    """
    bins, p = bands * width, percent / 100
    least = int(np.floor(bins * p - SIGMAS * np.sqrt(bins * p * (1 - p))))
    keys = ["bucket", "left", "right"]
    last = np.int64(np.iinfo(np.int64).max)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in whole_runs(batches, keys, 256):
            first = starts_of(found, keys)
            bucket, probe, apart, member, comp, n = (
                found.column(c).to_numpy() for c in ("bucket", "probe", "apart", "member", "comp", "n")
            )
            lines = np.frombuffer(b"".join(found.column("sketch").to_pylist()), np.uint16).reshape(-1, bins)
            nodes = found.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, bands)
            shingles = found.column("shingles").combine_chunks()
            ends, flat = np.cumsum(shingles.value_lengths().to_numpy()), shingles.flatten().to_numpy()
            own = [flat[e - k : e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
            links = []
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(found)], strict=True):
                near, far = lo + np.flatnonzero(probe[lo:hi]), lo + np.flatnonzero(~probe[lo:hi])
                pairs = []
                for i in near.tolist():
                    to = far[(comp[far] != comp[i]) & (~apart[far] | (member[far] > member[i]))]
                    to = to[100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i])]
                    agree = (lines[to] == lines[i]).sum(axis=1)
                    to, agree = to[agree >= least], agree[agree >= least]
                    met = np.where(nodes[to] == nodes[i], nodes[i], last).min(axis=1, initial=last) == bucket[lo]
                    pairs += [(-k, i, j) for k, j in zip(agree[met].tolist(), to[met].tolist(), strict=True)]
                groups = Groups()
                for _, i, j in sorted(pairs):
                    x, y = int(comp[i]), int(comp[j])
                    if groups.top(x) == groups.top(y):
                        continue
                    shared = len(np.intersect1d(own[i], own[j], assume_unique=True))
                    if 100 * shared >= percent * (n[i] + n[j] - shared):
                        groups.join(x, y)
                        links.append((int(member[i]), int(member[j])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())], names=["a", "b"]
            )

    still = open_buckets(rows, 0).where("members > 2").select("bucket", "members", "largest", "apart", "bytes")
    met = rows.join(still.withColumnsRenamed({"apart": "parted"}), "bucket")
    met = met.withColumn("apart", F.col("comp") != F.col("largest"))
    # Blocks are bounded by members, and on average by the bytes of their sets.
    by_bytes = F.col("bytes") / F.col("members") / BLOCK_BYTES
    of_near, of_far = (F.ceil(F.greatest(F.col(c) / block, F.col(c) * by_bytes)).cast("int") for c in ("parted", "members"))
    hashed = F.xxhash64("member")
    near = met.where("apart").withColumns(
        {"probe": F.lit(True), "left": F.pmod(hashed, of_near), "right": F.explode(F.sequence(F.lit(0), of_far - 1))}
    )
    far = met.withColumns(
        {"probe": F.lit(False), "right": F.pmod(hashed, of_far), "left": F.explode(F.sequence(F.lit(0), of_near - 1))}
    )
    columns = ["bucket", F.col("left").cast("int"), F.col("right").cast("int"), "probe", "apart", "member", "comp", "n"]
    both = written(near.select(*columns).unionByName(far.select(*columns)), "blocks")
    both = both.join(classes.select("member", "bands", "sketch"), "member").join(sets, "member")
    both = both.select(*keys, "probe", "apart", "member", "comp", "n", "bands", "sketch", "shingles").repartition(*keys)
    return both.sortWithinPartitions(*keys).mapInArrow(run, "a long, b long")


def components(
    docs: DataFrame,
    size: int = SIZE,
    percent: int = PERCENT,
    bands: int = BANDS,
    width: int = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """(row, doc_id, n_shingles, set_id, component_id), one per input row.

    ``set_id`` is the smallest id of documents with an equal set, ``component_id`` that of
    all documents linked directly or through others.
    """
    docs = printed(docs)
    rows = written(signed(docs, size, bands, width), "sketches")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "print", "bands", "sketch")
    classes = rows.groupBy("h1", "h2", "n").agg(F.min(best).alias("best")).select(
        "h1", "h2", "n", F.col("best.row").alias("member"), F.col("best.doc_id").alias("of_doc"),
        F.col("best.print").alias("of_print"), F.col("best.bands").alias("bands"), F.col("best.sketch").alias("sketch"),
    )
    classes = written(classes, "set-classes")
    buckets = written(buckets_of(classes), "buckets")
    wanted = buckets.select("member").distinct().join(classes.select("member", "of_doc", "of_print"), "member")
    sets = written(sets_of(docs, wanted, size), "sets")
    links = tested = labels = None
    for turn in range(STARS):
        pairs = star_pairs(with_components(buckets, labels), turn, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        new = written(confirmed(pairs, sets, percent), "tested")
        tested = new if tested is None else tested.unionByName(new)
        links = tested.where("linked").select("a", "b")
        labels = groups_of(links)
    more = written(links_apart(with_components(buckets, labels), classes, sets, bands, width, percent, block), "links")
    labels = groups_of(links.unionByName(more))
    known = classes.join(labels, "member", "left").select(
        "h1", "h2", "n", "of_doc", F.coalesce("label", "member").alias("label")
    )
    smallest = known.groupBy("label").agg(F.min("of_doc").alias("component_id"))
    known = written(known.join(smallest, "label").drop("label"), "components")
    return rows.join(known, ["h1", "h2", "n"]).select(
        "row", "doc_id", F.col("n").alias("n_shingles"), F.col("of_doc").alias("set_id"), "component_id"
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, links.b FROM r JOIN links ON links.a = r.other),
m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""


@query("op11_minhash_near_dedup", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = components(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))
