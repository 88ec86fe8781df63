"""Similarity join on word shingles: MinHash LSH forest, then exact Jaccard.

1. Every text gets its set of ``size``-word shingles and a MinHash signature, cut into
   ``trees`` paths of ``depth`` values: one sorted prefix trie per tree.  Texts with equal
   sets are one class, so copies, however many, are one row from here on.
2. The matched prefix starts at full depth and is shortened, value by value, until pairs
   at the threshold meet in some trie with the target recall.
3. Classes below one trie node are compared exactly, blocks of ``BLOCK`` at a time: their
   shingle sets come to the block, and an incidence product gives all intersections.  A
   node with the same members as a node of an earlier tree is left out, and a pair is
   taken in the first tree it meets in, so it is found once.
4. Links join classes to groups by smallest labels with pointer jumping, every round
   written to the shared folder.

A pair is linked if the Jaccard similarity of its sets is at least ``threshold``.  Links
are between classes; the class of each document and the number of its links expand them.

Defined results: a text of fewer than ``size`` words is one shingle of all its words; a
null text or one without words has no shingle and no link and is a class of its own;
repeated rows are members of one class; a null ``doc_id`` never names a class unless it
is alone.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.queries import query
from clickloom.llm.shared import id_and_text, packed, small_batches, table, written
from clickloom.llm.textcore import chunks, lists, mix, span_hashes, windows, words

SIZE = 5
THRESHOLD = 0.8
TREES = 10
DEPTH = 6
TARGET = 0.99
BLOCK = 256
_U = np.uint64


def prefix_length(threshold: float, trees: int, depth: int, target: float) -> int:
    """Shorten the matched prefix until pairs at the threshold are found with the target recall."""
    length = depth
    while length > 1 and 1 - (1 - threshold**length) ** trees < target:
        length -= 1
    return length


def shingle_sets(data: np.ndarray, starts: np.ndarray, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of every row, in order."""
    start, stop, first = words(data, starts)
    hashes = span_hashes(data, start, stop)
    value, inside = windows(hashes, first, size)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(value[a:b][inside[a:b]]))
        elif b > a:
            whole, _ = windows(hashes[a:b], np.array([0, b - a]), int(b - a))
            out.append(whole[:1])
        else:
            out.append(np.zeros(0, _U))
    return out


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """MinHash values, one row per set; sets must not be empty."""
    flat = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), count), np.uint32)
    high = (flat >> _U(32)).astype(np.uint32)
    salt = mix(np.arange(1, 2 * count + 1, dtype=_U))
    for i in range(count):
        a, b = np.uint32(salt[2 * i] & _U(0xFFFFFFFF)) | np.uint32(1), np.uint32(salt[2 * i + 1] & _U(0xFFFFFFFF))
        x = (high ^ b) * a
        out[:, i] = np.minimum.reduceat((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D), first)
    return out


SIGNED = "row long, doc_id long, print long, h1 long, h2 long, n long, nodes array<long>"


def signed(docs: DataFrame, size: int, trees: int, depth: int, length: int) -> DataFrame:
    """Of every row: a fingerprint of its set, and its trie node in each tree at the matched prefix length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, starts in chunks(batch.column("text")):
                sets = shingle_sets(data, starts, size)
                filled = [i for i, s in enumerate(sets) if len(s)]
                nodes, first = np.zeros(0, np.int64), np.zeros(hi - lo + 1, np.int64)
                h1, h2 = np.zeros(hi - lo, np.int64), row + np.arange(hi - lo)
                if filled:
                    full = [sets[i] for i in filled]
                    sign = signatures(full, trees * depth).reshape(len(full), trees, depth)[:, :, :length]
                    node = np.zeros((len(full), trees), _U)
                    for k in range(length):
                        node = mix(node + sign[:, :, k].astype(_U) + _U(k + 1))
                    nodes = node.astype(np.int64).ravel()
                    first[np.array(filled) + 1] = trees
                    first = np.cumsum(first)
                    h1[filled] = [int(np.add.reduce(mix(s)).astype(np.int64)) for s in full]
                    h2[filled] = [int(np.bitwise_xor.reduce(mix(s + _U(1))).astype(np.int64)) for s in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(hi - lo)), batch.column("doc_id")[lo:hi], batch.column("print")[lo:hi],
                        pa.array(h1), pa.array(h2), pa.array([len(s) for s in sets], pa.int64()),
                        lists(nodes, first, pa.int64()),
                    ],
                    names=[f.split()[0] for f in SIGNED.split(", ")],
                )
                row += hi - lo

    return docs.mapInArrow(run, SIGNED)


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(member, shingles) of the wanted classes, recomputed from the text of one member each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, starts in chunks(batch.column("text")):
                sets = shingle_sets(data, starts, size)
                first = np.cumsum([0, *map(len, sets)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("member")[lo:hi], lists(np.concatenate(sets).astype(np.int64), first, pa.int64())],
                    names=["member", "shingles"],
                )

    found = docs.join(wanted, [docs["doc_id"].eqNullSafe(wanted["of_doc"]), docs["print"] == wanted["of_print"]])
    return found.select("member", "text").mapInArrow(run, "member long, shingles array<long>").dropDuplicates(["member"])


def block_links(threshold: float, pairs: bool):
    """Links between two blocks of a trie node, or within one.

    Either all pairs, or of every member how many rows it is linked to and the smallest
    member it reaches: one row a member, however many links a block has.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("member")
        sets = [np.asarray(s) for s in rows["shingles"]]
        member, own = rows["member"].to_numpy(), rows["own"].to_numpy()
        tree, size = int(rows["tree"].iloc[0]), np.array([len(s) for s in sets], float)
        nodes = np.array(rows["nodes"].tolist(), np.int64).reshape(len(rows), -1)
        a, b = int(rows["left"].iloc[0]), int(rows["right"].iloc[0])
        left, right = np.flatnonzero(own == a), np.flatnonzero(own == b)
        flat = np.concatenate(sets)
        # Only shingles of more than one member can be shared.
        value, column, n = np.unique(flat, return_inverse=True, return_counts=True)
        rename = np.cumsum(n > 1) - 1
        line = np.repeat(np.arange(len(sets)), size.astype(int))
        both = np.zeros((len(left), len(right)), np.float32)
        step = 1 << 14
        for low in range(0, int((n > 1).sum()), step):
            at = (n[column] > 1) & (rename[column] >= low) & (rename[column] < low + step)
            found = np.zeros((len(sets), step), np.float32)
            found[line[at], rename[column[at]] - low] = 1
            both += found[left] @ found[right].T
        likeness = both / (size[left][:, None] + size[right][None, :] - both)
        ok = likeness >= threshold - 1e-6
        if a == b:
            ok &= left[:, None] < right[None, :]
        # A pair belongs to the first tree it meets in.
        for t in range(tree):
            ok &= nodes[left, t][:, None] != nodes[right, t][None, :]
        i, j = np.nonzero(ok)
        if pairs:
            x, y = member[left[i]], member[right[j]]
            return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "jaccard": likeness[i, j].astype(float)})
        copies = rows["copies"].to_numpy(np.int64)
        linked, label = np.zeros(len(rows), np.int64), np.arange(len(rows))
        np.add.at(linked, left, ok @ copies[right])
        np.add.at(linked, right, ok.T @ copies[left])
        while True:  # smallest line reachable within the block; lines are in order of members
            new = label.copy()
            np.minimum.at(new, left[i], label[right[j]])
            np.minimum.at(new, right[j], label[left[i]])
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        met = linked > 0
        return pd.DataFrame({"member": member[met], "root": member[label[met]], "linked": linked[met]})

    return run


def class_links(docs: DataFrame, classes: DataFrame, size: int, threshold: float, pairs: bool = False) -> DataFrame:
    """Of every block (member, root, linked), or all pairs of classes (a, b, jaccard), each once."""
    node = classes.where("n > 0").select("member", F.posexplode("nodes").alias("tree", "node"))
    full = (
        node.groupBy("tree", "node")
        .agg(F.count("*").alias("members"), F.sum(F.hash("member")).alias("who"), F.bit_xor(F.xxhash64("member")).alias("who2"))
        .where("members > 1")
    )
    # Nodes of equal members: the first tree has all their pairs.
    first = full.groupBy("members", "who", "who2").agg(F.min_by(F.struct("tree", "node"), "tree").alias("at"))
    first = first.select("at.tree", "at.node", "members")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = (
        node.join(first, ["tree", "node"])
        .withColumn("own", F.pmod(F.hash("member"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select(
            "tree", "node", "member", "own",
            F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
        )
    )
    placed = written(placed, "node-members")
    wanted = placed.select("member").distinct()
    wanted = wanted.join(classes.select("member", "of_doc", "of_print", "nodes", "copies"), "member")
    sets = sets_of(docs, wanted.drop("nodes", "copies"), size).join(wanted.select("member", "nodes", "copies"), "member")
    return (
        placed.join(sets, "member")
        .groupBy("tree", "node", "left", "right")
        .applyInPandas(
            block_links(threshold, pairs),
            "a long, b long, jaccard double" if pairs else "member long, root long, linked long",
        )
    )


def groups_of(links: DataFrame) -> DataFrame:
    """(member, label): the smallest member reachable over links, for members with a link."""
    edges = links.select("a", "b").union(links.select("b", "a"))
    labels = written(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "member"), "labels")
    while True:
        # The smallest label among neighbours, then the label of that label.
        near = (
            edges.join(labels.withColumnRenamed("member", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
            .join(labels.withColumnRenamed("member", "a"), "a")
            .select(F.col("a").alias("member"), "label", F.least("near", "label").alias("next"))
        )
        jump = labels.select(F.col("member").alias("next"), F.col("label").alias("jump"))
        new = written(
            near.join(jump, "next", "left").select(
                "member", F.least("next", F.coalesce("jump", "next")).alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        labels = new.drop("old")
        if new.where("label <> old").isEmpty():
            return labels


def set_classes(docs: DataFrame, size: int, trees: int, depth: int, target: float, threshold: float):
    """Signed rows and the classes of equal sets, both written."""
    length = prefix_length(threshold, trees, depth, target)
    rows = written(signed(docs, size, trees, depth, length), "signatures")
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "print", "nodes")
    classes = rows.groupBy("h1", "h2", "n").agg(F.min(best).alias("best"), F.count("*").alias("copies"))
    classes = classes.select(
        "h1", "h2", "n", "copies", F.col("best.row").alias("member"), F.col("best.doc_id").alias("of_doc"),
        F.col("best.print").alias("of_print"), F.col("best.nodes").alias("nodes"),
    )
    return rows, written(classes, "set-classes")


def printed(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return id_and_text(docs).withColumn("print", F.xxhash64("text"))


def near_duplicates(
    docs: DataFrame,
    size: int = SIZE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    target: float = TARGET,
) -> DataFrame:
    """(row, doc_id, print, n_shingles, set_id, class_id, n_links), one per input row.

    ``set_id`` is the smallest id of equal sets, ``class_id`` that of all documents linked
    directly or through others, ``n_links`` the number of other rows this one is linked to,
    copies of its own set included.
    """
    docs = printed(docs)
    rows, classes = set_classes(docs, size, trees, depth, target, threshold)
    found = written(class_links(docs, classes, size, threshold), "links")
    partners = found.groupBy("member").agg(F.sum("linked").alias("linked"))
    labels = groups_of(found.where("member <> root").select(F.col("member").alias("a"), F.col("root").alias("b")))
    known = classes.join(labels, "member", "left").join(partners, "member", "left")
    known = known.withColumn("label", F.coalesce("label", "member")).select(
        "h1", "h2", "n", "of_doc", "label",
        F.when(F.col("n") > 0, F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).otherwise(0).alias("n_links"),
    )
    smallest = known.groupBy("label").agg(F.min("of_doc").alias("class_id"))
    known = written(known.join(smallest, "label"), "classes")
    return rows.join(known, ["h1", "h2", "n"]).select(
        "row", "doc_id", "print", F.col("n").alias("n_shingles"), F.col("of_doc").alias("set_id"), "class_id", "n_links"
    )


def linked_pairs(
    docs: DataFrame,
    size: int = SIZE,
    threshold: float = THRESHOLD,
    trees: int = TREES,
    depth: int = DEPTH,
    target: float = TARGET,
) -> DataFrame:
    """(a, b, jaccard) of set ids: every link between different sets, as many rows as there are."""
    docs = printed(docs)
    _, classes = set_classes(docs, size, trees, depth, target, threshold)
    links = class_links(docs, classes, size, threshold, pairs=True)
    ids = classes.select("member", "of_doc")
    named = links.join(ids.toDF("a", "set_a"), "a").join(ids.toDF("b", "set_b"), "b")
    return named.select(F.col("set_a").alias("a"), F.col("set_b").alias("b"), "jaccard")


def without_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are first of their class: smallest id, then row."""
    members = near_duplicates(docs, **options)
    first = (
        members.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        .groupBy("class_id", F.when(F.col("n_shingles") == 0, F.col("row")).alias("alone"))
        .agg(F.min("print").alias("kept_print"))
        .select(F.col("class_id").alias("kept_id"), "kept_print")
        .distinct()
    )
    own = packed(docs).withColumn("print", F.xxhash64("text"))
    kept = own.join(first, [own["id"].eqNullSafe(first["kept_id"]), own["print"] == first["kept_print"]], "left_semi")
    # Rows repeated with the same id and text are one document.
    return kept.groupBy("id", "print").agg(F.min_by("row", "tie").alias("row")).select("row.*")


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = near_duplicates(table(spark, sf_dir, "documents"))
    return members.select("doc_id", "class_id", "set_id", "n_links")
