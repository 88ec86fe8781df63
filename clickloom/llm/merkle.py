"""A manifest of a data set: a Merkle tree whose parents keep hash states.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a source ascend by id and
every ``ARITY`` neighbours become one parent, level by level, until one node is left, the
source's subroot; the subroots, ordered by source, become the root the same way.

A parent keeps a copy of its hash state before each child's slot.  To fold a changed leaf
into a new root, each parent resumes the state of the child's slot, reads the replacement
and the siblings right of it, and ends; what lies left is never read again.

Leaves are numbered by a range sort and cut into blocks of ``ARITY ** LEVELS`` neighbours.
One task climbs ``LEVELS`` levels inside a block, whatever the size of its source; the
blocks' tops are the nodes of the next round, so 10^10 leaves take four rounds.  Rounds
above the first are at most a 700th of the rows; their states and siblings are written and
handed down, one path to each block of leaves, where all leaves of the block are folded.

Defined results: of a null field the leaf reads ``-``; a null source comes first and is a
source of its own; a null ``doc_id`` comes first within its source and counts as empty
text where ids are hashed; rows that repeat a ``doc_id`` follow by leaf, and equal rows by
their place in the input; a source of one row has its leaf as subroot, one source its
subroot as root.  An empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import sha256_states as sha
from clickloom.llm.ordering import numbered, starts_of, whole_runs
from clickloom.llm.queries import crc32_sql, query
from clickloom.llm.shared import table, written

ARITY = 3
LEVELS = 6
# The fields of a leaf in order, and their types.
FIELDS = (("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string"))
STEP = "array<struct<state: binary, left: binary, right: binary>>"
_STEP = pa.list_(pa.struct([("state", pa.binary()), ("left", pa.binary()), ("right", pa.binary())]))


def field_text(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: dict[str, Column]) -> Column:
    """SHA-256 of a row's fields, each with its length."""
    return F.unhex(F.sha2(F.concat(*[field_text(fields[name]) for name, _ in FIELDS]), 256))


def leaves(docs: DataFrame, found: Column | None = None) -> DataFrame:
    """(grp, doc_id, row, leaf, present): the leaf as it was, and of the text found later (null: nothing changed)."""
    own = {name: F.col(name).cast(kind) for name, kind in FIELDS}
    later = own | {"text": F.col("text").cast("string") if found is None else found}
    return docs.select(
        # Not null, and in the byte order of the sources with null first.
        F.coalesce(F.concat(F.lit("="), own["source"]), F.lit("")).alias("grp"),
        own["doc_id"].alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        leaf(own).alias("leaf"),
        leaf(later).alias("present"),
    )


class Level:
    """Nodes of blocks in order, their parents, and the states the parents keep."""

    def __init__(self, digest: np.ndarray, block: np.ndarray, at: np.ndarray) -> None:
        self.digest = digest
        self.slot = at % ARITY
        new = np.ones(len(at), bool)
        new[1:] = (block[1:] != block[:-1]) | (at[1:] // ARITY != at[:-1] // ARITY)
        self.parent = np.cumsum(new) - 1
        self.first = np.flatnonzero(new)
        self.width = np.diff(np.r_[self.first, len(at)])
        self.block, self.at = block[self.first], at[self.first] // ARITY
        # kept[p, s]: the state of parent p before slot s.
        self.kept = np.empty((len(self.first), ARITY, 8), np.uint32)
        state = sha.start(len(self.first))
        for s in range(ARITY):
            self.kept[:, s] = state
            has = self.width > s
            state = state.copy()
            state[has] = sha.read(state[has], digest[self.first[has] + s])
        self.above = sha.finish(state, self.width)

    def folded(self, node: np.ndarray, replaced: np.ndarray) -> np.ndarray:
        """The parents' digests if each node had another: resume, read it and the right siblings, end."""
        up, slot = self.parent[node], self.slot[node]
        state = sha.read(self.kept[up, slot], replaced)
        for s in range(1, ARITY):
            has = slot + s < self.width[up]
            state[has] = sha.read(state[has], self.digest[node[has] + s])
        return sha.finish(state, self.width[up])

    def siblings(self, text: list[bytes], size: int) -> list[tuple[bytes, bytes]]:
        """Left and right siblings of every node, out of one text per node of ``size`` bytes."""
        out = []
        for a, n in zip(self.first.tolist(), self.width.tolist(), strict=True):
            run = b"".join(text[a : a + n])
            out += [(run[: i * size], run[(i + 1) * size :]) for i in range(n)]
        return out


def climb(digest: np.ndarray, block: np.ndarray, at: np.ndarray, levels: int) -> list[Level]:
    out = []
    for _ in range(levels):
        out.append(Level(digest, block, at))
        digest, block, at = out[-1].above, out[-1].block, out[-1].at
    return out


def levels_of(n: np.ndarray, most: int) -> np.ndarray:
    """How many levels a block climbs, of a group of ``n`` nodes."""
    out = np.zeros(len(n), int)
    for i in range(most):
        out[n > ARITY**i] = i + 1
    return out


def block_of(levels: int) -> Column:
    return F.expr(f"at div {ARITY**levels}")


def in_blocks(nodes: DataFrame, levels: int) -> DataFrame:
    nodes = nodes.withColumn("block", block_of(levels))
    return nodes.repartition("grp", "block").sortWithinPartitions("grp", "block", "at")


def parts(rows: pa.Table, most: int) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, int]]:
    """Rows of blocks that climb equally many levels, their blocks' numbers, their places, and the levels."""
    first = starts_of(rows, ["grp", "block"])
    number = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(rows)]))
    levels = levels_of(rows.column("n").to_numpy(), most)
    at = rows.column("at").to_numpy() % ARITY**most
    for k in np.unique(levels):
        of = np.flatnonzero(levels == k)
        yield rows.take(pa.array(of)), number[of], at[of], int(k)


def tops_of(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, at, n, digest) of the blocks' tops."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_runs(batches, ["grp", "block"]):
            for own, block, at, k in parts(rows, levels):
                digest = sha.words_of(own.column("digest").to_pylist())
                for level in climb(digest, block, at, k):
                    digest = level.above
                first = starts_of(own, ["grp", "block"])
                one = own.take(pa.array(first))
                n = one.column("n").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column("grp").combine_chunks(), one.column("block").combine_chunks(),
                        pa.array(-(-n // ARITY**levels)), pa.array(sha.bytes_of(digest), pa.binary()),
                    ],
                    names=["grp", "at", "n", "digest"],
                )

    return in_blocks(nodes, levels).mapInArrow(run, "grp string, at long, n long, digest binary")


def climbed(nodes: DataFrame, levels: int) -> DataFrame:
    """(grp, at, n, top, path): of every node the top of its block, and states and siblings on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_runs(batches, ["grp", "block"]):
            for own, block, at, k in parts(rows, levels):
                digest = sha.words_of(own.column("digest").to_pylist())
                steps = climb(digest, block, at, k)
                node, paths = np.arange(len(own)), [[] for _ in range(len(own))]
                for level in steps:
                    beside = level.siblings(sha.bytes_of(level.digest), 32)
                    kept = sha.bytes_of(level.kept[level.parent[node], level.slot[node]])
                    for path, i, state in zip(paths, node.tolist(), kept, strict=True):
                        left, right = beside[i]
                        path.append({"state": state, "left": left, "right": right})
                    node = level.parent[node]
                    digest = level.above
                top = sha.bytes_of(digest)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[own.column(c).combine_chunks() for c in ("grp", "at", "n")],
                        pa.array([top[i] for i in node.tolist()], pa.binary()), pa.array(paths, _STEP),
                    ],
                    names=["grp", "at", "n", "top", "path"],
                )

    return in_blocks(nodes, levels).mapInArrow(run, f"grp string, at long, n long, top binary, path {STEP}")


def tree(nodes: DataFrame, largest: int, purpose: str, levels: int) -> tuple[DataFrame, DataFrame]:
    """Of nodes (grp, at, n, digest): (grp, digest) of each group's root, and (grp, at, path) from every node to it."""
    rounds, size = [], ARITY**levels
    while largest > 1:
        rounds.append(written(climbed(nodes, levels), purpose))
        first = rounds[-1].where(F.col("at") % size == 0)
        n = F.ceil(F.col("n") / size).cast("long")
        nodes = first.select("grp", block_of(levels).alias("at"), n.alias("n"), F.col("top").alias("digest"))
        largest = -(-largest // size)
    ways = nodes.select("grp", "at", F.array().cast(STEP).alias("path"))
    for level in reversed(rounds):
        higher = ways.select("grp", F.col("at").alias("up"), F.col("path").alias("rest"))
        own = level.select("grp", "at", "path", block_of(levels).alias("up"))
        ways = own.join(higher, ["grp", "up"]).select("grp", "at", F.concat("path", "rest").alias("path"))
    return nodes.select("grp", "digest"), ways


class Way:
    """The path of each block from its top to the root, as arrays to be resumed by all its leaves."""

    def __init__(self, paths: list[list[dict]]) -> None:
        self.length = np.array([len(p) for p in paths])
        self.steps = []
        for j in range(int(self.length.max(initial=0))):
            has = [p[j] if len(p) > j else None for p in paths]
            state = sha.words_of([s["state"] if s else bytes(32) for s in has])
            n = np.array([len(s["right"]) // 32 if s else 0 for s in has])
            right = sha.words_of([(s["right"] if s else b"").ljust(32 * (ARITY - 1), b"\0") for s in has])
            width = np.array([1 + (len(s["left"]) + len(s["right"])) // 32 if s else 0 for s in has])
            self.steps.append((state, right.reshape(len(paths), ARITY - 1, 8), n, width))
        self.text = [b"".join(s["left"] + s["right"] for s in p).hex().encode() for p in paths]

    def folded(self, block: np.ndarray, digest: np.ndarray) -> np.ndarray:
        for j, (state, right, n, width) in enumerate(self.steps):
            on = np.flatnonzero(self.length[block] > j)
            of = block[on]
            now = sha.read(state[of], digest[on])
            for s in range(ARITY - 1):
                more = n[of] > s
                now[more] = sha.read(now[more], right[of[more], s])
            digest[on] = sha.finish(now, width[of])
        return digest


FOLDED = (
    ("doc_id", "long", pa.int64()),
    ("source", "string", pa.string()),
    ("leaf", "string", pa.string()),
    ("subroot", "string", pa.string()),
    ("root", "string", pa.string()),
    ("proof_sha256", "string", pa.string()),
    ("folded_root", "string", pa.string()),
    ("verified", "boolean", pa.bool_()),
    ("proof", "array<string>", pa.list_(pa.string())),
)


def folded(rows: DataFrame, ways: DataFrame, with_proof: bool, levels: int) -> DataFrame:
    """Every leaf folded into a root along its block and the block's path."""
    fields = FOLDED if with_proof else FOLDED[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for both in whole_runs(batches, ["grp", "block"]):
            first = starts_of(both, ["grp", "block"])  # the row of the block's path comes before its leaves
            heads = both.take(pa.array(first))
            path, subroot, root = (heads.column(c).to_pylist() for c in ("path", "subroot", "root"))
            number = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(both)]))
            below = np.setdiff1d(np.arange(len(both)), first)
            rows = both.take(pa.array(below)).append_column("head", pa.array(number[below]))
            for own, block, at, k in parts(rows, levels):
                head, numbers = np.unique(own.column("head").to_numpy(), return_inverse=True)
                way = Way([path[i] for i in head])
                leaf = own.column("leaf").to_pylist()
                now = sha.words_of(own.column("present").to_pylist())
                steps, node = climb(sha.words_of(leaf), block, at, k), np.arange(len(own))
                for level in steps:
                    now = level.folded(node, now)
                    node = level.parent[node]
                now = way.folded(numbers, now)
                # Siblings as text, from the tops down: a node's own, then its parent's.
                text = [way.text[i] for i in (numbers if not steps else numbers[_first(steps)]).tolist()]
                for level in reversed(steps):
                    hexes = [x.hex().encode() for x in sha.bytes_of(level.digest)]
                    up = level.parent.tolist()
                    text = [a + b + text[p] for (a, b), p in zip(level.siblings(hexes, 64), up, strict=True)]
                got = sha.bytes_of(now)
                of = head[numbers].tolist()
                grp = own.column("grp").to_pylist()
                columns = [
                    own.column("doc_id").to_pylist(),
                    [g[1:] if g else None for g in grp],
                    [x.hex() for x in leaf],
                    [subroot[i].hex() for i in of],
                    [root[i].hex() for i in of],
                    [hashlib.sha256(t).hexdigest() for t in text],
                    [g.hex() for g in got],
                    [g == root[i] for g, i in zip(got, of, strict=True)],
                ]
                if with_proof:
                    columns.append([[t[i : i + 64].decode() for i in range(0, len(t), 64)] for t in text])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f[2]) for c, f in zip(columns, fields, strict=True)], names=[f[0] for f in fields]
                )

    heads = ways.select("grp", "block", F.lit(-1).cast("long").alias("at"), "path", "subroot", "root")
    both = rows.withColumn("block", block_of(levels)).unionByName(heads, allowMissingColumns=True)
    both = both.repartition("grp", "block").sortWithinPartitions("grp", "block", "at")
    return both.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in fields))


def _first(steps: list[Level]) -> np.ndarray:
    """Of every top of the climbed blocks, the index of its first leaf."""
    at = steps[-1].first
    for level in reversed(steps[:-1]):
        at = level.first[at]
    return at


def manifest(docs: DataFrame, found: Column | None = None, with_proof: bool = True, levels: int = LEVELS) -> DataFrame:
    """One row per document: its leaf, the roots above it, its proof, and the root that its present text folds into.

    ``found`` is the text of a row as it is found when the manifest is checked, in terms of
    the columns of ``docs``; where it differs from the text, the row does not verify.
    ``proof`` has the siblings from the leaf to the root, left to right in each level.
    """
    rows = numbered(written(leaves(docs, found), "leaves"), "grp", ["doc_id", "leaf", "row"], "sorted-leaves").drop("row")
    rows = written(rows, "numbered-leaves")
    largest = rows.agg(F.max("n")).first()[0]
    if largest is None:
        fields = ", ".join(f"{name} {kind}" for name, kind, _ in (FOLDED if with_proof else FOLDED[:-1]))
        return docs.sparkSession.createDataFrame([], fields)
    tops = written(tops_of(rows.select("grp", "at", "n", F.col("leaf").alias("digest")), levels), "tops")
    subroots, ways = tree(tops, -(-largest // ARITY**levels), "tree", levels)
    every = numbered(subroots.select(F.lit("").alias("all"), "grp", "digest"), "all", ["grp"], "subroots")
    every = written(every, "numbered-subroots")
    ends = every.select(F.col("all").alias("grp"), "at", "n", "digest")
    roots, upper = tree(ends, every.agg(F.max("n")).first()[0], "root", levels)
    of_source = (
        every.join(upper.select("at", F.col("path").alias("rest")), "at")
        .join(roots.select(F.col("grp").alias("all"), F.col("digest").alias("root")), "all")
        .select("grp", F.col("digest").alias("subroot"), "root", "rest")
    )
    ways = ways.join(of_source, "grp").select(
        "grp", F.col("at").alias("block"), F.concat("path", "rest").alias("path"), "subroot", "root"
    )
    return folded(rows, ways, with_proof, levels)


def _climb_sql(name: str, start: str) -> str:
    """``name``: the nodes (grp, lvl, spot, n, digest) of every level; ``name``_kin: what lies left and right of each."""
    return f"""
{name}(grp, lvl, spot, n, digest) AS (
  {start}
  UNION ALL
  SELECT grp, lvl + 1, spot // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY spot))
  FROM {name} WHERE n > 1 GROUP BY grp, lvl, spot // 3),
{name}_kin AS (
  SELECT a.grp, a.lvl, a.spot, coalesce(string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot < a.spot), '') AS l,
    coalesce(string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot > a.spot), '') AS r
  FROM {name} a LEFT JOIN {name} b ON b.grp = a.grp AND b.lvl = a.lvl AND b.spot // 3 = a.spot // 3 AND b.spot <> a.spot
  GROUP BY ALL)"""


def _fold_sql(name: str, nodes: str, start: str) -> str:
    """``name``: every row folded level by level (id, grp, lvl, spot, n, now, proof); it has arrived where n is 1."""
    return f"""
{name}(id, grp, lvl, spot, n, now, proof) AS (
  {start}
  UNION ALL
  SELECT id, f.grp, f.lvl + 1, f.spot // 3, (n + 2) // 3, sha256(l || now || r), proof || l || r
  FROM {name} f JOIN {nodes}_kin k ON k.grp = f.grp AND k.lvl = f.lvl AND k.spot = f.spot WHERE n > 1)"""


def _leaf_sql(text: str) -> str:
    fields = [f"CAST({name} AS VARCHAR)" for name, _ in FIELDS[:-1]] + [text]
    parts = [f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


SQL = f"""
WITH RECURSIVE found AS (
  SELECT *, {crc32_sql("doc_id::VARCHAR")} % 2 = 0 AS hit FROM documents),
leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp, {_leaf_sql("text")} AS leaf,
    {_leaf_sql("(CASE WHEN hit THEN replace(text, chr(10), '') ELSE text END)")} AS now FROM found),
placed AS (
  SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot,
    count(*) OVER (PARTITION BY grp) AS n FROM leaves),
{_climb_sql("up", "SELECT grp, 0, spot, n, leaf FROM placed")},
subroots AS (
  SELECT grp, digest, row_number() OVER (ORDER BY grp) - 1 AS spot, count(*) OVER () AS n FROM up WHERE n = 1),
{_climb_sql("top", "SELECT '', 0, spot, n, digest FROM subroots")},
{_fold_sql("low", "up", "SELECT id, grp, 0, spot, n, now, '' FROM placed")},
{_fold_sql("high", "top", "SELECT id, '', 0, s.spot, s.n, now, proof FROM low JOIN subroots s USING (grp) WHERE low.n = 1")}
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(h.proof) AS proof_sha256, h.now AS folded_root,
  h.now = t.digest AS verified
FROM placed p JOIN subroots s USING (grp) JOIN high h ON h.id = p.id AND h.n = 1 JOIN top t ON t.n = 1
"""


@query("op13_merkle_manifest", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    number = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")
    text = F.col("text").cast("string")
    found = F.when(F.crc32(number) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    return manifest(docs, found, with_proof=False).drop("source")
