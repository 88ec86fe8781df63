"""Prefix trie of conversations: what a store that keeps shared openings once would save.

1. Turns get dense dictionary ids, conversations become sequences of ids.  Both the ids and
   the places of turns come from range sorts, so a turn or a conversation that holds a
   third of all rows is spread over tasks.
2. Sequences are cut into stretches of ``STRETCH`` turns; a stretch hangs below the digest
   of everything before it.  So no row grows with a conversation.
3. Stretches are sorted by range into shards of bounded size.  A shard builds a ternary
   search tree over turn ids, sequences inserted median first so that the siblings of a
   node stay balanced, and an iterative traversal adds up members, leaves and savings.
4. Only the nodes on the paths to a shard's first and last sequence can reach into other
   shards.  They are merged by the digest of their path: members add up, children and
   leaves are counted once, and what that changes is handed to their ancestors.
5. Where conversations are longer than a stretch, the totals of the stretches below are
   found first, by doubling along the chain of stretches, and count as what lies below
   the end of the stretch above.

The digest of a node's ends is sequential by definition.  A shard hands on the ids of a
merged node as pieces of ``PIECE`` characters, and one task chains a node's pieces in order
as a stream.

Defined results: a null role or text is empty; a null turn comes first, turns of equal
number follow by the SHA-256 of role and text, repeated rows are turns like others; rows
without a ``conv_id`` belong to no conversation and are left out.  An empty table gives no
rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.ordering import numbered
from clickloom.llm.queries import crc32_sql, query
from clickloom.llm.shared import small_batches, table, written

STRETCH = 256
SHARD = 1 << 18  # turns and conversations a shard holds
PIECE = 1 << 16
NONE = hashlib.sha256(b"").hexdigest()


class Trie:
    """A ternary search tree: of every node the tree of its children, as links to lower, equal and higher ids."""

    def __init__(self) -> None:
        self.symbol, self.low, self.down, self.high = [-1], [0], [0], [0]
        self.parent, self.depth, self.size = [-1], [0], [0]
        self.count, self.conv, self.ends, self.below = [0], [None], [None], [None]

    def _node(self, symbol: int, size: int, parent: int) -> int:
        for column, value in (
            (self.symbol, symbol), (self.low, 0), (self.down, 0), (self.high, 0), (self.parent, parent),
            (self.depth, self.depth[parent] + 1), (self.size, size), (self.count, 0), (self.conv, None),
            (self.ends, None), (self.below, None),
        ):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, symbols: list[int], sizes: list[int]) -> int:
        """The node of a sequence, made if it is new."""
        node = 0
        for symbol, size in zip(symbols, sizes, strict=True):
            links, at = self.down, node
            while (found := links[at]) and self.symbol[found] != symbol:
                links, at = (self.low if symbol < self.symbol[found] else self.high), found
            if not found:
                found = links[at] = self._node(symbol, size, node)
            node = found
        return node

    def path(self, node: int) -> list[int]:
        """The nodes from the top down to one."""
        out = [node]
        while self.parent[out[-1]] >= 0:
            out.append(self.parent[out[-1]])
        return out[::-1]

    def preorder(self) -> list[int]:
        """All nodes, siblings by symbol, every node before what lies below it."""
        out, stack = [], [(0, True)]
        while stack:
            node, ready = stack.pop()
            if ready:
                out.append(node)
                if self.down[node]:
                    stack.append((self.down[node], False))
            else:
                # Lower siblings, the node and all below it, higher siblings; the stack turns them round.
                stack += [x for x in ((self.high[node], False), (node, True), (self.low[node], False)) if x[0]]
        return out


def median_first(n: int) -> Iterator[int]:
    """0 to n - 1, each range's middle before its halves."""
    stack = [(0, n)]
    while stack:
        low, high = stack.pop()
        if low < high:
            mid = (low + high) // 2
            yield mid
            stack += [(low, mid), (mid + 1, high)]


OUT = (
    ("kind", "int", pa.int32()),  # 0: a whole node, 1: part of a node that other shards may have, 2: a piece of its ends
    ("shard", "long", pa.int64()),
    ("edge", "int", pa.int32()),  # in a shard: the part itself, or of a whole node the part that is its parent (or -1)
    ("key", "binary", pa.binary()),
    ("chain", "array<binary>", pa.list_(pa.binary())),  # the keys from the top down to the node
    ("top", "binary", pa.binary()),
    ("local", "int", pa.int32()),
    ("depth", "long", pa.int64()),
    ("conv_id", "long", pa.int64()),
    ("parent_conv_id", "long", pa.int64()),
    ("n_convs", "long", pa.int64()),
    ("n_children", "long", pa.int64()),
    ("n_leaves", "long", pa.int64()),
    ("saved_tokens", "long", pa.int64()),
    ("size", "long", pa.int64()),
    ("below", "boolean", pa.bool_()),
    ("ends", "string", pa.string()),
)
SCHEMA = ", ".join(f"{name} {kind}" for name, kind, _ in OUT)
NODE = ("top", "local", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")
BELOW = "struct<children: bigint, leaves: bigint, saved: bigint, ends: string>"


def shard_rows(rows: list[tuple], shard: int, stretch_turns: int, piece: int) -> Iterator[dict]:
    """rows: (top, stretch, ids, sizes, conv_id, what lies below or None), sorted."""
    tops = [list(own) for _, own in groupby(rows, key=lambda r: r[0])]
    edges = 0
    for t, own in enumerate(tops):
        top, stretch = own[0][:2]
        runs = [list(same) for _, same in groupby(own, key=lambda r: r[2])]
        trie, end = Trie(), [0] * len(runs)
        for i in median_first(len(runs)):
            run = runs[i]
            node = end[i] = trie.insert(run[0][2], run[0][3])
            trie.count[node] += len(run)
            trie.conv[node] = run[0][4]
            if run[0][5] is None:
                trie.ends[node] = [r[4] for r in run]
            else:
                trie.below[node] = run[0][5]
        # The paths that other shards may share, and the keys on them.
        key, number, chain = {}, {}, {}
        for node in ([end[0]] if t == 0 else []) + ([end[-1]] if t == len(tops) - 1 else []):
            digest, above = hashlib.sha256(top), []
            for step in trie.path(node):
                if step:
                    digest.update(trie.symbol[step].to_bytes(8, "big"))
                above = [*above, digest.digest()]
                if step not in key:
                    key[step], chain[step], number[step] = above[-1], above, edges
                    edges += 1
        order = trie.preorder()
        children, leaves, saved = [0] * len(order), [0] * len(order), [0] * len(order)
        for node in reversed(order):
            whole, b = node not in key, trie.below[node]
            if whole:
                leaves[node] += b[1] if b else not children[node]
                saved[node] += (trie.count[node] - 1) * trie.size[node] + (b[2] if b else 0)
            up = trie.parent[node]
            if up >= 0:
                trie.count[up] += trie.count[node]
                if trie.conv[up] is None or trie.conv[node] < trie.conv[up]:
                    trie.conv[up] = trie.conv[node]
                if whole:
                    children[up] += 1
                    leaves[up] += leaves[node]
                    saved[up] += saved[node]
        for node in order:
            up, b, ends = trie.parent[node], trie.below[node], trie.ends[node]
            local = trie.depth[node]
            row = {
                "kind": int(node in key), "shard": shard, "edge": number.get(node, number.get(up, -1)), "top": top,
                "local": local, "depth": stretch * stretch_turns + local, "conv_id": trie.conv[node],
                "n_convs": trie.count[node], "n_children": b[0] if b else children[node], "n_leaves": leaves[node],
                "saved_tokens": saved[node], "size": trie.size[node], "below": b is not None, "ends": b[3] if b else NONE,
            }
            if node not in key:
                if up >= 0 and up not in key:
                    row["parent_conv_id"] = trie.conv[up]
                if ends:
                    row["ends"] = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
            else:
                row |= {"key": key[node], "chain": chain[node]}
                if b:
                    row["n_leaves"], row["saved_tokens"] = row["n_leaves"] + b[1], row["saved_tokens"] + b[2]
                step = max(1, piece // 21)
                for i in range(0, len(ends or ()), step):
                    text = ",".join(map(str, ends[i : i + step]))
                    yield {"kind": 2, "shard": shard, "edge": -1, "key": key[node], "conv_id": ends[i], "ends": text}
            yield row


def shards(stretch: int, shard_turns: int, piece: int):
    """A task's rows, cut into shards of about so many turns and conversations, as the pieces of their tries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, size = TaskContext.get().partitionId() << 32, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            found = list(shard_rows(held, shard, stretch, piece))
            for low in range(0, len(found), 10_000):
                part = found[low : low + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r.get(name) for r in part], kind) for name, _, kind in OUT], names=[f[0] for f in OUT]
                )

        for batch in batches:
            for top, number, ids, sizes, conv_id, below in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                held.append((top, number, ids, sizes, conv_id, below and tuple(below.values())))
                size += len(ids) + 1
                if size >= shard_turns:
                    yield from out()
                    shard, held, size = shard + 1, [], 0
        if held:
            yield from out()

    return run


def chained_ends(pieces: DataFrame) -> DataFrame:
    """(key, ends): the digest of each merged node's ends, from its pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends"])

        for batch in batches:
            for key, _, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != now:
                    if now is not None:
                        yield row()
                    now, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
        if now is not None:
            yield row()

    # Pieces of one node come from rows in order of conv_id; those of one shard never overlap another's.
    rows = pieces.select("key", "conv_id", "ends").repartition("key").sortWithinPartitions("key", "conv_id")
    return rows.mapInArrow(run, "key binary, ends string")


def merged(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of all shards: the whole ones, and those put together at the shards' edges, each with NODE's columns."""
    edge = parts.where("kind = 1")
    nodes = edge.groupBy("key").agg(
        F.any_value("chain").alias("chain"), F.any_value("top").alias("top"), F.any_value("local").alias("local"),
        F.any_value("depth").alias("depth"), F.any_value("size").alias("size"), F.any_value("below").alias("below"),
        F.any_value("ends").alias("ends"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.when(F.any_value("below"), F.max("n_children")).otherwise(F.sum("n_children")).alias("n_children"),
        F.when(F.any_value("below"), F.max("n_leaves")).otherwise(F.sum("n_leaves")).alias("n_leaves"),
        F.when(F.any_value("below"), F.max("saved_tokens")).otherwise(F.sum("saved_tokens")).alias("saved_tokens"),
    )
    nodes = nodes.withColumn("up", F.try_element_at("chain", F.lit(-2)))
    # A child on an edge counts once, in however many shards it is.
    children = nodes.where("up IS NOT NULL").groupBy(F.col("up").alias("key")).agg(F.count(F.lit(1)).alias("more"))
    nodes = nodes.join(children, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    nodes = nodes.withColumns({
        "n_leaves": F.col("n_leaves") + F.when(~F.col("below") & (F.col("n_children") == 0), 1).otherwise(0),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size"),
    })
    nodes = written(nodes.drop("more"), "edge-nodes")
    totals = nodes.select(F.explode("chain").alias("key"), "n_leaves", "saved_tokens").groupBy("key")
    totals = totals.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    names = nodes.select("key", F.col("conv_id").alias("parent_conv_id"))
    ends = chained_ends(parts.where("kind = 2")).withColumnRenamed("ends", "found")
    whole_nodes = (
        nodes.drop("n_leaves", "saved_tokens").join(totals, "key").join(ends, "key", "left")
        .withColumn("ends", F.coalesce("found", "ends"))
        .join(names.withColumnRenamed("key", "up"), "up", "left")
    )
    # A whole node below an edge finds its parent's smallest member by its shard's own number of that edge.
    of_edge = edge.select("shard", "edge", "key").join(names, "key").drop("key").withColumnRenamed("parent_conv_id", "found")
    inner = parts.where("kind = 0").join(of_edge, ["shard", "edge"], "left")
    inner = inner.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "found"))
    return inner.select(*NODE), whole_nodes.select(*NODE)


def tries(stretches: DataFrame, *limits: int) -> DataFrame:
    """All nodes of the tries of stretches (top, stretch, ids, sizes, conv_id, below); ``limits`` as of ``shards``."""
    rows = stretches.select("top", "stretch", "ids", "sizes", "conv_id", F.col("below").cast(BELOW).alias("below"))
    # Equal sequences are apart by conv_id, so that many copies are spread too.
    rows = rows.repartitionByRange("top", "ids", "conv_id").sortWithinPartitions("top", "ids", "conv_id")
    inner, edge = merged(written(rows.mapInArrow(shards(*limits), SCHEMA), "trie-parts"))
    return inner.unionByName(edge)


def with_tops(stretches: DataFrame) -> DataFrame:
    """``top`` and ``next``: digests of all that comes before and up to the end of each stretch of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, top = None, b""
        for batch in batches:
            tops, nexts = [], []
            for conv_id, digest in zip(batch.column("conv_id").to_pylist(), batch.column("digest").to_pylist(), strict=True):
                top = top if conv_id == now else b""
                now = conv_id
                tops.append(top)
                top = hashlib.sha256(top + digest).digest()
                nexts.append(top)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("stretch"), pa.array(tops, pa.binary()), pa.array(nexts, pa.binary())],
                names=["conv_id", "stretch", "top", "next"],
            )

    long = stretches.where("NOT last OR stretch > 0")
    rows = long.select("conv_id", "stretch", F.unhex(F.sha2(F.array_join("ids", ","), 256)).alias("digest"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "stretch")
    tops = rows.mapInArrow(run, "conv_id long, stretch long, top binary, next binary")
    found = stretches.join(tops, ["conv_id", "stretch"], "left")
    return found.withColumn("top", F.coalesce("top", F.lit(b""))).withColumn("next", F.when(~F.col("last"), F.col("next")))


def totals_below(stretches: DataFrame, longest: int, *limits: int) -> DataFrame:
    """(next, below): what lies below the end of every stretch that another follows."""
    lower = stretches.where("stretch > 0")
    nothing = F.struct(F.lit(0).alias("children"), F.lit(0).alias("leaves"), F.lit(0).alias("saved"), F.lit(NONE).alias("ends"))
    tops = tries(lower.withColumn("below", F.when(F.col("next").isNotNull(), nothing)), *limits).where("local = 0")
    above = lower.where("next IS NOT NULL").select(F.col("next").alias("top"), F.col("top").alias("up")).distinct()
    tops = written(tops.join(above, "top", "left").select("top", "up", "n_children", "n_leaves", "saved_tokens", "ends"), "tops")
    reach = 1
    while reach < longest:  # each round doubles how far down a total reaches
        more = tops.where("up IS NOT NULL").groupBy(F.col("up").alias("top"))
        more = more.agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        higher = tops.select(F.col("top").alias("up"), F.col("up").alias("higher"))
        tops = written(
            tops.join(more, "top", "left").join(higher, "up", "left").select(
                "top", F.col("higher").alias("up"), "n_children", "ends",
                (F.col("n_leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
            ),
            "tops",
        )
        reach *= 2
    return tops.select(F.col("top").alias("next"), F.struct("n_children", "n_leaves", "saved_tokens", "ends").cast(BELOW).alias("below"))


def stretches_of(turns: DataFrame, convs: DataFrame, stretch: int) -> DataFrame:
    """(conv_id, stretch, ids, sizes, last) of conversations (conv_id, length) from turns (conv_id, pos, id, size)."""
    rows = turns.withColumn("stretch", F.expr(f"pos div {stretch}")).groupBy("conv_id", "stretch")
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("pos", "id", "size"))).alias("own"))
    # Conversations whose length is a whole number of stretches end in an empty one.
    empty = convs.where(F.col("length") % stretch == 0).select(
        "conv_id", F.expr(f"length div {stretch}").alias("stretch"), F.lit(None).cast("array<struct<pos:long,id:long,size:long>>").alias("own")
    )
    own = F.coalesce("own", F.array().cast("array<struct<pos:long,id:long,size:long>>"))
    return rows.unionByName(empty).select(
        "conv_id", "stretch", own["id"].alias("ids"), own["size"].alias("sizes"), (F.size(own) < stretch).alias("last")
    )


def prefix_trie(
    turns: DataFrame, convs: DataFrame, stretch: int = STRETCH, shard: int = SHARD, piece: int = PIECE
) -> DataFrame:
    """One row per node of the trie of ``convs`` (conv_id, length) with ``turns`` (conv_id, pos, id, size).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (summed sizes that the subtree's members share), ends_sha256.
    """
    small_batches(turns.sparkSession, 2000)
    limits = (stretch, shard, piece)
    rows = written(stretches_of(turns, convs, stretch), "stretches")
    longest = rows.agg(F.max("stretch")).first()[0] or 0
    rows = rows.withColumns({"top": F.lit(b""), "below": F.lit(None).cast(BELOW)})
    if longest:
        rows = written(with_tops(rows.drop("top", "below")), "stretch-tops")
        rows = rows.join(totals_below(rows, longest, *limits), "next", "left")
    nodes = tries(rows, *limits).where("local > 0 OR depth = 0")
    return nodes.drop("top", "local").withColumnRenamed("ends", "ends_sha256")


def encoded(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, n, id, size): every turn's place, its conversation's length, dictionary id and bytes of text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("key"),
        F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("row"),
    )
    turns = written(turns, "turns")
    distinct = turns.select(F.lit(0).alias("all"), "key").distinct()
    ids = numbered(distinct, "all", ["key"], "turn-ids").select("key", F.col("at").alias("id"))
    placed = numbered(turns, "conv_id", ["turn", "key", "row"], "sorted-turns")
    return placed.join(ids, "key").select("conv_id", "at", "n", "id", "size")


def shared_openings(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations that open with turns of the first one of their group of ``every``.

    Conversation c opens with the first h turns of c - c % every, h = crc32(c) % most, and
    goes on with its own turns after its first h.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    lengths = turns.where("at = 0").select("conv_id", "n", base.alias("base"), h.alias("h"))
    lengths = lengths.join(lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("of_base")), "base", "left")
    opening = F.least("h", F.coalesce("of_base", F.lit(0)))
    convs = lengths.select(
        "conv_id", "base", "h", opening.alias("opening"), (opening + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")
    )
    convs = written(convs, "openings")
    own = turns.join(convs, "conv_id").where("at >= h").withColumn("pos", F.col("opening") + F.col("at") - F.col("h"))
    first = turns.where((F.col("at") < most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")
    first = first.join(convs, "base").where("at < h").withColumn("pos", F.col("at"))
    columns = ["conv_id", "pos", "id", "size"]
    return own.select(columns).unionByName(first.select(columns)), convs.select("conv_id", "length")


SQL = f"""
WITH RECURSIVE o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql("conv_id::VARCHAR")} % 9 AS h FROM o),
t AS (
  SELECT c.conv_id, place, role, text FROM c JOIN o ON o.conv_id = c.base AND place < h
  UNION ALL SELECT c.conv_id, place, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND place >= h),
p AS (
  SELECT conv_id, strlen(text) AS bytes, row_number() OVER w AS depth,
    sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (w ROWS UNBOUNDED PRECEDING)) AS id
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(depth) AS last FROM p GROUP BY 1),
up AS (SELECT a.id, any_value(b.id) AS above FROM p a JOIN p b ON b.conv_id = a.conv_id AND b.depth = a.depth - 1 GROUP BY 1),
n AS (
  SELECT id, any_value(above) AS above, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = last), '')) AS ends_sha256
  FROM p JOIN l USING (conv_id) LEFT JOIN up USING (id) GROUP BY id, depth),
k AS (SELECT above AS id, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (id)),
r(id, own, leaf, saved) AS (
  SELECT id, id, CAST(n_children = 0 AS INT), (n_convs - 1) * bytes FROM m
  UNION ALL SELECT up.above, own, leaf, saved FROM r JOIN up USING (id)),
s AS (SELECT id, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM r GROUP BY 1)
SELECT m.conv_id, m.depth, a.conv_id AS parent_conv_id, m.n_convs, m.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN s USING (id) LEFT JOIN m a ON a.id = m.above
"""


@query("op12_conversation_prefix_trie", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = written(encoded(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), "encoded-turns")
    return prefix_trie(*shared_openings(turns))
