"""The trie of all prefixes of conversations, with totals of every subtree.

A node is a distinct sequence of first turns, known by a digest chained over them.  Totals
go from the leaves to the root by time-forward processing: nodes are sorted by falling depth
(an external sort), and each adds what a priority queue holds for it to its own values and
puts the sum into the queue for its parent.  The queue keeps a bounded number of messages
in memory and spills the rest in sorted runs.

Shards are whole subtrees of a bounded number of turns: the subtrees below the nodes that
have more.  What their roots pass on is summed per parent by Spark, and the nodes above are
treated in the same way with a greater bound, until the root is reached.  No task sees more
than one bound's worth of turns below a node, however many conversations share it.

Odd input: rows without a conversation are left out; a null role or text is empty; turns of
equal number come in the order of the digest of role and text; repeated rows are turns of
their own; texts count whole; an empty table gives no nodes.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

# Turns below a node that meet in one shard, and how much the bound grows a round.
SHARD_TURNS = 100_000
GROWTH = 64
# Messages the queue keeps in memory.
QUEUE = 200_000
# Ids of a node's conversations are joined in ranges of so many bits.
_RANGE_BITS = 16
_FAMILY = 100
_SHARES = 6
_ROOT = bytes(16)


# -- rebuilt conversations ---------------------------------------------------------


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, key, chars, size) of every turn, and of depth 0, of the rebuilt conversations.

    With h the crc32 of the id as text modulo 6, conversation c starts with the first h
    turns of c - c % 100 and goes on with its own after its first h.  ``key`` is a digest
    of role and text, ``size`` the number of turns.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % _FAMILY).alias("family"),
        "turn",
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("key"),
        F.length(text).cast("long").alias("chars"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % _SHARES).cast("int").alias("shared"),
    )
    own = Window.partitionBy("family", "conv_id")
    turns = turns.repartition("family").select(
        "*",
        F.row_number().over(own.orderBy(F.col("turn").asc_nulls_first(), "key")).alias("place"),
        F.count(F.lit(1)).over(own).alias("turns"),
    )
    first = turns.filter(f"conv_id = family AND place < {_SHARES}")
    # at most five turns a family
    heads = first.groupBy("family").agg(F.sort_array(F.collect_list(F.struct("place", "key", "chars"))).alias("heads"))
    rows = turns.join(heads, "family", "left").withColumn(
        "head", F.slice(F.coalesce("heads", F.array().cast("array<struct<place:int,key:binary,chars:bigint>>")), F.lit(1), F.col("shared"))
    )
    size = (F.size("head") + F.greatest(F.col("turns") - F.col("shared"), F.lit(0))).cast("long")
    start = F.array(F.struct(F.lit(0).alias("place"), F.lit(b"").alias("key"), F.lit(0).cast("long").alias("chars")))
    none = F.array().cast("array<struct<place:int,key:binary,chars:bigint>>")
    tail = F.array(F.struct((F.size("head") + F.col("place") - F.col("shared")).alias("place"), "key", "chars"))
    made = F.concat(
        F.when(F.col("place") == 1, F.concat(start, "head")).otherwise(none),
        F.when(F.col("place") > F.col("shared"), tail).otherwise(none),
    )
    return rows.select("conv_id", size.alias("size"), F.inline(made)).withColumnRenamed("place", "depth")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the digests of all turns up to each, and up to the one before, to turns in order."""
    node = parent = None
    for batch in batches:
        nodes, parents = [], []
        for depth, key in zip(batch.column("depth").to_pylist(), batch.column("key").to_pylist()):
            if depth == 0:
                node, parent = _ROOT, None
            else:
                node, parent = hashlib.sha256(node + key).digest()[:16], node
            nodes.append(node)
            parents.append(parent)
        kept = [batch.column(c) for c in ("conv_id", "depth", "chars", "size")]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(nodes, pa.binary()), pa.array(parents, pa.binary())],
            names=["conv_id", "depth", "chars", "size", "node", "parent"],
        )


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, chars, size, node, parent): the node of every turn of every conversation.

    A conversation is read in order by one task, a batch at a time.
    """
    turns = turns.select("conv_id", "depth", "chars", "size", "key")
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "depth")
    return ordered.mapInArrow(_chained, "conv_id bigint, depth int, chars bigint, size bigint, node binary, parent binary")


# -- totals --------------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples of which a bounded number is in memory."""

    def __init__(self, limit: int = QUEUE):
        self.limit = max(1, limit)
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # first entry of each spilled run, with the rest of it

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.limit:
            file = tempfile.TemporaryFile()
            self.heap.sort()
            for at in range(0, len(self.heap), 4096):
                pickle.dump(self.heap[at : at + 4096], file)
            file.seek(0)
            self.heap = []
            self._advance(_entries(file), len(self.heads))

    def _advance(self, run: Iterator[tuple], number: int) -> None:
        entry = next(run, None)
        if entry is not None:
            heapq.heappush(self.heads, (entry, id(run), number, run))

    def peek(self) -> tuple | None:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            return self.heads[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.heads and (not self.heap or self.heads[0][0] < self.heap[0]):
            entry, _, number, run = heapq.heappop(self.heads)
            self._advance(run, number)
            return entry
        return heapq.heappop(self.heap)


def _entries(file) -> Iterator[tuple]:
    with file:
        while True:
            try:
                yield from pickle.load(file)
            except EOFError:
                return


_NODE = "node binary, parent binary, depth int, conv_id bigint, n_convs bigint, chars bigint, top boolean"
_TOTALS = "n_children bigint, n_leaves bigint, saved_tokens bigint"


def forward(limit: int = QUEUE):
    """A function that adds totals to nodes sorted by falling depth, then node.

    What comes in holds what roots of lower shards passed on; a node marked ``top`` passes
    nothing on, as its parent lies elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        for batch in batches:
            given = [batch.column(n).to_pylist() for n in ("node", "parent", "depth", "n_convs", "chars", "top")]
            sums = [batch.column(n).to_pylist() for n in ("n_children", "n_leaves", "saved_tokens")]
            out: tuple[list, list, list] = ([], [], [])
            for node, parent, depth, n_convs, chars, top, children, leaves, saved in zip(*given, *sums):
                while (head := queue.peek()) is not None and head[:2] == (-depth, node):
                    message = queue.pop()
                    children, leaves, saved = children + 1, leaves + message[2], saved + message[3]
                leaves = leaves if children else 1
                saved += (n_convs - 1) * chars
                if not top:
                    queue.push((1 - depth, parent, leaves, saved))
                for column, value in zip(out, (children, leaves, saved)):
                    column.append(value)
            kept = [batch.column(k) for k in range(7)]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, pa.int64()) for c in out)], names=batch.schema.names)

    return run


def totals(steps: DataFrame, nodes: DataFrame, shard_turns: int = SHARD_TURNS, queue: int = QUEUE) -> DataFrame:
    """The nodes with the number of children, leaves below and saved tokens."""
    most = nodes.agg(F.max("turns").alias("most")).first()["most"]
    lower, bound, done = 0, shard_turns, []
    while not done or lower < most:
        part = nodes.filter((F.col("turns") > lower) & (F.col("turns") <= bound))
        if most is None or most <= bound:
            part = part.withColumn("shard", F.lit(_ROOT)).withColumn("top", F.col("parent").isNull())
        else:
            # nodes with more turns form the upper part of the trie; below it each path has a first node
            upper = nodes.filter(F.col("turns") > bound).select("node")
            cut = steps.join(upper, "node").groupBy("conv_id").agg((F.max("depth") + 1).alias("depth"))
            roots = steps.join(cut, ["conv_id", "depth"]).select("conv_id", F.col("node").alias("shard"))
            part = part.join(roots, "conv_id").withColumn("top", F.col("node") == F.col("shard"))
        zero = F.lit(0).cast("long")
        if done:
            passed = reduce(DataFrame.unionAll, done).filter("top AND parent IS NOT NULL")
            passed = passed.groupBy(F.col("parent").alias("node")).agg(
                F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
            )
            part = part.join(passed, "node", "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"])
        else:
            part = part.withColumns({"n_children": zero, "n_leaves": zero, "saved_tokens": zero})
        rows = part.select(
            "node", "parent", "depth", "conv_id", "n_convs", "chars", "top", "n_children", "n_leaves", "saved_tokens", "shard"
        )
        rows = rows.repartition("shard").sortWithinPartitions(F.desc("depth"), "node").drop("shard")
        done.append(stored(rows.mapInArrow(forward(queue), f"{_NODE}, {_TOTALS}"), "totals"))
        lower, bound = bound, bound * GROWTH
        if most is None:
            break
    return reduce(DataFrame.unionAll, done)


def _list_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of its lists in order, joined by commas."""
    now, digest = None, hashlib.sha256()
    for batch in batches:
        nodes, digests = [], []
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != now:
                if now is not None:
                    nodes.append(now)
                    digests.append(digest.hexdigest())
                now, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
    if now is not None:
        yield pa.RecordBatch.from_pydict({"node": pa.array([now], pa.binary()), "ends_sha256": [digest.hexdigest()]})


def end_digests(steps: DataFrame) -> DataFrame:
    """Digest of the ids of the conversations that end at each node, ascending, joined by commas.

    Ids are joined in ranges first; the digest then reads a node's ranges one by one.
    """
    ends = steps.filter("depth = size").groupBy("node", F.shiftright("conv_id", _RANGE_BITS).alias("range"))
    # at most 2^16 ids a range
    lists = ends.agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ordered = lists.repartition("node").sortWithinPartitions("node", "range").select("node", "ids")
    return ordered.mapInArrow(_list_digests, "node binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, shard_turns: int = SHARD_TURNS, queue: int = QUEUE) -> DataFrame:
    """One row per node of the trie of the turns (conv_id, depth, key, chars, size).

    ``depth`` counts from 1; every conversation also has a row of depth 0 without text.
    """
    steps = stored(paths(turns), "paths")
    nodes = steps.groupBy("node").agg(
        F.first("parent").alias("parent"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("chars").alias("chars"),
        F.sum(F.col("size") - F.col("depth") + 1).alias("turns"),
    )
    found = totals(steps, stored(nodes, "nodes"), shard_turns, queue)
    above = found.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = found.join(end_digests(steps), "node", "left").join(above, "parent", "left")
    return found.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


ORACLE = """
WITH RECURSIVE ids AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS digits FROM conversations WHERE conv_id IS NOT NULL
), crc(conv_id, digits, bits, value) AS (
  SELECT conv_id, digits, 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT conv_id, digits, bits + 1, xor(mixed >> 1, (mixed & 1) * 3988292384) FROM (
    SELECT conv_id, digits, bits,
      CASE WHEN bits % 8 = 0 THEN xor(value, CAST(ascii(substr(digits, bits // 8 + 1, 1)) AS BIGINT)) ELSE value END AS mixed
    FROM crc WHERE bits < 8 * length(digits))
), shares AS (
  SELECT conv_id, xor(value, 4294967295) % 6 AS h FROM crc WHERE bits = 8 * length(digits)
), turns AS (
  SELECT conv_id, key, chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS place FROM (
    SELECT conv_id, turn, length(coalesce(text, '')) AS chars,
      sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
    FROM conversations WHERE conv_id IS NOT NULL)
), rebuilt AS (
  SELECT s.conv_id, t.place, t.key, t.chars, 0 AS part
  FROM shares s JOIN turns t ON t.conv_id = s.conv_id - s.conv_id % 100 AND t.place <= s.h
  UNION ALL
  SELECT s.conv_id, t.place, t.key, t.chars, 1 FROM shares s JOIN turns t ON t.conv_id = s.conv_id AND t.place > s.h
  UNION ALL
  SELECT conv_id, 0, '', 0, -1 FROM shares
), steps AS (
  SELECT conv_id, chars, row_number() OVER w - 1 AS depth, string_agg(key, '') OVER w AS path,
    count(*) OVER (PARTITION BY conv_id) - 1 AS size
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)
), nodes AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = size), '')) AS ends_sha256
  FROM steps GROUP BY path
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.path AS above
  FROM nodes n LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))
), children AS (
  SELECT above AS path, count(*) AS n_children FROM linked WHERE above IS NOT NULL GROUP BY above
), counted AS (
  SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c USING (path)
), pairs AS (
  SELECT DISTINCT a.path AS path, b.path AS below FROM steps a JOIN steps b ON a.conv_id = b.conv_id AND b.depth >= a.depth
)
SELECT n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children,
  CAST(count(*) FILTER (WHERE b.n_children = 0) AS BIGINT) AS n_leaves,
  CAST(sum((b.n_convs - 1) * b.chars) AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN pairs p ON p.path = n.path JOIN counted b ON b.path = p.below
GROUP BY n.path, n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, n.ends_sha256
"""
