"""Near-duplicate documents: minhash, banding, verification, connected components.

Two documents are linked if their sets of distinct five-word shingles have a Jaccard
similarity of 0.75 or more.

1. One pass over the texts gives each set's size, digest and 128 universal hash minima.
2. Equal sets are one node from here on, so copies never meet as pairs.
3. 32 bands of 4 minima are the buckets.  Rows are range-sorted by bucket and, within it, by
   the bands that follow.  A bucket of up to ``SMALL`` rows gives all its pairs; in a larger
   one each row is paired with the row before it and the first, and the bucket's rows are
   kept for step 5.  So the pairs are linear in the rows, whatever the size of a group.
4. Pairs are checked on sketches of the minima, then on the full sets: first the most
   similar partner of each node, then every pair that still joins two components.
5. In large buckets that span several components all rows of different components that
   fit by size are compared, block by block: the largest component with the rest, and the
   rest with itself; on their sketches, and those that may have a partner on their full
   sets, whose shared shingles are counted by products of matrices.  A block sends only
   links that join components, at most one a row, so no pair is left out and none is
   written that changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from tidemark.llm import kernels
from tidemark.llm.batches import annotate
from tidemark.llm.components import components
from tidemark.llm.storage import stored

SHINGLE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
PERCENT = 75
SMALL = 24  # rows of a bucket that are paired in full
# Rows and shingles of a slice of a large bucket; blocks are pairs of slices.
SKETCHES, TEXTS, SHINGLES = 1024, 256, 1 << 20
COLUMNS = 4096  # shingles counted at a time
# Sketches are compared byte by byte; 0.75 - 4 standard deviations of 128 draws.
LEAST_ESTIMATE = 0.597
SURE = 0.85
MEMBERS = 256  # of one first text, per group of the verification
_PIECE = 1 << 18

_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _sets(texts: pa.Array, powers: kernels.Powers) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingles of some texts, shingles before each text)."""
    for a, _, data, offsets in kernels.pieces(texts, _PIECE):
        hashes, before = kernels.word_hashes(data, offsets, powers)
        found, cuts = kernels.shingles(hashes, before, SHINGLE)
        owner = kernels.rows_of(cuts)
        order = np.lexsort((found, owner))
        found = found[order]
        fresh = np.ones(len(found), dtype=bool)
        fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
        kept = np.flatnonzero(fresh)
        yield a, found[kept], np.searchsorted(kept, cuts)


def _signatures(texts: pa.Array, powers: kernels.Powers) -> list[pa.Array]:
    n = len(texts)
    size, one, two = (np.zeros(n, dtype=np.int64) for _ in range(3))
    sketch: list[bytes | None] = [None] * n
    bands: list[np.ndarray | None] = [None] * n
    for a, shingles, cuts in _sets(texts, powers):
        counts = np.diff(cuts)
        full = np.flatnonzero(counts)
        size[a : a + len(counts)] = counts
        if not len(full):
            continue
        starts = cuts[full]
        one[a + full] = np.add.reduceat(kernels.mix(shingles), starts).view(np.int64)
        two[a + full] = np.add.reduceat(kernels.mix(shingles ^ _B[0]), starts).view(np.int64)
        minima = np.empty((len(full), HASHES), dtype=np.uint32)
        for k in range(HASHES):
            drawn = ((shingles * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32)
            minima[:, k] = np.minimum.reduceat(drawn, starts)
        key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None, :], len(full), axis=0)
        for r in range(ROWS):
            key = kernels.mix(key * np.uint64(0x9FB21C651E98DF25) + minima[:, r::ROWS])
        low = minima.astype(np.uint8)
        for i, row in enumerate(full):
            sketch[a + row] = low[i].tobytes()
            bands[a + row] = key[i].view(np.int64)
    return [pa.array(size), pa.array(one), pa.array(two), pa.array(sketch, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]


def signatures(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc_id, n_shingles, one, two, sketch, bands); no sketch and bands for an empty set."""
    fields = [
        StructField("n_shingles", LongType()),
        StructField("one", LongType()),
        StructField("two", LongType()),
        StructField("sketch", BinaryType()),
        StructField("bands", ArrayType(LongType())),
    ]

    def make():
        powers = kernels.Powers()
        return lambda texts: _signatures(texts, powers)

    return annotate(docs, "text", make, fields, keep)


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal keys; of at least one row."""
    edge = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).tolist()
    return list(zip(edge[:-1], edge[1:]))


def _pair_rows(key: list[int], a: list[int], b: list[int]) -> pa.RecordBatch:
    arrays = [pa.array(x, pa.int64()) for x in (key, a, b)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "a", "b"])


def _pair_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (null, a, b) within runs of the sorted rows (key, node), and rows (key, node, null) of large runs.

    The first and the last run of a task may go on in another one, so they count as large.
    """
    now: int | None = None
    held: list[int] = []  # rows of the run so far; its first and last ones once it is large
    large, edge = False, True
    key: list[int] = []
    left: list[int] = []
    right: list[int] = []

    def pair(a: int, b: int) -> None:
        if a != b:
            key.append(None)
            left.append(min(a, b))
            right.append(max(a, b))

    def keep(node: int) -> None:
        key.append(now)
        left.append(node)
        right.append(None)

    def close() -> None:
        if not large:
            for i, b in enumerate(held):
                for a in held[:i]:
                    pair(a, b)
                if edge:
                    keep(b)

    for batch in batches:
        keys, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for start, end in _runs(keys) if len(keys) else ():
            if int(keys[start]) != now:
                if now is not None:
                    close()
                    edge = False
                now, held, large = int(keys[start]), [], False
                if end - start == 1 and end < len(keys) and not edge:
                    continue  # alone in its bucket
            for node in nodes[start:end].tolist():
                if not large and len(held) == SMALL:
                    large = True
                    for i, own in enumerate(held):
                        keep(own)
                        if i:
                            pair(held[0], own)
                            pair(held[i - 1], own)
                if large:
                    keep(node)
                    pair(held[0], node)
                    pair(held[-1], node)
                    held = [held[0], node]
                else:
                    held.append(node)
        yield _pair_rows(key, left, right)
        key.clear(), left.clear(), right.clear()
    edge = True
    close()
    yield _pair_rows(key, left, right)


def _bucket_rows(nodes: DataFrame) -> DataFrame:
    """(key, node) of all bands, sorted by bucket and by bits of the four bands that come next."""
    exploded = nodes.select("node", "bands", F.posexplode("bands").alias("band", "key"))
    rows = exploded.select("key", _label(F.col("band"), 1).alias("label"), "node")
    return rows.repartitionByRange("key", "label").sortWithinPartitions("key", "label", "node").select("key", "node")


def _label(band, step: int):
    label = F.lit(0).cast("long")
    for k in range(1, 5):
        bits = F.get("bands", F.pmod(band + k * step, F.lit(BANDS))).bitwiseAND(F.lit(0xFFFF))
        label = F.shiftleft(label, 16).bitwiseOR(bits)
    return label


def _mixed(large: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (key, node, component) of buckets of several components; of buckets of the same rows only one."""
    rows = large.join(labels.select("node", "component"), "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    buckets = rows.groupBy("key").agg(
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"),
    )
    once = buckets.filter("lo <> hi").groupBy("n", "one", "two").agg(F.min("key").alias("key"))
    return rows.join(once.select("key"), "key", "left_semi").select("key", "node", "component")


def _cells(rows: DataFrame) -> DataFrame:
    """Rows with ``side`` and ``cell``: any two of a bucket that fit by size share a cell, one of them on side 0.

    Sizes of linked sets lie in the same or in neighbouring classes.  A cell holds a class
    (side 0) and the one above it (side 1); a bucket whose sizes all fit is one cell.
    """
    size = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(math.log(1.34)))  # a little above 4 / 3
    sizes = rows.groupBy("key").agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"))
    even = F.col("least") * 100 >= F.col("most") * PERCENT
    sides = F.when(F.col("even"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    both = rows.join(sizes.select("key", even.alias("even")), "key").withColumn("side", F.explode(sides))
    cell = F.when(F.col("even"), F.xxhash64("key", F.lit("even"))).otherwise(F.xxhash64("key", size - F.col("side")))
    return both.withColumn("cell", cell).drop("even")


def _blocks(rows: DataFrame, most_rows: int, most_shingles: int | None = None) -> DataFrame:
    """Rows (block, part, side, key, node, component, n_shingles): any two of different components of a cell share a block.

    The largest component of a cell and the rest are cut into slices.  A block holds a slice
    of the largest and one of the rest, or two of the rest (parts 0 and 1), or one of the
    rest (part 2); small cells are one block.  So a component is not compared with itself
    where it is large, and what is sent grows with the rows beside it.
    """

    def groups(n: str, shingles: str):
        found = F.ceil(F.col(n) / most_rows)
        found = F.greatest(found, F.ceil(F.col(shingles) / most_shingles)) if most_shingles else found
        return F.greatest(found, F.lit(1)).cast("int")

    both = _cells(rows)
    parts = both.groupBy("cell", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"), F.min("side").alias("first")
    )
    cells = parts.groupBy("cell").agg(
        F.max(F.struct("n", "component", "shingles")).alias("large"),
        F.sum("n").alias("all"),
        F.sum("shingles").alias("all_shingles"),
        F.min("first").alias("first"),
        F.count(F.lit(1)).alias("components"),
    )
    cells = cells.filter("first = 0 AND components > 1").select(
        "cell",
        F.col("large.component").alias("largest"),
        F.col("large.n").alias("n"),
        F.col("large.shingles").alias("shingles"),
        (F.col("all") - F.col("large.n")).alias("rest"),
        (F.col("all_shingles") - F.col("large.shingles")).alias("rest_shingles"),
        "all",
        "all_shingles",
    )
    cells = cells.select(
        "cell",
        "largest",
        (groups("all", "all_shingles") == 1).alias("one"),
        groups("n", "shingles").alias("slices"),
        groups("rest", "rest_shingles").alias("others"),
    )
    dealt = both.join(cells, "cell").withColumn("own", F.col("component") == F.col("largest"))
    count = F.when(F.col("own"), F.col("slices")).otherwise(F.col("others"))
    dealt = dealt.withColumn("slice", F.pmod(F.xxhash64("node"), count).cast("int"))

    def place(kind: int, low, high, part):
        return F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"), part.alias("part"))

    own, zero = F.col("slice"), F.lit(0)
    largest = F.transform(F.sequence(zero, F.col("others") - 1), lambda k: place(0, own, k, zero))
    beside = F.transform(F.sequence(zero, F.col("slices") - 1), lambda k: place(0, k, own, F.lit(1)))
    among = F.transform(
        F.sequence(zero, F.col("others") - 1),
        lambda k: place(1, F.least(own, k), F.greatest(own, k), F.when(own < k, 0).when(own > k, 1).otherwise(2)),
    )
    places = F.when(F.col("one"), F.array(place(2, zero, zero, F.lit(2)))).when(F.col("own"), largest).otherwise(F.concat(beside, among))
    dealt = dealt.withColumn("place", F.explode(places))
    return dealt.select(
        F.xxhash64("cell", "place.kind", "place.low", "place.high").alias("block"),
        F.col("place.part").alias("part"),
        "side",
        "key",
        "node",
        "component",
        "n_shingles",
    )


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after the other, from rows sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0).to_numpy()
        for start, end in _runs(keys) if len(keys) else ():
            if held and held[0].column(0)[0].as_py() != keys[start]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _sides(block: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows to compare with which rows, and which of these pairs fit by class, component and size."""
    part, side, component, size = (block.column(c).to_numpy() for c in ("part", "side", "component", "n_shingles"))
    a, b = np.flatnonzero(part != 1), np.flatnonzero(part != 0)
    fits = (side[a][:, None] + side[b] < 2) & (component[a][:, None] != component[b])
    fits &= 100 * np.minimum(size[a][:, None], size[b]) >= PERCENT * np.maximum(size[a][:, None], size[b])
    return a, b, fits


def _near_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) of the rows of a block whose sketch allows a link with another one."""
    for block in _block_rows(batches):
        a, b, fits = _sides(block)
        if not fits.any():
            continue
        joined = b"".join(block.column("sketch").to_pylist())
        sketches = np.ascontiguousarray(np.frombuffer(joined, dtype=np.uint8).reshape(-1, HASHES).T)
        alive = np.zeros(block.num_rows, dtype=bool)
        for at in range(0, len(a), 128):
            own = a[at : at + 128]
            alike = np.zeros((len(own), len(b)), dtype=np.uint8)
            for column in sketches:
                alike += column[own][:, None] == column[b]
            near = fits[at : at + 128] & (alike >= LEAST_ESTIMATE * HASHES)
            alive[own[near.any(axis=1)]] = True
            alive[b[near.any(axis=0)]] = True
        kept = block.select(["key", "node"]).filter(pa.array(alive)).combine_chunks()
        yield from kept.to_batches()


def _shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of elements that each set of ``a`` shares with each of ``b``."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = times > 1
    column = np.cumsum(several) - 1
    kept = several[place]
    owner, place = owner[kept], column[place[kept]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(a), len(b)), dtype=np.float32)  # exact below 2 ** 24
    for at in range(0, int(several.sum()), COLUMNS):
        lo, hi = np.searchsorted(place, [at, at + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        held[owner[lo:hi], place[lo:hi] - at] = 1
        out += held[a] @ held[b].T
    return out.astype(np.int64)


def _exact_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of a block that join components, one for each pair of components that come together."""
    powers = kernels.Powers()
    for block in _block_rows(batches):
        a, b, fits = _sides(block)
        if not fits.any():
            continue
        sets: list[np.ndarray] = []
        for _, found, cuts in _sets(block.column("text").combine_chunks(), powers):
            sets.extend(found[cuts[i] : cuts[i + 1]] for i in range(len(cuts) - 1))
        shared, sizes = _shared(sets, a, b), np.array([len(x) for x in sets])
        linked = fits & (100 * shared >= PERCENT * (sizes[a][:, None] + sizes[b] - shared))
        node, component = block.column("node").to_pylist(), block.column("component").to_pylist()
        parent = {c: c for c in component}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c

        u, v = [], []
        for i, k in zip(*(x.tolist() for x in np.nonzero(linked))):
            one, two = root(component[a[i]]), root(component[b[k]])
            if one != two:
                parent[one] = two
                u.append(node[a[i]])
                v.append(node[b[k]])
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _links_in_large(large: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) between components, from all pairs of rows (key, node) of large buckets."""
    rows = _mixed(large, labels).join(nodes.select("node", "n_shingles"), "node")
    rows = stored(rows.select("key", "node", "component", "n_shingles"), "mixed")
    blocks = _blocks(rows, SKETCHES).join(nodes.select("node", "sketch"), "node")
    blocks = blocks.select("block", "part", "side", "key", "node", "component", "n_shingles", "sketch")
    blocks = blocks.repartition("block").sortWithinPartitions("block", "node")
    near = stored(blocks.mapInArrow(_near_task, "key long, node long").distinct(), "near")
    rows = rows.join(near, ["key", "node"], "left_semi")
    blocks = _blocks(rows, TEXTS, SHINGLES).join(texts, "node")
    blocks = blocks.select("block", "part", "side", "node", "component", "n_shingles", "text")
    blocks = blocks.repartition("block").sortWithinPartitions("block", "node")
    return blocks.mapInArrow(_exact_task, "u long, v long")


def _estimate_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sketches = []
        for column in (batch.column(2), batch.column(3)):
            sketches.append(np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, HASHES))
        alike = (sketches[0] == sketches[1]).mean(axis=1)
        good = np.flatnonzero(alike >= LEAST_ESTIMATE)
        taken = [batch.column(k).take(pa.array(good)) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*taken, pa.array(alike[good])], names=["a", "b", "alike"])


def _plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches allow a link, with the sketches' estimate."""
    a = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("n_shingles").alias("na"))
    b = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"), F.col("n_shingles").alias("nb"))
    sized = pairs.join(a, "a").join(b, "b").filter(f"100 * least(na, nb) >= {PERCENT} * greatest(na, nb)")
    return sized.select("a", "b", "sa", "sb").mapInArrow(_estimate_task, "a long, b long, alike double")


def _verify_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among rows (a, salt, b, text) sorted so that each first text (b null) leads its group."""
    powers = kernels.Powers()
    group, held = None, np.zeros(0, dtype=np.uint64)
    for batch in batches:
        a_out, b_out = [], []
        a, salt, b = (batch.column(k).to_pylist() for k in range(3))
        for start, found, cuts in _sets(batch.column(3), powers):
            for i in range(len(cuts) - 1):
                row, own = start + i, found[cuts[i] : cuts[i + 1]]
                if b[row] is None:
                    group, held = (a[row], salt[row]), own.copy()
                elif group == (a[row], salt[row]):
                    place = np.minimum(np.searchsorted(held, own), len(held) - 1)
                    shared = int((held[place] == own).sum()) if len(held) else 0
                    if 100 * shared >= PERCENT * (len(own) + len(held) - shared):
                        a_out.append(a[row])
                        b_out.append(b[row])
        yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["u", "v"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough.

    The text of ``a`` leads a group of up to about ``MEMBERS`` partners; a node with more
    partners leads several groups, dealt by a hash of the partner.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("groups"))
    salted = pairs.join(groups, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("salt"), "b"
    )
    second = salted.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "salt", "b", "text")
    first = groups.join(texts.select(F.col("node").alias("a"), "text"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"), "text"
    )
    rows = first.unionAll(second).repartition("a", "salt")
    ordered = rows.sortWithinPartitions(F.col("a"), F.col("salt"), F.col("b").asc_nulls_first())
    return ordered.mapInArrow(_verify_task, "u long, v long")


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes lie in different components."""
    at = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    to = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    both = pairs.join(at, "a", "left").join(to, "b", "left")
    return both.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


_DIGEST = ("n_shingles", "one", "two")


def _first_texts(marked: DataFrame) -> DataFrame:
    """(doc_id, first) of ids that occur with different sets: the first set by size and digest."""
    own = F.struct(*_DIGEST)
    ids = marked.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(own).alias("first"), F.max(own).alias("last"))
    return stored(ids.filter("first <> last").select("doc_id", "first"), "first-texts")


def _node_texts(docs: DataFrame, pairs: DataFrame, large: DataFrame, first: DataFrame | None) -> DataFrame:
    """Texts of the nodes that occur in pairs or in large buckets: all that may be compared."""
    ids = [pairs.select(F.col(c).alias("doc_id")) for c in ("a", "b")]
    wanted = ids[0].unionAll(ids[1]).unionAll(large.select(F.col("node").alias("doc_id"))).distinct()
    # Always by shuffle, so that the plan is the same at every size.
    found = docs.select("doc_id", "text").join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    if first is not None:
        several = found.join(first, "doc_id", "left_semi").withColumnRenamed("text", "own")
        several = signatures(several.withColumn("text", F.col("own")), ("doc_id", "own")).join(first, "doc_id")
        several = several.filter(F.struct(*_DIGEST) == F.col("first")).select("doc_id", F.col("own").alias("text"))
        found = found.join(first, "doc_id", "left_anti").unionByName(several)
    # texts of one id have one set by now
    return found.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), "text")


def links(docs: DataFrame, nodes: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """(node, component) of the nodes that have a link.

    ``nodes``: (node, n_shingles, sketch, bands), one row per distinct set.  ``first`` names
    the set that counts for ids with texts of several sets.
    """
    found = stored(_bucket_rows(nodes).mapInArrow(_pair_task, "key long, a long, b long"), "pairs")
    large = found.filter("b IS NULL").select("key", F.col("a").alias("node"))
    pairs = _plausible(found.filter("b IS NOT NULL").select("a", "b").distinct(), nodes)
    pairs = stored(pairs, "plausible")
    texts = stored(_node_texts(docs, pairs, large, first), "texts")
    # Of partners that are all very similar the smallest, so that dense groups are stars at once.
    order = F.struct(F.least("alike", F.lit(SURE)), -F.col("a"))
    nearest = pairs.groupBy("b").agg(F.max_by("a", order).alias("a")).select("a", "b")
    labels = components(_verified(nearest, texts))
    labels = _joined(labels, _verified(_across(pairs, labels), texts))
    return _joined(labels, _links_in_large(large, labels, nodes, texts))


def _joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after further links; the same object if there are none."""
    edges = stored(edges, "links")
    if edges.isEmpty():
        return labels
    u = labels.select(F.col("node").alias("u"), F.col("component").alias("cu"))
    v = labels.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    raised = edges.join(u, "u", "left").join(v, "v", "left")
    merged = components(raised.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
    new = merged.select(F.col("node").alias("component"), F.col("component").alias("final"))
    moved = labels.join(new, "component", "left").select("node", F.coalesce("final", "component").alias("component"))
    # nodes that had no link before are components of themselves
    fresh = merged.join(labels.select("node"), "node", "left_anti")
    return stored(moved.unionByName(fresh.select("node", "component")), "labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    ``doc_id`` must be an integer; rows of one id are one document, its first text by size
    of set and digest being looked at.  A null or empty text and one without words has an
    empty set and is linked with nothing; so is a row without id, whose component is null
    and which is kept.  ``component_id`` is the smallest id reachable over links, ``kept``
    marks that document.
    """
    marked = stored(signatures(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")), "signatures")
    first = _first_texts(marked)
    if first.isEmpty():
        first = None
    else:
        several = marked.join(first, "doc_id")
        known = several.filter(F.struct(*_DIGEST) == F.col("first")).dropDuplicates(["doc_id"])
        again = several.select("doc_id").join(known, "doc_id").select(*marked.columns)
        marked = stored(marked.join(first, "doc_id", "left_anti").unionByName(again), "signatures")
    filled = marked.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = filled.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("node"))
    sets = stored(sets, "sets")
    nodes = sets.select("node", "one", "two").join(
        filled.select(F.col("doc_id").alias("node"), "one", "two", "n_shingles", "sketch", "bands"),
        ["node", "one", "two"],
    )
    nodes = nodes.dropDuplicates(["node"]).select("node", "n_shingles", "sketch", "bands")
    labels = links(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), stored(nodes, "nodes"), first)
    component = sets.join(labels, "node", "left").select(
        "one", "two", F.col("n_shingles").alias("n"), F.coalesce("component", "node").alias("component_id")
    )
    rows = marked.select("doc_id", "n_shingles", "one", "two")
    joined = rows.filter("n_shingles > 0").join(
        component.withColumnsRenamed({"one": "first", "two": "second"}),
        (F.col("n_shingles") == F.col("n")) & (F.col("one") == F.col("first")) & (F.col("two") == F.col("second")),
        "left",
    )
    # empty sets are no key of the join, however many there are
    empty = rows.filter("n_shingles = 0").withColumn("component_id", F.lit(None).cast("long"))
    joined = joined.select("doc_id", "n_shingles", "component_id").unionByName(empty.select("doc_id", "n_shingles", "component_id"))
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce(own, F.col("doc_id")))
    return joined.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept")
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one of the smallest id.

    Of rows that share an id the one of the first text in order stays; rows without id stay.
    """
    found = near_duplicates(docs).select("doc_id", "kept")
    gone = found.filter("NOT kept").select("doc_id").distinct()
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = stored(repeated, "repeated")
    if repeated.isEmpty():
        return rest
    marked = rest.join(repeated.withColumn("__again", F.lit(True)), "doc_id", "left")
    row = F.struct("text", *[c for c in docs.columns if c != "text"])
    once = marked.filter("__again").groupBy("doc_id").agg(F.min(row).alias("__row")).select("__row.*")
    return marked.filter("__again IS NULL").select(*docs.columns).unionByName(once)
