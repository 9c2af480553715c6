"""Periodic runs of words: stretches that repeat with a period, and texts without the repeats.

Equal windows of words, found for many texts at once by hashes, say which texts can hold a
run at all.  In those, words become numbers, suffixes are sorted by doubling, and adjacent
suffixes are united by decreasing length of their common prefix (LCP), with the positions
of every class kept in order.  Two positions that become neighbours in a class, at a distance
the LCP allows, seed a run: the run's start and the place one period later become neighbours
exactly when classes of their LCP are united, since any position between them with as long a
prefix would give the run a smaller period.  Seeds that could be extended to the left are the
same run seen later.

Suffixes with a common prefix too short for any run are never united, which loses none.

Odd input: a null text has no words; a text is searched whole, in memory proportional to its
own words; repeated rows are treated alike; an empty table gives no rows.  A column of the
caller that is kept gives way to a new one of its name.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidemark.llm import kernels
from tidemark.llm.batches import annotate
from tidemark.llm.columns import whole, words_of

MIN_LENGTH = 24
MIN_EXPONENT = 3
_BLOCK = 1024

RUN = StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")])
FIELDS = [StructField("runs", ArrayType(RUN, False), False), StructField("collapsed", StringType(), False)]


class Positions:
    """Positions in order, in blocks, so that adding one moves few others."""

    __slots__ = ("blocks", "heads", "size")

    def __init__(self, first: int):
        self.blocks, self.heads, self.size = [[first]], [first], 1

    def add(self, x: int) -> tuple[int | None, int | None]:
        """Adds a position; returns its neighbours."""
        b = max(0, bisect_right(self.heads, x) - 1)
        block = self.blocks[b]
        k = bisect_left(block, x)
        before = block[k - 1] if k else None  # only the first block takes smaller ones
        if k < len(block):
            after = block[k]
        else:
            after = self.heads[b + 1] if b + 1 < len(self.heads) else None
        block.insert(k, x)
        if not k:
            self.heads[b] = x
        self.size += 1
        if len(block) > _BLOCK:
            half = len(block) // 2
            self.blocks.insert(b + 1, block[half:])
            self.heads.insert(b + 1, block[half])
            del block[half:]
        return before, after

    def __iter__(self):
        for block in self.blocks:
            yield from block


def shortest_lcp(min_length: int, min_exponent: int) -> int:
    """A run's start and the place one period later share at least so many words."""
    return max(1, -(-min_length * (min_exponent - 1) // min_exponent))


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the words each shares with the one before it (0 for the first)."""
    n = len(words)
    ranks = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
    step = 1
    while step < n and ranks[-1].max() < n - 1:
        now = ranks[-1].astype(np.int64)
        following = np.zeros(n, dtype=np.int64)
        following[:-step] = now[step:] + 1
        ranks.append(np.unique(now * (n + 1) + following, return_inverse=True)[1].astype(np.int32))
        step *= 2
    order = np.argsort(ranks[-1], kind="stable")
    lcp = np.zeros(n, dtype=np.int64)
    left, right = order[:-1].copy(), order[1:].copy()
    for level in range(len(ranks) - 1, -1, -1):
        rank, width = ranks[level], 1 << level
        # ranks stand for whole windows only where the window fits
        fits = np.maximum(left, right) + width <= n
        same = fits & (rank[np.where(fits, left, 0)] == rank[np.where(fits, right, 0)])
        left[same] += width
        right[same] += width
    lcp[1:] = left - order[:-1]
    return order, lcp


def find_runs(words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """(start, length, smallest period) of all maximal runs, by start, then period.

    A run is at least ``min_length`` words and ``min_exponent`` (2 or more) periods long.
    """
    if len(words) < max(2, min_length):
        return np.zeros((0, 3), dtype=np.int64)
    order, lcp = suffix_order(words)
    edges = np.flatnonzero(lcp >= shortest_lcp(min_length, min_exponent))
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, Positions] = {}
    found: dict[tuple[int, int], int] = {}

    def top(x: int) -> int:
        root = x
        while (above := parent.get(root, root)) != root:
            root = above
        while x != root:
            parent[x], x = root, parent[x]
        return root

    def seed(i: int, j: int, common: int) -> None:
        period = j - i
        length = period + common
        if common < (min_exponent - 1) * period or length < min_length:
            return
        if i and words[i - 1] == words[j - 1]:
            return
        # equal classes are united one by one, so a multiple of the period may come first
        known = found.get((i, length))
        if known is None or period < known:
            found[i, length] = period

    for a, b, common in zip(order[edges - 1].tolist(), order[edges].tolist(), lcp[edges].tolist()):
        a, b = top(a), top(b)
        large, small = members.get(a), members.get(b)
        if (small.size if small else 1) > (large.size if large else 1):
            a, b, large, small = b, a, small, large
        if large is None:
            large = members[a] = Positions(a)
        parent[b] = a
        moved = None
        for x in small or (b,):
            before, after = large.add(x)
            # two of the smaller class were neighbours before, with a longer prefix
            if before is not None and before != moved:
                seed(before, x, common)
            if after is not None:
                seed(x, after, common)
            moved = x
        members.pop(b, None)
    rows = sorted((start, length, period) for (start, length), period in found.items())
    rows.sort(key=lambda r: (r[0], r[2]))
    return np.array(rows, dtype=np.int64).reshape(-1, 3)


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those in no run beyond its first period."""
    turns = np.zeros(n + 1, dtype=np.int64)
    np.add.at(turns, runs[:, 0] + runs[:, 2], 1)
    np.add.at(turns, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(turns)[:n] == 0


def _may_repeat(hashes: np.ndarray, before: np.ndarray, width: int) -> np.ndarray:
    """Texts in which a window of ``width`` words (a power of two) occurs twice."""
    n = len(hashes)
    text = kernels.rows_of(before)
    inside = np.arange(n) + width <= before[1:][text]
    if not inside.any():
        return np.zeros(0, dtype=np.int64)
    window, step = hashes, 1
    while step < width:
        following = np.zeros_like(window)
        following[:-step] = window[step:]
        window = kernels.mix(window * np.uint64(0x9FB21C651E98DF25) + following)
        step *= 2
    text, window = text[inside], window[inside]
    keyed = kernels.mix(window + text.astype(np.uint64))
    by_key = np.argsort(keyed)
    keyed = keyed[by_key]
    return np.unique(text[by_key[1:][keyed[1:] == keyed[:-1]]])


def periodic_runs(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """The ``keep`` columns of every row with the ``runs`` of its text and the ``collapsed`` text.

    ``collapsed`` joins the words that stay by one space.  Rows stay in their partitions.
    """
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    width = 1 << (shortest_lcp(min_length, min_exponent).bit_length() - 1)

    def make() -> Callable[[pa.Array], Sequence[pa.Array]]:
        powers = kernels.Powers()

        def work(column: pa.Array) -> Sequence[pa.Array]:
            all_runs, texts = [], []
            for first, last, data, offsets in kernels.pieces(column):
                hashes, before = kernels.word_hashes(data, offsets, powers)
                suspects = set(_may_repeat(hashes, before, width).tolist())
                for row in range(last - first):
                    words = data[offsets[row] : offsets[row + 1]].tobytes().split()
                    runs = ()
                    if row in suspects:
                        numbers: dict[bytes, int] = {}
                        coded = [numbers.setdefault(w, len(numbers)) for w in words]
                        runs = find_runs(np.array(coded), min_length, min_exponent)
                        words = [w for w, stays in zip(words, kept_words(len(words), runs)) if stays]
                        runs = [dict(zip(RUN.names, r)) for r in runs.tolist()]
                    all_runs.append(runs)
                    texts.append(b" ".join(words).decode())
            kind = pa.list_(pa.field("element", pa.struct([pa.field(n, pa.int64(), False) for n in RUN.names]), False))
            return [pa.array(all_runs, kind), pa.array(texts, pa.string())]

        return work

    return annotate(df, text, make, FIELDS, keep)


def planted(text: Column, doc_id: Column) -> Column:
    """The text, or for a tenth of the ids one whose end repeats with a period drawn from the id.

    With h the crc32 of the id as text, g = h div 10 and n words: where h mod 10 is 0, words
    from a = g mod n on repeat with the period 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, words = F.floor(h / 10), words_of(whole(text))
    n = F.size(words)
    a = (g % n).cast("int")
    rest = n - a
    p = (1 + F.floor(rest / (3 + g % 8))).cast("int")
    unit = F.slice(words, a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / p).cast("int"))), F.lit(1), rest)
    repeated = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return F.when((h % 10 == 0) & (n > 0), repeated).otherwise(text)


def collapse(docs: DataFrame) -> DataFrame:
    """Per document: the number of runs, the one of greatest exponent, and digests of all of it."""
    rows = docs.select("doc_id", planted(F.col("text").cast("string"), F.col("doc_id")).alias("text"))
    found = periodic_runs(rows, "text", ("doc_id",))
    none = F.lit(None).cast(RUN)
    # runs come by start and period, so the first of the greatest exponent stays
    best = F.aggregate(
        "runs",
        none,
        lambda top, r: F.when(top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
