"""Benchmark decontamination by counting shared q-grams and aligning what remains.

Benchmark items are cut into overlapping segments.  A text holding a segment with at most
k edits shares at least m + 1 - q (k + 1) of its q-grams (m: length of the segment), all on
diagonals no further than k apart.  Of the q-grams that lie side by side in the segment,
each edit spoils one at most, so some are found unchanged; only these anchors are looked
up, and two in a band of diagonals (one, for short segments) call for a count.  Shared
q-grams are then counted in that band, each place of the segment once; bands overlap, and
those that meet the bound are verified by banded alignment.  The
filters lose nothing within the edit budget and the alignment admits nothing beyond it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidemark.llm import kernels
from tidemark.llm.batches import TEXT, annotate, kept_rows

Q = 6
SHORTEST = 12  # items below match nothing
SEGMENT = 60
STEP = 20
EDIT_RATE = 0.12
BAND = 16
FILTER_BITS = 22
BLOCK_CHARS = 8_000_000
# Anchors of a piece of text that are looked at together, and bands that are verified together.
HITS = 500_000
VERIFIED = 4096

_NO_GRAM, _OUTSIDE = np.uint32(0xFFFFFFFF), np.uint32(0xFFFFFFFE)  # greater than any q-gram in brief

# Only letters and digits count; in ASCII everything else is a space.
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with runs of other characters as one space, offsets of the texts, kept places."""
    folded = _FOLD[data]
    space = folded == 32
    keep = ~space
    keep[1:] |= ~space[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    keep[first] = ~space[first]
    at = np.flatnonzero(keep)
    return folded[at], np.searchsorted(at, offsets), at


def grams_of(data: np.ndarray) -> np.ndarray:
    """The q-gram at each place (of the last axis) as one number; places too near the end are left out."""
    n = data.shape[-1] - Q + 1
    if n <= 0:
        return np.zeros((*data.shape[:-1], 0), dtype=np.uint64)
    wide = data.astype(np.uint64)
    out = wide[..., :n].copy()
    for k in range(1, Q):
        out <<= np.uint64(8)
        out |= wide[..., k : k + n]
    return out


def _sorted_counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def _brief(grams: np.ndarray) -> np.ndarray:
    """Shorter numbers for q-grams: equal for equal ones, and seldom for others."""
    return ((grams * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)).astype(np.uint32)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)


@dataclass(frozen=True)
class Index:
    """Segments of some benchmark items, and where the anchors of the items occur."""

    item: np.ndarray  # of each segment
    text: tuple[bytes, ...]  # of each segment
    edits: np.ndarray  # allowed for each segment
    needed: np.ndarray  # shared q-grams needed for each segment
    anchors: np.ndarray  # anchors found unchanged at least, for each segment
    wanted: np.ndarray  # q-grams of each segment in brief, padded with a number that is none
    at: np.ndarray  # place of each segment in its item
    grams: np.ndarray  # sorted distinct anchors
    start: np.ndarray  # first entry of each anchor
    body: np.ndarray  # item of each entry, by number
    offset: np.ndarray  # place of each entry in its item
    first: np.ndarray  # first of the segments around each entry, and one more at the end
    around: np.ndarray  # segments around the entries
    present: np.ndarray  # anchors by their slot


def build_index(items: list[tuple[int, str]]) -> Index:
    """Index of (id, text) pairs; items of fewer than ``SHORTEST`` bytes after folding match nothing."""
    owner, texts, places, grams, body, offset, around, bodies = [], [], [], [], [], [], [], []
    for item, text in items:
        raw = pa.array([text], pa.large_string())
        lowered = pc.utf8_lower(raw)
        whole = b"".join(normalised(d, o)[0].tobytes() for _, _, d, o in kernels.pieces(lowered)).strip()
        if len(whole) >= SHORTEST:
            bodies.append((item, whole, grams_of(np.frombuffer(whole, dtype=np.uint8))))
    common, times = _sorted_counts(np.concatenate([g for *_, g in bodies]) if bodies else np.zeros(0, np.uint64))
    for number, (item, whole, own) in enumerate(bodies):
        last = max(0, len(whole) - SEGMENT)
        starts = np.array(sorted({*range(0, last, STEP), last}))
        base, size = len(texts), min(SEGMENT, len(whole))
        owner += [item] * len(starts)
        texts += [whole[at : at + SEGMENT] for at in starts]
        places += starts.tolist()
        # every Q-th place of an item, from where the q-grams are rarest; a short one needs the first
        often = times[np.searchsorted(common, own)]
        begin = min(range(Q), key=lambda k: often[k::Q].sum()) if size == SEGMENT else 0
        anchors = np.arange(begin, len(own), Q)
        grams.append(own[anchors])
        body.append(np.full(len(anchors), number))
        offset.append(anchors)
        for anchor in anchors:
            around.append(base + np.flatnonzero((starts <= anchor) & (anchor + Q <= starts + size)))
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    edits = np.floor(sizes * EDIT_RATE).astype(np.int64)
    edits = np.minimum(edits, np.maximum(0, (sizes - 7) // 7))  # so that anchors and the bound stay above zero
    needed = np.maximum(1, sizes + 1 - Q * (edits + 1))
    flat = np.concatenate(grams) if grams else np.zeros(0, dtype=np.uint64)
    order = np.argsort(flat, kind="stable")
    distinct, start = np.unique(flat[order], return_index=True)
    present = np.zeros(1 << FILTER_BITS, dtype=bool)
    present[_slots(distinct)] = True
    near = [around[k] for k in order]
    # a segment of 60 has nine anchors at least and seven edits; of shorter ones one is left
    anchors = np.where(sizes == SEGMENT, 2, 1)
    wanted = np.full((len(texts), SEGMENT - Q + 1), _NO_GRAM, dtype=np.uint32)
    for row, text in enumerate(texts):
        own = _brief(grams_of(np.frombuffer(text, dtype=np.uint8)))
        wanted[row, : len(own)] = own
    join = lambda parts, kind: (np.concatenate(parts) if parts else np.zeros(0)).astype(kind)
    return Index(
        np.array(owner, dtype=np.int64), tuple(texts), edits, needed, anchors, wanted,
        np.array(places, dtype=np.int64), distinct, np.append(start, len(flat)), join(body, np.int64)[order], join(offset, np.int64)[order],
        np.cumsum([0, *(len(x) for x in near)]), join(near, np.int64), present,
    )


def _expanded(start: np.ndarray, times: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as ``times`` says."""
    return np.repeat(start - (np.cumsum(times) - times), times) + np.arange(times.sum())


def least_edits(patterns: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits that turn each pattern into a part of its window, and where that part ends.

    Row i of the pattern meets places i to i + width - 1 of the window only, width being
    what the window is longer than the pattern, plus one: a band of diagonals.
    """
    n, m = patterns.shape
    width = windows.shape[1] - m + 1
    cost = np.zeros((n, width), dtype=np.int16)
    lane = np.arange(width, dtype=np.int16)
    for i in range(m):
        best = cost + (windows[:, i : i + width] != patterns[:, i : i + 1])
        best[:, :-1] = np.minimum(best[:, :-1], cost[:, 1:] + 1)
        cost = (np.minimum.accumulate(best - lane, axis=1) + lane).astype(np.int16)
    end = cost.argmin(axis=1)
    return cost[np.arange(n), end], end + m


def _anchor_hits(index: Index, grams: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the texts that hold an anchor, and the number of the anchor."""
    place = np.flatnonzero(index.present[_slots(grams)])
    found = grams[place]
    slot = np.minimum(np.searchsorted(index.grams, found), max(0, len(index.grams) - 1))
    hit = index.grams[slot] == found if len(index.grams) else np.zeros(len(found), dtype=bool)
    place, slot = place[hit], slot[hit]
    inside = place + Q <= offsets[np.searchsorted(offsets, place, side="right")]
    return place[inside], slot[inside]


def search(index: Index, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, item, start, end) of verified regions in normalised bytes; at most one per band."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    grams = grams_of(data)
    place, slot = _anchor_hits(index, grams, offsets)
    if not len(place):
        return none
    times = index.start[slot + 1] - index.start[slot]
    texts, most = len(offsets) - 1, int(SEGMENT * EDIT_RATE)
    # Diagonals count from the longest item before the first byte, so none is negative.
    shift = int(index.offset.max())
    bands = (int(offsets[-1]) + shift) // BAND + 2
    total, keys, a = np.cumsum(times), [], 0
    while a < len(place):
        b = max(a + 1, int(np.searchsorted(total, total[a] - times[a] + HITS, side="right")))
        # two anchors of a region lie within a segment and its edits of each other
        c = int(np.searchsorted(place, place[b - 1] + SEGMENT + most, side="right"))
        entry = _expanded(index.start[slot[a:c]], times[a:c])
        at = np.repeat(place[a:c], times[a:c])
        hot = _in_company(index, entry, at, offsets, bands, shift)
        entry, at = entry[hot], at[hot]
        number = index.first[entry + 1] - index.first[entry]
        segment = index.around[_expanded(index.first[entry], number)]
        diagonal = np.repeat(at - index.offset[entry] + shift, number)
        text = np.repeat(np.searchsorted(offsets, at, side="right") - 1, number)
        key = (segment * bands + diagonal // BAND + 1) * texts + text
        again = diagonal % BAND < most  # also belongs to the band before
        key, count = _sorted_counts(np.concatenate([key, key[again] - texts]))
        keys.append(key[count >= index.anchors[key // (bands * texts)]])
        a = b
    segment, rest = np.divmod(_sorted_counts(np.concatenate(keys))[0], bands * texts)
    band, text = np.divmod(rest, texts)
    # where the segment starts on the first diagonal of the band
    low = (band - 1) * BAND - shift + index.at[segment]
    room = BAND + most - 1
    ends = [np.full(n, _OUTSIDE) for n in (shift + 2 * BAND, SEGMENT + room + Q)]
    grams = np.concatenate([ends[0], _brief(grams), ends[1]])
    out = []
    for k in range(0, len(segment), VERIFIED):
        part = slice(k, k + VERIFIED)
        enough = _shared(index, grams, segment[part], low[part] + shift + 2 * BAND, room) >= index.needed[segment[part]]
        for found in _aligned(index, data, offsets, segment[part][enough], text[part][enough], low[part][enough], room):
            out.append(found)
    if not out:
        return none
    return tuple(np.concatenate(x) for x in zip(*out))


def _in_company(index: Index, entry: np.ndarray, at: np.ndarray, offsets: np.ndarray, bands: int, shift: int) -> np.ndarray:
    """Hits with another of their item in one of their bands of diagonals, or whose item needs one only."""
    diagonal = at - index.offset[entry] + shift
    text = np.searchsorted(offsets, at, side="right") - 1
    key = (text * (int(index.body.max()) + 1) + index.body[entry]) * (2 * bands) + diagonal * 2 // BAND
    order = np.argsort(key)
    # bands of half the width: what belongs together lies in one or in two next to each other
    near = np.flatnonzero(np.diff(key[order]) <= 1)
    out = index.anchors[index.around[index.first[entry]]] == 1
    out[order[near]] = out[order[near + 1]] = True
    return out


def _shared(index: Index, grams: np.ndarray, segment: np.ndarray, low: np.ndarray, room: int) -> np.ndarray:
    """Places of each segment whose q-gram lies on one of the diagonals of a band."""
    wanted = index.wanted[segment]
    here = grams[low[:, None] + np.arange(wanted.shape[1] + room)]
    shared = np.zeros(wanted.shape, dtype=bool)
    for k in range(room + 1):
        shared |= here[:, k : k + wanted.shape[1]] == wanted
    return shared.sum(axis=1)


def _aligned(index: Index, data: np.ndarray, offsets: np.ndarray, segment: np.ndarray, text: np.ndarray, low: np.ndarray, room: int):
    """Regions of bands that hold their segments with few enough edits, size by size."""
    sizes = np.array([len(index.text[s]) for s in segment], dtype=np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        own, at = text[rows], low[rows][:, None] + np.arange(size + room)
        inside = (at >= offsets[own][:, None]) & (at < offsets[own + 1][:, None])
        window = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)  # 0 matches no byte of a segment
        pattern = np.stack([np.frombuffer(index.text[s], dtype=np.uint8) for s in segment[rows]])
        edits, end = least_edits(pattern, window)
        good = edits <= index.edits[segment[rows]]
        own, stop = own[good], low[rows][good] + end[good]
        begin = np.maximum(stop - size, offsets[own])
        yield own, index.item[segment[rows][good]], begin, np.minimum(stop, offsets[own + 1])


REGIONS = ArrayType(StructType([StructField(n, LongType()) for n in ("item_id", "start", "end")]))
_REGION = pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _finder(index: Index):
    def work(texts: pa.Array):
        out: list[list[dict]] = [[] for _ in range(len(texts))]
        lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
        for a, _, data, offsets in kernels.pieces(lowered):
            body, cuts, kept = normalised(data, offsets)
            text, item, start, end = search(index, body, cuts)
            if not len(text):
                continue
            letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            begin = letters[kept[start]] - letters[offsets[text]]
            stop = letters[kept[np.maximum(end - 1, start)]] - letters[offsets[text]] + 1
            for i in np.lexsort((stop, begin, item, text)):
                own, span = out[a + text[i]], (int(item[i]), int(begin[i]), int(stop[i]))
                if own and own[-1]["item_id"] == span[0] and span[1] <= own[-1]["end"]:
                    own[-1]["end"] = max(own[-1]["end"], span[2])  # overlapping segments of one item
                else:
                    own.append({"item_id": span[0], "start": span[1], "end": span[2]})
        return [pa.array(out, pa.list_(_REGION))]

    return work


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    item_id: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The ``keep`` columns with ``regions``: (item_id, start, end) of benchmark text in each whole text.

    Places count code points of the lower-cased text.  Regions of one item that overlap are
    one.  Case, white space and signs are ignored; an item counts when any of its segments
    of up to 60 bytes, taken every 20, lies in the text with at most 12 % edits.  Null or empty texts,
    and null items or ones of fewer than 12 letters and digits, match nothing.
    The benchmark is sent to the tasks in blocks of at most ``block_chars`` characters (and
    one more item), each searched over all documents, so no size of it is left out.
    """
    items = benchmark.filter(F.col(item_text).isNotNull()).select(
        F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")
    )
    out = docs.select(*keep, F.col(text).cast("string").alias(TEXT + "_"), F.array().cast(REGIONS).alias("regions"))
    for index in _blocks(items, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        fields = [StructField("__found", REGIONS)]
        more = annotate(out, TEXT + "_", lambda s=shared: _finder(s.value), fields, out.columns)
        out = more.withColumn("regions", F.concat("regions", "__found")).drop("__found")
    return out.drop(TEXT + "_")


def _blocks(items: DataFrame, block_chars: int):
    """Indexes of blocks of items, read one item after the other."""
    held, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= block_chars:
            yield build_index(held)
            held, size = [], 0
    if held:
        yield build_index(held)


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: whether it holds benchmark text, of which items, and where."""
    found = find(docs, benchmark)
    return found.select(
        "doc_id",
        (F.size("regions") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.col("regions.item_id"))).alias("item_ids"),
        "regions",
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark text, all their columns unchanged."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return kept_rows(docs, lambda df, text, keep: find(df, benchmark, text, keep), "size(regions) = 0")
