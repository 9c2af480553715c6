"""A word bigram model with interpolated modified Kneser-Ney smoothing.

Counting is done by Spark over blocks: a task turns its words into hashes, adds up equal
ones, and sends one block of sorted arrays per shard.  Shards are merged and written to the
shared folder as sorted hash arrays, which the scoring tasks map into memory; they look up
sorted, distinct hashes, so a task touches each page once per chunk and holds none of it.

A bigram lies in the shard of its first word.  A word that begins very many bigrams is
spread over several shards by its second word; which words those are follows from the
unigram counts, and there are at most as many as shards.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField

from tidemark.llm import kernels
from tidemark.llm.batches import annotate
from tidemark.llm.storage import fresh_folder, stored
from tidemark.plans.sizes import scanned_bytes

START, END = np.uint64(0x5D1A6C0F3E2B9471), np.uint64(0xA3C59AC2F1039E5B)
FLUSH_TOKENS = 1_500_000
CHUNK_TOKENS = 400_000
SHARD_BYTES = 64 * 1024 * 1024
_ODD = np.uint64(0x9FB21C651E98DF25)
BLOCK = "shard int, kind string, n long, payload binary"


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, stored as differences of the first (sorted) and raw others."""
    first = arrays[0].copy()
    first[1:] -= arrays[0][:-1]
    raw = b"".join([first.tobytes(), *(a.tobytes() for a in arrays[1:])])
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(payload: bytes, n: int, *types) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(payload)
    out, at = [], 0
    for kind in types:
        size = np.dtype(kind).itemsize * n
        out.append(np.frombuffer(raw, dtype=kind, count=n, offset=at))
        at += size
    return [np.cumsum(out[0], dtype=out[0].dtype), *out[1:]]


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of hashes, so arrays sorted by hash are sorted by shard."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return kernels.mix(first * _ODD + second)


@dataclass(frozen=True)
class Layout:
    """Where the arrays lie and how words map to shards."""

    folder: str
    shards: int
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))  # sorted
    spread: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    # entries of each shard's arrays, of words and pairs, and of the pairs' large counts
    held: dict[tuple[str, int], tuple[int, int]] = field(default_factory=dict)

    def pair_shard(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = _shard(first, self.shards)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, first), len(self.hot) - 1)
            is_hot = self.hot[at] == first
            part = kernels.mix(second[is_hot].copy()) % self.spread[at[is_hot]].astype(np.uint64)
            out[is_hot] = (out[is_hot] + part.astype(np.int64)) % self.shards
        return out


def _sequences(texts: pa.Array, powers: kernels.Powers) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words and ends of some texts in order, tokens before each text)."""
    for a, _, data, offsets in kernels.pieces(texts):
        hashes, before = kernels.word_hashes(data, offsets, powers)
        n = len(before) - 1
        cuts = before + np.arange(n + 1)
        tokens = np.empty(len(hashes) + n, dtype=np.uint64)
        tokens[np.arange(len(hashes)) + kernels.rows_of(before)] = hashes
        tokens[cuts[1:] - 1] = END
        yield a, tokens, cuts


def _previous(tokens: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[cuts[:-1]] = START
    return out


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, the place of one of each, and summed counts (of ones if not given)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    fresh = np.ones(len(keys), dtype=bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(fresh)
    if counts is None:
        summed = np.diff(np.append(starts, len(keys)))
    else:
        summed = np.add.reduceat(counts[order], starts) if len(keys) else counts
    return ordered[starts], order[starts], summed


def _rows(shards: list[int], kinds: list[str], sizes: list[int], payloads: list[bytes]) -> pa.RecordBatch:
    arrays = [pa.array(shards, pa.int32()), pa.array(kinds, pa.string()), pa.array(sizes, pa.int64())]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(payloads, pa.binary())], names=["shard", "kind", "n", "payload"])


def _blocks(kind: str, shard: np.ndarray, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row per shard of arrays whose shards are in order."""
    edges = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
    for a, b in zip(edges[:-1], edges[1:]):
        yield _rows([int(shard[a])], [kind], [int(b - a)], [_pack(*(x[a:b] for x in arrays))])


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Tokens and the ones before them, in portions of bounded size."""
    powers, held, size = kernels.Powers(), [], 0
    for batch in batches:
        for _, tokens, cuts in _sequences(batch.column(0), powers):
            held.append((tokens, _previous(tokens, cuts)))
            size += len(tokens)
            if size >= FLUSH_TOKENS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple[str, int, bytes]]]]:
    """Blocks of one shard after the other, of rows sorted by shard."""
    now, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for shard, kind, n, payload in zip(*columns):
            if shard != now:
                if held:
                    yield now, held
                now, held = shard, []
            held.append((kind, n, payload))
    if held:
        yield now, held


def _merged(blocks, kind: str, *types) -> list[np.ndarray]:
    parts = [_unpack(p, n, *types) for k, n, p in blocks if k == kind]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, dtype=t) for t in types]


def _count_words(shards: int):
    def run(batches):
        for tokens, _ in _flushes(batches):
            words, _, counts = _summed(tokens)
            yield from _blocks("words", _shard(words, shards), words, counts)

    return run


def _merge_words(shards: int):
    """Per shard its words, and a row of totals."""

    def run(batches):
        for shard, blocks in _by_shard(batches):
            words, counts = _merged(blocks, "words", np.uint64, np.int64)
            words, _, counts = _summed(words, counts)
            yield from _blocks("words", np.full(len(words), shard), words, counts)
            total = np.array([counts.sum(), len(words)], dtype=np.int64)
            yield _rows([shard], ["totals"], [2], [total.tobytes()])

    return run


def _frequent(least: int):
    """Words that occur so often, of rows of words."""

    def run(batches):
        for batch in batches:
            for n, payload in zip(batch.column("n").to_pylist(), batch.column("payload").to_pylist()):
                words, counts = _unpack(payload, n, np.uint64, np.int64)
                many = counts >= least
                columns = [pa.array(words[many].view(np.int64)), pa.array(counts[many])]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "count"])

    return run


def _count_pairs(layout: Layout):
    def run(batches):
        for tokens, before in _flushes(batches):
            keys = _pair_key(before, tokens)
            _, place, counts = _summed(keys)
            first, second = before[place], tokens[place]
            shard = layout.pair_shard(first, second)
            order = np.lexsort((first, shard))
            first, second, counts = first[order], second[order], counts[order].astype(np.uint32)
            yield from _blocks("pairs", shard[order], first, second, counts)

    return run


def _write(path: str, array: np.ndarray) -> None:
    """A whole file or none: a task that runs again replaces it by the same bytes."""
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "wb") as out:
        array.tofile(out)
    os.replace(temporary, path)


def _merge_pairs(layout: Layout):
    """Writes a shard's bigrams; sends on what their words need to know."""

    def run(batches):
        for shard, blocks in _by_shard(batches):
            first, second, counts = _merged(blocks, "pairs", np.uint64, np.uint64, np.uint32)
            del blocks
            keys, place, counts = _summed(_pair_key(first, second), counts.astype(np.int64))
            first, second = first[place], second[place]
            path = os.path.join(layout.folder, f"pairs-{shard:06d}")
            _write(path + ".key", keys)
            _write(path + ".count", np.minimum(counts, 255).astype(np.uint8))
            large = counts >= 255
            _write(path + ".large", np.concatenate([keys[large], counts[large].astype(np.uint64)]))
            steps = np.array([(counts == k).sum() for k in (1, 2, 3, 4)], dtype=np.int64)
            yield _rows([0], ["steps"], [4], [steps.tobytes()])
            yield _rows([shard], ["held"], [len(keys)], [np.array([large.sum()], dtype=np.int64).tobytes()])
            order = np.argsort(first, kind="stable")
            own, starts = np.unique(first[order], return_index=True)
            held = counts[order]
            stats = [np.add.reduceat(x.astype(np.int64), starts) for x in (held, held == 1, held == 2, held >= 3)]
            yield from _blocks("contexts", _shard(own, layout.shards), own, *stats)
            words, _, ways = _summed(second)
            yield from _blocks("ways", _shard(words, layout.shards), words, ways)

    return run


WORD = np.dtype([("count", "<i8"), ("ways", "<i8"), ("total", "<i8"), ("n1", "<u4"), ("n2", "<u4"), ("n3", "<u4")])


def _merge_facts(layout: Layout):
    """Writes a shard's words with all that scoring needs; returns sums of bounded size."""

    def run(batches):
        for shard, blocks in _by_shard(batches):
            words, counts = _merged(blocks, "words", np.uint64, np.int64)
            contexts = _merged(blocks, "contexts", np.uint64, *[np.int64] * 4)
            ways = _merged(blocks, "ways", np.uint64, np.int64)
            keys = np.unique(np.concatenate([words, contexts[0], ways[0]]))
            facts = np.zeros(len(keys), dtype=WORD)
            facts["count"][np.searchsorted(keys, words)] = counts
            for name, values in zip(("total", "n1", "n2", "n3"), contexts[1:]):
                summed = np.zeros(len(keys), dtype=np.int64)
                np.add.at(summed, np.searchsorted(keys, contexts[0]), values)
                facts[name] = summed
            summed = np.zeros(len(keys), dtype=np.int64)
            np.add.at(summed, np.searchsorted(keys, ways[0]), ways[1])
            facts["ways"] = summed
            path = os.path.join(layout.folder, f"words-{shard:06d}")
            _write(path + ".key", keys)
            _write(path + ".fact", facts)
            steps = np.zeros(4, dtype=np.int64)
            for kind, n, payload in blocks:
                if kind == "steps":
                    steps += np.frombuffer(payload, dtype=np.int64)
                elif kind == "held":
                    yield _rows([shard], ["held"], [n], [payload])
            sums = [summed.sum(), *((summed == k).sum() for k in (1, 2, 3, 4))]
            payload = np.concatenate([steps, np.array(sums, dtype=np.int64)]).tobytes()
            yield _rows([shard], ["sums"], [len(keys)], [payload])

    return run


def discounts(steps: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from how many counts are 1 to 4."""
    n1, n2, n3, n4 = (float(x) for x in steps)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [0.0]
    for k, (here, after) in enumerate(((n1, n2), (n2, n3), (n3, n4)), start=1):
        raw = k - (k + 1) * y * after / here if here else y
        # Few counts can put a discount outside its range; it then counts as a plain one.
        out.append(raw if 0 < raw < k else min(y, k - 0.01))
    return np.array(out)


@dataclass(frozen=True)
class BigramModel:
    layout: Layout
    tokens: int  # of the training texts, ends included
    words: int  # distinct ones
    pair_discounts: np.ndarray
    way_discounts: np.ndarray
    way_total: int
    way_rest: float  # probability left for the uniform distribution


def _dealt(blocks: DataFrame, shards: int) -> DataFrame:
    return blocks.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind", "n")


def _local(folder: str) -> str:
    """The folder as a path of the file system that driver and workers have in common."""
    path = folder.removeprefix("file://").removeprefix("file:")
    if not path.startswith("/"):
        raise ValueError(f"arrays are mapped into memory, so {folder} must be a folder mounted on every machine")
    return path


def learn(texts: DataFrame, text: str = "text") -> BigramModel:
    """Count all given texts and write the arrays below ``spark.checkpoint.dir``.

    Null texts count as empty ones.  Nothing of the corpus reaches the driver but sums of
    fixed size and the words of more than 1 / shards of all tokens, fewer than shards.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(text).cast("string").alias("text"))
    size = scanned_bytes(texts) or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size * 2 // SHARD_BYTES))
    folder = _local(fresh_folder(spark, "bigrams"))
    os.makedirs(folder, exist_ok=True)
    layout = Layout(folder, shards)
    counted = _dealt(rows.mapInArrow(_count_words(shards), BLOCK), shards).mapInArrow(_merge_words(shards), BLOCK)
    unigrams = stored(counted, "unigrams")
    tokens = words = 0
    for row in unigrams.filter("kind = 'totals'").select("payload").toLocalIterator():  # two numbers per shard
        total = np.frombuffer(row["payload"], dtype=np.int64)
        tokens, words = tokens + int(total[0]), words + int(total[1])
    # Words that fill a shard by themselves; there are at most as many as shards.
    own = unigrams.filter("kind = 'words'").select("n", "payload")
    frequent = own.mapInArrow(_frequent(max(1, -(-tokens // shards))), "word long, count long").collect()
    hot = {r["word"] % (1 << 64): r["count"] for r in frequent}
    # As often as the mark of a text's start, which begins one bigram per text.
    texts_share = np.uint64(START)
    ends = hot.get(int(END), 0)
    if ends:
        hot[int(texts_share)] = ends
    names = np.array(sorted(hot), dtype=np.uint64)
    spread = np.array([min(shards, 1 + hot[int(k)] * shards * 2 // max(tokens, 1)) for k in names], dtype=np.int64)
    layout = Layout(folder, shards, names, spread)
    pairs = _dealt(rows.mapInArrow(_count_pairs(layout), BLOCK), shards).mapInArrow(_merge_pairs(layout), BLOCK)
    facts = pairs.unionAll(unigrams.filter("kind = 'words'").select("shard", "kind", "n", "payload"))
    sums = _dealt(facts, shards).mapInArrow(_merge_facts(layout), BLOCK)
    total, held = np.zeros(9, dtype=np.int64), {}
    for row in sums.collect():  # a dozen numbers per shard
        numbers = np.frombuffer(row["payload"], dtype=np.int64)
        if row["kind"] == "held":
            held["pairs", row["shard"]] = (row["n"], int(numbers[0]))
        else:
            held["words", row["shard"]] = (row["n"], 0)
            total += numbers
    layout = replace(layout, held=held)
    way = discounts(total[5:])
    kinds = np.array([total[5], total[6], 0])
    return BigramModel(layout, tokens, words, discounts(total[:4]), way, int(total[4]), _rest(way, total, words, kinds))


def _rest(way: np.ndarray, total: np.ndarray, words: int, kinds: np.ndarray) -> float:
    """Share of the continuation mass that the discounts free."""
    if not total[4]:
        return 1.0
    kinds[2] = words - kinds[0] - kinds[1]
    return float((way[1:] * kinds).sum() / total[4])


class Arrays:
    """Lookups in the mapped arrays; a shard is opened when first needed."""

    def __init__(self, layout: Layout) -> None:
        self.layout = layout
        self.open: dict[tuple[str, int], tuple] = {}

    def _map(self, name: str, dtype, entries: int) -> np.ndarray:
        """The array of a file, which must have as many entries as were written."""
        if not entries:
            return np.zeros(0, dtype=dtype)
        path, dtype = os.path.join(self.layout.folder, name), np.dtype(dtype)
        if os.path.getsize(path) != entries * dtype.itemsize:
            raise OSError(f"{path} has {os.path.getsize(path)} bytes, not {entries * dtype.itemsize}")
        return np.memmap(path, dtype=dtype, mode="r")

    def _shard(self, kind: str, shard: int) -> tuple:
        if (kind, shard) not in self.open:
            stem = f"{kind}-{shard:06d}"
            n, m = self.layout.held.get((kind, shard), (0, 0))
            keys = self._map(stem + ".key", np.uint64, n)
            if kind == "words":
                self.open[kind, shard] = (keys, self._map(stem + ".fact", WORD, n))
            else:
                large = np.array(self._map(stem + ".large", np.uint64, 2 * m)).reshape(2, -1)
                self.open[kind, shard] = (keys, self._map(stem + ".count", np.uint8, n), large)
        return self.open[kind, shard]

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(0, dtype=np.int64), np.zeros(len(wanted), dtype=bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        there = keys[at] == wanted
        return at[there], there

    def words(self, wanted: np.ndarray) -> np.ndarray:
        """Facts of sorted distinct hashes, zeros for unknown ones."""
        out = np.zeros(len(wanted), dtype=WORD)
        shard = _shard(wanted, self.layout.shards)
        edges = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        for a, b in zip(edges[:-1], edges[1:]):
            keys, facts = self._shard("words", int(shard[a]))
            at, there = self._find(keys, wanted[a:b])
            out[a:b][there] = facts[at]
        return out

    def pairs(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Counts of bigrams, 0 for unknown ones."""
        keys, place, back = np.unique(_pair_key(first, second), return_index=True, return_inverse=True)
        shard = self.layout.pair_shard(first[place], second[place])
        order = np.argsort(shard, kind="stable")
        found = np.zeros(len(keys), dtype=np.int64)
        edges = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(order))
        for a, b in zip(edges[:-1], edges[1:]):
            rows = order[a:b]
            held, counts, large = self._shard("pairs", int(shard[rows[0]]))
            at, there = self._find(held, keys[rows])
            values = counts[at].astype(np.int64)
            top = np.flatnonzero(values == 255)
            if len(top):
                values[top] = large[1][np.searchsorted(large[0], held[at[top]])].astype(np.int64)
            found[rows[there]] = values
        return found[back]


def log_probabilities(model: BigramModel, arrays: Arrays, tokens: np.ndarray, cuts: np.ndarray):
    """log10 probability of each token after the one before it, its count, and its base log10."""
    before = _previous(tokens, cuts)
    known, back = np.unique(np.concatenate([tokens, before]), return_inverse=True)
    facts = arrays.words(known)
    own, last = facts[back[: len(tokens)]], facts[back[len(tokens) :]]
    d, w = model.pair_discounts, model.way_discounts
    ways = own["ways"]
    plain = np.maximum(ways - w[np.minimum(ways, 3)], 0) / max(model.way_total, 1)
    lower = plain + model.way_rest / (model.words + 1)
    total = last["total"]
    count = np.zeros(len(tokens), dtype=np.int64)
    seen = np.flatnonzero((total > 0) & (own["count"] > 0))
    count[seen] = arrays.pairs(before[seen], tokens[seen])
    freed = d[1] * last["n1"] + d[2] * last["n2"] + d[3] * last["n3"]
    some = np.maximum(total, 1)
    p = np.where(total > 0, np.maximum(count - d[np.minimum(count, 3)], 0) / some + freed / some * lower, lower)
    base = np.log10((own["count"] + 1) / (model.tokens + model.words + 1))
    return np.log10(p), own["count"], base


FIELDS = [
    StructField("n_tokens", LongType()),
    StructField("n_known", LongType()),
    StructField("train_tokens", LongType()),
    StructField("base_score", DoubleType()),
    StructField("score", DoubleType()),
    StructField("perplexity", DoubleType()),
]


def score(docs: DataFrame, model: BigramModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with log10 probabilities of each whole text and its perplexity.

    A null or empty text is its end alone.  With nothing learned every token has
    probability one over (distinct words + 1), which is 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value
        arrays, powers = Arrays(held.layout), kernels.Powers()

        def work(texts: pa.Array):
            n = len(texts)
            size, known = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
            base, value = np.zeros(n), np.zeros(n)

            def finish(parts):
                tokens = np.concatenate([t for _, t, _ in parts])
                at, cuts = [], [np.zeros(1, dtype=np.int64)]
                done = 0
                for a, t, c in parts:
                    at.append(a + np.arange(len(c) - 1))
                    cuts.append(c[1:] + done)
                    done += len(t)
                rows, ends = np.concatenate(at), np.concatenate(cuts)
                p, count, plain = log_probabilities(held, arrays, tokens, ends)
                starts = ends[:-1]
                size[rows] = np.diff(ends)
                known[rows] = np.add.reduceat((count > 0).astype(np.int64), starts)
                base[rows] = np.add.reduceat(plain, starts)
                value[rows] = np.add.reduceat(p, starts)

            parts, tokens = [], 0
            for part in _sequences(texts, powers):
                parts.append(part)
                tokens += len(part[1])
                if tokens >= CHUNK_TOKENS:
                    finish(parts)
                    parts, tokens = [], 0
            if parts:
                finish(parts)
            train = np.full(n, held.tokens, dtype=np.int64)
            spread = np.power(10.0, np.minimum(300, -value / np.maximum(size, 1)))
            return [pa.array(x) for x in (size, known, train, base, value, spread)]

        return work

    return annotate(docs, text, make, FIELDS, keep)


def evaluate(docs: DataFrame) -> DataFrame:
    """Scores of all documents under a model of those whose crc32 modulo 7 is not 2."""
    place = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    model = learn(docs.filter(F.coalesce(place != 2, F.lit(False))).select("text"))
    out = score(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(place == 2, F.lit(False))
    return out.select("doc_id", held_out.alias("held_out"), *[f.name for f in FIELDS])
