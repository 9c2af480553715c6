"""Language identification by a mixture of languages per document.

Each language is a distribution over hashed byte n-grams.  A document is a mixture of
languages whose proportions are found by expectation-maximisation; which languages take
part is decided by the likelihood less a penalty per language.

The log-likelihood is concave in the proportions.  At the best single language its slope
towards every other bounds from above what any mixture could gain, so where no slope
exceeds the penalty that language alone is the exact answer and no iterations are needed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField

from tidemark.llm import kernels
from tidemark.llm.batches import annotate, kept_rows

GRAM = 4  # bytes of an n-gram
BITS = 16  # n-grams are hashed to 2^BITS buckets
UNKNOWN = "und"

# Letters keep their place, everything else in ASCII counts as a space.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)


@dataclass(frozen=True)
class LanguageModel:
    """Log-probabilities of the buckets by language: languages x 2^BITS float32 numbers."""

    languages: tuple[str, ...]
    log_p: np.ndarray


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each text, with one space before and after it, and starts."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    wide = np.full(len(data) + n * GRAM, 32, dtype=np.uint8)
    shift = np.repeat(np.arange(n) * GRAM + 1, sizes)
    wide[np.arange(len(data)) + shift] = _FOLD[data]
    code = np.zeros(len(wide) - GRAM + 1, dtype=np.uint32)
    for k in range(GRAM):
        code = (code << np.uint32(8)) | wide[k : len(wide) - GRAM + 1 + k]
    # The last GRAM - 1 places before the next text's own space only hold spaces; harmless.
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.uint16)
    return bucket, offsets[:-1] + np.arange(n) * GRAM


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))


def _count_task(batches):
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), dtype=object)
        for a, b, data, offsets in kernels.pieces(_lowered(batch.column(1))):
            bucket, starts = _grams(data, offsets)
            if not len(bucket):
                continue
            owner = np.zeros(len(bucket), dtype=np.int64)
            owner[starts[1:][starts[1:] < len(bucket)]] = 1
            owner = np.cumsum(owner)
            here = langs[a:b]
            for lang in set(here):
                held = counts.setdefault(lang, np.zeros(1 << BITS, dtype=np.int64))
                held += np.bincount(bucket[(here == lang)[owner]], minlength=1 << BITS)
    for lang, held in counts.items():
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(held[at])],
            names=["lang", "bucket", "n"],
        )


def learn(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    sample_rows: int = 20_000,
    max_languages: int = 1000,
    prior: float = 2000.0,
    floor: float = 0.05,
) -> LanguageModel:
    """Fit the distributions on a sample of about ``sample_rows`` rows per language.

    Rows without language are left out.  The sample goes by a hash of the id, so it is the
    same on every run.  Counts are added in the task, then in Spark; the driver receives
    at most ``max_languages`` x 2^16 sums, and more languages are an error.  ``prior`` and
    ``floor`` draw each distribution towards the common one.
    """
    rows = labelled.filter(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.col(doc_id).alias("doc_id")
    )
    sizes = rows.groupBy("lang").count().take(max_languages + 1)
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not sizes:
        return LanguageModel((), np.zeros((0, 1 << BITS), dtype=np.float32))
    chosen = F.lit(False)
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("langid")), F.lit(1 << 30))
    for row in sizes:
        share = min(1.0, sample_rows / row["count"])
        chosen = chosen | ((F.col("lang") == row["lang"]) & (place < int(share * (1 << 30))))
    schema = "lang string, bucket int, n long"
    summed = rows.filter(chosen).select("lang", "text").mapInArrow(_count_task, schema).groupBy("lang", "bucket")
    found = summed.agg(F.sum("n").alias("n")).toArrow()
    languages = tuple(sorted(row["lang"] for row in sizes))
    counts = np.zeros((len(languages), 1 << BITS))
    code = {x: i for i, x in enumerate(languages)}
    at = np.array([code[x] for x in found.column("lang").to_pylist()], dtype=np.int64)
    counts[at, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    common = counts.sum(axis=0) + 0.5
    common /= common.sum()
    p = (counts + prior * common) / (counts.sum(axis=1, keepdims=True) + prior)
    p = (1 - floor) * p + floor * common
    return LanguageModel(languages, np.log(p).astype(np.float32))


def _em(p: np.ndarray, weight: np.ndarray, start: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood for probabilities ``p`` (n-grams x languages)."""
    share = start
    total = weight.sum()
    likelihood = -np.inf
    for _ in range(rounds):
        mixed = p @ share
        now = float(weight @ np.log(mixed))
        if now - likelihood < 1e-3:
            return share, now
        likelihood = now
        share = share * (p.T @ (weight / mixed)) / total
    return share, float(weight @ np.log(p @ share))


def _select(log_p: np.ndarray, bucket: np.ndarray, best: int, penalty: float) -> np.ndarray:
    """Proportions of all languages after dropping those not worth their penalty."""
    at, counts = np.unique(bucket, return_counts=True)
    table = log_p[:, at].T.astype(np.float64)
    p = np.exp(table - table.max(axis=1, keepdims=True))
    weight = counts / GRAM
    chosen = np.arange(p.shape[1])
    share, value = _em(p, weight, np.full(len(chosen), 1 / len(chosen)))
    while len(chosen) > 1:
        rest = np.delete(np.arange(len(chosen)), np.argmin(share))
        start = share[rest] + 1e-6
        fewer, lower = _em(p[:, chosen[rest]], weight, start / start.sum())
        if lower + penalty < value:
            break
        chosen, share, value = chosen[rest], fewer, lower
    if len(chosen) == 1:
        chosen = np.array([best])
    out = np.zeros(p.shape[1])
    out[chosen] = share if len(chosen) > 1 else 1.0
    return out


def _predictor(model: LanguageModel):
    log_p, names = model.log_p, np.array(model.languages, dtype=object)

    def work(texts: pa.Array):
        n = len(texts)
        lang = np.full(n, UNKNOWN, dtype=object)
        score, grams, number = np.zeros(n), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int32)
        mixture = np.full(n, "", dtype=object)
        lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        for a, b, data, offsets in kernels.pieces(_lowered(texts)):
            if not len(names):
                break
            bucket, starts = _grams(data, offsets)
            sizes = np.diff(np.append(starts, len(bucket)))
            ll = np.stack([np.add.reduceat(row[bucket], starts, dtype=np.float64) for row in log_p], axis=1) / GRAM
            best = ll.argmax(axis=1)
            odds = np.exp(ll - ll.max(axis=1, keepdims=True))
            sure = 1 / odds.sum(axis=1)
            penalty = 2.0 + np.log(np.maximum(sizes, 2))
            bound = np.zeros(b - a)
            for m in range(len(names)):
                slope = np.empty(len(bucket), dtype=np.float32)
                for l in np.unique(best):
                    ratio = np.exp(log_p[m] - log_p[l])
                    for i in np.flatnonzero(best == l):
                        s = starts[i]
                        np.take(ratio, bucket[s : s + sizes[i]], out=slope[s : s + sizes[i]])
                gain = (np.add.reduceat(slope, starts, dtype=np.float64) - sizes) / GRAM
                bound = np.maximum(bound, np.where(best == m, 0, gain))
            for i in range(b - a):
                row = a + i
                if not lettered[row]:
                    continue
                grams[row], number[row], first, share = sizes[i], 1, best[i], 1.0
                if bound[i] > penalty[i]:
                    shares = _select(log_p, bucket[starts[i] : starts[i] + sizes[i]], best[i], penalty[i])
                    first = int(shares.argmax())
                    share, number[row] = shares[first], int((shares > 0).sum())
                    order = np.argsort(-shares)[: number[row]]
                    mixture[row] = ",".join(f"{names[k]}:{shares[k]:.3f}" for k in order)
                else:
                    mixture[row] = f"{names[first]}:1.000"
                lang[row] = names[first]
                score[row] = share * (sure[i] if first == best[i] else 1.0)
        return [pa.array(lang, pa.string()), pa.array(score), pa.array(number), pa.array(mixture, pa.string()), pa.array(grams)]

    return work


FIELDS = [
    StructField("lang_pred", StringType()),
    StructField("score", DoubleType()),
    StructField("n_languages", IntegerType()),
    StructField("mixture", StringType()),
    StructField("n_grams", LongType()),
]


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with each text's language and mixture.

    ``lang_pred`` is the language of the largest share, ``und`` for a null text, one without
    a letter, or a model without languages; ``score`` is that share times the probability of
    the language among single ones (0 for ``und``); ``mixture`` lists language:share by
    falling share.  Ties go to the language first in the alphabet.  Whole texts are used.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return annotate(docs, text, lambda: _predictor(shared.value), FIELDS, keep)


def training_row(doc_id: Column) -> Column:
    """Rows the query may learn from: crc32 of the id modulo 4 is not 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Languages of all documents from a model of the training rows among them."""
    model = learn(docs.filter(training_row(F.col("doc_id"))))
    out = predict(docs.select("doc_id", "text"), model)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return out.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), *[f.name for f in FIELDS])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognisable language; texts without a letter go."""
    model = learn(docs.filter(training_row(F.col("doc_id"))))
    return kept_rows(docs, lambda df, text, keep: predict(df, model, text, keep), f"lang_pred <> '{UNKNOWN}'")
