"""Quality by compression: which of two dictionaries shortens a text more.

One zstandard dictionary is trained on good texts and one on bad ones.  A text is cut into
blocks, each block compressed on its own with either dictionary, so that the dictionaries
matter in every part of a long text.  The difference of the two sizes over their sum is the
only feature; a logistic curve fitted on labelled texts that trained no dictionary turns
it into a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField

from tidemark.llm import labelled
from tidemark.llm.batches import annotate

BLOCK = 512
LEVEL = 3
DICTIONARY_BYTES = 32 * 1024
ROWS_PER_CLASS = 4000
THRESHOLD = 0.3


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def _blocks(data: bytes):
    return (data[i : i + BLOCK] for i in range(0, len(data), BLOCK))


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = [b for t in texts for b in _blocks(t)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, blocks).as_bytes()
    except zstandard.ZstdError:  # too few texts to train on: they are the dictionary themselves
        return b"".join(blocks)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    if held is not None:
        held.precompute_compress(level=LEVEL)
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, **options)


class Measure:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, model: CompressionModel) -> None:
        self.good, self.bad = _compressor(model.good), _compressor(model.bad)

    def sizes(self, text: str | None) -> tuple[int, int]:
        good = bad = 0
        for block in _blocks((text or "").encode("utf-8", "surrogatepass")):
            good += len(self.good.compress(block))
            bad += len(self.bad.compress(block))
        return good, bad


def difference(sizes: np.ndarray) -> np.ndarray:
    """(bad - good) / (bad + good): positive where the good dictionary wins; 0 for an empty text."""
    total = sizes.sum(axis=1)
    return (sizes[:, 1] - sizes[:, 0]) / np.maximum(total, 1)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> CompressionModel:
    """Fit on a sample of at most ``rows_per_class`` rows of each class.

    Two thirds train the dictionaries, the rest the curve.  The sample, bounded by
    ``labelled.sample``, is all that reaches the driver.
    """
    rows = labelled.sample(docs, labels, label, rows_per_class, "compression").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["place"], str(r["doc_id"]), r["text"]))
    fit = [r for k, r in enumerate(rows) if k % 3]
    curve = rows[::3]
    texts = [[r["text"].encode("utf-8", "surrogatepass") for r in fit if r["label"] == v] for v in (0, 1)]
    model = CompressionModel(_dictionary(texts[1]), _dictionary(texts[0]), ())
    measure = Measure(model)
    sizes = np.array([measure.sizes(r["text"]) for r in curve], dtype=np.float64).reshape(-1, 2)
    y = np.array([r["label"] for r in curve], dtype=np.float64)
    x = difference(sizes)[:, None]
    weights = labelled.fit_logistic(x, y)
    return CompressionModel(model.good, model.bad, tuple(weights))


FIELDS = [
    StructField("score", DoubleType()),
    StructField("predicted", IntegerType()),
    StructField("good_bytes", LongType()),
    StructField("bad_bytes", LongType()),
]


def predict(docs: DataFrame, model: CompressionModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with score, prediction and both compressed sizes of each whole text.

    A null or empty text has sizes 0 and the score of a difference of 0.  Without labels
    of both classes every score is the smoothed share of ones among the labels.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        held = shared.value
        measure, weights = Measure(held), np.array(held.weights)

        def work(texts: pa.Array):
            sizes = np.array([measure.sizes(t.as_py()) for t in texts], dtype=np.int64).reshape(-1, 2)
            score = labelled.logistic(difference(sizes)[:, None], weights)
            predicted = (score >= THRESHOLD).astype(np.int32)
            return [pa.array(score), pa.array(predicted), pa.array(sizes[:, 0]), pa.array(sizes[:, 1])]

        return work

    return annotate(docs, text, make, FIELDS, keep)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from the labelled ones that may be learned from."""
    model = learn(docs, labels.filter(labelled.learning_row(F.col("doc_id"))))
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), *[f.name for f in FIELDS])
