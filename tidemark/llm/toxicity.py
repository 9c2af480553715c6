"""Toxicity by a weighted lexicon found with an Aho-Corasick automaton.

Texts are folded first: lower case, accents off, look-alike letters and digits replaced.
The lexicon is learned in folded form: words, and stems of words, that mark labelled
texts as toxic, each weighted by its log-odds.  Words below a stem that mark harmless
texts, and fixed harmless phrases, are exceptions and cancel what they cover.  The summed
weight, also in relation to the length of the text, becomes a score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField

from tidemark.llm import labelled
from tidemark.llm.batches import annotate, kept_rows
from tidemark.llm.storage import stored

ROWS_PER_CLASS = 6000
THRESHOLD = 0.5
SHORTEST_STEM = 4
LONGEST_STEM = 8
MIN_DOCS = 5
MIN_WEIGHT = 1.5
MIN_EVIDENCE = 24.0  # twice the log-likelihood ratio: about one chance in a million per form

# Letters of other scripts that look like Latin ones, and digits read as letters.
# l and i share a form because 1 stands for either.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "i", "м": "m",
    "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ᴀ": "a", "ʙ": "b", "ᴄ": "c", "ᴅ": "d", "ᴇ": "e", "ꜰ": "f", "ɢ": "g", "ʜ": "h", "ɪ": "i", "ᴊ": "j", "ᴋ": "k", "ʟ": "i",
    "ᴍ": "m", "ɴ": "n", "ᴏ": "o", "ᴘ": "p", "ʀ": "r", "ꜱ": "s", "ᴛ": "t", "ᴜ": "u", "ᴠ": "v", "ᴡ": "w", "ʏ": "y", "ᴢ": "z",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "i",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "l": "i"}
SIGNS = {"@": "a", "$": "s"}
# Insults known beforehand; they count until the labels speak against them.
SEEDS = "idiot moron imbecile stupid scum loser trash worthless pathetic disgusting clown dumbass retard scumbag".split()
SEED_WEIGHT = 3.0
#: Without labels of both classes: 0.94 at a single seed, 0.06 at none.
SEED_CURVE = (4.0, 0.0, -2 * math.log1p(SEED_WEIGHT))
HARMLESS = ("trash can", "trash bin", "trash bag", "clown fish", "class clown", "pathetic fallacy", "idiot proof")


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for code in [*range(0x00, 0x250), *range(0x1E00, 0x1F00), *range(0xFF01, 0xFF5F)]:
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c)).lower()
        table[code] = plain if plain.isalnum() and plain.isascii() else chr(code) if chr(code).isalnum() else " "
    for code in [0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF, *range(0x300, 0x370)]:
        table[code] = None
    for code in [*range(0x2010, 0x2070), *range(0x3000, 0x3004)]:
        table.setdefault(code, " ")
    for source in (HOMOGLYPHS, DIGITS):
        for a, b in source.items():
            table[ord(a)] = b
    for code, plain in list(table.items()):
        if plain:
            table[code] = plain.replace("l", "i")
    return table


_TABLE = _fold_table()
_SIGN = re.compile(r"[@$](?=\w)")


def fold(text: str | None) -> str:
    """The folded text: words of letters between single or repeated spaces, one at each end."""
    if not text:
        return " "
    # letters in circles, of mathematical alphabets, raised and lowered ones become plain
    low = (text if text.isascii() else unicodedata.normalize("NFKD", text)).lower()
    if "@" in low or "$" in low:
        low = _SIGN.sub(lambda m: SIGNS[m[0]], low)
    return f" {low.translate(_TABLE)} "


@dataclass(frozen=True)
class Lexicon:
    """Patterns with their weights, exceptions, and the curve from weight to score.

    A pattern starts with a space; a whole word ends with one, a stem does not.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...]
    curve: tuple[float, ...]


def _count_task(batches):
    """Per task: how many documents of each class hold a word, or a stem (marked by a star)."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set(fold(text).split())
            stems = {w[:k] + "*" for k in range(SHORTEST_STEM, LONGEST_STEM + 1) for w in found if len(w) >= k}
            seen[label].update(found)
            seen[label].update(stems)
    both = [w for w in seen[0].keys() | seen[1].keys()]
    for at in range(0, len(both), 50_000):
        part = both[at : at + 50_000]
        counts = [pa.array([seen[v][w] for w in part], pa.int64()) for v in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *counts], names=["form", "harmless", "toxic"])


def _choose(counts: dict[str, tuple[int, int]], n: tuple[int, int]) -> tuple[dict[str, float], tuple[str, ...]]:
    """Lexicon and learned exceptions from document counts (harmless, toxic) by form."""

    def weight(form: str) -> float:
        a, b = counts[form]
        return math.log((b + 0.5) / (n[1] + 1)) - math.log((a + 0.5) / (n[0] + 1))

    def marks(form: str) -> bool:
        a, b = counts[form]
        if b < MIN_DOCS or weight(form) < MIN_WEIGHT:
            return False
        share = n[1] / (n[0] + n[1])
        evidence = b * math.log(b / ((a + b) * share))
        if a:
            evidence += a * math.log(a / ((a + b) * (1 - share)))
        return 2 * evidence >= MIN_EVIDENCE

    children: dict[str, list[str]] = {}
    for form in counts:
        if form.endswith("*"):
            children.setdefault(form[:-2] + "*", []).append(form)
            if len(form) - 1 >= SHORTEST_STEM:
                children.setdefault(form, [])
        elif len(form) >= SHORTEST_STEM:
            children.setdefault(form[:LONGEST_STEM] + "*", []).append(form)
            if len(form) < LONGEST_STEM:
                children[form + "*"] = children.get(form + "*", [])
    weights: dict[str, float] = {}
    exceptions: list[str] = []

    def below(stem: str) -> list[str]:
        longer = [x for x in children.get(stem, []) if x != stem]
        word = stem[:-1]
        if word in counts and word not in longer:
            longer = [*longer, word]
        return longer

    def walk(form: str) -> None:
        word = not form.endswith("*")
        if not marks(form):
            if not word:
                for child in below(form):
                    if counts[child][1] >= MIN_DOCS:
                        walk(child)
            return
        # A stem carried by a single longer form is no stem yet.
        while not word:
            main = [c for c in below(form) if c in counts and counts[c][1] >= 0.9 * counts[form][1]]
            if not main:
                break
            form = max(main, key=lambda c: (counts[c][1], c.endswith("*"), c))
            word = not form.endswith("*")
        weights[f" {form} " if word else f" {form[:-1]}"] = weight(form)
        if not word:
            stack = [form]
            while stack:
                for child in below(stack.pop()):
                    a, b = counts[child]
                    if child.endswith("*"):
                        stack.append(child)
                    elif a >= 3 and a / max(n[0], 1) > 2 * b / max(n[1], 1):
                        exceptions.append(f" {child} ")

    for form in sorted(counts):
        if len(form) == SHORTEST_STEM + 1 and form.endswith("*"):
            walk(form)
        elif len(form) < SHORTEST_STEM and not form.endswith("*") and marks(form):
            weights[f" {form} "] = weight(form)
    return weights, tuple(sorted(set(exceptions)))


class Matcher:
    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...]) -> None:
        self.automaton = ahocorasick.Automaton()
        for pattern, value in weights.items():
            self.automaton.add_word(pattern, (len(pattern), value, pattern.strip()))
        for pattern in exceptions:
            self.automaton.add_word(pattern, (len(pattern), None, ""))
        self.ready = len(self.automaton) > 0
        if self.ready:
            self.automaton.make_automaton()

    def find(self, folded: str) -> list[tuple[float, str]]:
        """Weight and form of every match that no exception covers."""
        hits, spared = [], []
        for end, (size, value, form) in self.automaton.iter(folded) if self.ready else ():
            (spared if value is None else hits).append((end - size + 1, end, value, form))
        if spared:
            spared.sort()
            starts = [s[0] for s in spared]
            reach = list(accumulate((s[1] for s in spared), max))  # of all that start so early
            hits = [h for h in hits if not ((k := bisect_right(starts, h[0])) and h[1] <= reach[k - 1] + 1)]
        return [(value, form) for _, _, value, form in hits]


def _features(total: float, n_words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(100 * total / (n_words + 20))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    rows_per_class: int = ROWS_PER_CLASS,
    harmless: tuple[str, ...] = HARMLESS,
    seeds: tuple[str, ...] = tuple(SEEDS),
) -> Lexicon:
    """Learn from at most ``rows_per_class`` labelled rows of each class.

    Forms are counted in tasks and summed by Spark; only forms in at least five toxic
    documents reach the driver, of which there are fewer than words in the sample.
    Seed words that the labels know too little about keep a fixed weight; those that mark
    harmless texts rather are left out.  A second pass over the sample fits the curve
    from weights and lengths.  Without labels of both classes the lexicon is the seeds.
    """
    sampled = labelled.sample(docs, labels, label, rows_per_class, "toxicity").select("text", "label")
    rows = stored(sampled, "toxicity-sample")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    size = (n.get(0, 0), n.get(1, 0))
    counted = rows.mapInArrow(_count_task, "form string, harmless long, toxic long").groupBy("form")
    forms = counted.agg(F.sum("harmless").alias("a"), F.sum("toxic").alias("b"))
    # words of a stem that mark harmless texts are exceptions, so they are needed too
    held = {r["form"]: (r["a"], r["b"]) for r in forms.filter(f"b >= {MIN_DOCS}").toLocalIterator()}
    weights, _ = _choose(held, size)
    stems = [p[1:] for p in weights if not p.endswith(" ")]
    if stems:
        under = F.lit(False)
        for stem in stems:
            under = under | F.col("form").startswith(stem)
        for r in forms.filter(under & (F.col("a") >= 3)).toLocalIterator():
            held[r["form"]] = (r["a"], r["b"])
        weights, exceptions = _choose(held, size)
    else:
        exceptions = ()
    exceptions = (*exceptions, *(fold(phrase) for phrase in harmless))
    wanted = [fold(w).strip() for w in seeds]
    seen = {r["form"]: (r["a"], r["b"]) for r in forms.filter(F.col("form").isin(wanted)).collect()}
    for word in wanted:
        a, b = seen.get(word, (0, 0))
        if (b < MIN_DOCS or not all(size)) and a <= b and not any(f" {word} ".startswith(p) for p in weights):
            weights[f" {word} "] = SEED_WEIGHT
    if not all(size):
        return Lexicon(weights, exceptions, SEED_CURVE)
    found = _measured(rows, Lexicon(weights, exceptions, ()), ("label",)).select("label", "n_words", "weight").toArrow()
    y = found.column("label").to_numpy().astype(np.float64)
    pairs = zip(found.column("weight").to_pylist(), found.column("n_words").to_pylist())
    x = np.array([_features(t, w) for t, w in pairs], dtype=np.float64).reshape(-1, 2)
    return Lexicon(weights, exceptions, tuple(labelled.fit_logistic(x, y)))


FIELDS = [
    StructField("score", DoubleType()),
    StructField("predicted", IntegerType()),
    StructField("n_words", LongType()),
    StructField("weight", DoubleType()),
    StructField("terms", StringType()),
]


def _measured(docs: DataFrame, lexicon: Lexicon, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def make():
        held = shared.value
        matcher = Matcher(held.weights, held.exceptions)
        curve = np.array(held.curve) if held.curve else None

        def work(texts: pa.Array):
            n_words, totals, terms = [], [], []
            for value in texts:
                folded = fold(value.as_py())
                hits = matcher.find(folded)
                n_words.append(len(folded.split()))
                totals.append(sum(max(w, 0.0) for w, _ in hits))
                terms.append(",".join(sorted({form for _, form in hits})))
            x = np.array([_features(t, w) for t, w in zip(totals, n_words)], dtype=np.float64).reshape(-1, 2)
            score = labelled.logistic(x, curve) if curve is not None else np.zeros(len(x))
            return [
                pa.array(score),
                pa.array((score >= THRESHOLD).astype(np.int32)),
                pa.array(n_words, pa.int64()),
                pa.array(totals, pa.float64()),
                pa.array(terms, pa.string()),
            ]

        return work

    return annotate(docs, text, make, FIELDS, keep)


def predict(docs: DataFrame, lexicon: Lexicon, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns with score, prediction, words, summed weight and matched forms.

    A null or empty text has no words and the score of no match.  Without labels of both
    classes a score is at or above 0.5 only where a seed word matches.
    """
    return _measured(docs, lexicon, keep, text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from the labelled ones that may be learned from."""
    lexicon = learn(docs, labels.filter(labelled.learning_row(F.col("doc_id"))))
    out = predict(docs.select("doc_id", "text"), lexicon)
    return out.select("doc_id", labelled.held_out(F.col("doc_id")).alias("held_out"), *[f.name for f in FIELDS])


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, all their columns unchanged."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    lexicon = learn(docs, labels.filter(labelled.learning_row(F.col("doc_id"))))
    return kept_rows(docs, lambda df, text, keep: predict(df, lexicon, text, keep), "predicted = 0")
