"""Quality rules as a ledger: measure once, keep one bit per failed rule, apply policies later.

Only DataFrame functions.  ``measure`` reads each text once; everything after it works on a
few numbers per document, so policies can be changed and compared without reading text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import SPACE_RUN, SPACES, whole, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Name and failing condition of each rule over the measurements; the position is the bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("few_letters", "2 * n_letters < word_chars"),
    ("shouting", "2 * n_exclamations > n_words"),
)

#: Policies by version: the rules that reject a document.  Old versions stay, so that a
#: ledger written earlier can still be read under the policy of its time.
POLICIES: Mapping[str, tuple[str, ...]] = {
    "v1": ("few_words", "repeated_windows"),
    "v2": tuple(name for name, _ in RULES),
}
BASE = POLICIES["v1"]


def mask_of(names: tuple[str, ...]) -> int:
    known = [name for name, _ in RULES]
    return sum(1 << known.index(name) for name in names)


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of measurements per row of ``docs``: its id and long counts.

    A null text has no words and counts zero everywhere.  Repeated rows are measured each
    on its own; other columns of ``docs`` are not read.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("_t"))
    lines = F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = base.select("doc_id", "_t", words_of(F.col("_t")).alias("_w"), lines.alias("_l"))
    hashes = F.when(
        F.size("_w") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size("_w") - WINDOW),
            lambda i: F.xxhash64(*(F.get("_w", i + k) for k in range(WINDOW))),
        ),
    )
    counted = split.select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACES, "")).cast("long").alias("word_chars"),
        _occurrences("_t", SYMBOLS).alias("n_symbols"),
        _occurrences("_t", "!").alias("n_exclamations"),
        F.length(F.regexp_replace("_t", r"\P{L}+", "")).cast("long").alias("n_letters"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        hashes.alias("_h"),
    )
    kept = [c for c in counted.columns if not c.startswith("_")]
    # Sorting is only needed where some window occurs twice.
    placed = counted.select(
        *kept,
        F.when(
            F.size("_h") > F.size(F.array_distinct("_h")),
            F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_s"),
    )
    twice = placed.select(
        *kept,
        F.sort_array(
            F.transform(
                F.filter(
                    "_s",
                    lambda x, i: ((i > 0) & (F.get("_s", i - 1)["h"] == x["h"]))
                    | F.coalesce(F.get("_s", i + 1)["h"] == x["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ).alias("_p"),
    )
    covered = F.aggregate(
        F.transform(
            "_p",
            lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_p", k + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return twice.select(*kept, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def _occurrences(text: str, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def ledger(measured: DataFrame) -> DataFrame:
    """The measurements with ``fail_bits``: bit k is set if rule k fails."""
    bits = F.lit(0).cast("long")
    for k, (_, condition) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, version: str = "v2") -> DataFrame:
    """The ledger with ``base_failed``, ``kept`` and the policy's version."""

    def fails(names: tuple[str, ...]) -> Column:
        return F.col("fail_bits").bitwiseAND(F.lit(mask_of(names))) != 0

    return entries.select(
        "*",
        fails(BASE).alias("base_failed"),
        (~fails(BASE) & ~fails(POLICIES[version])).alias("kept"),
        F.lit(version).alias("policy"),
    )


def ablation(entries: DataFrame, version: str = "v2") -> DataFrame:
    """What each rule of a policy does: documents failing it, and failing nothing else.

    One aggregation over the bits, combined before the shuffle; a row per rule whatever
    the ledger holds, also when it is empty.
    """
    mask = mask_of(POLICIES[version])
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask))
    sums = entries.agg(
        *(
            F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).alias(f"{kind}_{name}")
            for k, (name, _) in enumerate(RULES)
            if mask >> k & 1
            for kind, condition in (
                ("all", failed.bitwiseAND(F.lit(1 << k)) != 0),
                ("only", failed == F.lit(1 << k)),
            )
        )
    )
    rows = [
        F.struct(
            F.lit(name).alias("rule"), F.col(f"all_{name}").alias("failed"), F.col(f"only_{name}").alias("only_this")
        )
        for name in POLICIES[version]
    ]
    return sums.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def score(docs: DataFrame, version: str = "v2") -> DataFrame:
    return apply_policy(ledger(measure(docs)), version)


ORACLE = rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACE_RUN}'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
h AS (
  SELECT *, list_transform(range(0, len(w) - 4),
                           lambda i: array_to_string(w[i + 1:i + 5], ' ')) AS h FROM t),
x AS (
  SELECT doc_id, i, s FROM (
    SELECT doc_id, unnest(h) AS s, unnest(range(0, len(h))) AS i FROM h)),
f AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM x) WHERE n > 1),
r AS (
  SELECT doc_id, sum(n) AS n FROM (
    SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS n FROM f)
  GROUP BY doc_id),
m AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '{SPACE_RUN}', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
         (length(t) - length(translate(t, '!', '')))::BIGINT AS n_exclamations,
         length(regexp_replace(t, '\P{{L}}+', '', 'g'))::BIGINT AS n_letters,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN r ON r.doc_id = t.doc_id),
b AS (
  SELECT *, ({" + ".join(f"CASE WHEN {c} THEN {1 << k} ELSE 0 END" for k, (_, c) in enumerate(RULES))})::BIGINT
            AS fail_bits FROM m)
SELECT *, (fail_bits & {mask_of(BASE)}) <> 0 AS base_failed, fail_bits = 0 AS kept, 'v2' AS policy FROM b
"""
