"""Small tables with every oddity the operators must bear."""

from __future__ import annotations

import random
import re
import zlib

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

# Names that operators use for their own columns.
CLASHING = "score, kept, label, copy, regions, weight, held_out, node, key, runs, ids, spans, _source, _steps, _parts, _u, _times, text_, lang_pred, predicted, one"


def words(text: str | None) -> list[str]:
    return SPACE.findall((text or "").translate(LOWER))


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode())


def sentence(seed: int, n: int = 30) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(n))


def odd_rows() -> list[tuple]:
    long = sentence(7, 60_000)
    rows = [
        (0, None, "en", "a"),
        (1, "", "en", "a"),
        (2, " \t\n\x0b ", "de", None),
        (3, "Word", None, "b"),
        (4, long, "en", "b"),
        (5, sentence(1), "en", "b"),
        (6, sentence(1), "en", "b"),
        (6, sentence(1), "en", "b"),
        (7, sentence(1) + " more", "fr", "b"),
        (None, sentence(2), "en", "b"),
        (None, None, None, None),
        (8, "12 34 ... !!", "en", "b"),
        (9, "퟿ \U0001f600 é́ ﬁ İ", "es", "c"),
    ]
    return rows


def frame(spark: SparkSession, rows: list[tuple], clash: bool = True) -> DataFrame:
    df = spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    if clash:
        for name in CLASHING.split(", "):
            df = df.selectExpr("*", f"'mine' AS {name}")
    return df


def write_tables(spark: SparkSession, folder: str, docs: DataFrame, empty: bool = False) -> str:
    """Documents with labels, pages and benchmark beside them, as a query reads them."""
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(5, 1, 0), (6, 0, 1), (6, 0, 1), (7, None, None), (None, 1, 1), (99, 1, 1)]
    pages = [(0, "u", None), (1, None, ""), (2, "u", "<p>one &amp; two"), (2, "u", "<p>one &amp; two"), (None, "u", "<")]
    turns = [(0, 0, "user", "hi"), (0, None, None, "x"), (0, None, None, "x"), (1, 0, "user", None), (None, 0, "user", "hi")]
    turns += [(205, 3, "user", ""), (-7, 1, "bot", sentence(3, 5000))]
    items = [(0, None), (1, ""), (2, "short"), (3, sentence(5, 40))]
    for name, rows, schema in (
        ("labels", labels, "doc_id bigint, quality int, toxic int, score string"),
        ("pages", pages, "page_id bigint, url string, html string, text string"),
        ("benchmark", items, "item_id bigint, text string, regions string"),
        ("conversations", turns, "conv_id bigint, turn bigint, role string, text string, depth string"),
    ):
        rows = [] if empty else [(*r, "mine") for r in rows]
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder
