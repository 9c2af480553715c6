"""Periodic runs against a scan of every period."""

from __future__ import annotations

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest

from tests.llm import tables
from tidemark.llm import runs
from tidemark.llm.queries import QUERIES


def scan(w, min_length: int = 24, min_exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period): for every period the stretches that keep it, by their smallest period."""
    found = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(min_length, min_exponent * q):
                found.setdefault((i, length), q)
            i = max(j, i + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, words: list[str]) -> list[str]:
    n, h = len(words), tables.crc(doc_id)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text: str | None) -> tuple:
    words = tables.SPACE.findall(text or "")
    words = planted(doc_id, words) if doc_id is not None else words
    found = scan(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_small_alphabets():
    draw = random.Random(11)
    for _ in range(1500):
        w = [draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(draw.randint(0, 90))]
        if len(w) > 4 and draw.random() < 0.6:
            a = draw.randrange(len(w))
            p = draw.randint(1, max(1, (len(w) - a) // 2))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            if draw.random() < 0.4:
                w[draw.randrange(len(w))] = 9
        for limits in ((24, 3), (4, 2), (6, 3), (2, 2)):
            found = [tuple(r) for r in runs.find_runs(np.array(w, dtype=np.int64), *limits).tolist()]
            assert found == scan(w, *limits), (w, limits)


@pytest.mark.parametrize("w", [[0] * 150_000, [i % 7 for i in range(150_000)], [*range(50_000)] * 3])
def test_long_texts_with_one_run(w):
    period = next(p for p in (1, 7, 50_000) if w[0] == w[p])
    assert runs.find_runs(np.array(w)).tolist() == [[0, 150_000, period]]


def test_positions_in_order():
    draw = random.Random(5)
    numbers = draw.sample(range(10_000), 5000)
    held, all_ = runs.Positions(numbers[0]), [numbers[0]]
    for x in numbers[1:]:
        before, after = held.add(x)
        assert before == max((y for y in all_ if y < x), default=None)
        assert after == min((y for y in all_ if y > x), default=None)
        all_.append(x)
        if len(all_) > 300 and draw.random() < 0.9:
            break
    for x in numbers[len(all_) :]:
        held.add(x)
    assert list(held) == sorted(numbers)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_like_the_scan(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if len(r["text"] or "") < 20_000}
    names = "n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256".split(", ")
    checked = 0
    for row in QUERIES["op11_periodic_runs"](spark, folder).collect():
        if row["doc_id"] in texts:
            assert tuple(row[n] for n in names) == expected(row["doc_id"], texts[row["doc_id"]]), row["doc_id"]
            checked += row["n_runs"] > 0
    assert checked > 5


def test_odd_rows(spark, tmp_path):
    rows = [r for r in tables.odd_rows() if r[0] != 4]
    rows += [(100 + k, " ".join(["a b"] * k), "en", "s") for k in (11, 12, 400)]
    rows += [(None, "é x " * 30, "en", "s"), (3, "Word", None, "b")]
    folder = tables.write_tables(spark, str(tmp_path), tables.frame(spark, rows))
    found = QUERIES["op11_periodic_runs"](spark, folder).collect()
    names = "n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256".split(", ")
    got = sorted(((r["doc_id"], *(r[n] for n in names)) for r in found), key=str)
    assert got == sorted(((r[0], *expected(r[0], r[1])) for r in rows), key=str)


def test_general_operator_keeps_texts(spark):
    df = spark.createDataFrame([(1, "x a b a b a b y", "mine"), (2, None, "mine")], "id int, t string, runs string")
    found = {r["id"]: r.asDict(True) for r in runs.periodic_runs(df, "t", ("id", "runs"), 4, 2).collect()}
    assert found[1]["runs"] == [{"start": 1, "length": 6, "period": 2}] and found[1]["collapsed"] == "x a b y"
    assert found[2]["runs"] == [] and found[2]["collapsed"] == ""
