"""Nulls, empty and very long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm import tables
from tidemark.llm.queries import QUERIES

ROWS = tables.odd_rows()


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("odd"))
    return tables.write_tables(spark, folder, tables.frame(spark, ROWS))


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    return tables.write_tables(spark, folder, tables.frame(spark, []), empty=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


PER_DOCUMENT = [n for n in QUERIES if not n.startswith(("op3_", "op7_", "op13_"))]


@pytest.mark.parametrize("name", sorted(PER_DOCUMENT))
def test_one_row_per_document(spark, odd, name):
    ids = sorted((r["doc_id"] for r in QUERIES[name](spark, odd).select("doc_id").collect()), key=str)
    assert ids == sorted((r[0] for r in ROWS), key=str)


def by_id(spark, folder, name):
    return {r["doc_id"]: r.asDict() for r in QUERIES[name](spark, folder).collect() if r["doc_id"] is not None}


def test_language_of_odd_texts(spark, odd):
    got = by_id(spark, odd, "op1_language_id")
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (0, 1, 2, 8))
    assert got[4]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_model_scores_of_odd_texts(spark, odd):
    got = by_id(spark, odd, "op2_kneser_ney")
    assert all(got[i]["n_tokens"] == 1 for i in (0, 1, 2)) and got[4]["n_tokens"] == 60_001
    assert got[0]["score"] == got[1]["score"] < 0


def test_pages(spark, odd):
    rows = [tuple(r) for r in QUERIES["op3_html_main_text"](spark, odd).collect()]
    assert sorted(rows, key=str) == sorted(
        [(0, "u", "", 0), (1, None, "", 0), (2, "u", "one & two", 9), (2, "u", "one & two", 9), (None, "u", "<", 1)], key=str
    )


def test_near_duplicates_of_odd_texts(spark, odd):
    got = by_id(spark, odd, "op4_minhash_near_dup")
    assert {i: r["component_id"] for i, r in got.items()} == {**{i: i for i in range(10)}, 6: 5, 7: 5}
    assert [got[i]["n_shingles"] for i in (0, 1, 2, 3)] == [0, 0, 0, 1]
    assert sorted(i for i, r in got.items() if not r["kept"]) == [6, 7]


def test_rules_of_odd_texts(spark, odd):
    got = by_id(spark, odd, "op5_quality_rules")
    assert all(got[i]["base_failed"] and not got[i]["kept"] for i in (0, 1, 2, 3, 8))
    assert got[4]["n_words"] == 60_000 and got[5]["kept"]


def test_scores_without_labels_are_the_same_for_all(spark, odd):
    for name in ("op6_toxicity", "op10_quality_classifier"):
        rows = QUERIES[name](spark, odd).collect()
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixing_draws_repeated_rows_alike(spark, odd):
    rows = QUERIES["op7_mixing"](spark, odd).collect()
    assert all(r["score"] == "mine" for r in rows)
    times = {}
    for r in rows:
        times.setdefault((r["doc_id"], r["text"]), []).append(r["copy"])
    for (doc_id, _), copies in times.items():
        each = 2 if doc_id == 6 else 1
        assert sorted(copies) == sorted(list(range(len(copies) // each)) * each)


def test_stages_keep_columns_and_apply_their_decisions(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, odd)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        rows = docs.collect()
        assert all(r["label"] == "mine" for r in rows)
        kept[name] = sorted(r["doc_id"] for r in rows if r["doc_id"] is not None)
    assert kept["language_id"] == [3, 4, 5, 6, 6, 7, 9]
    assert kept["near_dedup"] == kept["decontamination"] == [3, 4, 5, 9]


def test_pipeline_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_documents_stay_without_labels_to_learn_from(spark, tmp_path):
    from tidemark.llm import toxicity

    texts = ["a clean text", "you idiot", "by the trash can", *(f"idiot number {k}" for k in range(20))]
    docs = tables.frame(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])
    for rows in ([], [(99, 1)], [(0, 0)], [(k, 1) for k in range(1, 23) if k != 2]):
        labels = spark.createDataFrame(rows, "doc_id bigint, toxic int")
        got = {r["doc_id"]: r["predicted"] for r in toxicity.classify(docs, labels).collect()}
        assert got == {k: int(k not in (0, 2)) for k in range(23)}
    folder = tables.write_tables(spark, str(tmp_path), tables.frame(spark, ROWS), empty=True)
    assert len(toxicity.stage(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()) == len(ROWS)
    assert corpus_pipeline.run(spark, folder).count() > 0


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    from tidemark.llm import neardup

    docs = tables.frame(spark, [(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (2, "x", "en", "s"), (None, "y", "en", "s")])
    rows = neardup.stage(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows if r["doc_id"]) == [(1, "a b c"), (2, "x")] and len(rows) == 3


def test_near_duplicates_of_an_id_with_two_texts_in_any_order(spark):
    from tidemark.llm import neardup

    a, b = tables.sentence(1, 60), tables.sentence(2, 60)
    rows = [(5, a, "en", "s"), (5, b, "en", "s"), (6, a + " x", "en", "s"), (7, b + " x", "en", "s"), (8, tables.sentence(3), "en", "s")]
    rows += [(5, a, "en", "s"), (9, b, "en", "s")]
    sizes = {k: len({*zip(*(t.split()[i:] for i in range(5)))}) for k, t in ((6, a), (7, b))}
    found = []
    for order in (rows, rows[::-1], [*rows[3:], *rows[:3]]):
        docs = tables.frame(spark, order).repartition(1)
        found.append(sorted((r["doc_id"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs).collect()))
    assert found[0] == found[1] == found[2] and len(found[0]) == len(rows)
    of = {i: c for i, c, _ in found[0]}
    # one of the two texts counts for id 5, and for all its rows
    assert sizes and sorted(c for c in (of[6], of[7])) in ([5, 6], [5, 7]) and of[8] == 8 and of[9] == of[7]
    assert len({c for i, c, _ in found[0] if i == 5}) == 1
