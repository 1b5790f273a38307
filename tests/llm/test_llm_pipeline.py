"""The pipeline stage by stage, and the registered queries on the small tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from check import compare, oracle  # noqa: E402
from tallyforge.llm import jaccard, pii, quality  # noqa: E402
from tallyforge.llm.queries import JSON, ORACLES, QUERIES  # noqa: E402

from test_llm_pairs import brute_docs  # noqa: E402
from test_llm_text import brute_lines, brute_spans, check_packing  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_the_queries_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES) <= names


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_with_sql(spark, name):
    assert compare(QUERIES[name](spark, SF), oracle(SF), ORACLES[name]).startswith("ok")


def test_query_of_the_join_is_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op9_ngram_jaccard"](spark, SF).collect()
    assert {r.doc_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_docs(docs)


def test_stages_against_plain_code(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near_copies", "personal_data", "packing"]

    good = stage["quality"](spark, docs, SF)
    field = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r.doc_id: r.score for r in quality.score_docs(docs, field).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.7} and good.columns == docs.columns

    bare = stage["lines"](spark, good, SF)
    want = brute_lines([(r.doc_id, r.text) for r in good.collect()])
    import hashlib

    rows = bare.collect()
    assert bare.columns == docs.columns and all(hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id][2] and r.n_chars == len(r.text) for r in rows)

    alone = stage["near_copies"](spark, bare, SF)
    kept = brute_docs({r.doc_id: r.text for r in rows})
    assert {r.doc_id for r in alone.collect()} == {i for i, (_, _, k) in kept.items() if k} and alone.columns == docs.columns

    masked = stage["personal_data"](spark, alone, SF)
    assert masked.columns == docs.columns and masked.count() == alone.count()
    assert not any(brute_spans(r.text or "") for r in masked.collect())

    pieces = stage["packing"](spark, masked, SF)
    check_packing(pieces.collect(), {r.doc_id: r.text for r in masked.collect()})


def test_run_is_its_stages(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and JSON.endswith(".json")


def test_extra_columns_named_like_results_stay(spark):
    schema = "doc_id bigint, text string, n_lines string, n_dropped int, `a.b` string, score string, __rest string"
    line = "this very line stands in many documents, so it goes."
    docs = spark.createDataFrame([(k, f"{line}\nown line {k}", "keep me", k, "dots", "s", "r") for k in range(6)], schema)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        rows = stage(spark, docs, SF).collect()
        assert rows and all((r.n_lines, r.n_dropped, r["a.b"], r.score, r["__rest"]) == ("keep me", r.doc_id, "dots", "s", "r") for r in rows), name
    assert {r.text for r in corpus_pipeline.without_repeated_lines(spark, docs, SF).collect()} == {*(f"own line {k}" for k in range(5)), f"{line}\nown line 5"}


def test_stages_take_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, spans string"
    rows = [(1, None, None, None, None, None, None), (2, "", "en", "s", 0, 1.0, "x"), (3, "some plain words stand in this line.", None, None, 36, None, None),
            (3, "some plain words stand in this line.", None, None, 36, None, None), (None, "a line without an id, at 10.1.2.3", None, None, 33, None, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns, name
            stage(spark, docs, SF).count()
        assert corpus_pipeline.packed(spark, docs, SF).count() == docs.count()
    assert jaccard.WORDS == 5 and jaccard.THRESHOLD == 0.8 and pii.KINDS[0] == "email"
