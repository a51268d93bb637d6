"""Registered corpus queries and the pipeline, on the smallest driver tables."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2] / "tools"))

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
from ledgerline.llm import chunks, neardup  # noqa: E402
from ledgerline.llm.oracle import SQL  # noqa: E402
from ledgerline.llm.workload import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).is_dir(), reason="driver tables are not here")


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare.difference(spark, compare.duck(SF_DIR), SF_DIR, name, SQL[name]) is None


@pytest.mark.parametrize("name", ["op1_imatch", "op5_external_shuffle"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_pipeline_stages(spark, docs):
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = frame.columns, {r["doc_id"]: r["text"] for r in frame.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = chunks.written(stage(spark, frame, SF_DIR), "stage")
        if name != "bpe":
            assert after.columns == columns
        kept = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert kept <= {r["doc_id"] for r in frame.select("doc_id").collect()}
        if name == "near_duplicates":
            assert neardup.near_duplicates(after, 5).filter("NOT kept").count() == 0
            assert kept
        if name in ("secrets", "bpe"):
            assert len(kept) == frame.count()
        frame = after
    assert set(frame.columns) >= {"doc_id", "n_tokens", "ids"} and 0 < frame.count() <= len(before)


def test_pipeline_on_odd_rows(spark, odd):
    frame = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = chunks.written(stage(spark, frame, SF_DIR), "stage")
        assert frame.columns == odd.columns
    ids = [r["doc_id"] for r in frame.collect()]
    assert set(ids) == {None, 1, 2, 3, 4, 7, 8}
    assert corpus_pipeline.encode(spark, frame, SF_DIR).count() == len(ids)
