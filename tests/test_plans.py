"""Plan checks: pruning and pushdown reach the scan, aggregates are two-phase,
top-n is bounded; and of what was executed: no Cartesian product, texts tokenized
once, lines parsed once."""

import contextlib
import io
import json
import os
import pathlib
import subprocess
import sys

import pytest

import __spark_entry__ as se

from conftest import SF_SMALL


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_flagship_plan(spark):
    text = plan_text(se.entry(spark))
    assert "partial_count" in text
    assert "TakeOrderedAndProject" in text
    assert ("ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,"
            "event_type:string,value:double>") in text            # props never read


def test_pruning_into_scan(spark):
    text = plan_text(se.queries()["item_rating_stats"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text


def test_filters_pushed_into_scan(spark):
    text = plan_text(se.queries()["filter_chain"](spark, SF_SMALL))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    assert "GreaterThan(l_quantity,10.0)" in pushed
    assert "LessThan(l_discount,0.05)" in pushed


def test_no_python_udf_in_text_pipeline(spark):
    text = plan_text(se.queries()["cosine_inverted"](spark, SF_SMALL), "extended")
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


# Joins with a one-row table (a total, a count, the new user) have no key: the only
# nested loops there may be, in these queries.
ONE_ROW = {"als_new_user", "als_new_user_pairs", "als_normal_residual", "cosine_pair", "gold_evaluation", "idf_weights",
           "lowest_idf_tokens", "idf_histogram", "mean_baseline_rmse", "recommend_top_n", "recommend_unrated",
           "recommend_unrated_pairs"}
TEXT = ["cosine_inverted", "gold_evaluation", "idf_histogram", "inverted_index", "join_left_default", "shared_tokens",
        "sparse_dot", "tfidf_weights", "threshold_prf", "vector_norms"]


@pytest.fixture(scope="module")
def executed(tmp_path_factory):
    """The plans that every query of the library really ran, from an event log."""
    out = tmp_path_factory.mktemp("plans") / "plans.json"
    root = pathlib.Path(__file__).resolve().parent.parent
    from tessera.plans import QUERIES
    run = subprocess.run([sys.executable, str(root / "tools" / "executed.py"), SF_SMALL, str(out), *sorted(QUERIES)],
                         timeout=900, capture_output=True, text=True, cwd=out.parent,
                         env={**os.environ, "PYTHONPATH": str(root)})
    assert run.returncode == 0, run.stderr[-3000:]
    return json.loads(out.read_text())


def test_no_cartesian_product_in_executed_plans(executed):
    from tessera.plans import QUERIES
    assert set(executed) == set(QUERIES)
    for name, plans in executed.items():
        for plan in plans:
            assert "CartesianProduct" not in plan, name
            assert "NestedLoop" not in plan or name in ONE_ROW, (name, plan)


@pytest.mark.parametrize("name", TEXT)
def test_documents_are_tokenized_once(executed, name):
    """Over all jobs of a query, those behind written tables included, the tokenizer
    stands in one plan, once for each of the two tables."""
    found = [plan for plan in executed[name] if "split(lower(text" in plan]
    assert len(found) == 1 and "documents.parquet" in found[0], (name, len(found))
    assert found[0].count("split(lower(text") == 2


def test_load_parses_once(executed):
    parses = [plan for plan in executed["clf_load_report"] if plan.count("regexp_replace(")]
    assert len(parses) == 1 and "CollectMetrics" in parses[0]


def test_histogram_is_one_job(executed):
    assert len(executed["idf_histogram"]) == 1
