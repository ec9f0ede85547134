"""Plan assertions: pushdown, pruning, no row-at-a-time UDFs, no cartesian products."""

import pytest

import __spark_entry__ as entry
from conftest import SF0001
from tessera.plans.catalog import QUERIES

# alignment, merges, gram counts and blocks of vectors in Arrow batches
ALLOWED_PY = {"m11_text_edits_f05", "k5_bpe_encode", "m6_chrf_plus_plus", "m35_soft_match"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in {"k4_train_bpe", "k5_bpe_encode",
                                                                         "s5_save_prepared", "s6_report_rollup",
                                                                         "s7_run_log_explode"}])
def test_plan_shape(spark, name):
    plan = _plan(entry.queries()[name](spark, SF0001))
    assert "BatchEvalPython" not in plan, "row-at-a-time Python UDF in the plan"
    assert "CartesianProduct" not in plan
    if name not in ALLOWED_PY:
        assert "ArrowEvalPython" not in plan and "MapInPandas" not in plan and "MapInArrow" not in plan


def test_filter_pushed_and_columns_pruned(spark):
    plan = _plan(entry.queries()["s2_read_config"](spark, SF0001))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,fr)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string,n_chars:bigint>" in plan
