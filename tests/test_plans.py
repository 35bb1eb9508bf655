"""Physical-plan checks: pruning, shuffle counts, no cartesian products, no single-partition windows."""

import re

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_scan_prunes_text(spark):
    from rareclass.operators.metrics import score_counts
    from rareclass.plans.catalog_ml import _scored_docs

    # the metrics write this aggregate once and go on from there
    plan = _plan(score_counts(_scored_docs(spark, SF_SMALL), "toxic", "score"))
    docs = [l for l in plan.split("\n") if "documents.parquet" in l]
    assert docs and all("text" not in l.split("ReadSchema:")[-1] for l in docs)


def test_term_stats_single_shuffle(spark):
    from rareclass.operators.textops import term_stats
    from rareclass.sources.io import table

    plan = _plan(term_stats(table(spark, SF_SMALL, "documents"), "text", "doc_id"))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_split_has_one_row_shuffle_and_no_single_partition(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["exact_split"](spark, SF_SMALL))
    assert "SinglePartition" not in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


def test_knn_has_no_cartesian_product_and_limits_map_side(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["knn_vote"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_python_row_udf_in_sql_checked_queries(spark):
    import __spark_entry__ as E

    for name in ["clean_products", "transform_products", "top_tokens", "text_clean", "roc_pr_auc", "percent_rank_dist"]:
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
