"""The stage jobs end to end (Parquet/JSON between stages)."""

import json
import os
import tempfile

from conftest import SF_SMALL


def test_run_all_stages(spark):
    from rareclass.plans import products as PD
    from rareclass.plans.jobs import run_all
    from rareclass.sources.io import read_table

    work = tempfile.mkdtemp(prefix="rc-jobs-")
    best = run_all(spark, PD.products_raw(spark, SF_SMALL), PD.categories(spark, SF_SMALL), work,
                   scorers=("logit", "recon_error", "knn"), n_trials=2)
    assert best in {"logit", "recon_error", "knn"}
    split = read_table(spark, os.path.join(work, "split"))
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    n = sum(counts.values())
    assert n == read_table(spark, os.path.join(work, "transformed")).count()
    assert set(counts) == {"train", "validation", "test"}
    cmp_dir = os.path.join(work, "comparison")
    doc = json.loads(open(os.path.join(cmp_dir, [f for f in os.listdir(cmp_dir) if f.endswith(".json")][0])).read())
    assert doc["best_model"] == best and set(doc["models"]) == {"logit", "recon_error", "knn"}
    assert os.path.isdir(os.path.join(work, "models", "logit", "model"))
