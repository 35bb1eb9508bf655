"""The registered queries do the whole job: all trials, the scorers' own settings, the full width."""

import pytest

from conftest import SF_SMALL
from rareclass.operators import tune
from rareclass.plans import catalog_ml as C
from rareclass.scorers import SCORERS


class Stop(Exception):
    pass


class Frame:
    def persist(self):
        return self


@pytest.fixture()
def no_data(monkeypatch):
    monkeypatch.setattr(C, "embedding_features", lambda *a: Frame())
    monkeypatch.setattr(C, "_split", lambda f, *names: names)


@pytest.mark.parametrize("name", ["forest", "boosted", "kernel_svm", "knn", "iforest", "one_class_svm", "recon_error"])
def test_every_tuner_runs_five_trials(monkeypatch, no_data, name):
    def search(train, validation, scorer, ranges, n_trials=5, parallelism=2, metric=None):
        raise Stop(scorer, n_trials, parallelism, metric)

    monkeypatch.setattr(tune, "search", search)
    with pytest.raises(Stop) as got:
        C._tune_query(name)(None, None)
    assert got.value.args == (SCORERS[name], 5, 2, "pr_auc" if name == "boosted" else "roc_auc")


def test_compared_models_have_the_default_settings(monkeypatch, no_data):
    fitted = []
    monkeypatch.setattr(tune, "fit_scorer", lambda scorer, train: fitted.append(scorer))

    def stop(models, test):
        raise Stop

    monkeypatch.setattr(tune, "evaluate", stop)
    with pytest.raises(Stop):
        C.q_evaluate_compare(None, None)
    assert [type(s) for s in fitted] == list(SCORERS.values()) and all(vars(s) == vars(type(s)()) for s in fitted)


def test_embed_has_the_full_width(spark):
    from pyspark.sql import functions as F

    from rareclass.operators.textops import embed

    rows = {r["doc_id"]: r for r in C.q_embed(spark, SF_SMALL).collect()}
    assert {r["width"] for r in rows.values()} == {1 << 18}
    for r in embed(C.documents_text(spark, SF_SMALL), "text", "doc_id").orderBy(F.col("doc_id")).limit(20).collect():
        got, v = rows[r["doc_id"]], r["embedding"]
        assert got["non_zeros"] == v.numNonzeros() and got["total"] == pytest.approx(v.values.sum(), abs=1e-5)
