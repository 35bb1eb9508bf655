"""Feature, metric, kNN and scorer queries (registered into the catalog).

Metric fixture (FIXTURES.md): ``labels`` joined to ``documents``; label
``toxic``; the stand-in score is ``n_chars`` (many ties).  Scorer fixture:
``embeddings`` with class 0 as the rare positive class, split exactly
(70/15/15, seed 13) on ``vec_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import order as O
from ..operators.features import FeatureBuilder
from ..sources.io import table
from . import products as PD
from .training import CATEGORICAL_FEATURES, NUMERIC_FEATURES, POSITIVE_CLASS, TARGET, embedding_features, product_features, product_features_and_model
from .catalog import _tokens_sql, _transformed, _with, documents_text, query, rnd

# --------------------------------------------------------------- metrics --


def _scored_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id", "inner").select("doc_id", "toxic", "quality", F.col("n_chars").cast("double").alias("score"))


_SCORED_SQL = """
d AS (SELECT l.doc_id, l.toxic AS y, l.quality, CAST(d.n_chars AS DOUBLE) AS sc
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def _curve_sql(src: str, by: str = "") -> str:
    """Exact curve metrics by plain window sums (independent of the Spark operator)."""
    pb = f"PARTITION BY {by} " if by else ""
    gb = f"{by}, " if by else ""
    join = f"USING ({by})" if by else "ON TRUE"
    return f"""
g AS (SELECT {gb}sc, SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS p, SUM(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS q
      FROM {src} WHERE sc IS NOT NULL GROUP BY {gb}sc),
c AS (SELECT g.*, SUM(p) OVER ({pb}ORDER BY sc DESC) AS tp, SUM(q) OVER ({pb}ORDER BY sc DESC) AS fp FROM g),
t AS (SELECT {gb}SUM(p) AS PP, SUM(q) AS NN FROM g {'GROUP BY ' + by if by else ''}),
pts AS (
  SELECT c.*, t.PP, t.NN,
    CAST(tp AS DOUBLE) / (tp + fp) AS prec,
    CASE WHEN tp - p + fp - q = 0 THEN 1.0 ELSE CAST(tp - p AS DOUBLE) / (tp - p + fp - q) END AS prev_prec,
    CAST(tp AS DOUBLE) / t.PP AS rec,
    2.0 * tp / (tp + fp + t.PP) AS f1
  FROM c JOIN t {join}),
best AS (SELECT * FROM (SELECT pts.*, ROW_NUMBER() OVER ({pb}ORDER BY f1 DESC, sc DESC) AS rn FROM pts) WHERE rn = 1),
agg AS (
  SELECT {gb}SUM(q * (tp - p / 2.0)) / (MAX(PP) * MAX(NN)) AS roc_auc,
    SUM(CAST(p AS DOUBLE) / PP * (prec + prev_prec) / 2) AS pr_auc
  FROM pts {'GROUP BY ' + by if by else ''})"""


@query(
    "roc_pr_auc",
    "WITH " + _SCORED_SQL + "," + _curve_sql("d") + """
SELECT ROUND(agg.roc_auc, 6) AS roc_auc, ROUND(agg.pr_auc, 6) AS pr_auc,
  ROUND(best.prec, 6) AS precision, ROUND(best.rec, 6) AS recall, ROUND(best.f1, 6) AS f1,
  ROUND(best.sc, 6) AS threshold, CAST(best.PP AS BIGINT) AS positives, CAST(best.NN AS BIGINT) AS negatives
FROM agg, best""",
)
def q_roc_pr_auc(spark, sf_dir):
    """Exact tie-aware ROC-AUC, PR-AUC and best-F1 point."""
    m = M.curve_metrics(_scored_docs(spark, sf_dir), "toxic", "score")
    return m.select(*[rnd(c) for c in ["roc_auc", "pr_auc", "precision", "recall", "f1", "threshold"]], "positives", "negatives")


@query(
    "pr_curve",
    "WITH " + _SCORED_SQL + "," + _curve_sql("d") + """
SELECT ROUND(sc, 6) AS threshold, ROUND(prec, 6) AS precision, ROUND(rec, 6) AS recall FROM pts""",
)
def q_pr_curve(spark, sf_dir):
    """precision/recall at every distinct threshold."""
    c = M.pr_curve(_scored_docs(spark, sf_dir), "toxic", "score")
    return c.select(rnd("threshold"), rnd("precision"), rnd("recall"))


@query(
    "confusion_at",
    "WITH " + _SCORED_SQL + """
SELECT COUNT(*) FILTER (WHERE y = 1 AND sc >= 2500) AS tp, COUNT(*) FILTER (WHERE y <> 1 AND sc >= 2500) AS fp,
  COUNT(*) FILTER (WHERE y = 1 AND sc < 2500) AS fn, COUNT(*) FILTER (WHERE y <> 1 AND sc < 2500) AS tn
FROM d""",
)
def q_confusion_at(spark, sf_dir):
    """Confusion counts at a fixed threshold."""
    c = M.confusion(_scored_docs(spark, sf_dir), "toxic", "score", threshold=2500.0)
    return c.select("tp", "fp", "fn", "tn")


@query(
    "class_weights",
    """
SELECT toxic, COUNT(*) AS count,
  ROUND(CAST(SUM(COUNT(*)) OVER () AS DOUBLE) / (COUNT(*) OVER () * COUNT(*)), 6) AS weight
FROM labels GROUP BY toxic""",
)
def q_class_weights(spark, sf_dir):
    """Balanced class weights of the toxic label."""
    w = M.class_weights(table(spark, sf_dir, "labels"), "toxic")
    return w.select("toxic", "count", rnd("weight"))


_MODELS = {"n_chars": "sc", "neg_n_chars": "-sc", "quality": "CAST(quality AS DOUBLE)"}


def _model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _scored_docs(spark, sf_dir)
    exprs = {"n_chars": F.col("score"), "neg_n_chars": -F.col("score"), "quality": F.col("quality").cast("double")}
    stacked = d.select(
        "toxic",
        F.explode(F.array(*[F.struct(F.lit(k).alias("model"), v.alias("sc")) for k, v in exprs.items()])).alias("m"),
    )
    return stacked.select("toxic", F.col("m.model").alias("model"), F.col("m.sc").alias("sc"))


_MODEL_SCORES_SQL = _SCORED_SQL + ",\nms AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS model, y, {v} AS sc FROM d" for k, v in _MODELS.items()
) + ")"


@query(
    "model_metrics",
    "WITH " + _MODEL_SCORES_SQL + "," + _curve_sql("ms", "model") + """
SELECT agg.model, ROUND(agg.roc_auc, 6) AS roc_auc, ROUND(agg.pr_auc, 6) AS pr_auc,
  ROUND(best.prec, 6) AS precision, ROUND(best.rec, 6) AS recall, ROUND(best.f1, 6) AS f1, ROUND(best.sc, 6) AS threshold
FROM agg JOIN best USING (model)""",
)
def q_model_metrics(spark, sf_dir):
    """Metrics of several scorers in one grouped pass (the comparison table)."""
    m = M.curve_metrics(_model_scores(spark, sf_dir), "toxic", "sc", by="model")
    return m.select("model", *[rnd(c) for c in ["roc_auc", "pr_auc", "precision", "recall", "f1", "threshold"]])


@query(
    "best_model",
    "WITH " + _MODEL_SCORES_SQL + "," + _curve_sql("ms", "model") + """
SELECT model AS best_model, ROUND(f1, 6) AS f1 FROM best ORDER BY f1 DESC, model LIMIT 1""",
)
def q_best_model(spark, sf_dir):
    """The scorer with the highest F1."""
    m = M.curve_metrics(_model_scores(spark, sf_dir), "toxic", "sc", by="model")
    b = M.best_model(m, "f1")
    return b.select("best_model", rnd("f1"))


# -------------------------------------------------------------- features --

def _impute_scale_sql() -> str:
    cols = NUMERIC_FEATURES
    med = ", ".join(f"QUANTILE_CONT({c}, 0.5) AS {c}" for c in cols)
    imp = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), (SELECT {c} FROM med)) AS {c}" for c in cols)
    st = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in cols)
    out = ", ".join(
        f"ROUND(({c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}" for c in cols
    )
    return _with(
        f""",
med AS (SELECT {med} FROM transformed),
imp AS (SELECT asin, {imp} FROM transformed),
st AS (SELECT {st} FROM imp)
SELECT asin, {out} FROM imp, st"""
    )


@query("impute_scale", _impute_scale_sql())
def q_impute_scale(spark, sf_dir):
    """Interpolated-median imputation and population-std scaling (fitted on all rows, as the reference)."""
    df = _transformed(spark, sf_dir)
    model = FeatureBuilder(NUMERIC_FEATURES).fit(df)
    return df.select("asin", *model.scaled_columns(df)).select("asin", *[rnd(c) for c in NUMERIC_FEATURES])


def _onehot_sql() -> str:
    cats = "".join(
        f""",
cats_{c} AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT COALESCE(CAST({c} AS VARCHAR), 'missing') AS v FROM train))"""
        for c in CATEGORICAL_FEATURES
    )
    joins = " ".join(
        f"LEFT JOIN cats_{c} ON COALESCE(CAST(t.{c} AS VARCHAR), 'missing') = cats_{c}.v" for c in CATEGORICAL_FEATURES
    )
    sel = ", ".join(f"cats_{c}.idx AS {c}_idx" for c in CATEGORICAL_FEATURES)
    return _with(
        f""",
pos AS (SELECT asin, ROW_NUMBER() OVER (ORDER BY md5(asin || '#13'), asin) AS pos, COUNT(*) OVER () AS n FROM transformed),
train AS (SELECT t.* FROM transformed t JOIN pos USING (asin) WHERE pos.pos <= FLOOR(CAST(0.7 AS DOUBLE) * pos.n)){cats}
SELECT t.asin, {sel} FROM transformed t {joins}"""
    )


@query("onehot", _onehot_sql())
def q_onehot(spark, sf_dir):
    """E2, E3 (+O5): categories fitted on the training split; unseen -> NULL index (all-zero block)."""
    df = _transformed(spark, sf_dir)
    split = O.split_exact(df.select("asin"), "asin", seed=13)
    train = df.join(split.where(F.col("split") == "train"), "asin", "left_semi")
    model = FeatureBuilder([], CATEGORICAL_FEATURES).fit(train)
    df = model.with_indexes(df)
    return df.select("asin", *[model.category_index(c).cast("int").alias(f"{c}_idx") for c in CATEGORICAL_FEATURES])


# ------------------------------------------------------------------- kNN --


def embeddings_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vec_id, vec, y, split`` - class 0 is the rare positive class."""
    e = table(spark, sf_dir, "embeddings")
    sp = O.split_exact(e.select("vec_id"), "vec_id", seed=13)
    return e.join(sp, "vec_id").select(
        "vec_id", F.col("embedding").alias("vec"), (F.col("label") == POSITIVE_CLASS).cast("int").alias("y"), "split"
    )


@query(
    "knn_vote",
    f"""
WITH pos AS (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR) || '#13'), vec_id) AS pos,
                    COUNT(*) OVER () AS n FROM embeddings),
e AS (SELECT e.vec_id, list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)) AS v,
        CASE WHEN e.label = {POSITIVE_CLASS} THEN 1 ELSE 0 END AS y,
        p.pos <= FLOOR(CAST(0.7 AS DOUBLE) * p.n) AS is_train
      FROM embeddings e JOIN pos p USING (vec_id)),
pairs AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.y,
            list_sum(list_transform(list_zip(q.v, t.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS dp
          FROM e q JOIN e t ON (NOT q.is_train) AND t.is_train),
r AS (SELECT qid, y, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY dp, tid) AS rn FROM pairs)
SELECT qid AS vec_id, ROUND(AVG(CAST(y AS DOUBLE)), 6) AS score FROM r WHERE rn <= 5 GROUP BY qid""",
)
def q_knn_vote(spark, sf_dir):
    """Exact 5-NN vote of every validation/test vector against all training vectors."""
    e = embeddings_split(spark, sf_dir).persist()  # both sides and the pivot passes read it
    from ..scorers.knn import knn_vote

    train = e.where(F.col("split") == "train")
    qs = e.where(F.col("split") != "train")
    res = knn_vote(train, qs, k=5, id_col="vec_id", vec_col="vec", label_col="y")
    return res.select("vec_id", rnd("score"))


# ----------------------------------------------- scorers (rows-only checks) --


def _split(df: DataFrame, *names: str) -> DataFrame:
    return df.where(F.col("split").isin(*names))


def _fit_score(scorer, train: DataFrame, score_on: DataFrame) -> DataFrame:
    from ..operators.tune import fit_scorer, score_frame

    return score_frame(fit_scorer(scorer, train), score_on, "id").select("id", rnd("score"))


def _features_sql() -> str:
    """Median, mean and scale of the training rows; numeric block, then the place of each row's one in the one-hot blocks."""
    med = ", ".join(f"QUANTILE_CONT({c}, 0.5) AS {c}" for c in NUMERIC_FEATURES)
    imp = ", ".join(f"COALESCE(CAST({c} AS DOUBLE), (SELECT {c} FROM med)) AS {c}" for c in NUMERIC_FEATURES)
    st = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in NUMERIC_FEATURES)
    num = ", ".join(f"ROUND((i.{c} - m_{c}) / CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1 ELSE s_{c} END, 4) AS {c}" for c in NUMERIC_FEATURES)
    cats, joins, hot, ahead = "", "", [], [str(len(NUMERIC_FEATURES))]
    for c in CATEGORICAL_FEATURES:
        cats += f""",
cats_{c} AS (SELECT v, CAST(ROW_NUMBER() OVER (ORDER BY v) - 1 AS INTEGER) AS idx
  FROM (SELECT DISTINCT COALESCE(CAST({c} AS VARCHAR), 'missing') AS v FROM train))"""
        joins += f" LEFT JOIN cats_{c} ON COALESCE(CAST(t.{c} AS VARCHAR), 'missing') = cats_{c}.v"
        hot.append(f"CAST(cats_{c}.idx + {' + '.join(ahead)} AS INTEGER) AS {c}_at")
        ahead.append(f"(SELECT COUNT(*) FROM cats_{c})")
    return _with(
        f""",
pos AS (SELECT asin, ROW_NUMBER() OVER (ORDER BY md5(asin || '#13'), asin) AS pos, COUNT(*) OVER () AS n FROM transformed),
parts AS (SELECT asin, CASE WHEN pos <= FLOOR(CAST(0.7 AS DOUBLE) * n) THEN 'train'
  WHEN pos <= FLOOR(CAST(0.85 AS DOUBLE) * n) THEN 'validation' ELSE 'test' END AS split FROM pos),
train AS (SELECT t.* FROM transformed t JOIN parts USING (asin) WHERE split = 'train'){cats},
med AS (SELECT {med} FROM train),
imp AS (SELECT asin, split, {TARGET}, {imp} FROM transformed JOIN parts USING (asin)),
st AS (SELECT {st} FROM imp WHERE split = 'train')
SELECT t.asin AS id, i.split, CAST(i.{TARGET} AS DOUBLE) AS label, CAST({' + '.join(ahead)} AS INTEGER) AS n_features, {num}, {', '.join(hot)}
FROM transformed t JOIN imp i USING (asin){joins}, st"""
    )


@query("features", _features_sql())
def q_features(spark, sf_dir):
    """The assembled vector of every product (fitted on the training split): its width, the numeric
    block, and the place of the one in each one-hot block (NULL for an unseen category)."""
    from pyspark.ml.functions import vector_to_array

    out, model = product_features_and_model(spark, sf_dir)
    v = vector_to_array("features")
    place, at = [], len(NUMERIC_FEATURES)
    for c in CATEGORICAL_FEATURES:
        block = F.slice(F.col("v"), at + 1, model.width(c))
        found = F.array_position(block, F.lit(1.0))
        place.append(F.when(found > 0, found + at - 1).cast("int").alias(f"{c}_at"))
        at += model.width(c)
    return out.select("id", "split", "label", v.alias("v")).select(
        "id", "split", "label", F.size("v").alias("n_features"), *[F.round(F.col("v")[i], 4).alias(c) for i, c in enumerate(NUMERIC_FEATURES)], *place)


@query("logit")
def q_logit(spark, sf_dir):
    """M1: balanced logistic regression, validation scores."""
    from ..scorers import LogitScorer

    f = product_features(spark, sf_dir).persist()
    return _fit_score(LogitScorer(), _split(f, "train"), _split(f, "validation"))


@query("forest")
def q_forest(spark, sf_dir):
    """M2: balanced random forest (100 trees), validation scores."""
    from ..scorers import ForestScorer

    f = product_features(spark, sf_dir).persist()
    return _fit_score(ForestScorer(), _split(f, "train"), _split(f, "validation"))


@query("boosted")
def q_boosted(spark, sf_dir):
    """M3: boosted trees with the reference's default settings, validation scores."""
    from ..scorers import BoostedScorer

    f = product_features(spark, sf_dir).persist()
    return _fit_score(BoostedScorer(), _split(f, "train"), _split(f, "validation"))


@query("tree_attribution")
def q_tree_attribution(spark, sf_dir):
    """Which features speak for the rare class: exact Shapley values of the forest for every validation row, the training split
    as background; a row per product and feature that its trees ask for, with the score that they add up to."""
    from ..scorers import ForestScorer
    from ..scorers.attribution import tree_attribution

    f = product_features(spark, sf_dir).persist()
    train = _split(f, "train")
    model = ForestScorer().fit(train)
    out = tree_attribution(model, model.transform(_split(f, "validation")), train)
    return out.select("id", "score", "base", F.explode("attribution").alias("e")).select(
        "id", rnd("score"), rnd("base"), "e.feature", rnd(F.col("e.value"), "attribution"))


@query("svm")
def q_svm(spark, sf_dir):
    """M4: RBF-kernel SVM (random Fourier features + Platt), validation scores."""
    from ..scorers import KernelSVMScorer

    f = product_features(spark, sf_dir).persist()
    return _fit_score(KernelSVMScorer(), _split(f, "train"), _split(f, "validation"))


@query("iforest")
def q_iforest(spark, sf_dir):
    """M6: isolation forest fitted on normal training embeddings (all rows per tree), held-out scores."""
    from ..scorers import IsolationForestScorer

    f = embedding_features(spark, sf_dir).persist()
    return _fit_score(IsolationForestScorer(), _split(f, "train"), _split(f, "validation", "test"))


@query("ocsvm")
def q_ocsvm(spark, sf_dir):
    """M7: one-class SVM on normal training embeddings, held-out scores."""
    from ..scorers import OneClassSVMScorer

    f = embedding_features(spark, sf_dir).persist()
    return _fit_score(OneClassSVMScorer(), _split(f, "train"), _split(f, "validation", "test"))


@query("recon_error")
def q_recon_error(spark, sf_dir):
    """PCA reconstruction error (encoding_dim 32) on held-out embeddings."""
    from ..scorers import ReconstructionScorer

    f = embedding_features(spark, sf_dir).persist()
    return _fit_score(ReconstructionScorer(32), _split(f, "train"), _split(f, "validation", "test"))


@query("tune")
def q_tune(spark, sf_dir):
    """M9: 5 seeded trials (2 at a time) of logistic regression over the reference's ranges."""
    from ..operators.tune import RANGES, search
    from ..scorers import LogitScorer

    f = product_features(spark, sf_dir, stratify=True).persist()
    trials, _ = search(_split(f, "train"), _split(f, "validation"), LogitScorer, RANGES["logit"], n_trials=5, parallelism=2)
    f.unpersist()
    return trials.select("trial", "params", rnd("roc_auc"), rnd("pr_auc"), rnd("f1"), "is_best")


def _tune_query(name: str):
    """M9 for one scorer: 5 seeded trials (2 at a time) over its ranges on the embeddings."""

    def run(spark, sf_dir):
        from ..operators.tune import OBJECTIVES, RANGES, search
        from ..scorers import SCORERS

        f = embedding_features(spark, sf_dir).persist()
        trials, _ = search(_split(f, "train"), _split(f, "validation"), SCORERS[name], RANGES[name], n_trials=5, parallelism=2,
                           metric=OBJECTIVES[name])
        f.unpersist()
        return trials.select("trial", "params", rnd("roc_auc"), rnd("pr_auc"), rnd("f1"), "is_best")

    return run


for _name in ("forest", "boosted", "kernel_svm", "knn", "iforest", "one_class_svm", "recon_error"):
    query(f"tune_{_name}")(_tune_query(_name))


@query("evaluate_compare")
def q_evaluate_compare(spark, sf_dir):
    """Fit all eight scorers, evaluate each on the test split, metrics table with the best-F1 flag."""
    from ..operators.tune import compare, evaluate, fit_scorer
    from ..scorers import SCORERS

    f = embedding_features(spark, sf_dir).persist()
    train, test = _split(f, "train"), _split(f, "test")
    models = {name: fit_scorer(cls(), train) for name, cls in SCORERS.items()}
    metrics, best = compare(evaluate(models, test))
    return metrics.select("model", *[rnd(c) for c in ["roc_auc", "pr_auc", "precision", "recall", "f1", "threshold"]],
                          (F.col("model") == F.lit(best)).alias("is_best"))


@query("embed")
def q_embed(spark, sf_dir):
    """Built-in HashingTF + IDF text embedding of every document: width, non-zeros, sum and norm of the vector."""
    from ..operators.textops import embed

    e = embed(documents_text(spark, sf_dir), "text", "doc_id").withColumn("u", F.unwrap_udt("embedding"))  # sparse: no dense array is made
    v = F.filter("u.values", lambda x: x != 0)
    return e.select("doc_id", F.col("u.size").alias("width"), v.alias("v")).select(
        "doc_id", "width", F.size("v").alias("non_zeros"), F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
        F.round(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)), 6).alias("norm"))


@query(
    "describe_strings",
    """WITH c AS (SELECT COUNT(c_mktsegment) AS n, MIN(c_mktsegment) AS lo, MAX(c_mktsegment) AS hi, COUNT(c_name) AS n2, MIN(c_name) AS lo2, MAX(c_name) AS hi2 FROM customer)
SELECT s.summary, CASE s.summary WHEN 'count' THEN CAST(n AS VARCHAR) WHEN 'min' THEN lo WHEN 'max' THEN hi END AS c_mktsegment,
  CASE s.summary WHEN 'count' THEN CAST(n2 AS VARCHAR) WHEN 'min' THEN lo2 WHEN 'max' THEN hi2 END AS c_name
FROM c, (VALUES ('count'), ('mean'), ('stddev'), ('min'), ('max')) s(summary)""",
)
def q_describe_strings(spark, sf_dir):
    """A3: describe with string columns (values as text; no mean or deviation of text)."""
    from ..operators.profile import describe

    return describe(table(spark, sf_dir, "customer").select("c_mktsegment", "c_name"))


@query(
    "sql_over_views",
    """SELECT n.n_name, COUNT(*) AS customers, ROUND(AVG(c.c_acctbal), 6) AS mean_balance FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""",
)
def q_sql_over_views(spark, sf_dir):
    """The SQL path - tables registered as views, one statement over them."""
    from ..sources.io import register_tables

    register_tables(spark, sf_dir, ["customer", "nation"])
    return spark.sql("""SELECT n.n_name, COUNT(*) AS customers, ROUND(AVG(c.c_acctbal), 6) AS mean_balance FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY n.n_name""")


@query(
    "token_label_relation",
    "WITH " + _tokens_sql() + """,
tf AS (SELECT tok AS token, COUNT(*) AS count, COUNT(DISTINCT doc_id) AS docs FROM kept GROUP BY tok),
vocab AS (SELECT token FROM tf WHERE docs >= 5 ORDER BY count DESC, token LIMIT 100),
n AS (SELECT l.doc_id, l.toxic, v.token, (SELECT COUNT(*) FROM kept k WHERE k.doc_id = l.doc_id AND k.tok = v.token) AS c
      FROM labels l JOIN documents d ON d.doc_id = l.doc_id, vocab v)
SELECT token, ROUND(CORR(c, toxic), 6) AS corr FROM n GROUP BY token""",
)
def q_token_label_relation(spark, sf_dir):
    """Relation of vocabulary terms with the label: correlation of each term's count with ``toxic``."""
    from ..operators.textops import token_label_correlation

    return token_label_correlation(documents_text(spark, sf_dir), table(spark, sf_dir, "labels"), "text", "doc_id", "toxic").select("token", rnd("corr"))


@query(
    "pair_sample",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
ORDER BY md5(CAST(l_orderkey AS VARCHAR) || '#' || CAST(l_linenumber AS VARCHAR) || '#42'), l_orderkey, l_linenumber LIMIT 1000""",
)
def q_pair_sample(spark, sf_dir):
    """Seeded sample of 1000 rows of the four numeric lineitem columns (with their keys)."""
    from ..operators.profile import pair_sample

    keys = ["l_orderkey", "l_linenumber"]
    cols = [*keys, "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return pair_sample(table(spark, sf_dir, "lineitem").select(*cols), cols, 1000, 42, keys)


# ------------------------------------------------------ more oracle checks --


@query(
    "count_vectors",
    "WITH "
    + _tokens_sql()
    + """,
tf AS (SELECT tok AS token, COUNT(*) AS count, COUNT(DISTINCT doc_id) AS docs FROM kept GROUP BY tok),
vocab AS (SELECT token FROM tf WHERE docs >= 5 ORDER BY count DESC, token LIMIT 100),
hits AS (SELECT k.doc_id, k.tok FROM kept k JOIN vocab v ON k.tok = v.token)
SELECT d.doc_id, CAST(COUNT(h.tok) AS DOUBLE) AS n_vocab_tokens, CAST(COUNT(DISTINCT h.tok) AS INTEGER) AS n_terms
FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id""",
)
def q_count_vectors(spark, sf_dir):
    """Count vectors over the 100-term vocabulary (minDF 5): tokens and distinct terms per document."""
    from pyspark.ml.functions import vector_to_array

    from ..operators.textops import count_vectors

    cv = count_vectors(documents_text(spark, sf_dir), "text", "doc_id", vocab_size=100, min_df=5)
    arr = vector_to_array("features")
    return cv.select(
        "doc_id",
        F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("n_vocab_tokens"),
        F.size(F.filter(arr, lambda x: x > 0)).alias("n_terms"),
    )


@query(
    "stratified_split",
    """
WITH s AS (
  SELECT doc_id, toxic,
    ROW_NUMBER() OVER (PARTITION BY toxic ORDER BY md5(CAST(doc_id AS VARCHAR) || '#13'), doc_id) AS pos,
    COUNT(*) OVER (PARTITION BY toxic) AS n
  FROM labels)
SELECT doc_id, toxic,
  CASE WHEN pos <= FLOOR(CAST(0.7 AS DOUBLE) * n) THEN 'train'
       WHEN pos <= FLOOR(CAST(0.85 AS DOUBLE) * n) THEN 'validation'
       ELSE 'test' END AS split
FROM s""",
)
def q_stratified_split(spark, sf_dir):
    """O5 (stratified): the exact 70/15/15 cut applied within each class of the toxic label."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return O.split_exact(labels, "doc_id", seed=13, stratify="toxic").select("doc_id", "toxic", "split")


@query(
    "knn_vote_l1_distance",
    f"""
WITH pos AS (SELECT vec_id, ROW_NUMBER() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR) || '#13'), vec_id) AS pos,
                    COUNT(*) OVER () AS n FROM embeddings),
e AS (SELECT e.vec_id, list_transform(e.embedding, lambda x: CAST(x AS DOUBLE)) AS v,
        CASE WHEN e.label = {POSITIVE_CLASS} THEN 1 ELSE 0 END AS y,
        p.pos <= FLOOR(CAST(0.7 AS DOUBLE) * p.n) AS is_train
      FROM embeddings e JOIN pos p USING (vec_id)),
pairs AS (SELECT q.vec_id AS qid, t.vec_id AS tid, t.y,
            list_sum(list_transform(list_zip(q.v, t.v), lambda z: abs(z[1] - z[2]))) AS dp
          FROM e q JOIN e t ON (NOT q.is_train) AND t.is_train),
r AS (SELECT qid, y, dp, ROW_NUMBER() OVER (PARTITION BY qid ORDER BY dp, tid) AS rn FROM pairs),
k AS (SELECT * FROM r WHERE rn <= 7)
SELECT qid AS vec_id,
  ROUND(CASE WHEN MAX(CASE WHEN dp = 0 THEN 1 ELSE 0 END) = 1
             THEN SUM(CASE WHEN dp = 0 THEN CAST(y AS DOUBLE) ELSE 0 END) / SUM(CASE WHEN dp = 0 THEN 1.0 ELSE 0 END)
             ELSE SUM(y / dp) / SUM(1.0 / dp) END, 6) AS score
FROM k GROUP BY qid""",
)
def q_knn_vote_l1_distance(spark, sf_dir):
    """M5 variant: 7 neighbours, Manhattan distance, 1/distance-weighted vote."""
    from ..scorers.knn import knn_vote

    e = embeddings_split(spark, sf_dir).persist()  # both sides and the pivot passes read it
    res = knn_vote(e.where(F.col("split") == "train"), e.where(F.col("split") != "train"), k=7, id_col="vec_id",
                   vec_col="vec", label_col="y", weights="distance", p=1)
    return res.select("vec_id", rnd("score"))


# ------------------------------------------------- how sure the metrics are --

REPLICATES = 100


def _bootstrap_sql() -> str:
    """Rows times replicates, weights from the same digests; curve metrics by plain window sums."""
    from ..operators.uncertainty import POISSON_CUTS

    weight = " + ".join(f"(u >= {c})::INT" for c in POISSON_CUTS)
    return "WITH " + _SCORED_SQL + f""",
h AS (SELECT y, sc, r, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '#42#' || CAST(r // 4 AS VARCHAR)), CAST(8 * (r % 4) + 1 AS INT), 8) AS BIGINT) AS u
      FROM d, range({REPLICATES}) t(r)),
g AS (SELECT r, sc, SUM(w * y) AS p, SUM(w * (1 - y)) AS q FROM (SELECT r, sc, y, {weight} AS w FROM h) GROUP BY r, sc),
c AS (SELECT *, SUM(p) OVER o AS tp, SUM(q) OVER o AS fp, SUM(p) OVER (PARTITION BY r) AS pp, SUM(q) OVER (PARTITION BY r) AS nn FROM g
      WINDOW o AS (PARTITION BY r ORDER BY sc DESC)),
m AS (SELECT r, SUM(q * (tp - p / 2.0)) / (MAX(pp) * MAX(nn)) AS roc_auc,
        SUM(CASE WHEN p > 0 THEN CAST(p AS DOUBLE) / pp * (CAST(tp AS DOUBLE) / (tp + fp)
          + CASE WHEN tp - p + fp - q = 0 THEN 1.0 ELSE CAST(tp - p AS DOUBLE) / (tp - p + fp - q) END) / 2 ELSE 0 END) AS pr_auc FROM c GROUP BY r),
l AS (SELECT 'roc_auc' AS metric, roc_auc AS v FROM m UNION ALL SELECT 'pr_auc', pr_auc FROM m)
SELECT metric, ROUND(AVG(v), 6) AS mean, ROUND(STDDEV_SAMP(v), 6) AS std_error, ROUND(QUANTILE_CONT(v, 0.025), 6) AS lower,
  ROUND(QUANTILE_CONT(v, 0.975), 6) AS upper, COUNT(v) AS replicates FROM l GROUP BY metric"""


@query("bootstrap_bounds", _bootstrap_sql())
def q_bootstrap_bounds(spark, sf_dir):
    """Poisson bootstrap (100 replicates) of ROC-AUC and PR-AUC: mean, standard error, 95 % bounds."""
    from ..operators.uncertainty import bootstrap_bounds

    b = bootstrap_bounds(_scored_docs(spark, sf_dir), "toxic", "score", ["doc_id"], REPLICATES)
    return b.select("metric", *[rnd(c) for c in ["mean", "std_error", "lower", "upper"]], "replicates")


def _delong_sql() -> str:
    """Components by comparing every positive with every negative."""
    from ..operators.uncertainty import ERF_A, ERF_P

    series = "0.0"
    for a in reversed(ERF_A):
        series = f"(({series}) + ({a}::DOUBLE)) * t"
    return "WITH " + _SCORED_SQL + f""",
e AS (SELECT doc_id, y, sc AS a, CAST(quality AS DOUBLE) AS b FROM d WHERE sc IS NOT NULL AND quality IS NOT NULL),
pairs AS (SELECT p.doc_id AS i, n.doc_id AS j, CASE WHEN p.a > n.a THEN 1.0::DOUBLE WHEN p.a = n.a THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS a,
            CASE WHEN p.b > n.b THEN 1.0::DOUBLE WHEN p.b = n.b THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS b
          FROM e p JOIN e n ON p.y = 1 AND n.y <> 1),
v10 AS (SELECT i, AVG(a) AS a, AVG(b) AS b FROM pairs GROUP BY i), v01 AS (SELECT j, AVG(a) AS a, AVG(b) AS b FROM pairs GROUP BY j),
s AS (SELECT (SELECT AVG(a) FROM v10) AS auc_a, (SELECT AVG(b) FROM v10) AS auc_b,
        (SELECT VAR_SAMP(a - b) / COUNT(*) FROM v10) + (SELECT VAR_SAMP(a - b) / COUNT(*) FROM v01) AS variance),
z AS (SELECT *, auc_a - auc_b AS difference, (auc_a - auc_b) / sqrt(variance) AS z FROM s),
t AS (SELECT *, abs(z) / sqrt(2.0::DOUBLE) AS x, 1.0::DOUBLE / (1.0::DOUBLE + {ERF_P}::DOUBLE * abs(z) / sqrt(2.0::DOUBLE)) AS t FROM z)
SELECT ROUND(auc_a, 6) AS auc_a, ROUND(auc_b, 6) AS auc_b, ROUND(difference, 6) AS difference, ROUND(variance, 6) AS variance,
  ROUND(z, 6) AS z, ROUND({series} * exp(-x * x), 6) AS p_value FROM t"""


@query("delong_test", _delong_sql())
def q_delong_test(spark, sf_dir):
    """Paired test of two models' ROC-AUCs on the same documents: length against the quality label, for the toxic label."""
    from ..operators.uncertainty import delong_test

    return delong_test(_scored_docs(spark, sf_dir), "toxic", "score", "quality").select(
        *[rnd(c) for c in ["auc_a", "auc_b", "difference", "variance", "z", "p_value"]])


@query("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    """Importance of every embedding component for the reconstruction error's ROC-AUC on the held-out rows."""
    from ..operators.importance import permutation_importance
    from ..scorers import ReconstructionScorer

    f = embedding_features(spark, sf_dir)
    model = ReconstructionScorer(32).fit(_split(f, "train"))
    found = permutation_importance(model, _split(f, "validation", "test").select("id", "label", "features"))
    return found.select("feature", *[rnd(c) for c in ["baseline", "permuted", "importance"]])
