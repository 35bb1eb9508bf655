"""Token statistics (O3, A15, E6) as grouped aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX


def filtered_tokens(df: DataFrame, text_col: str, key: str, stop_words: list[str] | None = None,
                    out: str = "tokens") -> DataFrame:
    """``key, tokens``: F5 tokens minus F6 stop words (hash-set lookup in the JVM)."""
    toks = df.select(key, TX.tokens(text_col).alias("__raw"))
    return TX.remove_stop_words(toks, "__raw", out, stop_words).select(key, out)


def token_table(df: DataFrame, text_col: str, key: str, stop_words: list[str] | None = None) -> DataFrame:
    """One row per (document, token occurrence): F5 tokens minus F6 stop words."""
    return filtered_tokens(df, text_col, key, stop_words).select(key, F.explode("tokens").alias("token"))


def term_stats(df: DataFrame, text_col: str, key: str, stop_words: list[str] | None = None) -> DataFrame:
    """``token, count, docs``: term frequency and document frequency.

    One shuffle: every token occurrence contributes ``count`` 1 and every
    distinct token of a document (``array_distinct``, computed inside the row)
    contributes ``docs`` 1; the grouped sum is combined map-side first, so each
    task ships at most one row per distinct token - a word found in every
    document, or a 20,000-word document, never becomes one huge group.
    """
    toks = filtered_tokens(df, text_col, key, stop_words)
    kind = "array<struct<token:string,tf:int,df:int>>"

    def tagged(arr, tf: int, dfc: int):
        n = F.size(arr)
        return F.arrays_zip(arr, F.array_repeat(F.lit(tf), n), F.array_repeat(F.lit(dfc), n)).cast(kind)

    # one tokenisation, one explode: occurrences tagged (1, 0), distinct tokens (0, 1)
    both = F.concat(tagged(F.col("tokens"), 1, 0), tagged(F.array_distinct("tokens"), 0, 1))
    return (
        toks.select(F.explode(both).alias("e"))
        .groupBy(F.col("e.token").alias("token"))
        .agg(F.sum("e.tf").cast("long").alias("count"), F.sum("e.df").cast("long").alias("docs"))
    )


def vocabulary(df: DataFrame, text_col: str, key: str, vocab_size: int = 100, min_df: float = 5,
               stop_words: list[str] | None = None) -> DataFrame:
    """The CountVectorizer vocabulary - terms in at least ``min_df`` documents
    (a fraction when < 1), the ``vocab_size`` most frequent, ties by token.

    ``orderBy().limit()`` plans as ``TakeOrderedAndProject``: each task keeps
    its own top ``vocab_size`` and only those reach the final merge.
    """
    stats = term_stats(df, text_col, key, stop_words)
    if min_df < 1:
        n_docs = df.count()
        stats = stats.where(F.col("docs") >= F.lit(min_df * n_docs))
    else:
        stats = stats.where(F.col("docs") >= F.lit(min_df))
    return stats.orderBy(F.col("count").desc(), F.col("token")).limit(vocab_size)


def top_tokens(df: DataFrame, text_col: str, key: str, vocab_size: int = 100, min_df: float = 5, top: int = 50,
               stop_words: list[str] | None = None) -> DataFrame:
    """Total counts of the first ``top`` vocabulary terms, by count descending.

    The totals are the element-wise sum of the count vectors (A15) - computed
    directly as a grouped sum instead of reducing dense arrays on the driver.
    """
    vocab = vocabulary(df, text_col, key, vocab_size, min_df, stop_words)
    return vocab.orderBy(F.col("count").desc(), F.col("token")).limit(top).select("token", "count")


def count_vectors(df: DataFrame, text_col: str, key: str, vocab_size: int = 100, min_df: float = 5,
                  stop_words: list[str] | None = None, out: str = "features") -> DataFrame:
    """Sparse count vector per document over :func:`vocabulary`.

    The vocabulary (at most ``vocab_size`` rows) is broadcast; indices follow
    the vocabulary order.  Returns ``key, out`` (``VectorUDT``).
    """
    from pyspark.ml.feature import CountVectorizerModel

    vocab_rows = vocabulary(df, text_col, key, vocab_size, min_df, stop_words).collect()  # <= vocab_size rows
    terms = [r["token"] for r in vocab_rows]
    toks = filtered_tokens(df, text_col, key, stop_words, out="__toks")
    model = CountVectorizerModel.from_vocabulary(terms, inputCol="__toks", outputCol=out)
    return model.transform(toks).select(key, out)


def token_label_correlation(df: DataFrame, labels: DataFrame, text_col: str, key: str, label: str,
                            vocab_size: int = 100, min_df: float = 5) -> DataFrame:
    """``token, corr``: Pearson correlation of each vocabulary term's count with the label, over the labelled texts.

    One join of the term occurrences with the labels; documents without the term enter through the label totals, so no
    dense (documents x terms) table is built.
    """
    vocab = F.broadcast(vocabulary(df, text_col, key, vocab_size, min_df).select("token"))  # at most ``vocab_size`` rows
    known = labels.select(key, F.col(label).cast("double").alias("__y")).where("__y is not null").join(df.select(key), key, "left_semi")
    base = known.agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("y"), F.sum(F.col("__y") * F.col("__y")).alias("yy")).first()
    n, y, yy = float(base["n"] or 0), float(base["y"] or 0), float(base["yy"] or 0)
    counts = token_table(df, text_col, key).join(vocab, "token").groupBy(key, "token").agg(F.count(F.lit(1)).cast("double").alias("c"))
    sums = counts.join(known, key).groupBy("token").agg(
        F.sum("c").alias("x"), F.sum(F.col("c") * F.col("c")).alias("xx"), F.sum(F.col("c") * F.col("__y")).alias("xy"))
    spread = (n * F.col("xx") - F.col("x") * F.col("x")) * F.lit(n * yy - y * y)
    corr = F.try_divide(n * F.col("xy") - F.col("x") * F.lit(y), F.sqrt(spread))
    return vocab.join(sums, "token", "left").select("token", corr.alias("corr"))


def embed(df: DataFrame, text_col: str, key: str, make_predict_fn=None, batch_size: int = 128,
          dim: int = 768, num_features: int = 1 << 18, out: str = "embedding") -> DataFrame:
    """A text embedding column.

    With ``make_predict_fn`` (a factory returning ``fn(texts: np.ndarray) ->
    np.ndarray[batch, dim]``, e.g. a transformer's first-token vector), the
    model runs batched on the executors through ``predict_batch_udf``.  The
    built-in default is ``HashingTF`` + ``IDF`` over the F5/F6 tokens (a sparse
    vector; the IDF fit is one distributed pass).
    """
    if make_predict_fn is not None:
        from pyspark.ml.functions import predict_batch_udf
        from pyspark.sql import types as T

        udf = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
        return df.select(key, udf(F.col(text_col)).alias(out))
    from pyspark.ml.feature import IDF, HashingTF

    toks = filtered_tokens(df, text_col, key, out="__toks")
    tf = HashingTF(inputCol="__toks", outputCol="__tf", numFeatures=num_features).transform(toks)
    idf = IDF(inputCol="__tf", outputCol=out).fit(tf)
    return idf.transform(tf).select(key, out)
