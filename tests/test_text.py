from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from rareclass.functions import text as TX

SAMPLES = ["   ", "\t\n", "x \n\n ", "I love it~! \U0001F60D", "½ ² 中文 – x\x1cz", "a  b\tc\n\nd  ", "", "Café -- ok|no; yes?",
           "  lead", "emoji‍️join ☀ sun"]


# Expected results, written out by hand: symbols and emoji go, a run of white space becomes one space, no trim.
CLEANED = [" ", " ", "x ", "I love it! ", "½ ² x z", "a b c d ", "", "Café -- ok|no; yes?", " lead", "emojijoin sun"]


def test_clean_text_fixed_examples(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, t string")
    got = [r["c"] for r in df.orderBy("i").select(TX.clean_text("t").alias("c")).collect()]
    assert got == CLEANED


def test_tokens_match_ml_tokenizer(spark):
    df = spark.createDataFrame([(s,) for s in SAMPLES], "t string")
    ours = [r["x"] for r in df.select(TX.tokens("t").alias("x")).collect()]
    ml = [r["x"] for r in Tokenizer(inputCol="t", outputCol="x").transform(df).collect()]
    assert ours == ml


def test_stop_words_keep_order_and_duplicates(spark):
    df = spark.createDataFrame([(["the", "red", "red", "and", "1", "x", "&"],)], "a array<string>")
    got = df.select(TX.drop_stop_words("a").alias("b")).first()["b"]
    assert got == ["red", "red", "x"]
    ml = StopWordsRemover(inputCol="a", outputCol="b", stopWords=TX.stop_words()).transform(df).first()["b"]
    assert got == ml


def test_default_stop_words_are_sparks():
    assert list(TX.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_catalog_loads_without_jars_or_session(monkeypatch):
    """Importing the catalog and its SQL touches neither Spark's jars nor a session."""
    import glob
    import importlib
    import zipfile

    def refuse(*_a, **_k):
        raise AssertionError("the catalog must not look for jars")

    monkeypatch.setattr(glob, "glob", refuse)
    monkeypatch.setattr(zipfile, "ZipFile", refuse)
    import rareclass.functions.text as text
    import rareclass.plans.catalog as catalog

    importlib.reload(text)
    assert len(catalog.queries()) >= 47 and len(catalog.oracle_sql()) >= 35
