"""Small tables with the awkward cases: nulls in any column, empty and long texts, ties, repeated rows, clashing names."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use for columns of their own
CLASHES = ["size", "bucket", "shard", "slot", "pack", "fp", "component_id", "copies", "score", "host", "target", "part", "line"]


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(seed: int = 1, n: int = 40) -> list[tuple]:
    rng = random.Random(seed)
    shared = words(rng, 40)
    out = [(i, words(rng, rng.randint(5, 120)), "en", f"src{i % 3}", 0) for i in range(n)]
    out += [(n, f"{words(rng, 30)} {shared} {words(rng, 30)}", "en", "src0", None), (n + 1, f"{words(rng, 5)} {shared}", None, "src0", 1)]
    out += [(n + 2, out[3][1], "en", "src1", 0), (n + 3, out[3][1], "en", None, 0), (n + 4, out[3][1] + " tail", "en", "src1", 0)]
    out += [(n + 5, None, None, None, None), (n + 6, "", "en", "src2", 0), (n + 7, " \t\n ", "en", "src2", 3), (n + 8, "née ½ 中文  x y", "fr", "ß", 0)]
    out += [(n + 9, words(rng, 20_000), "en", "src0", 0), (None, "no id here at all", "en", "src0", 0)]
    out += [(n + 10, "the same row twice " * 4, "en", "src1", 9)] * 2
    return out


def docs(spark, clash: bool = True, seed: int = 1, n: int = 40):
    df = spark.createDataFrame(rows(seed, n), SCHEMA).repartition(3)
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES]) if clash else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
