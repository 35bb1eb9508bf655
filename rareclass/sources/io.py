"""Sources and sinks.

All reads are lazy DataFrame scans; all writes are distributed writers.  Nothing
here collects a table to the driver.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml.functions import array_to_vector

# Fixed metrics schema shared by every scorer (trap T11: one schema for all).
METRICS_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("roc_auc", T.DoubleType()),
        T.StructField("pr_auc", T.DoubleType()),
        T.StructField("precision", T.DoubleType()),
        T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
    ]
)


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
) -> DataFrame:
    """CSV or Parquet scan.

    For CSV an explicit ``schema`` is preferred (column pruning reaches the
    reader and no inference job runs); ``infer_schema=True`` reproduces the
    reference's inference.  Without either, every column is read as string so
    dirty values survive to :func:`rareclass.operators.clean.cast_columns`.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header).option("inferSchema", infer_schema and schema is None)
        return reader.csv(path)
    return reader.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: str | list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Distributed overwrite sink (optionally partitioned)."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.save(path)


def read_label_first(
    spark: SparkSession,
    directory: str,
    n_features: int,
    fmt: str = "csv",
) -> DataFrame:
    """Headerless label-first files of a directory -> ``label, features``.

    Column 0 is the label, the rest are features.  Raises when the directory
    holds no file of the format (as the reference loaders do).
    """
    cols = ["label"] + [f"f{i}" for i in range(n_features)]
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in cols])
    if fmt == "csv":
        df = (
            spark.read.schema(schema)
            .option("header", False)
            .option("pathGlobFilter", "*.csv")
            .csv(directory)
        )
    else:
        df = spark.read.option("pathGlobFilter", f"*.{fmt}").format(fmt).load(directory)
        df = df.toDF(*cols)
    if not df.inputFiles():
        raise ValueError(f"No {fmt.upper()} files found in {directory}")
    return df.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.array(*[F.col(c).cast("double") for c in cols[1:]])).alias("features"),
    )


def write_label_first(df: DataFrame, path: str, fmt: str = "csv", label: str = "label", features: str = "features") -> None:
    """Counterpart of :func:`read_label_first`: label then features, no header."""
    from pyspark.ml.functions import vector_to_array

    arr = vector_to_array(F.col(features))
    first = df.select(features).first()  # one row: the vector width
    n = len(first[0]) if first is not None else 0
    out = df.select(F.col(label).cast("double").alias("label"), *[arr[i].alias(f"f{i}") for i in range(n)])
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", False).csv(path)
    else:
        writer.format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics rows as JSON lines."""
    metrics.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Read one metrics JSON per model; a missing model is warned about and skipped."""
    import warnings

    frames = []
    for model, path in paths.items():
        if not _exists(spark, path):
            warnings.warn(f"metrics for {model} not found at {path}; skipped")
            continue
        frames.append(
            spark.read.schema(METRICS_SCHEMA).json(path).withColumn("model", F.lit(model))
        )
    if not frames:
        return spark.createDataFrame([], METRICS_SCHEMA)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names: Iterable[str] = TABLES) -> None:
    """Register the given parquet tables as temp views."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-distribute ``df`` over the cluster's cores before CPU-heavy row work
    (regex cleaning, tokenising) when the scan yields fewer tasks than cores.

    A Parquet file with one large row group is read by one task however many
    byte splits it has; its text would then be cleaned on one core.  On a large
    input the scan already has far more splits than cores and this is a no-op
    (no extra shuffle).  Hashing on ``keys`` keeps the layout deterministic
    when a lost task is recomputed.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)
