"""Session helpers: a local session for tests and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rareclass") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session.  Where it is unset, a
    private folder is created in local mode only (tests); on a cluster, whose
    executors could not see it, that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="rareclass-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the Python workers (pandas UDFs,
    ``mapInPandas``) wherever the driver was started from.

    The package's sources go out as one zip through ``addPyFile`` - the same as
    ``--py-files``, on any cluster (a plain folder could only be added in local
    mode).  The zip is only the upload's source on the driver; every executor
    gets its own copy.  Once per context.
    """
    sc = spark.sparkContext
    if getattr(sc, "_rareclass_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="rareclass-"), "rareclass.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(pkg):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._rareclass_shipped = True
