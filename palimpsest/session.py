"""Session helpers: local sessions for tests and the checkpoint folder shared by all executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, name: str = "palimpsest", **conf: str) -> SparkSession:
    """A session on this machine; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that the session names in spark.checkpoint.dir; a temporary one only on one machine, as in tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="palimpsest-"))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
