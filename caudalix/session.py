"""Session defaults and the few places where a plan must be cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build(app: str = "caudalix", master: str = "local[8]", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.appName(app).master(master)
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where it is unset and Spark runs on one machine (tests, the bench) a temporary folder serves; on a cluster that would
    be a folder the executors do not share, so it is an error there.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named is None and (known := sc.getCheckpointDir()) is not None:
        named = known
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="caudalix-checkpoint-")
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; the result survives the loss of executors."""
    sc = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
