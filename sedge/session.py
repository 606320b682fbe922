"""Session settings: adaptive execution with skew handling, Arrow transfer, UTC."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "sedge", **settings: str) -> SparkSession:
    """A session with the engine's defaults; the cluster's own settings and ``settings`` take precedence."""
    builder = SparkSession.builder.appName(app)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    for k, v in (defaults | settings).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def cut(df: DataFrame) -> DataFrame:
    """The table kept in the shared folder (``spark.checkpoint.dir``), without its lineage.

    Only a local session may lack the setting and gets a folder on this machine.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="sedge-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()
