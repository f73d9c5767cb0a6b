"""Spark session construction and cluster-safe scratch locations.

Everything in the library is lazy DataFrame code; this module only decides
session-wide settings (AQE, time zone, Arrow) and where lineage may be cut.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of the library wants. AQE re-plans joins at runtime
# (broadcast when a side is measured small, skew-join splitting of hot keys,
# partition coalescing after shuffles).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    filesystem), and it must be set there. Only a local session that leaves
    it unset (tests) gets a private one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # noqa: BLE001 - sessions without a SparkContext handle
        pass
    return path


def cut_lineage(df: DataFrame, name: str = "cut", compression: str = "snappy") -> DataFrame:
    """``df`` written as parquet to a new folder below the shared one and read
    back: survives executor loss, and whatever depends on the partitioning of
    this one job (range samples, positions in a partition) is fixed by it."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(df: DataFrame) -> DataFrame:
    """``df``; Python workers that it starts find this package where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", root)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
