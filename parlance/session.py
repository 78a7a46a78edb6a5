"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "20g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("parlance")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; a local one only on a local master."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder: lineage is cut there")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()
