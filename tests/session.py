"""A local session as the tests and tools use it."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def share_folder(spark: SparkSession) -> SparkSession:
    """A session of this machine alone may share its temporary folder."""
    context = spark.sparkContext
    if context.master.startswith("local[") and not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="shelfline-"))
    return spark


def local_session(cpus: int | str = 8, partitions: int = 8) -> SparkSession:
    os.environ.setdefault("PYSPARK_PYTHON", "python")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    share_folder(spark)
    return spark
