"""Session settings that fit both a laptop and a large cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# AQE plans joins from measured sizes, splits skewed partitions and merges small ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | None = None, scratch: str | None = None) -> SparkSession:
    """Session for tests and benchmarks on one machine.

    `scratch` becomes the checkpoint folder; without it a new folder of this machine does.
    """
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName("rollbook")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.checkpoint.dir", scratch or tempfile.mkdtemp(prefix="rollbook-"))
    )
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
