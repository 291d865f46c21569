"""A session for one machine. On a cluster use the session the cluster gives."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = 8, memory: str = "12g", config: Mapping[str, str] | None = None
) -> SparkSession:
    """Local Spark with as many shuffle partitions as cores; adaptive execution stays on."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("jobtide")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in (config or {}).items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
