"""Sessions: UTC, adaptive execution, Arrow."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(name: str = "quillspark", cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", **more: str) -> SparkSession:
    """A local session; on a cluster, pass the cluster's own session to every function instead."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): str(v) for k, v in more.items()}
    out = SparkSession.builder.master(f"local[{cores}]").appName(name).config(map=conf).getOrCreate()
    out.sparkContext.setLogLevel("ERROR")
    return out
