"""A session for one machine: tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, memory: str = "12g", **conf: str) -> SparkSession:
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": memory,
        "spark.driver.host": "127.0.0.1",
    } | conf
    return SparkSession.builder.master(f"local[{cores}]").appName("tallymark").config(map=settings).getOrCreate()
