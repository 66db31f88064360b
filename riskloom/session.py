"""Session settings shared by the tests, the bench and ad-hoc use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, name: str = "riskloom") -> SparkSession:
    """A local session. On a cluster the caller's own session is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
