"""A Spark session for local work.

On a cluster the session comes from the platform; nothing in this package sets
session options.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", name: str = "tallyboard") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
