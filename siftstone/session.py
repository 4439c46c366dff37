"""Session defaults for local runs, tests and the benchmark.

On a cluster the submitter owns the session; nothing in the operators depends
on the values set here.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """A local session with adaptive execution on and UTC timestamps."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("siftstone")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
