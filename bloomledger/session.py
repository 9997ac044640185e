"""Session set-up for tests, benchmarks and scripts.

Library functions never build or change a session; a cluster job passes its own,
best with the settings below that are not about local mode.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "bloomledger") -> SparkSession:
    """Local session with the settings the results rely on (UTC, AQE)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        # The JVM does not compile methods above 8000 bytes of bytecode.  Long
        # chains of patterns reach that in one fused stage, and run twice as fast
        # as separate projections, whose code Spark splits into small methods.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
