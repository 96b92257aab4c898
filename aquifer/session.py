"""Sessions set up as the engine expects them."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "aquifer", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session in UTC with adaptive execution and the RocksDB state store; ``master`` only for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    b = b.config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
    return b.getOrCreate()
