"""Session settings the package is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# On a cluster pass these to spark-submit; sizes there follow the cluster.
CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Python workers get long texts in batches of this many bytes, however many rows that is.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    # State of the windowed counts off the heap, so its size is not bound by it.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cpus: str = "*", partitions: int = 8, app: str = "hiretide",
                  memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark = (builder.config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.driver.memory", memory)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
