"""Session helpers.

The library never creates its own cluster settings beyond what a test or the
bench needs: on a cluster the session is handed in and its configuration
(shuffle partitions, checkpoint dir, AQE) is respected.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.maxPlanStringLength": "1000000",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              driver_memory: str = "8g", app: str = "cellrisk") -> SparkSession:
    """Local session for tests and the bench (cluster jobs pass their own)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read; a
    session on a cluster that does not set it is an error.  On a local master
    (tests) a fresh scratch folder is created and registered.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: it has to name a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="cellrisk-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf)
    return conf
