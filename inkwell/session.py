"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Configs the operators are written against.  AQE re-plans joins and
# coalesces/splits partitions at runtime (and splits skewed join
# partitions); the session-window flag merges sessions inside a partition
# where Spark supports it (streaming).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def get_spark(app: str = "inkwell", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
