"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here is also safe on a cluster: AQE sizes the reduce side and
# splits skewed join partitions, so the initial shuffle width is only a ceiling.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # The JVM never compiles a method of more than 8,000 bytecodes. A fused stage
    # that large would run interpreted (measured about three to four times slower), so
    # such a stage is split into per-operator code instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Column call-site capture costs more than building the expressions themselves.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the code-generation limit to a session that was built elsewhere."""
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, DEFAULTS[key])
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and ``bench.py``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("polderbook")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
