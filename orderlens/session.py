"""Session settings the jobs rely on; all can be set on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A join on a skewed key is split even where an aggregate on that key follows: the extra shuffle
# costs far less than one task with a third of the rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # shuffles begin with many partitions, and neighbours are merged up to this size, as are splits of files: what a task sorts or
    # groups stays the same however large the tables are
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "16m",
}
PARTITIONS = 1000  # that a shuffle begins with, at least; 16 GB of them fill up to the size above


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(PARTITIONS, given)))
    return spark
