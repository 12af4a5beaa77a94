"""Relational warehouse over JDBC (the driver jar comes from the cluster)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int = 1,
    **properties: str,
) -> DataFrame:
    """Table scan; give a partition column and its bounds to read with parallel range queries."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", lower)
            .option("upperBound", upper)
            .option("numPartitions", partitions)
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", connections: int = 16, **properties: str) -> None:
    """Write with at most ``connections`` parallel sessions; ``overwrite`` keeps grants by truncating."""
    (
        df.write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", "true")
        .option("numPartitions", connections)
        .options(**properties)
        .save()
    )
