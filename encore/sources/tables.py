"""Batch and stream inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet folder; a declared schema saves reading a footer and fixes names and types."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str, columns: list[str] | None = None) -> DataFrame:
    table = spark.table(name)
    return table.select(*columns) if columns else table


def kafka_actions(spark: SparkSession, brokers: str, topic: str, group: str, **options: str) -> DataFrame:
    """Action records of a topic, from the latest offset on. Needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").options(**{
        "kafka.bootstrap.servers": brokers, "subscribe": topic, "startingOffsets": "latest",
        "groupIdPrefix": group, **options,
    })
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def file_actions(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Action records of the text files that arrive in a folder, one record per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("value")
