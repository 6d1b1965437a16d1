"""Delimited text with declared types, as source and as sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """Rows of a CSV file; a value that does not fit its declared type is an error."""
    return spark.read.csv(path, schema=schema, header=header, mode="FAILFAST")


def replace_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)
