"""Parquet tables of a dataset directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table `name` of the dataset directory, a file or a folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
