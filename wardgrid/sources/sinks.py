"""Datasets written as wholes: by split and shard, replaced at once, never over what isn't ours."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.columns import c


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), options: Mapping | None = None) -> None:
    """Writes beside the path, then takes its place, so a dataset may be rewritten from itself.

    The old dataset is moved aside, the new one moved in, and only then is the old one deleted: at any
    moment one of them is there whole. If the new one can't be moved in, the old one is put back.
    """
    fs, target, jvm = _fs(df.sparkSession, path)
    path = path.rstrip("/")
    mark = uuid.uuid4().hex[:8]
    new, old = (jvm.org.apache.hadoop.fs.Path(f"{path}.{what}-{mark}") for what in ("new", "old"))
    writer = df.write.options(**(options or {}))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(new.toString())
    if fs.exists(target) and not fs.rename(target, old):
        raise OSError(f"{path} could not be moved aside; the new dataset is {new.toString()}")
    if not fs.rename(new, target):
        if fs.exists(old):
            fs.rename(old, target)
        raise OSError(f"{new.toString()} could not take the place of {path}")
    fs.delete(old, True)


def write_by_key(df: DataFrame, path: str, key: str, parts: int = 64) -> None:
    """Parquet by `part`, the key's remainder, so that all rows of a key lie in one folder; null keys in part -1."""
    part = F.coalesce(F.pmod(c(key).cast("long"), F.lit(parts)).cast("int"), F.lit(-1))
    replace(df.withColumn("part", part).repartition("part"), path, ["part"])


def write_shards(df: DataFrame, path: str, split: str = "split", shard: str = "shard", order: Sequence[str] = ()) -> None:
    """Parquet by split and shard, one file each: rows of a shard meet in one task, sorted by order."""
    rows = df.repartition(split, shard).sortWithinPartitions(split, shard, *order)
    replace(rows, path, [split, shard])


def write_by_split(df: DataFrame, path: str, split: str = "split", rows_per_file: int = 1_000_000) -> None:
    """Parquet by split, each task's rows in parts of at most rows_per_file: a large table isn't shuffled for it."""
    replace(df, path, [split], {"maxRecordsPerFile": rows_per_file})


def guard(spark: SparkSession, path: str, known: Sequence[str], overwrite: bool = False) -> None:
    """Makes ready an output folder: known results there are an error, or deleted if overwrite; others stay."""
    fs, target, jvm = _fs(spark, path)
    found = [n for n in known if fs.exists(jvm.org.apache.hadoop.fs.Path(target, n))]
    if found and not overwrite:
        raise FileExistsError(f"{path} holds {', '.join(found)}")
    for n in found:
        fs.delete(jvm.org.apache.hadoop.fs.Path(target, n), True)
    fs.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a dataset of ours."""
    fs, target, _ = _fs(spark, path)
    fs.delete(target, True)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A small text file beside a dataset."""
    fs, target, _ = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_json(spark: SparkSession, content: Mapping, path: str) -> None:
    """A small JSON file beside a dataset."""
    write_text(spark, json.dumps(content, indent=1, sort_keys=True, default=str), path)


def write_csv(df: DataFrame, path: str) -> None:
    """A small table as one CSV file in a folder."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
