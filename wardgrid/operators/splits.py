"""Samples and splits of ids by a hash order that any engine can repeat."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c
from wardgrid.operators.events import row_index
from wardgrid.operators.lookups import null_safe


def hash_order(key: Column, seed: int) -> Column:
    """The order of a seeded shuffle: the MD5 of seed and key."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def sample(ids: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n different keys by the seeded order."""
    return ids.select(key).filter(c(key).isNotNull()).distinct().orderBy(hash_order(c(key), seed), key).limit(n)


def first_ids(ids: DataFrame, key: str, n: int) -> DataFrame:
    """The n smallest keys."""
    return ids.select(key).filter(c(key).isNotNull()).distinct().orderBy(key).limit(n)


def _ranked(ids: DataFrame, key: str, seed: int, parts: int = 256) -> tuple[DataFrame, int]:
    """Each key's place in the seeded order from 0, and how many there are: ranked inside 256 ranges of the
    hash, then moved by the sizes of the ranges before, so no task sorts all keys."""
    keys = ids.select(key).filter(c(key).isNotNull()).distinct().withColumn("__h", hash_order(c(key), seed)).withColumn("__p", F.conv(F.substring("__h", 1, 2), 16, 10).cast("int"))
    sizes = {r["__p"]: r["n"] for r in keys.groupBy("__p").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in range(parts):
        before.append((p, total))
        total += sizes.get(p, 0)
    offsets = keys.sparkSession.createDataFrame(before, "__p int, __o long")
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("__h", key)) - 1
    return keys.withColumn("__r", rank).join(F.broadcast(offsets), "__p").select(key, (F.col("__r") + F.col("__o")).alias("rank")), total


def rounded_split(ids: DataFrame, key: str, shares: Mapping[str, float], seed: int = 0) -> DataFrame:
    """(key, split): each split but the last gets round(n * share) keys, halves to even, in the seeded order."""
    ranked, n = _ranked(ids, key, seed)
    return ranked.select(key, _cut(F.col("rank"), [(s, round(n * f)) for s, f in shares.items()]).alias("split"))


def largest_remainder_split(ids: DataFrame, key: str, shares: Mapping[str, float], seed: int = 0) -> DataFrame:
    """(key, split): floors of n * share, and what is left to the largest remainders (ties: the first)."""
    ranked, n = _ranked(ids, key, seed)
    sizes = {s: int(n * f) for s, f in shares.items()}
    order = sorted(shares, key=lambda s: -(n * shares[s] - sizes[s]))
    for s in order[: n - sum(sizes.values())]:
        sizes[s] += 1
    return ranked.select(key, _cut(F.col("rank"), list(sizes.items())).alias("split"))


def _cut(rank: Column, sizes: list[tuple[str, int]]) -> Column:
    out, upto = F.lit(sizes[-1][0]), sum(n for _, n in sizes[:-1])
    for name, n in reversed(sizes[:-1]):
        out = F.when(rank < upto, F.lit(name)).otherwise(out)
        upto -= n
    return out


def attached(df: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """df with the split of its key. A key that the manifest lacks or has twice is an error, raised when
    the rows are made."""
    one = manifest.groupBy(key).agg(F.max("split").alias("split"), F.count("*").alias("__n"))
    joined = df.drop("split").join(one, key, "left")
    wrong = F.when(F.col("__n").isNull(), F.raise_error(F.concat(F.lit(f"no split for {key} "), c(key).cast("string")))).when(F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"several splits for {key} "), c(key).cast("string"))))
    return joined.withColumn("split", F.coalesce(wrong.cast("string"), "split")).drop("__n")


def sharded(units: DataFrame, unit: str, per_shard: int, split: str = "split") -> DataFrame:
    """units (unit, split) with `shard`: per_shard units each, by unit within a split.

    Units are put into ranges and numbered inside each, so no task sorts a split; see row_index."""
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = row_index(units.select(unit, split).distinct(), [split, unit], parts, "__row")
    first = placed.groupBy(split).agg(F.min("__row").alias("__first"))  # a row for each split
    return null_safe(placed, first, [split]).select(unit, split, F.floor((F.col("__row") - F.col("__first")) / F.lit(per_shard)).cast("long").alias("shard"))
