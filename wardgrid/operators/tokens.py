"""Timelines of tokens: expansion of events, vocabularies, ids, and the index of timelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c, gap_tokens, split_quantile
from wardgrid.operators.events import row_index

END = "TIMELINE_END"
UNKNOWN = "UNK"


def expanded(events: DataFrame, group: Sequence[str], time: str, code: str, minutes: Column | None = None) -> DataFrame:
    """(group, seq, token, time): the gap before an event, its code, its quantile, and an end after the last.

    Events are ordered by time and code. `time` counts milliseconds unless `minutes` turns it into
    minutes. Tokens are made by arrays in the executors; no timeline is gathered.
    """
    w = Window.partitionBy(*group).orderBy(time, code)
    at = minutes if minutes is not None else c(time) / F.lit(60_000.0)
    rows = events.filter(c(time).isNotNull() & c(code).isNotNull()).withColumn("__m", at)
    rows = rows.withColumns({"__gap": F.col("__m") - F.lag("__m").over(w), "__n": F.row_number().over(w), "__last": F.lead(code).over(w).isNull()})
    tokens = F.concat(F.coalesce(gap_tokens(F.col("__gap")), F.array().cast("array<string>")), split_quantile(c(code)), F.when(F.col("__last"), F.array(F.lit(END))).otherwise(F.array().cast("array<string>")))
    long = rows.select(*group, c(time).alias("time"), "__n", F.posexplode(tokens).alias("__p", "token"))
    seq = F.row_number().over(Window.partitionBy(*group).orderBy("__n", "__p")) - 1
    return long.select(*group, seq.cast("long").alias("seq"), "token", "time")


def vocabulary(tokens: DataFrame, token: str = "token", unknown: str = UNKNOWN) -> DataFrame:
    """(token, id, n): different tokens in order from 0, the unknown one among them; numbered in ranges, so no
    task orders them all."""
    counts = tokens.groupBy(token).agg(F.count("*").alias("n"))
    all_ = counts.unionByName(tokens.sparkSession.createDataFrame([(unknown, 0)], f"{token} string, n long")).groupBy(token).agg(F.sum("n").alias("n"))
    parts = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return row_index(all_, [token], parts, "id").select(token, F.col("id").cast("long").alias("id"), "n")


def numbered(tokens: DataFrame, vocab: DataFrame, token: str = "token", unknown: str = UNKNOWN) -> DataFrame:
    """Adds the token's id, that of the unknown token where it has none, and whether it has none."""
    joined = tokens.join(vocab.select(token, "id"), token, "left").withColumn("is_unknown", F.col("id").isNull())
    spare = vocab.filter(c(token) == unknown).select(c(token).alias("__u"), F.col("id").alias("__unk"))  # one row
    joined = joined.withColumn("__u", F.when(F.col("is_unknown"), F.lit(unknown))).join(F.broadcast(spare), "__u", "left")
    return joined.withColumn("id", F.coalesce("id", "__unk")).drop("__u", "__unk")


def timeline_index(tokens: DataFrame, group: Sequence[str], shard: Column | None = None) -> DataFrame:
    """(group, shard, first, n): where each timeline's tokens begin in its shard, timelines in order of their keys."""
    sizes = tokens.groupBy(*group).agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("shard", F.lit(0) if shard is None else shard)
    w = Window.partitionBy("shard").orderBy(*group).rowsBetween(Window.unboundedPreceding, 0)
    return sizes.withColumn("first", F.sum("n").over(w) - F.col("n"))
