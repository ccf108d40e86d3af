"""Exact quantiles of keys of any size: no task holds or sorts one key's values.

Values are counted; counts are added up by logarithmic bucket, some thousands a key at most; the buckets'
running sums tell in which buckets the wanted ranks lie, and only the values of those are put in order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c
from wardgrid.operators.lookups import null_safe

#: Relative width of a bucket, and what keeps the buckets' numbers apart from 0.
WIDTH, OFFSET, LAST = 0.02, 50_000, 1_000_000


def _bucket(v: Column) -> Column:
    """Numbers that rise with the value: 0 for 0, infinities outermost, NaN above all, as it is ordered."""
    size = F.least(F.ceil(F.log(F.abs(v)) / F.lit(math.log1p(WIDTH))), F.lit(OFFSET)) + F.lit(OFFSET)
    return F.when(F.isnan(v), LAST).when(v == 0, 0).otherwise(F.signum(v) * size).cast("int")


def values_at(df: DataFrame, keys: Sequence[str], value: str, ranks: Callable[[Column], Column], copies: Column | None = None) -> DataFrame:
    """(keys, n, values): the values at the ranks, from 0, that `ranks` gives as an array for a key's number n.

    Nulls aren't counted; a value counts `copies` times, those of less than 1 not at all. A key without
    values gives no row; null keys are keys. The array of ranks is as long as the caller makes it.
    """
    keys = list(keys)
    n = F.lit(1) if copies is None else copies
    rows = df.select(*keys, c(value).cast("double").alias("__v"), n.cast("long").alias("__c")).filter("__v is not null and __c > 0")
    counts = rows.groupBy(*keys, "__v").agg(F.sum("__c").alias("__c")).withColumn("__b", _bucket(F.col("__v")))
    along = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    buckets = counts.groupBy(*keys, "__b").agg(F.sum("__c").alias("__m"))
    buckets = buckets.withColumns({"__from": F.sum("__m").over(along) - F.col("__m"), "__all": F.sum("__m").over(Window.partitionBy(*keys))})
    wanted = F.transform(ranks(F.col("__all")), lambda r, i: F.struct(r.cast("long").alias("r"), i.alias("i")))
    here = buckets.withColumn("__t", F.filter(wanted, lambda t: (t["r"] >= F.col("__from")) & (t["r"] < F.col("__from") + F.col("__m")))).filter("size(__t) > 0")
    inside = null_safe(counts, here.select(*keys, "__b", "__from", "__all", "__t"), [*keys, "__b"])
    upto = F.col("__from") + F.sum("__c").over(Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0))
    found = inside.withColumn("__upto", upto)
    found = found.withColumn("__t", F.explode(F.filter("__t", lambda t: (t["r"] < F.col("__upto")) & (t["r"] >= F.col("__upto") - F.col("__c")))))
    packed = found.groupBy(*keys).agg(F.max("__all").alias("n"), F.sort_array(F.collect_list(F.struct("__t.i", "__v"))).alias("__p"))
    return packed.select(*keys, "n", F.col("__p.__v").alias("values"))


def percentiles(df: DataFrame, keys: Sequence[str], value: str, at: Sequence[float], copies: Column | None = None) -> DataFrame:
    """(keys, n, p): percentiles at shares of 0 to 1, linear between neighbouring values; see values_at."""
    place = lambda n, q: (n - 1) * F.lit(float(q))
    found = values_at(df, keys, value, lambda n: F.array(*[f(place(n, q)) for q in at for f in (F.floor, F.ceil)]), copies)
    low = lambda i: F.col("values")[2 * i]
    part = lambda q: place(F.col("n"), q) - F.floor(place(F.col("n"), q))
    return found.select(*keys, "n", F.array(*[F.when(part(q) == 0, low(i)).otherwise(low(i) + (F.col("values")[2 * i + 1] - low(i)) * part(q)) for i, q in enumerate(at)]).alias("p"))


def evenly(df: DataFrame, keys: Sequence[str], value: str, many: int) -> DataFrame:
    """(keys, n, p): `many` percentiles from the least value to the greatest, evenly spaced; see values_at."""
    place = lambda n: F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda i: (n - 1) * i / F.lit(many - 1))
    found = values_at(df, keys, value, lambda n: F.flatten(F.transform(place(n), lambda x: F.array(F.floor(x), F.ceil(x)))))
    between = lambda x, i: F.get("values", 2 * i) + F.when(x > F.floor(x), (F.get("values", 2 * i + 1) - F.get("values", 2 * i)) * (x - F.floor(x))).otherwise(0.0)
    return found.select(*keys, "n", F.transform(place(F.col("n")), between).alias("p"))


def nearest_ranks(df: DataFrame, keys: Sequence[str], value: str, bins: int) -> DataFrame:
    """(keys, n, values): the values at the ranks round((n - 1) i / bins), halves up, in whole numbers; see values_at."""
    return values_at(df, keys, value, lambda n: F.array(*[F.floor(((n - 1) * F.lit(2 * i) + F.lit(bins)) / F.lit(2 * bins)) for i in range(1, bins)]))
