"""Overlapping and gapped intervals per entity: continuous periods and the gaps between them.

The aggregate's state is a sorted list of disjoint intervals, and two states combine by a linear merge.
States are built per input partition, combined in a reduction tree per (key, time bucket of the start),
and only then written out as rows, which a running maximum of the stops of earlier buckets joins. No
task ever holds one key's whole list, so a key with a third of all rows spreads over its buckets, and
a bucket with a third of all rows over FAN tasks first; an interval is never cut at a bucket's edge.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY_MS = 86_400_000
#: Inner nodes of the reduction tree below each (key, bucket).
FAN = 16

State = tuple[np.ndarray, np.ndarray]


def disjoint(start: np.ndarray, stop: np.ndarray) -> State:
    """The state of intervals that are sorted by their starts."""
    if not len(start):
        return start, stop
    reach = np.maximum.accumulate(stop)
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return start[first], np.maximum.reduceat(stop, first)


def combined(a: State, b: State) -> State:
    """The state of both: their starts are two sorted runs, which a stable sort merges in linear time."""
    start = np.concatenate([a[0], b[0]])
    order = np.argsort(start, kind="stable")
    return disjoint(start[order], np.concatenate([a[1], b[1]])[order])


def reduced(states: list[State]) -> State:
    """All states combined, pair by pair, level by level."""
    while len(states) > 1:
        states = [combined(*states[i : i + 2]) if i + 1 < len(states) else states[i] for i in range(0, len(states), 2)]
    return states[0]


def _folded(batches: Iterator[pd.DataFrame], keys: Sequence[str], pieces: Callable[[pd.DataFrame, np.ndarray], list[list[State]]]) -> Iterator[pd.DataFrame]:
    """The state of each key of batches sorted by keys; null keys are equal. `pieces` gives the states of each
    run of equal keys in a batch, the run that goes on from the batch before as number 0."""
    head: pd.DataFrame | None = None
    held: list[State] = []
    made = lambda heads, states: pd.concat(heads, ignore_index=True).assign(__s=[x for x, _ in states], __e=[x for _, x in states])
    for batch in batches:
        if batch.empty:
            continue
        mine = batch[list(keys)]
        both = mine if head is None else pd.concat([head, mine])
        new = np.zeros(len(both), dtype=bool)
        new[0] = True
        for k in keys:
            null = both[k].isna().to_numpy()
            value = both[k].to_numpy()
            new[1:] |= ~((value[1:] == value[:-1]).astype(bool) | (null[1:] & null[:-1]))
        new = new[len(both) - len(mine) :]
        run, first = np.cumsum(new), np.flatnonzero(new)
        states = pieces(batch, run)
        held += states[0]
        if len(first):
            heads, closed = ([head], [reduced(held)]) if head is not None else ([], [])
            if len(first) > 1:
                heads.append(mine.iloc[first[:-1]])
                closed += [reduced(x) for x in states[1:-1]]
            if heads:
                yield made(heads, closed)
            head, held = mine.iloc[first[-1:]], states[-1]
    if head is not None:
        yield made([head], [reduced(held)])


def _leaf_states(batch: pd.DataFrame, run: np.ndarray) -> list[list[State]]:
    """One state for each run of rows sorted by their starts, all runs at once."""
    start, stop = batch["__s"].to_numpy(), batch["__e"].to_numpy()
    reach = pd.Series(stop).groupby(run).cummax().to_numpy()
    first = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (start[1:] > reach[:-1])])
    s, e = start[first], np.maximum.reduceat(stop, first)
    edge = np.searchsorted(run[first], np.arange(run[-1] + 2))
    return [[(s[lo:hi], e[lo:hi])] if hi > lo else [] for lo, hi in zip(edge, edge[1:])]


def _node_states(batch: pd.DataFrame, run: np.ndarray) -> list[list[State]]:
    """The states of each run of rows that hold one each."""
    out: list[list[State]] = [[] for _ in range(run[-1] + 1)]
    for r, s, e in zip(run.tolist(), batch["__s"], batch["__e"]):
        out[r].append((s, e))
    return out


def _merged_lists(df: DataFrame, keys: Sequence[str], start: str, stop: str, bucket: int) -> tuple[DataFrame, list[str]]:
    """Sorted disjoint intervals per (key, bucket), as rows (__k*, __b, __s, __e)."""
    named = [f"__k{i}" for i in range(len(keys))]
    # Whole numbers beside a null would reach pandas as floats; nulls travel as a flag of their own.
    whole = [n for k, n in zip(keys, named) if dict(df.dtypes)[k] in ("bigint", "int", "smallint", "tinyint")]
    flags = [f"__z{n}" for n in whole]
    node = [*flags, *named, "__b"]
    key = lambda k, n: F.coalesce(F.col(f"`{k}`"), F.lit(0)) if n in whole else F.col(f"`{k}`")
    rows = df.select(
        *[F.col(f"`{k}`").isNull().alias(f"__z{n}") for k, n in zip(keys, named) if n in whole],
        *[key(k, n).cast(dict(df.dtypes)[k]).alias(n) for k, n in zip(keys, named)],
        F.floor(F.col(f"`{start}`").cast("long") / F.lit(bucket)).cast("long").alias("__b"),
        F.col(f"`{start}`").cast("long").alias("__s"),
        F.col(f"`{stop}`").cast("long").alias("__e"),
    ).filter("__s is not null and __e is not null and __e > __s")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[: len(node)]) + ", __s array<bigint>, __e array<bigint>"
    states = rows.sortWithinPartitions(*node, "__s").mapInPandas(lambda it: _folded(it, node, _leaf_states), schema)
    # The inner level takes each partition's state to one of FAN nodes, the root the nodes' states together.
    inner = states.withColumn("__n", F.pmod(F.spark_partition_id(), F.lit(FAN))).repartition(*node, "__n").drop("__n")
    for level in (inner, None):
        level = states.repartition(*node) if level is None else level
        states = level.sortWithinPartitions(*node).mapInPandas(lambda it: _folded(it, node, _node_states), schema)
    lists = states.select(*node, F.explode(F.arrays_zip("__s", "__e")).alias("x"))
    back = [F.when(~F.col(f"__z{n}"), F.col(n)).alias(n) if n in whole else F.col(n) for n in named]
    return lists.select(*back, "__b", F.col("x.__s").alias("__s"), F.col("x.__e").alias("__e")), named


def _with_reach(lists: DataFrame, named: list[str]) -> DataFrame:
    """Adds __p, the largest stop of any interval of the key that starts earlier."""
    buckets = lists.groupBy(*named, "__b").agg(F.max("__e").alias("__m"))
    earlier = Window.partitionBy(*named).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = buckets.select(*[F.col(c).alias(f"{c}c") for c in (*named, "__b")], F.max("__m").over(earlier).alias("__c"))
    on = [F.col(c).eqNullSafe(F.col(f"{c}c")) for c in (*named, "__b")]
    inside = Window.partitionBy(*named, "__b").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    joined = lists.join(carry, on).drop(*[f"{c}c" for c in (*named, "__b")])
    return joined.withColumn("__p", F.greatest(F.max("__e").over(inside), "__c")).drop("__c")


def interval_gaps(df: DataFrame, keys: Sequence[str], start: str, stop: str, out: tuple[str, str] = ("gapstart", "gapstop"), bucket: int = DAY_MS) -> DataFrame:
    """The longest stretches between a key's first start and last stop that no interval covers.

    Intervals are half-open [start, stop) of integers. Rows whose start or stop is null, and rows
    with stop <= start, cover nothing. Touching intervals leave no gap; repeated rows and ties
    change nothing. A null key is a key of its own. An empty table, and a key with one period,
    give no row. Other columns are ignored, whatever their names.
    """
    lists, named = _merged_lists(df, keys, start, stop, bucket)
    gaps = _with_reach(lists, named).filter("__p is not null and __s > __p")
    return gaps.select(*[F.col(n).alias(k) for n, k in zip(named, keys)], F.col("__p").alias(out[0]), F.col("__s").alias(out[1]))


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, stop: str, out: tuple[str, str] = ("periodstart", "periodstop"), bucket: int = DAY_MS) -> DataFrame:
    """Continuous periods: the union of a key's intervals as maximal disjoint ones.

    Rules for nulls, reversed and empty intervals, ties, repeats and null keys as in interval_gaps.
    """
    lists, named = _merged_lists(df, keys, start, stop, bucket)
    reach = _with_reach(lists, named)
    inside = Window.partitionBy(*named, "__b").orderBy("__s")
    opens = reach.filter("__p is null or __s > __p").withColumn("__q", F.lead("__p").over(inside)).withColumn("__last", F.lead("__s").over(inside).isNull())
    # A bucket's last period ends before the next bucket's first one, or at the key's last stop.
    later = Window.partitionBy(*named).orderBy(F.desc("__b")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        lists.groupBy(*named, "__b").agg(F.max("__e").alias("__m"), F.lit(None).cast("long").alias("__f"))
        .unionByName(opens.groupBy(*named, "__b").agg(F.lit(None).cast("long").alias("__m"), F.min_by("__p", "__s").alias("__f")))
        .groupBy(*named, "__b").agg(F.max("__m").alias("__m"), F.max("__f").alias("__f"))
    )
    ends = buckets.select(
        *[F.col(c).alias(f"{c}c") for c in (*named, "__b")],
        F.coalesce(F.last("__f", ignorenulls=True).over(later), F.max("__m").over(Window.partitionBy(*named))).alias("__end"),
    )
    on = [F.col(c).eqNullSafe(F.col(f"{c}c")) for c in (*named, "__b")]
    whole = opens.join(ends, on).withColumn("__stop", F.when(F.col("__last"), F.col("__end")).otherwise(F.col("__q")))
    return whole.select(*[F.col(n).alias(k) for n, k in zip(named, keys)], F.col("__s").alias(out[0]), F.col("__stop").alias(out[1]))
