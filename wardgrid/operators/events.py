"""Events of a timeline: boundaries of intervals, facts about a stay, order, and what holds of all."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.functions.columns import c
from wardgrid.session import stored


def boundary_events(df: DataFrame, keys: Sequence[str], code: Column, start: str, stop: str, keep: Column | None = None) -> DataFrame:
    """(keys, time, code): a START and an END event for every interval with stop >= start, in one scan;
    `keep` is a condition on the event's `time`."""
    pair = F.array(F.struct(c(start).alias("time"), F.concat(code, F.lit("//START")).alias("code")), F.struct(c(stop).alias("time"), F.concat(code, F.lit("//END")).alias("code")))
    rows = df.filter(c(stop) >= c(start)).select(*keys, F.explode(pair).alias("e")).select(*keys, "e.time", "e.code")
    return rows if keep is None else rows.filter(keep)


def facts(df: DataFrame, keys: Sequence[str], events: Sequence[tuple[Column, Column, Column]]) -> DataFrame:
    """(keys, time, code, text_value) of several events made from each row; those without a time or code go."""
    made = F.array(*[F.struct(t.alias("time"), code.alias("code"), text.cast("string").alias("text_value")) for t, code, text in events])
    return df.select(*keys, F.explode(made).alias("e")).select(*keys, "e.*").filter("time is not null and code is not null")


def ordered(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str = "seq") -> DataFrame:
    """Adds the place of each event in its timeline from 0, missing values last."""
    w = Window.partitionBy(*group).orderBy(*[F.asc_nulls_last(o) for o in order])
    return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))


def row_index(df: DataFrame, order: Sequence[str], parts: int, out: str = "row") -> DataFrame:
    """Adds each row's place from 0 in an order of columns, missing values last, over the whole table.

    The rows are put into `parts` ranges and numbered inside each; the ranges' sizes, `parts` numbers, move
    them. Name enough columns: rows that are equal in all of them get their places in any order.
    """
    nulls = [c(o).isNull().alias(f"__n{i}") for i, o in enumerate(order)]
    keys = [k for i, o in enumerate(order) for k in (f"__n{i}", o)]
    ranged = stored(df.select("*", *nulls).repartitionByRange(parts, *[c(k) for k in keys]).withColumn("__p", F.spark_partition_id()))
    sizes = {r["__p"]: r["n"] for r in ranged.groupBy("__p").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for p in sorted(sizes):
        before.append((p, total))
        total += sizes[p]
    place = F.row_number().over(Window.partitionBy("__p").orderBy(*[c(k) for k in keys])) - 1
    moved = ranged.withColumn(out, place).join(df.sparkSession.createDataFrame(before, "__p int, __o long"), "__p")
    return moved.withColumn(out, c(out) + F.col("__o")).select(*[c(x) for x in df.columns if x != out], out)


def assigned_deaths(stays: DataFrame, person: str, stay: str, start: str, stop: str, death: str, grace_ms: int = 86_400_000) -> DataFrame:
    """Each recorded death with one stay: (person, stay, relation, hours_after, emitted, event_time).

    A person's earliest recorded death belongs to the last stay that it falls into, from grace_ms before its start
    to its stop (during_stay, stamped at the stop); else to the last stay that stopped before it (within_grace,
    stamped at the death, or later, not emitted). Persons without a recorded death, or with one before
    every stay, give no row. Ties of starts and stops fall to the larger stay id.
    """
    dead = stays.groupBy(person).agg(F.min(death).alias("__d")).filter("__d is not null")
    rows = stays.select(person, stay, c(start).alias("__a"), c(stop).alias("__b")).join(dead, person).filter("__b is not null")
    during = F.coalesce((F.col("__d") >= F.col("__a") - grace_ms) & (F.col("__d") <= F.col("__b")), F.lit(False))
    after = F.col("__d") > F.col("__b")
    rows = rows.filter(during | after).withColumn("__during", during)
    best = F.max(F.struct("__during", F.when(F.col("__during"), F.col("__a")).otherwise(F.col("__b")).alias("t"), c(stay).alias("stay"), "__b", "__d"))
    one = rows.groupBy(person).agg(best.alias("x")).select(person, F.col("x.stay").alias(stay), "x.__during", "x.__b", "x.__d")
    late = F.col("__d") - F.col("__b")
    relation = F.when(F.col("__during"), "during_stay").when(late <= grace_ms, "within_grace").otherwise("later")
    emitted = F.col("__during") | (late <= grace_ms)
    return one.select(person, stay, relation.alias("relation"), (late / F.lit(3_600_000.0)).alias("hours_after"), emitted.alias("emitted"), F.when(F.col("__during"), F.col("__b")).when(emitted, F.col("__d")).alias("event_time"))


def earliest_facts(df: DataFrame, keys: Sequence[str], fact: str, time: str, tie: str, role: str = "role") -> DataFrame:
    """One row for each different fact, its earliest; the first fact of all of its keys is `static`, others `dynamic`."""
    w = Window.partitionBy(*keys, fact).orderBy(F.asc_nulls_last(time), F.asc_nulls_last(tie))
    one = df.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")
    first = F.min(time).over(Window.partitionBy(*keys))
    return one.withColumn(role, F.when(c(time).eqNullSafe(first), "static").otherwise("dynamic"))


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(rule, n): how many rows break each rule (a condition that holds of bad rows), all counted in one pass."""
    names = list(rules)
    counts = df.agg(*[F.count_if(F.coalesce(rules[n], F.lit(False))).alias(f"__{i}") for i, n in enumerate(names)])
    made = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"__{i}").alias("n")) for i, n in enumerate(names)])
    return counts.select(F.explode(made).alias("x")).select("x.*")
