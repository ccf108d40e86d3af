"""A vocabulary's policy layers: reviewed decisions and rules laid over a baseline, in an order that is
part of the meaning, with an account of what each one changed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.functions.columns import c
from wardgrid.operators.lookups import overwritten


@dataclass(frozen=True)
class Manifest:
    """Reviewed decisions: a row a token with the fields it sets, null or not."""

    name: str
    rows: DataFrame
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Rule:
    """Where the condition holds, fields get these values; all are taken from the state before the rule."""

    name: str
    where: Column
    sets: Mapping[str, Column]


def applied(state: DataFrame, layers: Sequence[Manifest | Rule], key: str) -> DataFrame:
    """The state after all layers, with `changed`, the names of the layers that changed a row, in order.

    A manifest that names a token twice is an error, raised when the rows are made; a token that the
    state lacks is passed over. A layer that sets what is there already changes nothing.
    """
    now = state.withColumn("changed", F.array().cast("array<string>"))
    for layer in layers:
        fields = list(layer.fields if isinstance(layer, Manifest) else layer.sets)
        kept = now.withColumns({f"__old_{f}": c(f) for f in fields})
        if isinstance(layer, Manifest):
            seen = layer.rows.groupBy(c(key)).agg(*[F.first(c(f)).alias(f) for f in fields], F.count("*").alias("__n"))
            twice = F.when(F.col("__n") > 1, F.raise_error(F.concat(F.lit(f"{layer.name} decides twice on "), c(key).cast("string"))).cast("int"))
            after = overwritten(kept.withColumn("__twice", F.lit(None).cast("int")), seen.withColumn("__twice", twice), key, [*fields, "__twice"])
            after = after.filter("__twice is null").drop("__twice")
        else:
            where = F.coalesce(layer.where, F.lit(False))
            after = kept.withColumns({f: F.when(where, value).otherwise(c(f)) for f, value in layer.sets.items()})
        differs = reduce(lambda a, b: a | b, [~c(f).eqNullSafe(F.col(f"__old_{f}")) for f in fields])
        now = after.withColumn("changed", F.when(differs, F.concat("changed", F.array(F.lit(layer.name)))).otherwise(F.col("changed"))).drop(*[f"__old_{f}" for f in fields])
    return now


def account(state: DataFrame, layers: Sequence[Manifest | Rule]) -> DataFrame:
    """(layer, n): how many tokens each layer changed, in the layers' order by `place`; counted in one pass."""
    counts = state.agg(*[F.count_if(F.array_contains("changed", layer.name)).alias(f"__{i}") for i, layer in enumerate(layers)])
    made = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(layer.name).alias("layer"), F.col(f"__{i}").alias("n")) for i, layer in enumerate(layers)])
    return counts.select(F.explode(made).alias("x")).select("x.*")
