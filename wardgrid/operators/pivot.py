"""Attribute-value rows into wide tables: one row per entity, one typed column per attribute."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A wide table has at most this many columns; discovery of more is an error, not a cut.
MAX_ATTRIBUTES = 5_000


@dataclass(frozen=True)
class Attribute:
    """An attribute's id, its column's name, and its type: integer, decimal or flag."""

    id: int
    name: str
    kind: str


def discover_attributes(df: DataFrame, catalogue: DataFrame, attribute: str, kind: str, prefix: str = "item_") -> list[Attribute]:
    """The attributes of the catalogue and of the rows, in order of id; one that the catalogue lacks,
    or whose type it doesn't give, is decimal. Null ids are no attributes. The ids found are at most
    MAX_ATTRIBUTES, else ValueError."""
    c = lambda name: F.col(f"`{name}`")
    ids = df.select(c(attribute).alias("a"), F.lit(None).cast("string").alias("k")).unionByName(catalogue.select(c(attribute).alias("a"), c(kind).alias("k")))
    found = ids.filter("a is not null").groupBy("a").agg(F.min("k").alias("k")).limit(MAX_ATTRIBUTES + 1).collect()
    if len(found) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
    return [Attribute(r["a"], f"{prefix}{r['a']}", r["k"] or "decimal") for r in sorted(found, key=lambda r: r["a"])]


def typed(value: Column, kind: str) -> Column:
    """value as the attribute's type: integer rounds half away from 0 and is null beyond 64 bits, flag is
    true for 1 and false for 0 and else null, decimal stays a double."""
    if kind == "integer":
        return F.when(F.abs(value) < F.lit(9.2e18), F.round(value).cast("long"))
    if kind == "flag":
        return F.when(value == 1, True).when(value == 0, False)
    return value


def pivot_wide(df: DataFrame, entity: str, attribute: str, value: str, attributes: Sequence[Attribute], order: Sequence[str], entities: DataFrame | None = None) -> DataFrame:
    """One row per entity, one column per attribute of the list, typed.

    Of several values of one entity and attribute the one that is last by `order` (whole numbers,
    nulls first) holds, and of those the largest; so repeated rows change nothing. Null and NaN values
    are passed over; an attribute that an entity lacks is null. `entities` adds entities without
    values. A null entity is one of its own. Attributes outside the list are ignored; other columns
    too, whatever their names. Empty tables give no row.
    """
    c = lambda name: F.col(f"`{name}`")
    rank = F.struct(*[F.coalesce(c(o).cast("long"), F.lit(-(2**63) + 1)).alias(f"o{i}") for i, o in enumerate(order)], c(value).cast("double").alias("v"))
    ids = [a.id for a in attributes]
    rows = df.select(c(entity).alias("__e"), c(attribute).alias("__a"), rank.alias("__r")).filter(F.col("__r.v").isNotNull() & ~F.isnan("__r.v") & F.col("__a").isin(ids))
    # Tall first: a value for each entity and attribute, combined on the map side.
    last = rows.groupBy("__e", "__a").agg(F.max("__r").alias("__r")).select("__e", "__a", F.col("__r.v").alias("__v"))
    if entities is not None:
        last = last.unionByName(entities.select(c(entity).alias("__e")).distinct().select("__e", F.lit(None).cast(dict(df.dtypes)[attribute]).alias("__a"), F.lit(None).cast("double").alias("__v")))
    wide = last.groupBy("__e").agg(*[F.max(F.when(F.col("__a") == a.id, F.col("__v"))).alias(a.name) for a in attributes])
    return wide.select(F.col("__e").alias(entity), *[typed(F.col(a.name), a.kind).alias(a.name) for a in attributes])
