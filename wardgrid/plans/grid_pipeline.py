"""The dense hourly grid of stays, from events to a table a model can read, as one lazy plan.

The order is part of the meaning: plausible values, hours, skeleton, mask, split of persons, scaling
by training rows, filling, one-hots. All stays in one plan; only the split's 256 counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.config import GridConfig
from wardgrid.functions.columns import lookup
from wardgrid.operators import anchors, fit, grid, quality, splits
from wardgrid.session import stored
from wardgrid.sources import sinks


def build_grid(events: DataFrame, admissions: DataFrame, items: DataFrame, config: GridConfig | None = None) -> DataFrame:
    """(admissionid, hour, split, features, feature__observed ..., one-hots). events has admissionid, itemid,
    admission_relative_ms, value; admissions and items are the tables of that name.

    Features are hourly medians of plausible values, z-scored by the training stays' grid values and
    filled forward. A stay's split is its person's (subject_id, else the stay itself).
    """
    config = config or GridConfig()
    tags = list(dict.fromkeys(config.tags.values()))
    stays = anchors.valid_stays(anchors.stays(admissions))
    number = events.filter(F.col("itemid").isin(list(config.tags)) & F.col("value").isNotNull() & ~F.isnan("value")).select("admissionid", "itemid", "admission_relative_ms", "value")
    good = quality.bounded(number, items, "itemid", "value", "physmin", "physmax").withColumn("tag", lookup(F.col("itemid"), config.tags))
    # Read for the fit and for the grid, so the medians are worked out once.
    long = stored(grid.hourly(good, ["admissionid", "tag"], "admission_relative_ms", {"v": F.median("value")}))
    static = admissions.groupBy("admissionid").agg(F.min(F.coalesce("subject_id", "admissionid")).alias("person"), *[F.max(c).alias(c) for c in config.categories])
    people = splits.rounded_split(static.filter("admissionid is not null"), "person", config.shares, config.seed)
    static = static.join(people, "person").drop("person")

    # Parameters come from training rows only, and are a table joined onto all.
    inside = long.join(stays.select("admissionid", "los_hours"), "admissionid").filter("hour < ceil(los_hours)").drop("los_hours")
    train = inside.join(static.filter(F.col("split") == list(config.shares)[0]).select("admissionid"), "admissionid", "left_semi")
    scaled = fit.scaled(inside, fit.fit_moments(train, "tag", "v"), "tag", "v", "z", config.least)
    wide = grid.wide(scaled, ["admissionid", "hour"], "tag", "z", tags)
    full = grid.masked(grid.assembled(grid.skeleton(stays, "admissionid", "los_hours"), [wide], ["admissionid", "hour"]), tags)
    full = grid.forward_filled(full, "admissionid", "hour", config.filled, config.zero).join(static, "admissionid")
    for column, categories in config.categories.items():
        full = fit.one_hot(full, column, list(categories), column).drop(column)
    return full


def write_grid(table: DataFrame, path: str, config: GridConfig | None = None) -> None:
    """The grid by split and numbered shard, hours in order."""
    config = config or GridConfig()
    shards = splits.sharded(table.select("admissionid", "split").distinct(), "admissionid", config.per_shard)
    sinks.write_shards(table.join(shards.drop("split"), "admissionid"), path, order=["admissionid", "hour"])
