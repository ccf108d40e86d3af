"""Queries of the general problems (intervals, spikes, grids, units, wide tables) over the dataset's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.columns import number
from wardgrid.operators.intervals import interval_gaps, merge_intervals
from wardgrid.operators.pivot import discover_attributes, pivot_wide
from wardgrid.operators.plausibility import flag_implausible
from wardgrid.operators.regular import regular_grid
from wardgrid.operators.units import convert_units
from wardgrid.sources.tables import table

UNKNOWN_TIME = -1899


def _medication(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "drugitems").filter((F.col("admissionid").isNotNull()) & (F.col("start") != UNKNOWN_TIME) & (F.col("stop") != UNKNOWN_TIME))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Gaps in each admission's medication."""
    return interval_gaps(_medication(spark, d), ["admissionid"], "start", "stop")


def p1_periods(spark: SparkSession, d: str) -> DataFrame:
    """Continuous periods under medication."""
    return merge_intervals(_medication(spark, d), ["admissionid"], "start", "stop")


def _converted(spark: SparkSession, d: str, bounds: bool = False, rows: DataFrame | None = None) -> DataFrame:
    return convert_units(table(spark, d, "numericitems") if rows is None else rows, table(spark, d, "items"), table(spark, d, "units"), bounds=bounds)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Registrations of faulty readings."""
    rows = _converted(spark, d, bounds=True).filter(F.col("measuredat") != UNKNOWN_TIME)
    return flag_implausible(rows, ["admissionid", "itemid"], "itemid", "measuredat", "target_value", "numericid", "__physmin", "__physmax", "__measured", "islabresult")


def _grid(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "items").filter("cadence_ms is not null").select("itemid").distinct()
    rows = _converted(spark, d, rows=table(spark, d, "numericitems").join(items, "itemid", "left_semi"))
    stays = table(spark, d, "admissions").select("admissionid", (F.col("dischargedat") - F.col("admittedat")).alias("lasted"))
    return regular_grid(rows, stays, "admissionid", ["itemid"], "admission_relative_ms", "target_value", "lasted", counted="value")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Hours of a stay without a reading of an item."""
    return _grid(spark, d).filter("status <> 'observed'").select("admissionid", "itemid", "hournr")


def p5_grid(spark: SparkSession, d: str) -> DataFrame:
    """Hourly values of each item with a cadence, missing hours filled; values to 4 decimals."""
    return _grid(spark, d).withColumn("value", F.round("value", 4))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Registrations recorded in another unit or scale than the item's target."""
    return _converted(spark, d).filter("target_value_changed").select("numericid").distinct()


def p6_converted(spark: SparkSession, d: str) -> DataFrame:
    """Every value in its item's target unit; NaN, which is no value, is null."""
    return _converted(spark, d).select("numericid", "admissionid", "itemid", number(F.col("value")).alias("value"), F.round("target_value", 6).alias("target_value"), "target_value_changed")


def p7_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per admission, one typed column per item: the value last measured, then last registered."""
    rows, items = table(spark, d, "numericitems"), table(spark, d, "items")
    attributes = discover_attributes(rows, items, "itemid", "valuetype")
    return pivot_wide(rows, "admissionid", "itemid", "value", attributes, ["measuredat", "registeredat", "numericid"], entities=table(spark, d, "admissions"))


def p7_wide_converted(spark: SparkSession, d: str) -> DataFrame:
    """The same with values brought to their items' target units first."""
    items = table(spark, d, "items")
    rows = _converted(spark, d)
    attributes = discover_attributes(table(spark, d, "numericitems"), items, "itemid", "valuetype")
    wide = pivot_wide(rows, "admissionid", "itemid", "target_value", attributes, ["measuredat", "registeredat", "numericid"], entities=table(spark, d, "admissions"))
    return wide.withColumns({a.name: F.round(F.col(a.name), 6) for a in attributes if a.kind == "decimal"})


QUERIES = {f.__name__: f for f in (p1_found, p1_periods, p3_found, p5_found, p5_grid, p6_found, p6_converted, p7_wide, p7_wide_converted)}
