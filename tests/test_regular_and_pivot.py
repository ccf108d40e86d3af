import math

import numpy as np
import pytest

from tests.conftest import rows
from wardgrid.operators.pivot import Attribute, discover_attributes, pivot_wide
from wardgrid.operators.regular import HOUR_MS, regular_grid

READ = "adm long, item long, ms long, v double, hournr string, status int"
STAYS = "adm long, lasted long, item string"


def grid(spark, readings, stays, **kw):
    df = spark.createDataFrame([(*r, None, None) for r in readings], READ)
    s = spark.createDataFrame([(*r, None) for r in stays], STAYS)
    return regular_grid(df, s, "adm", ["item"], "ms", "v", "lasted", **kw)


def test_every_hour_that_begins_before_the_end(spark):
    got = grid(spark, [(1, 7, 0, 2.0), (1, 7, HOUR_MS - 1, 4.0), (1, 7, 3 * HOUR_MS, 6.0), (1, 8, 2 * HOUR_MS, 1.0)], [(1, 4 * HOUR_MS + 1)])
    seen = {(r["item"], r["hournr"]): (r["status"], r["n_readings"], r["value"]) for r in got.collect()}
    assert sorted(seen) == [(7, h) for h in range(5)] + [(8, h) for h in range(5)]
    assert seen[7, 0] == ("observed", 2, 3.0) and seen[7, 3] == ("observed", 1, 6.0)
    assert [seen[7, h][0] for h in (1, 2, 4)] == ["filled"] * 3
    assert all(math.isfinite(v[2]) for v in seen.values())


def test_readings_without_a_value_count(spark):
    df = spark.createDataFrame([(1, 7, 0, 5.0, 2.0), (1, 7, HOUR_MS, 9.0, None), (1, 7, 3 * HOUR_MS, 5.0, 2.0), (1, 8, HOUR_MS, 9.0, None), (1, 8, 0, None, None)], "adm long, item long, ms long, raw double, v double")
    stays = spark.createDataFrame([(1, 4 * HOUR_MS)], "adm long, lasted long")
    got = {(r["item"], r["hournr"]): r for r in regular_grid(df, stays, "adm", ["item"], "ms", "v", "lasted", counted="raw").collect()}
    assert [got[7, h]["status"] for h in range(4)] == ["observed", "observed", "filled", "observed"]
    assert got[7, 1]["value"] is None and got[7, 1]["n_readings"] == 1 and abs(got[7, 2]["value"] - 2.0) < 0.5
    assert [got[8, h]["status"] for h in range(4)] == ["marked", "observed", "marked", "marked"]


def test_fill_follows_the_season_and_meets_the_observed(spark):
    def true(h):
        return 80 + 0.05 * h + 10 * math.cos(2 * math.pi * h / 24) + 4 * math.sin(4 * math.pi * h / 24)

    observed = [h for h in range(240) if h % 7 not in (2, 3) and not 100 <= h < 106]
    got = grid(spark, [(1, 7, h * HOUR_MS + 5, true(h)) for h in observed], [(1, 240 * HOUR_MS)]).collect()
    assert len(got) == 240
    assert max(abs(r["value"] - true(r["hournr"])) for r in got) < 0.5


def test_what_counts(spark):
    readings = [(1, 7, None, 1.0), (1, 7, -5, 1.0), (1, 7, 2 * HOUR_MS, 1.0), (1, 7, 5, None), (1, 7, 5, math.nan), (None, 7, 5, 1.0), (1, None, 5, 1.0), (2, 7, 5, 1.0), (3, 7, 5, 1.0), (4, 7, 5, 1.0), (5, 7, 5, math.inf), (6, 7, 5, 1.0), (6, 7, 5, 1.0)]
    stays = [(1, 2 * HOUR_MS), (2, None), (3, 0), (5, 2 * HOUR_MS), (6, 2 * HOUR_MS), (6, None), (6, HOUR_MS), (None, 9)]
    got = grid(spark, readings, stays)
    assert rows(got, "adm", "item", "hournr", "n_readings", "status") == [(5, 7, 0, 1, "observed"), (5, 7, 1, 0, "marked"), (6, 7, 0, 2, "observed"), (6, 7, 1, 0, "filled")]
    assert grid(spark, [], []).count() == 0 == grid(spark, [(1, 7, 5, 1.0)], []).count()


EAV = "adm long, item long, v double, t long, r long, id long, item_1 string"


def test_pivot_types_duplicates_and_missing(spark):
    data = [(1, 1, 79.5, 1, 1, 1), (1, 1, 80.5, 2, 1, 2), (1, 1, 81.4, 2, 2, 3), (1, 1, 99.0, None, 9, 9), (1, 2, 1.25, 1, 1, 4), (1, 3, 1.0, 1, 1, 5), (2, 3, 0.5, 1, 1, 6), (2, 1, None, 5, 5, 7), (2, 1, math.nan, 6, 6, 8), (None, 2, 3.0, 1, 1, 1), (3, 9, 5.0, 1, 1, 1), (1, 2, 1.25, 1, 1, 4), (1, 2, 1.5, 1, 1, 4)]
    df = spark.createDataFrame([(*r, "x") for r in data], EAV)
    catalogue = spark.createDataFrame([(1, "integer"), (2, "decimal"), (3, "flag"), (4, "integer")], "item long, kind string")
    attributes = discover_attributes(df, catalogue, "item", "kind")
    assert attributes == [Attribute(1, "item_1", "integer"), Attribute(2, "item_2", "decimal"), Attribute(3, "item_3", "flag"), Attribute(4, "item_4", "integer"), Attribute(9, "item_9", "decimal")]
    everyone = spark.createDataFrame([(1,), (7,)], "adm long")
    out = pivot_wide(df, "adm", "item", "v", attributes, ["t", "r", "id"], entities=everyone)
    assert dict(out.dtypes) == {"adm": "bigint", "item_1": "bigint", "item_2": "double", "item_3": "boolean", "item_4": "bigint", "item_9": "double"}
    assert rows(out) == [(None, None, 3.0, None, None, None), (1, 81, 1.5, True, None, None), (2, None, None, None, None, None), (3, None, None, None, None, 5.0), (7, None, None, None, None, None)]
    assert pivot_wide(df.filter("false"), "adm", "item", "v", attributes, ["t"]).count() == 0


def test_too_many_attributes(spark):
    df = spark.range(5001).selectExpr("id as item")
    with pytest.raises(ValueError):
        discover_attributes(df, spark.createDataFrame([], "item long, kind string"), "item", "kind")


def test_huge_integers_are_null(spark):
    df = spark.createDataFrame([(1, 1, 1e30, 1, 1, 1, "x"), (2, 1, -2.5, 1, 1, 1, "x")], EAV)
    assert rows(pivot_wide(df, "adm", "item", "v", [Attribute(1, "a", "integer")], ["t"])) == [(1, None), (2, -3)]
