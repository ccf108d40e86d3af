"""Small frames with results worked out by hand, after the survey's fixtures."""

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from wardgrid.functions import columns as x
from wardgrid.operators import anchors, audits, cohort, events, fit, grid, joint, lookups, quality, splits, tokens

HOUR = 3_600_000


def test_anchored_hourly_medians(spark):
    stays = anchors.stays(spark.createDataFrame([(10, 0, 2 * HOUR), (20, 0, 2 * HOUR), (None, 0, 1)], "admissionid long, admittedat long, dischargedat long"))
    e = spark.createDataFrame([(10, 80.0, 600000), (10, 82.0, 1200000), (10, 999.0, -1899), (20, 90.0, 3900000), (30, 1.0, 5)], "admissionid long, value double, measuredat long")
    at = anchors.anchored(e, stays, ["admissionid"], {"measuredat": "ms"})
    got = grid.hourly(at, ["admissionid"], "ms", {"v": F.median("value")})
    assert rows(got) == [(10, 0, 81.0), (20, 1, 90.0)]
    assert anchors.anchored(e, stays, ["admissionid"], {"measuredat": "ms"}, how="left").count() == 5


def test_mode_ties_fall_to_the_first_in_order(spark):
    for labels in (["b", "a", "b", "a"], ["a", "b", "a", "b"]):
        df = spark.createDataFrame([(1, 0, v) for v in labels], "k long, ms long, label string")
        assert rows(grid.hourly(df, ["k"], "ms", {"m": F.mode("label", True)})) == [(1, 0, "a")]


def test_causal_binning(spark):
    data = [(10, 1, 10.0, 0), (10, 1, 20.0, 30), (10, 1, 30.0, 60), (10, 1, 50.0, 90), (20, 1, 100.0, 0), (20, 1, 200.0, 30), (10, 2, 4.0, 0), (10, 2, 5.0, 120)]
    df = spark.createDataFrame([(a, i, v, m * 60_000) for a, i, v, m in data], "adm long, item long, v double, ms long")
    out = grid.binned(df, spark.createDataFrame([(1,)], "item long"), "item", ["adm", "item"], "ms", "v")
    assert rows(out) == [
        (10, 1, HOUR, 15.0, 2, "causal_mean"), (10, 1, 2 * HOUR, 40.0, 2, "causal_mean"), (10, 2, 0, 4.0, 1, "raw_passthrough"), (10, 2, 2 * HOUR, 5.0, 1, "raw_passthrough"), (20, 1, HOUR, 150.0, 2, "causal_mean"),
    ]


def test_interval_hours(spark):
    df = spark.createDataFrame([(1, -1000, 5400000), (2, 7200000, 3600000), (3, 8000000, None), (4, -5, -1), (5, 3600000, 7200000), (6, 10, 10)], "k long, a long, b long")
    assert rows(grid.covered_hours(df, ["k"], "a", "b")) == [(1, 0), (1, 1), (2, 2), (5, 1), (6, 0)]
    assert rows(grid.covered_hours(df.filter("k = 1"), ["k"], "a", "b", point=F.lit(True))) == [(1, 0)]


def test_ratio_guards(spark):
    df = spark.createDataFrame([(90.0, 30.0), (None, 40.0), (80.0, 0.0), (100.0, 50.0)], "po2 double, fio2 double")
    assert [r[0] for r in df.select(x.ratio(F.col("po2"), F.col("fio2") / 100)).collect()] == [pytest.approx(300), None, None, 200.0]


def test_mask_before_fill(spark):
    df = spark.createDataFrame([(1, 0, 80.0, None), (1, 1, None, None), (1, 2, 80.0, None), (1, 3, None, 50.0)], "k long, hour long, hr double, urine double")
    out = grid.forward_filled(grid.masked(df, ["hr", "urine"]), "k", "hour", ["hr", "urine"], ["urine"]).orderBy("hour").collect()
    assert [(r["hr"], r["urine"], r["hr__observed"], r["urine__observed"]) for r in out] == [(80.0, 0.0, 1, 0), (80.0, 0.0, 0, 0), (80.0, 0.0, 1, 0), (80.0, 50.0, 0, 1)]


def test_skeleton_of_stays_without_length(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 0.0), (3, -1.0), (4, None), (5, 0.1)], "k long, h double")
    assert rows(grid.skeleton(df, "k", "h")) == [(1, 0), (1, 1), (5, 0)]


def test_state_changes(spark):
    df = spark.createDataFrame([(1, 7, 1, v) for v in (5, 5, 6, 6, 5)], "k long, item long, z long, v long").withColumn("t", F.monotonically_increasing_id())
    assert grid.state_changes(df, ["k", "item"], "v", ["t"], [7], "item").count() == 3
    assert grid.state_changes(df, ["k", "item"], "v", ["t"], [8], "item").count() == 5


def test_phases_and_floor(spark):
    df = spark.createDataFrame([(-1, 10), (0, 10), (10, 10), (11, 10), (None, 10), (11, None)], "ms long, los long")
    assert [r[0] for r in df.select(x.phase_relative(F.col("ms"), F.col("los"))).collect()] == ["preadmission", "admission", "admission", "postadmission", "unknown", "admission"]
    assert [r[0] for r in df.select(x.bucket(F.col("ms"), 3)).collect()][0] == -1


def test_corrections_in_order(spark):
    rules = spark.createDataFrame([(1, False, 0.0, False, 2.0, None, 10.0, 30.0), (2, True, None, None, None, None, None, None), (3, None, None, True, None, 1.0, None, None)], "item long, exclude boolean, sentinel double, percent boolean, a double, b double, low double, high double")
    df = spark.createDataFrame([(1, 0.0), (1, 5.0), (1, 16.0), (2, 5.0), (3, 0.5), (3, -0.5), (4, 7.0), (1, None)], "item long, v double")
    assert rows(quality.corrected(df, rules, "item", "v")) == [(1, 10.0), (3, 0.5), (3, 51.0), (4, 7.0)]


def test_bounds_pass_items_without_rules(spark):
    bounds = spark.createDataFrame([(1, 0.0, 10.0), (2, None, 5.0)], "item long, low double, high double")
    df = spark.createDataFrame([(1, 0.0), (1, 10.0), (1, 11.0), (1, None), (2, -99.0), (2, 6.0), (3, None)], "item long, v double")
    assert rows(quality.bounded(df, bounds, "item", "v")) == [(1, 0.0), (1, 10.0), (2, -99.0), (3, None)]


def test_frozen_fit(spark):
    train = spark.createDataFrame([("a", "u", float(v)) for v in range(1, 11)] + [("b", None, 5.0)], "t string, u string, v double")
    b = fit.fit_quantiles(train, ["t", "u"], "v")
    first = b.filter("t = 'a'").first()
    assert [first[f"q{i}"] for i in range(1, 10)] == [2.0, 3.0, 4.0, 5.0, 6.0, 6.0, 7.0, 8.0, 9.0]
    val = spark.createDataFrame([("a", "u", 0.0), ("a", "u", 2.0), ("a", "u", 99.0), ("a", None, 1.0), ("b", None, 6.0)], "t string, u string, v double")
    assert rows(fit.coded(val, b, ["t", "u"], "v", "bin"), "t", "v", "bin") == [("a", 0.0, 1), ("a", 2.0, 1), ("a", 99.0, 10), ("b", 6.0, 10)]


def test_rank_transform_keeps_zero_and_order(spark):
    train = spark.createDataFrame([("a", float(v)) for v in range(0, 101)], "t string, v double")
    ranks = fit.fit_ranks(train, "t", "v", 5)
    df = spark.createDataFrame([("a", v) for v in (-3.0, 0.0, 0.5, 1.0, 50.5, 100.0, 500.0, None)], "t string, v double")
    got = [r["p"] for r in fit.ranked(df, ranks, "t", "v", "p").orderBy(F.asc_nulls_first("v")).collect()]
    assert got == [None, 0.0, 0.0, 0.0, 0.0, 0.5, 1.0, 1.0]


def test_scaling_with_few_values_or_no_spread(spark):
    moments = fit.fit_moments(spark.createDataFrame([("a", 2.0)] * 10 + [("b", 1.0)], "t string, v double"), "t", "v")
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 5.0), ("a", None)], "t string, v double")
    assert rows(fit.scaled(df, moments, "t", "v", "z"), "t", "z") == [("a", None), ("a", 3.0), ("b", 5.0), ("c", 5.0)]


def test_pooling(spark):
    w = fit.cohort_weights({"x": 100, "y": 400})
    assert w == {"x": pytest.approx(1 / 3), "y": pytest.approx(2 / 3)}
    parts = spark.createDataFrame([("f", 0.0, 1.0, 0.5), ("f", 2.0, 1.0, 0.5)], "t string, mean double, std double, w double")
    assert rows(fit.pooled_moments(parts, "t", "w")) == [("f", 1.0, pytest.approx(math.sqrt(2)))]


def test_one_hot_collisions(spark):
    df = spark.createDataFrame([("a b",), (None,), ("zz",)], "c string")
    assert rows(fit.one_hot(df, "c", ["a b"], "c"), "c_a_b", "c_missing") == [(0, 1), (0, 1), (1, 0)]
    with pytest.raises(ValueError):
        fit.one_hot(df, "c", ["a b", "a-b"], "c")


def test_splits_are_whole_and_seeded(spark):
    ids = spark.range(1000).selectExpr("id as k")
    got = {r["split"]: r["count"] for r in splits.rounded_split(ids, "k", {"a": 0.7, "b": 0.15, "c": 0.15}, 3).groupBy("split").count().collect()}
    assert got == {"a": 700, "b": 150, "c": 150}
    three = {r["split"]: r["count"] for r in splits.largest_remainder_split(ids.limit(3), "k", {"a": 0.5, "b": 0.3, "c": 0.2}).groupBy("split").count().collect()}
    assert sum(three.values()) == 3
    assert rows(splits.sample(ids, "k", 5, 1)) == rows(splits.sample(ids.repartition(7), "k", 5, 1)) != rows(splits.sample(ids, "k", 5, 2))


def test_split_manifest_is_checked(spark):
    df = spark.createDataFrame([(1,), (2,)], "k long")
    good = spark.createDataFrame([(1, "a"), (2, "b")], "k long, split string")
    assert rows(splits.attached(df, good, "k")) == [(1, "a"), (2, "b")]
    for bad in ([(1, "a")], [(1, "a"), (2, "b"), (2, "a")]):
        with pytest.raises(PySparkException):
            splits.attached(df, spark.createDataFrame(bad, "k long, split string"), "k").collect()


def test_deaths(spark):
    day = 86_400_000
    data = [(1, 10, 0, day, 4 * day), (1, 11, 3 * day, 4 * day + 5, 4 * day), (2, 20, 0, day, day + 12 * HOUR), (3, 30, 0, day, 4 * day), (4, 40, 0, day, None), (5, 50, day, 2 * day, day - 8 * HOUR)]
    df = spark.createDataFrame(data, "p long, s long, a long, b long, d long")
    got = rows(events.assigned_deaths(df, "p", "s", "a", "b", "d"), "p", "s", "relation", "emitted", "event_time")
    assert got == [(1, 11, "during_stay", True, 4 * day + 5), (2, 20, "within_grace", True, day + 12 * HOUR), (3, 30, "later", False, None), (5, 50, "during_stay", True, 2 * day)]


def test_tokens(spark):
    m = 60_000
    data = [(1, 0, "ICU_ADMISSION"), (1, 120 * m, "MEDICATION//C07//A//B02"), (1, 180 * m, "ICU_DISCHARGE"), (2, 0, "ICU_ADMISSION"), (2, 60 * m, "VITAL//HEART_RATE//Q5"), (2, 60 * m + 540 * 1440 * m, "X")]
    df = spark.createDataFrame(data, "s long, t long, code string").withColumn("code", x.truncated_code(F.col("code"), "MEDICATION", 2))
    got = tokens.expanded(df, ["s"], "t", "code").orderBy("s", "seq").collect()
    assert [r["token"] for r in got if r["s"] == 1] == ["ICU_ADMISSION", "2h-3h", "MEDICATION//C07//A", "45m-1h15m", "ICU_DISCHARGE", "TIMELINE_END"]
    assert [r["token"] for r in got if r["s"] == 2] == ["ICU_ADMISSION", "45m-1h15m", "VITAL//HEART_RATE", "Q5", "=6mt", "=6mt", "=6mt", "X", "TIMELINE_END"]
    vocab = tokens.vocabulary(tokens.expanded(df.filter("s = 1"), ["s"], "t", "code"))
    ids = tokens.numbered(tokens.expanded(df, ["s"], "t", "code"), vocab)
    unk = vocab.filter("token = 'UNK'").first()["id"]
    assert {r["token"] for r in ids.filter(f"id = {unk}").collect()} == {"VITAL//HEART_RATE", "Q5", "=6mt", "X"}
    index = tokens.timeline_index(ids, ["s"]).orderBy("s").collect()
    assert [(r["first"], r["n"]) for r in index] == [(0, 6), (6, 9)]


def test_parent_codes(spark):
    df = spark.createDataFrame([("a",), ("a//b",), ("a//b//c",), ("a//b//c//d",)], "code string")
    assert [r[0] for r in df.select(x.parent_codes(F.col("code"))).collect()] == [[], [], ["a//b"], ["a//b", "a//b//c"]]


def test_keys(spark):
    df = spark.createDataFrame([("12.0",), ("12.5",), ("None",), (None,), (" a ",)], "k string")
    assert [r[0] for r in df.select(x.norm_key(F.col("k"))).collect()] == ["12", "12.5", "", "", "a"]
    df = spark.createDataFrame([("60-69",), ("80+",), ("x",), (None,)], "k string")
    assert [r[0] for r in df.select(x.age_years(F.col("k"))).collect()] == [64.5, 80.0, None, None]


def test_near_events(spark):
    a = spark.createDataFrame([(1, 100), (2, 100), (3, 100), (4, None)], "k long, t long")
    b = spark.createDataFrame([(1, 90), (1, 500), (2, 111), (3, 89), (3, 110), (4, 1)], "k long, u long")
    assert rows(lookups.any_pair_within(a, b, "k", "t", "u", 10, 10)) == [(1,), (3,)]
    assert rows(lookups.paired_within(a, b, "k", "t", "u", 10, 10)) == [(1, 100, 90)]


def test_overwrite_can_empty_a_field(spark):
    state = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k long, f string, g string")
    changes = spark.createDataFrame([(2, None)], "k long, f string")
    assert rows(lookups.overwritten(state, changes, "k", ["f"])) == [(1, "a", "x"), (2, None, "y")]


def test_fingerprints_see_where_nulls_are(spark):
    one = spark.createDataFrame([(None, 1), (2, 3)], "a long, b long")
    two = spark.createDataFrame([(2, 3), (1, None)], "a long, b long")
    assert rows(audits.fingerprint(one, ["a", "b"])) == rows(audits.fingerprint(one.orderBy("a"), ["a", "b"]))
    assert rows(audits.fingerprint(one, ["a", "b"])) != rows(audits.fingerprint(two, ["a", "b"]))


def test_cohorts(spark):
    a, b = spark.createDataFrame([(1, 2)], "id long, v long"), spark.createDataFrame([(1, 3)], "id long, w long")
    assert rows(joint.stacked({"x": a, "y": b}, ["id"]), "id", "native_id", "cohort", "v", "w") == [("x_1", 1, "x", 2, None), ("y_1", 1, "y", None, 3)]
    with pytest.raises(ValueError, match="f"):
        joint.united_registry({"x": {"f": ("numeric", "a")}, "y": {"f": ("numeric", "b")}})
    assert joint.united_categories({"x": {"f": ["b", "a"]}, "y": {"f": ["c"]}}) == {"f": ["a", "b", "c"]}


def test_gaps(spark):
    df = spark.createDataFrame([(1, 0), (1, 5), (1, 5), (2, 3)], "k long, h long")
    assert rows(cohort.longest_gaps(df, "k", "h")) == [(1, 2, 5), (2, 1, 0)]
