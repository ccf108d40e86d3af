"""Written datasets, policies, contracts, joint cohorts, evidence: small frames with results worked by hand."""

import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardgrid.operators import cohort, events, grid, tokens
from wardgrid.operators.contract import contract
from wardgrid.operators.policies import Manifest, Rule, account, applied
from wardgrid.plans import joint_dataset
from wardgrid.plans.joint_dataset import CohortsDontFit
from wardgrid.sources import evidence, parameters, raw, sinks, tensors


def test_tensor_bytes():
    content = tensors.encoded({"a": np.array([1, -2, 2**62]), "none": np.array([], dtype=int)})
    n = int.from_bytes(content[:8], "little")
    assert n % 8 == 0 and json.loads(content[8 : 8 + n])["a"] == {"dtype": "I64", "shape": [3], "data_offsets": [0, 24]}
    back = tensors.decoded(content)
    assert back["a"].tolist() == [1, -2, 2**62] and back["none"].tolist() == []


def test_every_timeline_is_where_the_index_says(spark, tmp_path):
    data = [(k % 3, k, q, 100 * k + q, None if q == 1 else q) for k in (7, 3, 12, 9, 4) for q in range(k % 4 + 1)]
    df = spark.createDataFrame(data, "shard long, k long, seq long, id long, time long").repartition(4)
    folder = f"file://{tmp_path}/t"
    written = tensors.write_tensors(df, folder, ["k"], {"tokens": "id", "times": "time"}, per_timeline={"ks": "k"}).collect()
    assert sum(r["n_tokens"] for r in written) == len(data) and sum(r["n_timelines"] for r in written) == 5
    for r in written:
        content = (tmp_path / "t" / f"{r['shard']}.safetensors").read_bytes()
        assert hashlib.sha256(content).hexdigest() == r["sha256"] and len(content) == r["bytes"]
    assert {r["sha256"] for r in written} == {r["sha256"] for r in tensors.digests(spark, folder).collect()}
    read = {(r["shard"], r["tensor"], r["place"]): r["value"] for r in tensors.read_tensors(spark, folder).collect()}
    for r in tokens.timeline_index(df, ["k"], F.col("k") % 3).collect():
        mine = [read[r["shard"], "tokens", r["first"] + i] for i in range(r["n"])]
        assert mine == [100 * r["k"] + q for q in range(r["k"] % 4 + 1)]
        times = [read[r["shard"], "times", r["first"] + i] for i in range(r["n"])]
        assert times == [-1 if q == 1 else q for q in range(r["k"] % 4 + 1)]
        nth = [v for (s, t, p), v in sorted(read.items()) if s == r["shard"] and t == "ks"].index(r["k"])
        assert read[r["shard"], "offsets", nth] == r["first"]
    # Written again, by a task run twice, it is the same file.
    tensors.write_tensors(df, folder, ["k"], {"tokens": "id", "times": "time"}, per_timeline={"ks": "k"}).collect()
    assert sorted(f for f in os.listdir(tmp_path / "t") if not f.startswith(".")) == ["0.safetensors", "1.safetensors"]
    assert tensors.write_tensors(df.filter("false"), f"file://{tmp_path}/none", ["k"], {"tokens": "id"}).count() == 0


def test_replace_keeps_the_old_one_when_the_new_cannot_move_in(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    sinks.replace(spark.range(3), path)

    class Stubborn:
        """A file system that doesn't let the new dataset in."""

        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return False if ".new-" in a.toString() else self.fs.rename(a, b)

        def __getattr__(self, name):
            return getattr(self.fs, name)

    real = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda *a: (Stubborn(real(*a)[0]), *real(*a)[1:]))
    with pytest.raises(OSError):
        sinks.replace(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3


def test_written_by_key(spark, tmp_path):
    path = str(tmp_path / "k")
    sinks.write_by_key(spark.createDataFrame([(1, "a"), (65, "b"), (2, "c"), (None, "d"), (-1, "e")], "id long, v string"), path, "id")
    assert rows(spark.read.parquet(path), "part", "v") == [(-1, "d"), (1, "a"), (1, "b"), (2, "c"), (63, "e")]


def test_saved_fits(spark, tmp_path):
    path = str(tmp_path / "fit")
    parameters.save_fit(spark, {"moments": spark.createDataFrame([("x", 1.5)], "k string, mean double")}, path, {"least": 3})
    assert rows(parameters.load_fit(spark, path)["moments"]) == [("x", 1.5)]
    sinks.replace(spark.createDataFrame([("x",)], "k string"), f"{path}/moments")
    with pytest.raises(ValueError, match="moments"):
        parameters.load_fit(spark, path)
    knots = spark.createDataFrame([(1, [0.0, 10.0, 30.0]), (2, [5.0]), (3, None)], "k long, knots array<double>")
    assert rows(parameters.drawn_from_knots(knots, "k", 4)) == [(1, 2.5), (1, 7.5), (1, 15.0), (1, 25.0), (2, 5.0), (2, 5.0), (2, 5.0), (2, 5.0)]


def test_input_modes_and_unknown_ids(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    assert raw.input_mode(spark, str(tmp_path / "a.csv"), str(tmp_path / "s")) == "csv" == raw.input_mode(spark, str(tmp_path / "a.csv"), None)
    sinks.replace(spark.range(2), str(tmp_path / "s"))
    assert raw.input_mode(spark, str(tmp_path / "a.csv"), str(tmp_path / "s")) == "shards"
    with pytest.raises(FileNotFoundError):
        raw.input_mode(spark, str(tmp_path / "b.csv"), None)
    kept, warnings = raw.scoped(spark.range(5), spark.createDataFrame([(3,), (8,)], "id long"), "id")
    assert rows(kept) == [(3,)] and "1 ids" in warnings[0] and "8" in warnings[0]
    assert raw.scoped(spark.range(5), spark.createDataFrame([(3,)], "id long"), "id")[1] == []


def test_column_order_and_row_index(spark):
    df = spark.createDataFrame([(2, "b"), (1, None), (1, "a"), (None, "z")], "x long, y string")
    assert grid.in_order(df, ["y", "x"]).columns == ["y", "x"]
    for wrong in (["x"], ["x", "y", "z"], ["x", "y", "y"]):
        with pytest.raises(ValueError):
            grid.in_order(df, wrong)
    assert rows(events.row_index(df.repartition(3), ["x", "y"], 4), "row", "x", "y") == [(0, 1, "a"), (1, 1, None), (2, 2, "b"), (3, None, "z")]
    assert events.row_index(df.filter("false"), ["x"], 4).count() == 0


def test_metadata(spark):
    stays = spark.createDataFrame([(1, 10, 5.0), (1, 11, 2.0), (2, 12, 1.0), (2, 13, None)], "person long, stay long, los_hours double")
    shards = spark.createDataFrame([(10, "train", 1), (11, "train", 0), (12, "val", 0), (13, "val", 0)], "stay long, split string, shard long")
    got = cohort.person_metadata(cohort.stay_metadata(stays, shards, "person", "stay"), "person", "stay")
    assert rows(got) == [(1, "train", 2, "10;11", "0;1", 7.0), (2, "val", 2, "12;13", "0", 1.0)]


STATE = "token string, target string, emit string"


def test_policy_layers(spark):
    state = spark.createDataFrame([("a", "x", "true"), ("b", "0", "true"), ("c", None, "false")], STATE)
    first = Manifest("first", spark.createDataFrame([("a", "0"), ("c", None), ("gone", "y")], "token string, target string"), ("target",))
    zero = Rule("zero", F.col("target") == "0", {"target": F.lit(""), "emit": F.lit("false")})
    layers = [first, zero]
    out = applied(state, layers, "token")
    assert rows(out) == [("a", "", "false", ["first", "zero"]), ("b", "", "false", ["zero"]), ("c", None, "false", [])]
    assert rows(account(out, layers)) == [(0, "first", 1), (1, "zero", 2)]
    # The order is part of the meaning.
    assert rows(applied(state, layers[::-1], "token"), "token", "target") == [("a", "0"), ("b", ""), ("c", None)]
    twice = Manifest("twice", spark.createDataFrame([("a", "1"), ("a", "2")], "token string, target string"), ("target",))
    with pytest.raises(Exception, match="twice decides twice on a"):
        applied(state, [twice], "token").collect()
    assert applied(state.filter("false"), layers, "token").count() == 0


def test_contract_names_every_broken_rule(spark):
    schema = "token string, itemid string, target string, role string, emit string, concept string"
    source = spark.createDataFrame([("N//1", "1"), ("N//2", "2"), ("N//3", "3")], "token string, itemid string")
    good = [("N//1", "1", "t", "r", "true", "5"), ("N//2", "2", None, None, "no", None), ("N//3", "3", "u", "r", "YES", "6.0")]
    concepts = spark.createDataFrame([(5,), (6,)], "concept long")
    call = lambda data: {r["rule"]: r["n"] for r in contract(source, spark.createDataFrame(data, schema), "token", "emit", "target", "role", ["itemid"], concepts, "concept", F.col("target") == "bad", ["OLD//"], {"LAB//": "lab"}, F.col("target") == "must").collect()}
    assert set(call(good).values()) == {0} and len(call(good)) == 14
    broken = [("N//1", "9", "OLD//t", "", "1", "0.0"), ("N//1", "9", "bad", "lab", "yes", "7"), ("", "1", "must", "r", "no", "5"), ("LAB//1", "1", " ", "x", "true", "5")]
    got = call(broken)
    assert got == {"empty token": 1, "emitted without target": 1, "emitted without role": 1, "emitted in a legacy namespace": 1, "emitted of a kind that never is": 1, "LAB// without lab": 1, "lab without LAB//": 1, "withheld": 1, "emitted with concept 0": 1, "emitted with an unknown concept": 2, "lost": 2, "added": 2, "changed itemid": 1, "repeated token": 1}


def test_joint_cohorts(spark, tmp_path):
    a = spark.createDataFrame([(1, h, "train", 1.0 + h) for h in range(2)] + [(2, 0, "val", 5.0)], "k long, hour long, split string, v double")
    b = spark.createDataFrame([(1, 0, "test", 2)], "k long, hour long, split string, extra int")
    path = str(tmp_path / "j")
    fits = {"a": {"moments": spark.createDataFrame([("v", 1.0)], "tag string, mean double")}}
    joint_dataset.write_joint({"a": a, "b": b}, path, "k", "hour", 1, fits, {"targets": {"a": a.select("k", "v"), "b": b.select("k")}}, fill={"extra": -1})
    back = spark.read.parquet(f"{path}/data")
    assert rows(back, "k", "native_k", "cohort", "hour", "v", "extra", "split", "shard") == [("a_1", 1, "a", 0, 1.0, -1, "train", 0), ("a_1", 1, "a", 1, 2.0, -1, "train", 0), ("a_2", 2, "a", 0, 5.0, -1, "val", 0), ("b_1", 1, "b", 0, None, 2, "test", 0)]
    assert rows(parameters.load_fit(spark, f"{path}/fit/a")["moments"]) == [("v", 1.0)]
    assert rows(spark.read.parquet(f"{path}/targets"), "k", "v") == [("a_1", 1.0), ("a_1", 2.0), ("a_2", 5.0), ("b_1", None)]
    assert rows(joint_dataset.shared_keys([a, b], "k"), "k") == [(1,)]
    with pytest.raises(CohortsDontFit, match="hour is .* c lacks split"):
        joint_dataset.joint_grid({"a": a, "c": a.drop("split").withColumn("hour", F.lit("0"))}, "k")
    with pytest.raises(CohortsDontFit, match="a_1"):
        joint_dataset.joint_shards(joint_dataset.joint_grid({"a": a.unionByName(a.filter("hour = 0").withColumn("split", F.lit("test")))}, "k"), "k", 2)


def test_evidence_adapters(spark):
    usagi = spark.createDataFrame([("12-7", "label", "5.0", "", "APPROVED"), ("x", "odd", None, None, None), ("13", "Na", "6", "s", None), (None, None, None, None, None)], "sourceCode string, sourceName string, conceptId string, comment string, mappingStatus string")
    long = evidence.adapted(usagi, "usagi", evidence.ADAPTERS["usagi"], "dir/numericitems_unit.usagi.csv")
    assert rows(long, "code", "itemid", "unitid", "label", "target_concept", "note", "status", "keyed_by", "source_table") == [("12-7", "12", "7", "label", "5", None, "APPROVED", "itemid_unitid", "numericitems"), ("13", "13", None, "Na", "6", "s", None, "itemid", "numericitems"), ("x", None, None, "odd", None, None, None, "nothing", "numericitems")]
    drug = spark.createDataFrame([("12-7", "AB drugitems")], "source_code string, source_vocabulary_id string")
    assert rows(evidence.adapted(drug, "concept_map", evidence.ADAPTERS["concept_map"]), "ordercategoryid", "source_table", "keyed_by") == [("7", "drugitems", "itemid_ordercategoryid")]
    sql = evidence.insert_statements(spark.createDataFrame([("INSERT INTO fs VALUES (9, 'pols', 'pulse', 'c', 1, 'l', 'list');",)], "t string"), "t", 7)
    assert rows(evidence.adapted(sql, "flowsheet", evidence.ADAPTERS["flowsheet"]), "itemid", "source_table", "note") == [("9", "listitems", "pulse|c|1|l|list")]
    parts = [("usagi", usagi, "numericitems.usagi.csv"), ("usagi", usagi, "numericitems.usagi.csv"), ("vocabulary", spark.createDataFrame([("ATC", "1", "drugs", "v", "2020")], "vocabulary_id string, vocabulary_concept_id string, vocabulary_name string, vocabulary_reference string, vocabulary_version string"), "")]
    both = evidence.all_evidence(parts)
    assert both.count() == 4 == both.select("evidence_id").distinct().count() and both.columns == ["evidence_id", *evidence.LONG]
    assert set(evidence.ADAPTERS) == {"usagi", "concept_map", "value_map", "source_concepts", "dictionary", "old_dictionary", "flowsheet", "context", "vocabulary"}


def test_review_is_read_back(spark, tmp_path):
    from wardgrid.sources import resources, review

    features = [{"tag": "hf", "reconstruction_type": "direct_numeric", "target_unit": "/min", "structural_zero": "no"}, {"tag": "pump", "reconstruction_type": "treatment_indicator", "target_unit": None, "structural_zero": "yes"}]
    found = spark.createDataFrame([("hf", i, "a|b\nc" if i == 1 else None, 100 - i % 3) for i in range(1, 30)] + [("other", 1, None, 5)], "tag string, itemid long, label string, n long")
    review.write_review(spark, features, found, str(tmp_path / "r"), many=3)
    text = (tmp_path / "r" / "review.md").read_text()
    parsed, problems = resources.parse_manifest(text)
    assert problems == [] and parsed["hf"] == {"reconstruction_type": "direct_numeric", "target_unit": "/min", "keep": [3, 6, 9], "structural_zero": False}
    assert parsed["pump"]["keep"] == [] and parsed["pump"]["structural_zero"]
    assert spark.read.option("header", True).csv(str(tmp_path / "r" / "candidates")).count() == 4
    assert spark.read.option("header", True).csv(str(tmp_path / "r" / "manifest")).count() == 2
    assert review.examples(found.filter("false"), "tag", "n", ["itemid"]).count() == 0


def test_sidecars(spark, tmp_path):
    from wardgrid.sources import sidecars

    columns = ["k", "hf", "hf__observed", "sex_man", "sex_missing"]
    features = {"hf": {"kind": "integer", "unit": "/min"}, "gone": {"kind": "decimal", "unit": None}, "sex": {"kind": "category", "unit": None}}
    sidecars.write_sidecars(spark, str(tmp_path), columns, features, {"sex": ["Man", "Vrouw"]}, ["gone", "hf"])
    schema = json.loads((tmp_path / "feature_schema.json").read_text())
    assert schema == {"hf": {"kind": "integer", "unit": "/min", "columns": ["hf"], "mask": "hf__observed"}, "sex": {"kind": "category", "unit": None, "columns": ["sex_man", "sex_missing"]}}
    assert json.loads((tmp_path / "targets.json").read_text()) == {"targets": ["hf"], "missing": ["gone"]}
    assert rows(spark.read.option("header", True).csv(str(tmp_path / "categorical_encoding")), "column") == [("sex_man",), ("sex_missing",), ("sex_vrouw",)]


def test_admission_table_and_spread_sample(spark):
    from datetime import datetime

    from wardgrid.operators import anchors

    raw_ = spark.createDataFrame([(1, 10, "a", 0, 7_200_000), (1, 11, "b", -1899, None), (2, 12, None, 5, 6)], "p long, s long, g string, admittedat long, dischargedat long")
    epochs = {"a": datetime(2003, 1, 1), "b": datetime(2010, 1, 1)}
    call = lambda e: anchors.admission_table(raw_, "p", "s", "g", e, {"admittedat": "at", "dischargedat": "to"}, "own")
    assert rows(call(epochs), "stay_id", "subject_id", "at", "to", "los_hours") == [(10, 1, datetime(2003, 1, 1), datetime(2003, 1, 1, 2), 2.0), (11, 1, None, None, None), (12, 2, None, None, 1 / 3_600_000)]
    with pytest.raises(Exception, match="no epoch for g b"):
        call({"a": epochs["a"]}).collect()
    stays = spark.createDataFrame([(i, float(i)) for i in range(100)] + [(200, None)], "k long, h double")
    assert rows(anchors.spread_sample(stays, "k", "h", 4), "k") == [(12,), (37,), (62,), (87,)]
    assert anchors.spread_sample(stays.limit(3), "k", "h", 9).count() == 3 and anchors.spread_sample(stays.filter("false"), "k", "h", 9).count() == 0
