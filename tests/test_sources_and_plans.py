import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardgrid.config import GridConfig, TokenConfig
from wardgrid.operators import events, splits
from wardgrid.plans import grid_pipeline, token_pipeline
from wardgrid.sources import raw, resources, sinks, tensors
from wardgrid.sources.tables import table
from wardgrid.streaming.causal import causal_means_stream, deduplicated_stream


def test_latin1_csv_keeps_words_for_nothing(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_bytes("id,name,unit,v\n1,patiënt,None,80.5\n2,,NA,x\n3,\"café, bar\",,\n".encode("latin-1"))
    df = raw.read_latin1_csv(spark, str(p), {"id": "bigint", "v": "double"})
    assert rows(df) == [(1, "patiënt", "None", 80.5), (2, None, "NA", None), (3, "café, bar", None, None)]


def test_gzip_csv_and_times(spark, tmp_path):
    p = tmp_path / "a.csv.gz"
    with gzip.open(p, "wt") as f:
        f.write("id,t\n1,2010-01-01 08:00:00\n2,soon\n")
    df = raw.read_gzip_csv(spark, str(p), {"id": "bigint", "t": "timestamp_ntz"}, partitions=2)
    got = rows(df)
    assert got[0][1].hour == 8 and got[1] == (2, None)


def test_tab_concepts_without_quotes(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('concept_id\tname\n1\tthe "old" one\n2\t"open\n')
    assert rows(raw.read_tab_concepts(spark, str(p))) == [("1", 'the "old" one'), ("2", '"open')]


def test_cache_is_built_once(spark, tmp_path):
    path, calls = str(tmp_path / "cache"), []

    def build():
        calls.append(1)
        return spark.range(5)

    assert raw.cached(spark, path, build).count() == 5 == raw.cached(spark, path, build).count()
    assert len(calls) == 1
    raw.cached(spark, path, build, rebuild=True)
    assert len(calls) == 2
    assert raw.prefer(spark, path, "other") == path and raw.prefer(spark, path + "x", "other") == "other"


def test_replace_from_itself_and_guard(spark, tmp_path):
    path = str(tmp_path / "d")
    sinks.replace(spark.range(5), path)
    sinks.replace(spark.read.parquet(path).filter("id > 2"), path)
    assert spark.read.parquet(path).count() == 2
    assert [p for p in os.listdir(tmp_path) if ".new-" in p] == []
    (tmp_path / "mine.txt").write_text("x")
    with pytest.raises(FileExistsError):
        sinks.guard(spark, str(tmp_path), ["d"])
    sinks.guard(spark, str(tmp_path), ["d"], overwrite=True)
    assert sorted(p for p in os.listdir(tmp_path) if not p.startswith(".")) == ["mine.txt"]


def test_shards_by_split(spark, tmp_path):
    df = spark.range(50).selectExpr("id as unit", "if(id % 5 = 0, 'val', 'train') as split")
    shards = splits.sharded(df, "unit", 8)
    sinks.write_shards(df.join(shards.drop("split"), "unit"), str(tmp_path / "s"), order=["unit"])
    files = [os.path.join(r, f) for r, _, fs in os.walk(tmp_path / "s") for f in fs if f.endswith(".parquet")]
    assert len(files) == 5 + 2
    assert spark.read.parquet(str(tmp_path / "s")).count() == 50


def test_side_files(spark, tmp_path):
    sinks.write_json(spark, {"b": 1, "a": [1, 2]}, str(tmp_path / "x.json"))
    assert json.loads((tmp_path / "x.json").read_text()) == {"a": [1, 2], "b": 1}
    sinks.write_csv(spark.range(3), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3


def test_ids_from_a_file(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("3\n 4 \nx\n\n3\n")
    assert rows(raw.read_ids(spark, str(tmp_path / "ids.txt"), "k")) == [(3,), (4,)]


def test_manifest_blocks():
    text = "\n".join(["# Review", "", "### pulse", "- reconstruction_type: direct_numeric", "- target_unit: /min", "- keep: 41011, 41012", "", "### pump", "- reconstruction_type: treatment_indicator", "- keep: none", "- structural_zero: true", "", "### odd", "- keep: 5", "### pulse", "- reconstruction_type: direct_numeric"])
    found, problems = resources.parse_manifest(text)
    assert found["pulse"] == {"reconstruction_type": "direct_numeric", "target_unit": "/min", "keep": [41011, 41012], "structural_zero": False}
    assert found["pump"]["structural_zero"] and found["pump"]["keep"] == []
    assert problems == ["odd: no reconstruction_type", "pulse: described twice"]


def test_feature_seed_and_inventory(tmp_path):
    (tmp_path / "seed.csv").write_text("tag,unit\na,x\nb,y\n")
    assert [r["tag"] for r in resources.load_seed(str(tmp_path / "seed.csv"), ["tag", "unit"], "tag")] == ["a", "b"]
    (tmp_path / "bad.csv").write_text("tag;unit\na;x\na;y\n")
    with pytest.raises(ValueError, match="a"):
        resources.load_seed(str(tmp_path / "bad.csv"), ["tag"], "tag")
    with pytest.raises(ValueError, match="missing"):
        resources.load_seed(str(tmp_path / "seed.csv"), ["tag", "missing"], "tag")
    found = {r["name"]: r for r in resources.inventory(str(tmp_path), "*.csv")}
    assert found["bad.csv"]["delimiter"] == ";" and found["seed.csv"]["columns"] == ["tag", "unit"]


def test_grid_pipeline_is_frozen_on_training(spark, data):
    args = [table(spark, data, t) for t in ("numericitems", "admissions", "items")]
    out = grid_pipeline.build_grid(*args).cache()
    assert out.groupBy("admissionid", "hour").count().filter("count > 1").count() == 0
    held = out.filter("split <> 'train'").select("admissionid").distinct()
    moved = args[0].join(held.withColumn("h", F.lit(1)), "admissionid", "left").withColumn("value", F.when(F.col("h") == 1, F.col("value") + 7).otherwise(F.col("value"))).drop("h")
    again = grid_pipeline.build_grid(moved, *args[1:])
    keep = ["admissionid", "hour", F.round("hf", 9)]
    assert rows(out.filter("split = 'train'"), *keep) == rows(again.filter("split = 'train'"), *keep)


def test_grid_is_written_by_split(spark, data, tmp_path):
    config = GridConfig(per_shard=4)
    out = grid_pipeline.build_grid(*[table(spark, data, t) for t in ("numericitems", "admissions", "items")], config)
    grid_pipeline.write_grid(out, str(tmp_path / "g"), config)
    back = spark.read.parquet(str(tmp_path / "g"))
    assert back.count() == out.count() and {"split", "shard"} <= set(back.columns)


def test_token_pipeline(spark, data):
    t = token_pipeline.build_events(*[table(spark, data, n) for n in ("numericitems", "listitems", "drugitems", "admissions")], TokenConfig())
    ids, vocabulary = token_pipeline.build_tokens(t)
    ids = ids.cache()
    n = vocabulary.count()
    assert ids.filter(f"id is null or id < 0 or id >= {n}").count() == 0
    assert ids.filter("token = 'TIMELINE_END'").count() == t.select("admissionid").distinct().count()
    assert ids.filter("split = 'train' and is_unknown").count() == 0
    after = events.ordered(ids, ["admissionid"], ["seq"], "n").withColumn("before", F.expr("lag(token) over (partition by admissionid order by seq)"))
    assert after.filter("token rlike '^Q[0-9]+$' and before not like 'NUM//%'").count() == 0


def test_stream_gives_what_a_table_gives(spark, tmp_path):
    data = [(1, f"2020-01-01 0{h}:{m:02d}:00", float(v)) for h, m, v in ((0, 0, 1), (0, 30, 3), (1, 0, 5), (3, 10, 7), (3, 20, 9))] + [(2, "2020-01-01 00:10:00", 4.0), (2, "2020-01-01 00:20:00", None), (9, "2020-01-03 00:00:00", 1.0)]
    df = spark.createDataFrame(data, "k long, t string, v double").withColumn("at", F.col("t").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    static = rows(causal_means_stream(df, ["k"], "at", "v"), "k", "at", "v", "n")
    stream = causal_means_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["k"], "at", "v", late="1 hour")
    q = stream.writeStream.format("memory").queryName("causal").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    got = rows(spark.table("causal"), "k", "at", "v", "n")
    # The newest window stays open until something newer comes.
    assert got == [r for r in static if r[0] != 9]
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 2.0, 2), (1, 5.0, 1), (1, 8.0, 2), (2, 4.0, 1)]


def test_stream_without_repeats(spark, tmp_path):
    df = spark.createDataFrame([(1, "2020-01-01 00:00:00"), (1, "2020-01-01 00:00:00"), (2, "2020-01-01 00:00:00")], "id long, t string").withColumn("at", F.col("t").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    stream = deduplicated_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["id"], "at")
    q = stream.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("once").count() == 2


def test_insert_statements_and_evidence(spark):
    from wardgrid.sources.evidence import evidence, insert_statements

    lines = spark.createDataFrame([("INSERT INTO m VALUES (12, 'it''s, a label', NULL), (13,'b','x');",), ("-- nothing (1, 2, 3)",), (None,)], "t string")
    got = insert_statements(lines, "t", 3)
    assert rows(got) == [("12", "it's, a label", None), ("13", "b", "x")]
    long = evidence({"sql": (got, {"code": "c0", "label": "c1", "target": "c2"}), "map": (spark.createDataFrame([("12.0", "y"), (None, "z"), ("12.0", "y")], "code string, target string"), {"code": "code", "target": "target"})})
    assert rows(long, "source", "code", "label", "target") == [("map", "12", None, "y"), ("sql", "13", "b", "x")]


def test_audits_name_all_broken_rules(spark):
    from wardgrid.plans import audits

    good = spark.createDataFrame([(1, h, "train", 0.5, 1, 1, 0) for h in range(3)], "admissionid long, hour long, split string, pulse double, pulse__observed int, a int, b int")
    audits.check(audits.audit_grid(good, ["pulse"], [["a", "b"]]))
    bad = good.unionByName(spark.createDataFrame([(1, 2, "val", float("inf"), 2, 1, 1), (1, 9, None, None, 0, 0, 0)], good.schema))
    with pytest.raises(audits.AuditFailed) as e:
        audits.check(audits.audit_grid(bad, ["pulse"], [["a", "b"]]))
    for rule in ("a ... not exclusive: 2", "holes in hours: 1", "no split: 1", "pulse mask: 1", "pulse not finite: 1", "repeated keys: 1", "several splits: 1"):
        assert rule in str(e.value)
    tokens = spark.createDataFrame([(1, 0, "A", 0, 5), (1, 1, "Q3", 1, 4), (1, 3, "TIMELINE_END", 9, 6), (2, 0, "Q1", 1, 1), (2, 1, "Q2", 1, 1)], "admissionid long, seq long, token string, id long, time long")
    got = dict(rows(audits.audit_tokens(tokens, 5)))
    assert got == {"id out of range": 1, "place": 1, "time goes back": 1, "quantile without code": 2, "end not last": 0, "no end": 1}
    a, b = spark.createDataFrame([(1, 2), (1, 3), (2, 4)], "k long, v long"), spark.createDataFrame([(1, 3), (1, 2), (2, 5)], "k long, v long")
    assert rows(audits.audit_preserved(a, b, ["v"], ["k"])) == [(2, 1, 1)]


def test_command_line(spark, data, tmp_path):
    from wardgrid.__main__ import main

    main(["grid", "--input", data, "--output", str(tmp_path / "g")])
    assert spark.read.parquet(str(tmp_path / "g" / "data")).count() > 0
    with pytest.raises(FileExistsError):
        main(["grid", "--input", data, "--output", str(tmp_path / "g")])
    main(["tokens", "--input", data, "--output", str(tmp_path / "t")])
    index = spark.read.parquet(str(tmp_path / "t" / "index"))
    for r in index.groupBy("split").agg(F.sum("n").alias("n")).collect():
        assert tensors.read_tensors(spark, f"file://{tmp_path}/t/tokens/{r['split']}").filter("tensor = 'tokens'").count() == r["n"]
    assert json.loads((tmp_path / "t" / "summary.json").read_text())["events"] == spark.read.parquet(str(tmp_path / "t" / "events")).count()
    main(["query", "p1_found", "--input", data, "--output", str(tmp_path / "q")])
    assert spark.read.parquet(str(tmp_path / "q" / "data")).columns == ["admissionid", "gapstart", "gapstop"]
