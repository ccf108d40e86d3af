"""Every query with SQL against DuckDB on the smallest tables, and the driver's contract."""

import datetime
import importlib
import math

import pytest

from wardgrid.queries import ORACLES, QUERIES

TABLES = "admissions numericitems drugitems listitems items units documents evalitems events orders lineitem customer part supplier nation region embeddings".split()


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    from tests.conftest import DATA

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v + 0.0, 5)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def ordered(rows):
    return sorted([tuple(map(plain, r)) for r in rows], key=lambda r: [(v is not None, str(type(v)), v) for v in r])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, data, con, name):
    got = QUERIES[name](spark, data)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert ordered(got.select(*names).collect()) == ordered(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).limit(1).count() == 1


def test_contract(spark, data):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p1_found", "p3_found", "p5_found", "p6_found"} <= set(entry.queries())


def test_found_columns_are_whole_numbers(spark, data):
    for name, columns in {"p1_found": ["admissionid", "gapstart", "gapstop"], "p3_found": ["numericid"], "p5_found": ["admissionid", "itemid", "hournr"], "p6_found": ["numericid"]}.items():
        df = QUERIES[name](spark, data)
        assert df.dtypes == [(c, "bigint") for c in columns]
        assert df.count() == df.distinct().count()


def test_extra_and_clashing_columns_change_nothing(spark, data, tmp_path):
    """The queries' tables with columns added whose names the operators use themselves."""
    import shutil

    from pyspark.sql import functions as F

    for t in ("items", "units", "admissions"):
        shutil.copy(f"{data}/{t}.parquet", tmp_path / f"{t}.parquet")
    clash = {"target_value": F.lit("x"), "physmin": F.lit(-1.0), "season": F.lit(3), "source": F.lit(None).cast("string"), "bits": F.lit(1), "hournr": F.lit(7), "status": F.lit("q"), "v": F.lit(1)}
    spark.read.parquet(f"{data}/numericitems.parquet").withColumns(clash).write.parquet(str(tmp_path / "numericitems.parquet"))
    spark.read.parquet(f"{data}/drugitems.parquet").withColumns({"gapstart": F.lit(1), "__m": F.lit(2)}).write.parquet(str(tmp_path / "drugitems.parquet"))
    for name in ("p1_found", "p3_found", "p5_found", "p6_found", "p7_wide"):
        a, b = QUERIES[name](spark, data), QUERIES[name](spark, str(tmp_path))
        assert ordered(a.collect()) == ordered(b.select(*a.columns).collect()), name


def test_empty_tables(spark, data, tmp_path):
    for t in ("items", "units"):
        spark.read.parquet(f"{data}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    for t in ("numericitems", "drugitems", "admissions"):
        spark.read.parquet(f"{data}/{t}.parquet").filter("false").write.parquet(str(tmp_path / f"{t}.parquet"))
    for name in ("p1_found", "p1_periods", "p3_found", "p5_found", "p5_grid", "p6_found", "p7_wide"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0, name
