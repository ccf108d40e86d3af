import math

import pytest

from wardgrid.operators.units import InconsistentConversions, compose, convert_units, substance_edges
from wardgrid.functions.unit_tables import GENERAL_EDGES, SPELLINGS

ITEMS = "itemid long, item string, tag string, valuetype string, target_unit string, target_unitid long, physmin double, physmax double, measured boolean"
ROWS = "numericid long, itemid long, item string, value double, unitid long, unit string, comment string, tag string, __v string"
UNITS = [(301, "mmHg", "pressure"), (302, "kPa", "pressure"), (306, "%", "share"), (307, "fraction", "share"), (308, "°C", "temperature"), (309, "°F", "temperature"), (310, "mmol/l", "concentration"), (311, "mg/dl", "concentration"), (313, "mEq/l", "concentration"), (317, "10^9/l", "count"), (318, "/µl", "count"), (319, "K/µl", "count"), (330, "None", "none")]


@pytest.fixture
def tables(spark):
    items = spark.createDataFrame(
        [(1, "Druk", "p", "integer", "mmHg", 301, 5.0, 240.0, True), (2, "FiO2", "fio2", "integer", "%", 306, 19.0, 100.0, False), (3, "Temp", "t", "decimal", "°C", 308, 24.0, 44.5, True), (4, "K", "k", "decimal", "mmol/l", 310, 0.9, 13.0, True), (5, "Gluc", "glucpoc", "decimal", "mmol/l", 310, 0.4, 75.0, True), (6, "Tromb", "tromb", "integer", "10^9/l", 317, 1.0, 2600.0, True), (7, "Score", "s", "integer", None, None, None, None, False)],
        ITEMS,
    )
    return items, spark.createDataFrame(UNITS, "unitid long, unit string, quantity string")


def run(spark, tables, rows, **kw):
    df = spark.createDataFrame([(i, *r, None, None) for i, r in enumerate(rows)], ROWS)
    out = convert_units(df, *tables, **kw)
    assert out.columns[: len(df.columns)] == df.columns
    return [(None if r["target_value"] is None else round(r["target_value"], 3), r["target_value_changed"]) for r in out.orderBy("numericid").collect()]


def test_where_the_unit_stands(spark, tables):
    got = run(spark, tables, [
        (1, "Druk", 10.0, None, " k.Pa ", None),  # unit, spelt freely
        (1, "Druk", 10.0, 302, "None", None),  # unitid
        (1, "Druk", 10.0, 0, None, "value given in KPA"),
        (1, "Druk", 10.0, 330, "-", "units=kPa; rest ok"),
        (1, "Druk", 10.0, None, "Geen", "overgenomen uit oude status, kpa"),
        (1, "Druk (kPa)", 10.0, None, "", "na 500 ml vulling"),
        (1, "Druk, kpa", 10.0, None, None, "nulpunt 2 cm hoger"),
        (1, "Druk (bloed)", 70.0, None, None, None),
        (1, "Druk", 70.0, 302, "mmHg", None),  # the unit's text goes first
        (1, "Druk", 70.0, 302, "furlong", None),  # an unknown text names nothing
    ])
    assert got == [(75.006, True)] * 7 + [(70.0, False), (70.0, False), (round(70 * 7.500617, 3), True)]


def test_shift_equal_units_and_substances(spark, tables):
    got = run(spark, tables, [(3, "Temp", 98.6, 309, None, None), (4, "K", 4.0, 313, "mEq/l", None), (6, "Tromb", 200.0, None, "k/uL", None), (6, "Tromb", 200000.0, None, "/mm3", None), (5, "Gluc", 180.156, None, "mg/dL", None)])
    assert got == [(37.0, True), (4.0, False), (200.0, False), (200.0, True), (10.0, True)]


def test_size_shows_the_scale_only_if_the_item_uses_it(spark, tables):
    named = [(2, "FiO2", float(v), 306, "%", None) for v in range(21, 100)]
    assert run(spark, tables, [*named, (2, "FiO2", 0.4, None, None, None)])[-1] == (0.4, False)
    assert run(spark, tables, [*named, (2, "FiO2", 0.5, 307, None, None), (2, "FiO2", 0.4, None, None, None), (2, "FiO2", 999.0, None, None, None), (2, "FiO2", 45.0, None, None, None)])[-4:] == [(50.0, True), (40.0, True), (999.0, False), (45.0, False)]


def test_size_shows_the_scale_of_unusual_values_too(spark, tables):
    named = [(2, "FiO2", float(v), 306, "%", None) for v in range(21, 91) for _ in range(2)] + [(2, "FiO2", 0.5, None, "fractie", None)]
    assert run(spark, tables, [*named, (2, "FiO2", 1.0, None, None, None), (2, "FiO2", 1.01, None, None, None), (2, "FiO2", 0.2, None, None, None)])[-3:] == [(100.0, True), (1.01, False), (20.0, True)]
    # A number for no reading is no value in another scale, though possible there.
    sugar = [(5, "Gluc", 4 + i / 10, 310, None, None) for i in range(100)] + [(5, "Gluc", 150.0, 311, None, None)]
    assert run(spark, tables, [*sugar, (5, "Gluc", 999.0, None, None, None), (5, "Gluc", 360.0, None, None, None)])[-2:] == [(999.0, False), (round(360 / 18.0156, 3), True)]
    # Without scatter the bounds decide.
    assert run(spark, tables, [(2, "FiO2", 40.0, 306, None, None)] * 3 + [(2, "FiO2", 0.4, 307, None, None), (2, "FiO2", 0.5, None, None, None)])[-1] == (50.0, True)


def test_nulls_unknown_items_and_empty_tables(spark, tables):
    got = run(spark, tables, [(1, "Druk", None, 302, None, None), (1, None, math.nan, 302, None, None), (99, "x", 5.0, 302, None, None), (None, None, 5.0, None, None, None), (7, "Score", 5.0, 302, None, None), (1, "Druk", 5.0, 306, None, None)])
    assert got == [(None, False), (None, False), (5.0, False), (5.0, False), (5.0, False), (None, False)]
    assert run(spark, tables, []) == []


def test_long_and_repeated_texts(spark, tables):
    assert run(spark, tables, [(1, "Druk", 10.0, None, None, "x" * 100_000 + " [kPa]")] * 2) == [(75.006, True)] * 2


def test_units_at_the_end_of_comments(spark, tables):
    comments = ["gemeten als kPa", "taken in kPa; fine", "overgenomen (kilo pascal)", "set on the machine as k Pa.", "na 20 kPa", "na 20 kPa verhoogd", "bed C", "kPa is what it was", "", "in kPa", "12 kPa", "kPa"]
    got = run(spark, tables, [(1, "Druk", 10.0, None, None, t) for t in comments])
    assert [x for _, x in got] == [True, True, True, True, False, False, False, False, False, True, False, True]


def test_compositions_are_consistent():
    for tag in (None, "glucpoc", "ca", "hb"):
        for target in SPELLINGS:
            compose([*GENERAL_EDGES, *substance_edges(tag)], target)
    assert compose(GENERAL_EDGES, "°C")["°F"] == pytest.approx((1 / 1.8, -32 / 1.8))
    with pytest.raises(InconsistentConversions):
        compose([("a", "b", 2.0, 0.0), ("b", "c", 2.0, 0.0), ("a", "c", 5.0, 0.0)], "c")


def test_spellings_name_one_unit_each():
    from wardgrid.operators.units import _spelt

    said = [(_spelt(s), u) for u, ways in SPELLINGS.items() for s in {*ways, u}]
    assert len({t for t, _ in set(said)}) == len(set(said))
