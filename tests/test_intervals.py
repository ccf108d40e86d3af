import random

import pytest

from tests.conftest import rows
from wardgrid.operators.intervals import interval_gaps, merge_intervals

SCHEMA = "k long, s long, e long, periodstart string, __b int"


def brute(data):
    periods, gaps = [], []
    for k in {r[0] for r in data}:
        spans = sorted((s, e) for kk, s, e in data if kk == k and s is not None and e is not None and e > s)
        merged = []
        for s, e in spans:
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        periods += [(k, s, e) for s, e in merged]
        gaps += [(k, a[1], b[0]) for a, b in zip(merged, merged[1:])]
    key = lambda r: [(v is not None, v) for v in r]
    return sorted(periods, key=key), sorted(gaps, key=key)


@pytest.mark.parametrize("seed", range(6))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    data = []
    for _ in range(rng.choice([1, 30, 400])):
        s = rng.randint(-300, 300)
        data.append((rng.choice([1, 1, 1, 2, 3, None]), s if rng.random() > 0.05 else None, s + rng.randint(-3, rng.choice([2, 20, 400])) if rng.random() > 0.05 else None))
    data += data[: len(data) // 3]
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA).repartition(4)
    periods, gaps = brute(data)
    for bucket in (1, 7, 100_000):
        assert rows(merge_intervals(df, ["k"], "s", "e", bucket=bucket)) == periods
        assert rows(interval_gaps(df, ["k"], "s", "e", bucket=bucket)) == gaps


def test_touching_leave_no_gap_and_long_ones_cover_many_buckets(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 10, 20), (1, 5, 1000), (1, 1001, 1002), (2, 5, 5), (2, 9, 3)], "k long, s long, e long")
    assert rows(interval_gaps(df, ["k"], "s", "e", bucket=10)) == [(1, 1000, 1001)]
    assert rows(merge_intervals(df, ["k"], "s", "e", bucket=10)) == [(1, 0, 1000), (1, 1001, 1002)]


def test_empty_table_and_two_keys(spark):
    empty = spark.createDataFrame([], "k long, j string, s long, e long")
    assert rows(interval_gaps(empty, ["k", "j"], "s", "e")) == [] == rows(merge_intervals(empty, ["k", "j"], "s", "e"))
    df = spark.createDataFrame([(1, "a", 0, 5), (1, "a", 7, 9), (1, "b", 0, 9), (1, None, 0, 1), (1, None, 2, 3)], "k long, j string, s long, e long")
    assert rows(interval_gaps(df, ["k", "j"], "s", "e")) == [(1, None, 1, 2), (1, "a", 5, 7)]


def test_one_hot_key_is_spread(spark):
    df = spark.range(0, 20000, 1, 8).selectExpr("1L as k", "id * 10 as s", "id * 10 + 6 as e")
    assert interval_gaps(df, ["k"], "s", "e", bucket=1000).count() == 19999


def test_states_combine_in_any_order():
    import numpy as np

    from wardgrid.operators.intervals import combined, disjoint, reduced

    rng = random.Random(31)
    for _ in range(50):
        spans = sorted((s, s + rng.randint(1, 30)) for s in (rng.randint(0, 300) for _ in range(rng.randint(1, 40))))
        whole = disjoint(*map(np.array, zip(*spans)))
        parts = [[x for x in spans if rng.random() < 0.5] for _ in range(5)] + [spans]
        states = [disjoint(*map(np.array, zip(*p))) for p in parts if p]
        rng.shuffle(states)
        for got in (reduced(states), reduced(states[::-1]), combined(states[0], reduced(states))):
            assert got[0].tolist() == whole[0].tolist() and got[1].tolist() == whole[1].tolist()
        assert (whole[0][1:] > whole[1][:-1]).all()


def test_runs_over_batches():
    import numpy as np
    import pandas as pd

    from wardgrid.operators.intervals import _folded, _leaf_states, _node_states

    rng = random.Random(32)
    data = sorted(((rng.choice([None, 1, 2, 3]), rng.randint(0, 400)) for _ in range(300)), key=lambda r: (r[0] is not None, r))
    rows_ = [(k, s, s + rng.randint(1, 5)) for k, s in data]
    periods = {}
    for k, s, e in rows_:
        mine = periods.setdefault(k, [])
        if mine and s <= mine[-1][1]:
            mine[-1][1] = max(mine[-1][1], e)
        else:
            mine.append([s, e])
    for size in (1, 7, 300):
        frame = pd.DataFrame(rows_, columns=["k", "__s", "__e"])
        batches = [frame.iloc[i : i + size].reset_index(drop=True) for i in range(0, 300, size)]
        leaves = list(_folded(iter(batches), ["k"], _leaf_states))
        for level in (leaves, list(_folded(iter(leaves), ["k"], _node_states))):
            got = {None if pd.isna(k) else k: np.stack([s, e], axis=1).tolist() for x in level for k, s, e in zip(x["k"], x["__s"], x["__e"])}
            assert got == periods


def test_large_keys_beside_null_ones(spark):
    big = 2**60 + 1
    df = spark.createDataFrame([(big, 0, 5), (big + 1, 0, 5), (big, 9, 12), (big + 1, 3, 20), (None, 0, 1), (None, 4, 6)], "k long, s long, e long")
    assert rows(interval_gaps(df, ["k"], "s", "e")) == [(None, 1, 4), (big, 5, 9)]
    assert rows(merge_intervals(df, ["k"], "s", "e")) == [(None, 0, 1), (None, 4, 6), (big, 0, 5), (big, 9, 12), (big + 1, 0, 20)]
