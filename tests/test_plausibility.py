import math
import random

import numpy as np
import pytest

from wardgrid.operators.plausibility import SpikeRules, _judge, fit_tail, flag_implausible, run_lengths, stand_off, tail_cutoff, bucket_of

SCHEMA = "id long, adm long, item long, t long, v double, lo double, hi double, measured boolean, lab long, source string, x double"


def make(seed, n_series=12, hot=600):
    rng = random.Random(seed)
    out, i = [], 0
    for s in range(n_series):
        n = hot if s == 0 else rng.randint(1, 120)
        level = rng.uniform(60, 100)
        t = 0
        for _ in range(n):
            t += rng.randint(1, 5)
            v = round(rng.gauss(level, 2), 1)
            p = rng.random()
            if p < 0.02:
                v += rng.choice([-40, 40])
            elif p < 0.03:
                v = 999.0
            i += 1
            out.append((i, s, 1 + s % 2, t, v, 0.0, 300.0, True, int(s == 5), "q", 0.0))
            if rng.random() < 0.05:
                i += 1
                out.append((i, *out[-1][1:]))
        if n > 60:
            at = rng.randint(10, n - 20)
            base = len(out) - n
            for j in range(base + at, min(base + at + 8, len(out))):
                out[j] = (*out[j][:4], 77.7, *out[j][5:])
    return out


def whole(data, rules):
    """The same judgement with each series whole in memory."""
    first = {}
    for r in sorted(data):
        first.setdefault((r[1], r[2], r[3]), r)
    readings = [first[k] for k in sorted(first)]
    s = np.array([hash((r[1], r[2])) for r in readings])
    v = np.array([r[4] for r in readings])
    season = {}
    for item in {r[2] for r in data}:
        ok = [r for r in data if r[2] == item and 0 <= r[4] <= 300]
        mean = sum(r[4] for r in ok) / len(ok)
        for phase in range(24):
            mine = [r[4] for r in ok if r[3] % rules.period // (rules.period // rules.phases) == phase]
            season[item, phase] = sum(mine) / len(mine) - mean if mine else 0
    x = np.array([r[4] - season[r[2], r[3] % rules.period // (rules.period // rules.phases)] for r in readings])
    bits = np.array([(0 if 0 <= r[4] <= 300 else 1) + 2 * r[7] + 4 * (r[8] != 0) for r in readings])
    flagged, off, residual = _judge(s, v, x, bits, rules)
    return readings, flagged, off, residual


@pytest.mark.parametrize("seed", range(4))
def test_partition_edges_change_nothing(spark, seed):
    data = make(seed)
    rules = SpikeRules()
    readings, flagged, off, residual = whole(data, rules)
    df = spark.createDataFrame(data, SCHEMA)
    call = lambda rows: {r[0] for r in flag_implausible(df, ["adm", "item"], "item", "t", "v", "id", "lo", "hi", "measured", "lab", SpikeRules(rows=rows)).collect()}
    # One partition; one level of edges; several levels.
    results = [call(rows) for rows in (1_000_000, 400, 101)]
    ids = {}
    for r in data:
        ids.setdefault((r[1], r[2], r[3]), set()).add(r[0])
    sources = np.array([r[2] for r in readings])
    cutoffs = {}
    for item in set(sources.tolist()):
        size = np.abs(residual[(sources == item) & ~np.isnan(residual)])
        b, n = np.unique([bucket_of(np.array([x]), rules.width)[0] if x > 0 else -(2**31) for x in size], return_counts=True)
        cutoffs[item] = rules.scatters * tail_cutoff(b, n, rules)[0]
    expected = {i for r, f, o in zip(readings, flagged, off) if f or o >= cutoffs[r[2]] for i in ids[r[1:4]]}
    assert len(expected) > 20
    assert results == [expected] * 3


def test_spikes_shifts_courses_and_pairs():
    s = np.zeros(12, dtype=int)
    flat = [10, 11, 10, 11, 10, 11, 10, 11, 10, 11, 10, 11.0]
    assert stand_off(np.array(flat), s)[0].max() <= 1
    one = flat.copy()
    one[5] = 50
    assert stand_off(np.array(one), s)[0][5] == 40
    two = flat.copy()
    two[5] = two[6] = 50
    off = stand_off(np.array(two), s)[0]
    assert off[5] >= 39 and off[6] >= 39
    shift = np.array(flat[:6] + [v + 40 for v in flat[6:]])
    assert stand_off(shift, s)[0].max() <= 2
    course = np.arange(12) * 20.0
    assert stand_off(course, s)[0].max() == 0
    between = flat.copy()
    between[4] = between[6] = 50
    assert stand_off(np.array(between), s)[0][5] <= 2
    ends = flat.copy()
    ends[0] = ends[-1] = 90
    assert stand_off(np.array(ends), s)[0][[0, -1]].max() == 0


def test_runs():
    v = np.array([1, 1, 1, 2, 2, 1, 1, 1.0])
    assert run_lengths(v, np.array([0, 0, 0, 0, 0, 0, 1, 1])).tolist() == [3, 3, 3, 2, 2, 1, 2, 2]
    assert len(run_lengths(np.zeros(0), np.zeros(0))) == 0


def counted(size):
    return np.unique(bucket_of(size, 0.01), return_counts=True)


def test_cutoff_of_normal_tails():
    rng = np.random.default_rng(0)
    size = np.abs(rng.normal(0, 3, 200_000))
    scatter, cutoff = tail_cutoff(*counted(size), SpikeRules())
    assert scatter == pytest.approx(3, rel=0.02)
    assert 3.2 < cutoff / 3 < 6


@pytest.mark.parametrize("shape", [-0.3, 0.0, 0.2])
def test_tails_are_fitted_in_shape_and_scale(shape):
    u = np.random.default_rng(1).random(100_000)
    excess = -np.log(u) * 2 if shape == 0 else 2 * (u**-shape - 1) / shape
    reach = float(np.quantile(excess, 0.8))
    seen = excess[excess <= reach]
    got = fit_tail(seen, np.ones(len(seen)), reach, float((excess > reach).sum()))
    assert got == (pytest.approx(shape, abs=0.06), pytest.approx(2, rel=0.08))


def test_the_tail_decides_what_is_ordinary():
    """Faults beyond the cutoff don't count for the scatter; without a tail they would hide themselves."""
    rng = np.random.default_rng(2)
    size = np.abs(np.concatenate([rng.normal(0, 1, 50_000), rng.uniform(9, 40, 1500)]))
    scatter, cutoff = tail_cutoff(*counted(size), SpikeRules())
    assert 3 < cutoff < 9 and scatter == pytest.approx(1, rel=0.03)
    assert 6 * tail_cutoff(*counted(size), SpikeRules(risk=1e-300))[0] > 20
    heavy = np.abs(rng.standard_t(2.5, 50_000))
    assert tail_cutoff(*counted(heavy), SpikeRules())[1] > 20


def test_tails_of_steps_and_of_few_values():
    assert tail_cutoff(np.array([-(2**31)]), np.array([5]), SpikeRules())[0] == 0
    assert tail_cutoff(np.array([3]), np.array([1]), SpikeRules())[0] > 0
    b, n = counted(np.array([1.0] * 900 + [2.0] * 90 + [14.0] * 10))
    scatter, _ = tail_cutoff(b, n, SpikeRules())
    assert 1 < scatter < 14 / 6


@pytest.mark.parametrize("value", [500.0, 50.0])
def test_hot_series_out_of_bounds_or_stuck(spark, value):
    """A series without judged readings hands on a fixed number at each edge, and loses nothing."""
    from wardgrid.operators.plausibility import _edges

    data = [(i, 1, 1, i, value if i % 97 else 51.0, 0.0, 300.0, True, 0, "q", 0.0) for i in range(2000)]
    got = {r[0] for r in flag_implausible(spark.createDataFrame(data, SCHEMA), ["adm", "item"], "item", "t", "v", "id", "lo", "hi", "measured", "lab", SpikeRules(rows=150)).collect()}
    assert got >= {i for i in range(2000) if i % 97}
    for judged in (np.zeros(2000, dtype=bool), np.ones(2000, dtype=bool)):
        assert _edges(np.zeros(2000), judged, SpikeRules())[1].sum() <= SpikeRules().edge


def test_nulls_labs_and_empty(spark):
    rows = [(None, 1, 1, 1, 5000.0), (1, None, 1, 1, 5000.0), (2, 1, None, 1, 5000.0), (3, 1, 1, None, 5000.0), (4, 1, 1, 2, None), (5, 1, 1, 3, math.nan), (6, 1, 1, 4, 5000.0), (6, 1, 1, 4, 5000.0), (7, 1, 1, 5, 50.0)]
    df = spark.createDataFrame([(*r, 0.0, 300.0, None, None, None, None) for r in rows], SCHEMA)
    call = lambda df: sorted(r[0] for r in flag_implausible(df, ["adm", "item"], "item", "t", "v", "id", "lo", "hi", "measured", "lab").collect())
    assert call(df) == [6]
    assert call(df.filter("false")) == []
