"""Implausible readings: values out of bounds, stuck values, and spikes judged by extreme-value cutoffs.

One range shuffle by (series, time) puts each series in order and splits a hot one over partitions.
Each partition judges the readings whose neighbours it holds, and hands on a fixed number of readings at
its edges, which are judged level by level afterwards. Residuals' sizes are counted in logarithmic
buckets per source. A generalised Pareto tail is fitted by likelihood to those counts' peaks over a
threshold; the size that ordinary readings exceed with a fixed risk separates them from faults, and the
scatter that the ordinary ones show sets the stand-off from which a reading is a spike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.session import discard, stored

DAY_MS = 86_400_000
OUT_OF_BOUNDS, MEASURED, LAB = 1, 2, 4
FLAGGED, CANDIDATE, COUNT, EDGE, EDGE_ID = range(5)
#: What a reading at a partition's edge still waits for.
SPIKE, STUCK = 1, 2
OUT_SCHEMA = "kind byte, source long, series array<long>, t long, id long, x double, bits byte, open byte, v double"


@dataclass(frozen=True)
class SpikeRules:
    """stuck: readings in a row with one value; scatters: the least stand-off in scatters of ordinary
    readings; risk: the chance that an ordinary residual lies beyond the tail's cutoff; threshold: the
    quantile of residuals whose peaks are fitted; censor: the quantile beyond which peaks only count as
    beyond it, because faults gather there; width: relative width of the residual buckets; context:
    readings on a side that a verdict needs; rounds: times the tail is fitted; rows: of a partition judged at once, about 100 bytes each."""

    stuck: int = 6
    scatters: float = 6.0
    risk: float = 1e-5
    threshold: float = 0.8
    censor: float = 0.96
    width: float = 0.01
    context: int = 6
    period: int = DAY_MS
    phases: int = 24
    rounds: int = 4
    rows: int = 250_000

    @property
    def edge(self) -> int:
        """Readings that a partition hands on at most."""
        return 2 * (2 * self.context + 1 + 2 * self.stuck)


def _shifted(v: np.ndarray, s: np.ndarray, by: int) -> np.ndarray:
    """The value `by` places on in the same series, else NaN."""
    out = np.full(len(v), np.nan)
    n = len(v)
    if abs(by) >= n:
        return out
    a, b = (slice(0, n - by), slice(by, n)) if by > 0 else (slice(-by, n), slice(0, n + by))
    same = s[a] == s[b]
    out[a] = np.where(same, v[b], np.nan)
    return out


def stand_off(v: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stand-off, residual) of each value of series s: how far it, alone or with one neighbour, lies
    beyond the readings on both sides (0 if it doesn't), and its distance to the median of three on
    either side (NaN without all six). A stand-off counts at most twice the distance from the median
    of the surroundings on its own side, so that an ordinary reading between two spikes has none."""
    if not len(v):
        return np.zeros(0), np.zeros(0)
    p1, p2, p3 = (_shifted(v, s, -k) for k in (1, 2, 3))
    n1, n2, n3, n4 = (_shifted(v, s, k) for k in (1, 2, 3, 4))
    around = np.stack([p1, p2, p3, n1, n2, n3])
    with np.errstate(all="ignore"):
        whole = ~np.isnan(around).any(axis=0)
        residual = np.where(whole, v - np.median(around, axis=0), np.nan)
        level = _median(around)
        up = np.minimum(np.minimum(v - p1, v - n1), 2 * (v - level))
        down = np.minimum(np.minimum(p1 - v, n1 - v), 2 * (level - v))
        single = np.fmax(np.fmax(up, down), 0)
        low, high = np.minimum(v, n1), np.maximum(v, n1)
        outer = _median(np.stack([p1, p2, p3, n2, n3, n4]))
        up = np.minimum(low - np.maximum(p1, n2), 2 * (low - outer))
        down = np.minimum(np.minimum(p1, n2) - high, 2 * (outer - high))
        pair = np.fmax(np.fmax(up, down), 0)
    pair = np.where(np.isnan(p1) | np.isnan(n2), 0, pair)
    single = np.where(np.isnan(p1) | np.isnan(n1), 0, single)
    before = _shifted(pair, s, -1)
    return np.fmax(single, np.fmax(pair, np.nan_to_num(before))), residual


def _median(rows: np.ndarray) -> np.ndarray:
    """The median down the rows without NaN; NaN where there is nothing."""
    ordered = np.sort(rows, axis=0)  # NaN last
    n = (~np.isnan(rows)).sum(axis=0)
    at = np.arange(rows.shape[1])
    low, high = np.maximum(n - 1, 0) // 2, n // 2
    return np.where(n > 0, (ordered[low, at] + ordered[np.minimum(high, len(rows) - 1), at]) / 2, np.nan)


def run_lengths(v: np.ndarray, s: np.ndarray) -> np.ndarray:
    """How many consecutive readings of the series, this one included, have this one's value."""
    if not len(v):
        return np.zeros(0, dtype=int)
    new = np.r_[True, (s[1:] != s[:-1]) | ~(np.abs(v[1:] - v[:-1]) <= 1e-9 * np.maximum(1, np.abs(v[1:])))]
    run = np.cumsum(new) - 1
    return np.bincount(run)[run]


def bucket_of(x: np.ndarray, width: float) -> np.ndarray:
    """The logarithmic bucket of sizes above 0."""
    return np.ceil(np.log(x) / math.log1p(width)).astype(np.int64)


def _judge(s: np.ndarray, v: np.ndarray, x: np.ndarray, bits: np.ndarray, rules: SpikeRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flagged outright, stand-off, residual) of readings in order; s numbers the series, x is v without season."""
    out = (bits & OUT_OF_BOUNDS) > 0
    measured = (bits & MEASURED) > 0
    flagged = out | (measured & (run_lengths(v, s) >= rules.stuck))
    judged = np.flatnonzero(~out & measured & ((bits & LAB) == 0))
    off, residual = np.zeros(len(v)), np.full(len(v), np.nan)
    off[judged], residual[judged] = stand_off(x[judged], s[judged])
    return flagged, off, residual


def _readings(rows: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(reading of each row, first row of each reading, series of each reading)."""
    names = [f"k{i}" for i in range(k)]
    keys = rows[names].to_numpy()
    series_new = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
    t = rows["t"].to_numpy()
    new = series_new | np.r_[True, t[1:] != t[:-1]]
    first = np.flatnonzero(new)
    return np.cumsum(new) - 1, first, (np.cumsum(series_new) - 1)[first]


def _edges(series: np.ndarray, judged: np.ndarray, rules: SpikeRules) -> tuple[np.ndarray, np.ndarray]:
    """(what each reading of a partition waits for, whether it is handed on).

    A spike's verdict needs `context` judged readings on either side, a run's `stuck` readings of any kind;
    whatever the readings of a series are, a fixed number at each edge waits or serves as context."""
    n = len(series)
    waits, context = np.zeros(n, dtype=np.int8), np.zeros(n, dtype=bool)
    for mine, place, nth in (
        (series == series[0], np.arange(1, n + 1), np.cumsum(judged)),
        (series == series[-1], np.arange(n, 0, -1), np.cumsum(judged[::-1])[::-1]),
    ):
        waits |= np.where(mine & judged & (nth <= rules.context), SPIKE, 0).astype(np.int8)
        waits |= np.where(mine & (place < rules.stuck), STUCK, 0).astype(np.int8)
        context |= mine & ((judged & (nth <= 2 * rules.context + 1)) | (place <= 2 * rules.stuck))
    return waits, context


def _emit(kind: int, mask: np.ndarray, **columns) -> pd.DataFrame:
    """Rows of OUT_SCHEMA where mask holds; columns are given for all."""
    m = int(mask.sum())
    zero = {"source": np.int64, "series": object, "t": np.int64, "id": np.int64, "x": float, "bits": np.int8, "open": np.int8, "v": float}
    made = {"kind": np.full(m, kind, dtype=np.int8)}
    for name, kind_ in zero.items():
        value = columns.get(name)
        made[name] = pd.Series([None] * m if value is None else list(value[mask]), dtype=object) if name == "series" else np.zeros(m, dtype=kind_) if value is None else np.asarray(value)[mask].astype(kind_)
    return pd.DataFrame(made)


def _verdicts(s: np.ndarray, head: dict[str, np.ndarray], bits: np.ndarray, open_: np.ndarray, whole: bool, rules: SpikeRules):
    """Judges readings in order; open_ is what each one may be judged for. Yields the counts and what waits at
    the edges, unless these are `whole`, all there are; returns (flagged, stand-off to be compared, what
    still waits) of each reading."""
    flagged, off, residual = _judge(s, head["v"], head["x"], bits, rules)
    judged = ((bits & (OUT_OF_BOUNDS | LAB)) == 0) & ((bits & MEASURED) > 0)
    waits, context = _edges(s, judged, rules)
    waits = waits & (0 if whole else open_)
    ripe = ((open_ & SPIKE) > 0) & ((waits & SPIKE) == 0)
    yield _counted(head["source"], residual, ripe, rules)
    yield _emit(EDGE, context & (not whole), source=head["source"], series=head["series"], t=head["t"], x=head["x"], v=head["v"], bits=bits, open=waits)
    # A run that is long enough here is so whatever follows.
    return flagged & (open_ > 0), np.where(ripe, off, 0.0), waits


def _edges(series: np.ndarray, judged: np.ndarray, rules: SpikeRules) -> tuple[np.ndarray, np.ndarray]:
    """(what each reading of a partition waits for, whether it is handed on).

    A spike's verdict needs `context` judged readings on either side, a run's `stuck` readings of any kind;
    whatever the readings of a series are, a fixed number at each edge waits or serves as context."""
    n = len(series)
    waits, context = np.zeros(n, dtype=np.int8), np.zeros(n, dtype=bool)
    for mine, place, nth in (
        (series == series[0], np.arange(1, n + 1), np.cumsum(judged)),
        (series == series[-1], np.arange(n, 0, -1), np.cumsum(judged[::-1])[::-1]),
    ):
        waits |= np.where(mine & judged & (nth <= rules.context), SPIKE, 0).astype(np.int8)
        waits |= np.where(mine & (place < rules.stuck), STUCK, 0).astype(np.int8)
        context |= mine & ((judged & (nth <= 2 * rules.context + 1)) | (place <= 2 * rules.stuck))
    return waits, context


def _emit(kind: int, mask: np.ndarray, **columns) -> pd.DataFrame:
    """Rows of OUT_SCHEMA where mask holds; columns are given for all."""
    m = int(mask.sum())
    zero = {"source": np.int64, "series": object, "t": np.int64, "id": np.int64, "x": float, "bits": np.int8, "open": np.int8, "v": float}
    made = {"kind": np.full(m, kind, dtype=np.int8)}
    for name, kind_ in zero.items():
        value = columns.get(name)
        made[name] = pd.Series([None] * m if value is None else list(value[mask]), dtype=object) if name == "series" else np.zeros(m, dtype=kind_) if value is None else np.asarray(value)[mask].astype(kind_)
    return pd.DataFrame(made)


def _verdicts(s: np.ndarray, head: dict[str, np.ndarray], bits: np.ndarray, open_: np.ndarray, whole: bool, rules: SpikeRules):
    """Judges readings in order; open_ is what each one may be judged for. Yields the counts and what waits at
    the edges, unless these are `whole`, all there are; returns (flagged, stand-off to be compared, what
    still waits) of each reading."""
    flagged, off, residual = _judge(s, head["v"], head["x"], bits, rules)
    judged = ((bits & (OUT_OF_BOUNDS | LAB)) == 0) & ((bits & MEASURED) > 0)
    waits, context = _edges(s, judged, rules)
    waits = waits & (0 if whole else open_)
    ripe = ((open_ & SPIKE) > 0) & ((waits & SPIKE) == 0)
    yield _counted(head["source"], residual, ripe, rules)
    yield _emit(EDGE, context & (not whole), source=head["source"], series=head["series"], t=head["t"], x=head["x"], v=head["v"], bits=bits, open=waits)
    # A run that is long enough here is so whatever follows.
    return flagged & (open_ > 0), np.where(ripe, off, 0.0), waits


def _scan(batches: Iterator[pd.DataFrame], k: int, whole: bool, rules: SpikeRules) -> Iterator[pd.DataFrame]:
    """Judges a sorted partition; see OUT_SCHEMA. id, x of a CANDIDATE: its row and stand-off; x, t of a COUNT: number and bucket."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    reading, first, series = _readings(rows, k)
    keys, ids = rows[[f"k{i}" for i in range(k)]].to_numpy(), rows["id"].to_numpy()
    head = {c: rows[c].to_numpy()[first] for c in ("source", "t", "v", "x")} | {"series": keys[first]}
    bits = np.zeros(len(first), dtype=np.int64)
    np.bitwise_or.at(bits, reading, rows["bits"].to_numpy().astype(np.int64))
    flagged, off, waits = yield from _verdicts(series, head, bits, np.full(len(first), SPIKE | STUCK, dtype=np.int8), whole, rules)
    yield _emit(FLAGGED, flagged[reading], id=ids)
    yield _emit(CANDIDATE, ((off > 0) & ~flagged)[reading], id=ids, source=head["source"][reading], x=off[reading])
    yield _emit(EDGE_ID, ((waits > 0) & ~flagged)[reading], series=keys, t=rows["t"].to_numpy(), id=ids)


def _scan_edges(batches: Iterator[pd.DataFrame], whole: bool, rules: SpikeRules) -> Iterator[pd.DataFrame]:
    """Judges what waits at the edges of partitions, in order; FLAGGED and CANDIDATE name readings by series and time."""
    parts = [b for b in batches if len(b)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    keys = np.stack(rows["series"].to_numpy())
    series = np.cumsum(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    head = {c: rows[c].to_numpy() for c in ("source", "t", "v", "x")} | {"series": keys}
    flagged, off, _ = yield from _verdicts(series, head, rows["bits"].to_numpy().astype(np.int64), rows["open"].to_numpy(), whole, rules)
    yield _emit(FLAGGED, flagged, series=keys, t=head["t"])
    yield _emit(CANDIDATE, (off > 0) & ~flagged, series=keys, t=head["t"], source=head["source"], x=off)


def _counted(source: np.ndarray, residual: np.ndarray, use: np.ndarray, rules: SpikeRules) -> pd.DataFrame:
    """COUNT rows: residuals' sizes counted (x) by bucket (t); a size of 0 has the lowest bucket."""
    size = np.abs(residual)
    use = use & ~np.isnan(size)
    bucket = np.full(len(size), np.iinfo(np.int32).min, dtype=np.int64)
    positive = use & (size > 0)
    bucket[positive] = bucket_of(size[positive], rules.width)
    counts = pd.DataFrame({"source": source[use], "t": bucket[use]}).value_counts().reset_index(name="x")
    return _emit(COUNT, np.ones(len(counts), dtype=bool), source=counts["source"].to_numpy(), t=counts["t"].to_numpy(), x=counts["x"].to_numpy())


# The shapes and scales (in units of the mean excess) at which the tail's likelihood is taken.
SHAPES = np.round(np.linspace(-0.6, 0.6, 61), 10)
SCALES = np.round(np.geomspace(0.4, 2.5, 81), 10)


def fit_tail(excess: np.ndarray, counts: np.ndarray, reach: float, beyond: float) -> tuple[float, float]:
    """(shape, scale) of the generalised Pareto distribution of the largest likelihood for counted excesses
    over a threshold, of which `beyond` more are only known to lie above `reach`."""
    n = counts.sum()
    unit = (float((excess * counts).sum()) + reach * beyond) / (n + beyond)
    scale = SCALES[None, :, None] * unit
    shape = np.where(np.abs(SHAPES) < 1e-9, 1e-9, SHAPES)[:, None, None]
    with np.errstate(all="ignore"):
        inside = np.log1p(shape * excess[None, None, :] / scale)
        likelihood = -(n * np.log(scale[..., 0]) + ((1 + 1 / shape) * inside * counts).sum(axis=2)) - beyond * (np.log1p(shape * reach / scale) / shape)[..., 0]
    likelihood = np.where(np.isnan(likelihood), -np.inf, likelihood)
    i, j = np.unravel_index(np.argmax(likelihood), likelihood.shape)
    return float(shape[i, 0, 0]), float(scale[0, j, 0])


def tail_cutoff(buckets: np.ndarray, counts: np.ndarray, rules: SpikeRules) -> tuple[float, float]:
    """(scatter, cutoff) from counted residual sizes.

    cutoff is the size that the tail over the `threshold` quantile, fitted to its peaks, exceeds with
    probability `risk`. Sizes beyond it are faults; without them the tail is fitted again, `rounds` times
    in all, so that faults don't make the tail that is to tell them. scatter is the root of the mean
    square of the sizes up to the last cutoff. A source without peaks has all its sizes for ordinary.
    """
    order = np.argsort(buckets)
    gamma = 1 + rules.width
    size = np.where(buckets[order] > -(2**31), 2 * gamma ** buckets[order].astype(float) / (gamma + 1), 0.0)
    counts = counts[order].astype(float)
    cutoff = math.inf
    for _ in range(rules.rounds):
        ordinary = size <= cutoff
        size, counts = size[ordinary], counts[ordinary]
        cutoff = _cutoff(size, counts, rules)
    ordinary = size <= cutoff
    return math.sqrt(float((size[ordinary] ** 2 * counts[ordinary]).sum() / counts[ordinary].sum())), cutoff


def _cutoff(size: np.ndarray, counts: np.ndarray, rules: SpikeRules) -> float:
    upto = np.cumsum(counts)
    total = upto[-1]
    at = lambda q: size[min(int(np.searchsorted(upto, q * (total - 1), side="right")), len(size) - 1)]
    low, high = at(rules.threshold), at(rules.censor)
    if high == low and size[-1] > low:
        high = size[size > low][0]
    peaks = (size > low) & (size <= high)
    if not peaks.any():
        return math.inf
    # Sizes come in buckets or in steps of what was recorded: the threshold lies halfway to the next one.
    low = (low + size[peaks][0]) / 2
    beyond = float(counts[size > high].sum())
    shape, scale = fit_tail(size[peaks] - low, counts[peaks], high - low, beyond)
    share = (counts[peaks].sum() + beyond) / total
    return low + scale * ((share / rules.risk) ** shape - 1) / shape


def flag_implausible(
    df: DataFrame, series: Sequence[str], source: str, time: str, value: str, row_id: str, low: str, high: str, measured: str, laboratory: str, rules: SpikeRules | None = None
) -> DataFrame:
    """The row_ids (distinct) of implausible readings.

    Rows of one series and time are one reading, with the value of the lowest id; all its ids are
    listed. A reading is implausible if its value is below `low` or above `high`; or if it is
    `measured` and one of `stuck` or more consecutive readings with the same value; or if it is
    measured, not `laboratory` (not 0), and stands off from the readings on both sides, alone or with
    one neighbour, by `scatters` times the scatter that its source's ordinary readings show, those
    whose residuals don't exceed the source's extreme-value cutoff.

    series, source, time and row_id are whole numbers. Rows with a null among series, time or id, and
    values that are null or NaN, are no readings; a null source is one of its own, a null bound sets
    no bound, a null flag is false. Series of one or two readings and first and last readings have no
    spikes. Other columns are ignored, whatever their names. An empty table gives no row.
    """
    rules = rules or SpikeRules()
    if rules.rows < 2 * rules.edge:
        raise ValueError(f"a partition must hold {2 * rules.edge} rows, or its edges never shrink")
    k = len(series)
    c = lambda name: F.col(f"`{name}`")
    beyond = F.coalesce(c(value) < c(low), F.lit(False)) | F.coalesce(c(value) > c(high), F.lit(False))
    bit = lambda cond, b: F.when(F.coalesce(cond, F.lit(False)), b).otherwise(0)
    rows = df.select(
        *[c(s).cast("long").alias(f"k{i}") for i, s in enumerate(series)],
        F.coalesce(c(source).cast("long"), F.lit(-(2**63) + 1)).alias("source"), c(time).cast("long").alias("t"), c(value).cast("double").alias("v"), c(row_id).cast("long").alias("id"),
        (bit(beyond, OUT_OF_BOUNDS) + bit(c(measured), MEASURED) + bit(c(laboratory) != 0, LAB)).cast("byte").alias("bits"),
    ).filter(" and ".join([*[f"k{i} is not null" for i in range(k)], "t is not null and id is not null and v is not null and not isnan(v)"]))

    # Read again for the season, the ranges and the verdict, so what comes before is worked out once.
    rows = written = stored(rows)
    parts = max(1, -(-rows.count() // rules.rows))
    phase = F.floor(F.pmod(F.col("t"), F.lit(rules.period)) / F.lit(rules.period // rules.phases)).cast("int")
    # Read again for the season, the ranges and the verdict, so what comes before is worked out once.
    rows = written = stored(rows)
    parts = max(1, -(-rows.count() // rules.rows))
    phase = F.floor(F.pmod(F.col("t"), F.lit(rules.period)) / F.lit(rules.period // rules.phases)).cast("int")
    # The season: each source's mean by phase of the day, within bounds; a row for each source and phase.
    means = rows.filter(F.col("bits").bitwiseAND(OUT_OF_BOUNDS) == 0).groupBy("source", phase.alias("phase")).agg(F.avg("v").alias("m"), F.count("*").alias("n"))
    overall = F.sum(F.col("m") * F.col("n")).over(Window.partitionBy("source")) / F.sum("n").over(Window.partitionBy("source"))
    season = stored(means.select(F.col("source").alias("__s"), F.col("phase").alias("__p"), (F.col("m") - overall).alias("season")))
    rows = rows.join(season, (F.col("source") == F.col("__s")) & (phase == F.col("__p")), "left")
    names = [f"k{i}" for i in range(k)]
    rows = rows.select(*names, "source", "t", "v", (F.col("v") - F.coalesce("season", F.lit(0.0))).alias("x"), "id", "bits")

    order = [*names, "t"]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "id")
    level = scanned = stored(ranged.mapInPandas(lambda it: _scan(it, k, parts == 1, rules), OUT_SCHEMA))
    for done in (written, season):
        discard(done)
    of = lambda df, kind: df.filter(F.col("kind") == kind)
    sure, candidates, counts = of(scanned, FLAGGED).select("id"), of(scanned, CANDIDATE).select("source", "id", "x"), of(scanned, COUNT)
    ids = of(scanned, EDGE_ID).select("series", "t", "id")
    n = parts
    while n > 1:
        # A level hands on rules.edge readings a partition at most; the last one is a single partition.
        n = -(-n * rules.edge // rules.rows)
        waiting = of(level, EDGE).repartitionByRange(n, "series", "t").sortWithinPartitions("series", "t")
        level = stored(waiting.mapInPandas(lambda it, n=n: _scan_edges(it, n == 1, rules), OUT_SCHEMA))
        sure = sure.unionByName(of(level, FLAGGED).select("series", "t").join(ids, ["series", "t"]).select("id"))
        candidates = candidates.unionByName(of(level, CANDIDATE).select("series", "t", "source", "x").join(ids, ["series", "t"]).select("source", "id", "x"))
        counts = counts.unionByName(of(level, COUNT))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        scatter, _ = tail_cutoff(pdf["t"].to_numpy(), pdf["n"].to_numpy(), rules)
        return pd.DataFrame({"source": pdf["source"].iloc[:1], "least": [rules.scatters * scatter if scatter > 0 else math.inf]})

    # A source has as many counts as buckets, some thousands at most.
    counts = counts.groupBy("source", "t").agg(F.sum("x").alias("n"))
    least = counts.groupBy("source").applyInPandas(fit, "source long, least double")
    spikes = candidates.join(least, "source").filter("x >= least").select("id")
    return sure.unionByName(spikes).distinct().select(F.col("id").alias(row_id))
