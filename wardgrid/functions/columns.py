"""Column expressions used by the operators: times, texts, numbers, tokens."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
UNKNOWN_TIME = -1899


def c(name: str) -> Column:
    """The column of that very name."""
    return F.col(f"`{name}`")


# Time


def known_time(t: Column, unknown: int = UNKNOWN_TIME) -> Column:
    """The time, or null where it's the sign for an unknown one."""
    return F.when(t != unknown, t)


def bucket(ms: Column, width: int = HOUR_MS) -> Column:
    """The number of the step of `width` that holds ms; rounds down below 0 too."""
    return F.floor(ms / F.lit(width)).cast("long")


def phase_absolute(t: Column, admitted: Column, discharged: Column) -> Column:
    """preadmission, admission, postadmission, or unknown, of a time on the stays' own scale."""
    return F.when(t.isNull() | admitted.isNull(), "unknown").when(t < admitted, "preadmission").when(discharged.isNotNull() & (t > discharged), "postadmission").otherwise("admission")


def phase_relative(ms: Column, length: Column) -> Column:
    """The same of a time since admission and the stay's length."""
    return F.when(ms.isNull(), "unknown").when(ms < 0, "preadmission").when(length.isNotNull() & (ms > length), "postadmission").otherwise("admission")


def add_ms(base: Column, ms: Column) -> Column:
    """The time of day ms milliseconds after base."""
    return F.timestamp_add("MICROSECOND", ms * F.lit(1000), base)


def ms_between(start: Column, stop: Column) -> Column:
    """Whole milliseconds from one time to another, rounded down to 0."""
    return F.timestamp_diff("MILLISECOND", start, stop)


# Text


def truthy(text: Column) -> Column:
    """true, 1 and yes, whatever their case and outer blanks."""
    return F.coalesce(F.lower(F.trim(text.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def norm_key(text: Column) -> Column:
    """A key as text: 12.0 is 12, and the usual words for nothing are empty."""
    bare = F.regexp_replace(F.trim(text.cast("string")), r"^(-?\d+)\.0+$", "$1")
    return F.when(bare.isNull() | F.lower(bare).isin("none", "nan", "null", "na", "<na>"), "").otherwise(bare)


def label_key(text: Column) -> Column:
    """A label without case and repeated blanks."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")))


def search_text(text: Column) -> Column:
    """Letters and digits in lower case with single blanks."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9]+", " "))


def matched_share(text: Column, terms: Sequence[str]) -> Column:
    """The share of the terms that occur in the text."""
    return sum((text.contains(t).cast("int") for t in terms), F.lit(0)) / F.lit(float(len(terms)))


def age_years(group: Column) -> Column:
    """The middle of an age group such as 60-69, or its lower end where it is open (80+)."""
    low, high = F.regexp_extract(group, r"^(\d+)-(\d+)$", 1), F.regexp_extract(group, r"^(\d+)-(\d+)$", 2)
    open_ = F.regexp_extract(group, r"^(\d+)\+$", 1)
    return F.when(low != "", (low.cast("double") + high.cast("double")) / 2).when(open_ != "", open_.cast("double"))


def source_token(prefix: str, *parts: Column) -> Column:
    """PREFIX//part//part, a missing part as the word NONE."""
    return F.concat_ws("//", F.lit(prefix), *[F.when(p.isNull() | (F.trim(p.cast("string")) == ""), "NONE").otherwise(F.trim(p.cast("string"))) for p in parts])


def parse_code(code: Column) -> tuple[Column, Column]:
    """(item, suffix) of item-suffix where the item is a number; the suffix is empty if there is none."""
    return F.nullif(F.regexp_extract(code, r"^(\d+)(?:-(.*))?$", 1), F.lit("")).cast("long"), F.regexp_extract(code, r"^(\d+)(?:-(.*))?$", 2)


def sanitized(label: str) -> str:
    """A column's name from a label: letters, digits and underscores."""
    kept = "".join(ch if ch.isalnum() else "_" for ch in label.strip().lower())
    return "_".join(p for p in kept.split("_") if p) or "empty"


def lookup(value: Column, table: Mapping[str, object], default: object = None) -> Column:
    """A value by a small table; unknown and null ones get the default."""
    out = F.lit(default)
    for key, result in table.items():
        out = F.when(value == F.lit(key), F.lit(result)).otherwise(out)
    return out


# Numbers


def finite(x: Column) -> Column:
    """Whether it is a number, and not an infinite one."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def number(x: Column) -> Column:
    """The value, or null for NaN."""
    return F.when(~F.isnan(x), x)


def within(x: Column, low: Column, high: Column) -> Column:
    """low <= x <= high, a missing bound setting none; false for a missing x."""
    return x.isNotNull() & F.coalesce(x >= low, F.lit(True)) & F.coalesce(x <= high, F.lit(True))


def affine(x: Column, a: Column, b: Column) -> Column:
    """a * x + b, without a or b x itself or x with only the other."""
    return x * F.coalesce(a, F.lit(1.0)) + F.coalesce(b, F.lit(0.0))


def fraction_to_percent(x: Column, upto: float = 1.5) -> Column:
    """Values from 0 to `upto` as hundredths; others unchanged."""
    return F.when((x >= 0) & (x <= upto), x * 100).otherwise(x)


def ratio(a: Column, b: Column) -> Column:
    """a / b where b is above 0, else null."""
    return F.when(b > 0, a / b)


def signed_log1p(x: Column) -> Column:
    """sign(x) * log(1 + |x|)."""
    return F.signum(x) * F.log1p(F.abs(x))


def zscore(x: Column, mean: Column, std: Column, n: Column, least: int = 10) -> Column:
    """(x - mean) / std, std 0 taken as 1; unscaled with fewer than `least` values behind the fit."""
    return F.when(n >= least, (x - mean) / F.when(std > 0, std).otherwise(1.0)).otherwise(x)


def rank_share(x: Column, knots: Column) -> Column:
    """Where x lies among sorted knots, from 0 to 1, linearly between them; 0 and less give 0."""
    last = F.size(knots) - 1
    at = F.size(F.filter(knots, lambda k: k <= x))
    low, high = F.element_at(knots, F.greatest(at, F.lit(1))), F.element_at(knots, F.least(at + 1, last + 1))
    inside = (at - 1 + F.when(high > low, (x - low) / (high - low)).otherwise(0.0)) / last
    return F.when(x <= 0, 0.0).when(at == 0, 0.0).when(at > last, 1.0).otherwise(inside)


def quantile_bin(x: Column, bounds: Column) -> Column:
    """1 plus the number of bounds below x."""
    return F.when(x.isNotNull() & bounds.isNotNull(), F.lit(1) + F.size(F.filter(bounds, lambda b: x > b)))


def nearest_rank(values: Column, q: float) -> Column:
    """The value at rank round((n - 1) * q) of a sorted array, halves up."""
    return F.element_at(values, F.floor((F.size(values) - 1) * F.lit(q) + F.lit(0.5)).cast("int") + 1)


# Codes and tokens

# Labels of the time between two events, each from its minutes on.
GAP_LABELS: tuple[tuple[str, int], ...] = (
    ("5m-15m", 5), ("15m-45m", 15), ("45m-1h15m", 45), ("1h15m-2h", 75), ("2h-3h", 120), ("3h-5h", 180), ("5h-8h", 300), ("8h-12h", 480), ("12h-18h", 720), ("18h-1d", 1080),
    ("1d-2d", 1440), ("2d-4d", 2880), ("4d-7d", 5760), ("7d-12d", 10080), ("12d-20d", 17280), ("20d-30d", 28800), ("30d-2mt", 43200), ("2mt-6mt", 86400), ("=6mt", 259200),
)


def gap_tokens(minutes: Column) -> Column:
    """Tokens of a gap: its label, none below the least; the longest label repeats once for each of its lengths."""
    longest, length = GAP_LABELS[-1]
    out = F.array().cast("array<string>")
    for label, least in GAP_LABELS[:-1]:
        out = F.when(minutes >= least, F.array(F.lit(label))).otherwise(out)
    return F.when(minutes >= length, F.array_repeat(F.lit(longest), F.greatest(F.lit(1), F.bround(minutes / F.lit(float(length)))).cast("int"))).otherwise(out)


def split_quantile(code: Column) -> Column:
    """[code, Qn] of a code that ends in //Q1 to //Q10, else [code]."""
    pattern = r"^(.+)//(Q(?:[1-9]|10))$"
    return F.when(code.rlike(pattern), F.array(F.regexp_extract(code, pattern, 1), F.regexp_extract(code, pattern, 2))).otherwise(F.array(code))


def truncated_code(code: Column, prefix: str, depth: int) -> Column:
    """Codes that begin with prefix// cut to `depth` levels below it."""
    return F.when(code.startswith(f"{prefix}//"), F.array_join(F.slice(F.split(code, "//"), 1, 1 + depth), "//")).otherwise(code)


def parent_codes(code: Column) -> Column:
    """The shorter codes above a//b//c..., from two levels up: [a//b]; none for two levels or one."""
    parts = F.split(code, "//")
    n = F.size(parts)
    return F.when(n > 2, F.transform(F.sequence(F.lit(2), n - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "//"))).otherwise(F.array().cast("array<string>"))
