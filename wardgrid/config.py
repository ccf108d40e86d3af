"""What a pipeline is built with: frozen settings, handed to pure functions of DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


# The catalogue's items and the features they feed.
CATALOGUE = {
    41011: "hf", 41012: "mapart", 41013: "satperi", 41014: "adf", 41015: "sysart", 42021: "tempc", 42022: "cvd", 42023: "etco2", 42024: "urineuit", 42025: "glucpoc", 42026: "tvexp", 42027: "ppiek", 42028: "hmv",
    42029: "amv", 42030: "pam", 43041: "fio2", 43042: "peep", 43043: "freqset", 43044: "pace", 43045: "alhf", 43046: "tinsp", 44061: "na", 44062: "k", 44063: "cl", 44064: "gluclab", 44065: "kreat", 44066: "ureum",
    44067: "lact", 44068: "hb", 44069: "tromb", 44070: "leuko", 44071: "crp", 44072: "bili", 44073: "ca", 44074: "mg", 44075: "alb", 44076: "ph", 44077: "po2", 44078: "pco2", 44079: "hco3", 45081: "coma", 45082: "sed",
    45083: "pijn", 45084: "fix", 45085: "prone", 46091: "gew", 46092: "len", 46093: "kwets", 46094: "dial", 46095: "beadvoor", 46096: "donor",
}


@dataclass(frozen=True)
class GridConfig:
    """tags: item -> feature; filled: features filled forward; zero: of these, what is still missing is 0;
    categories: static column -> its categories; shares and seed: the split of persons; least: training
    values a scaler needs; per_shard: stays in an output file."""

    tags: Mapping[int, str] = field(default_factory=lambda: dict(CATALOGUE))
    filled: tuple[str, ...] = tuple(CATALOGUE.values())
    zero: tuple[str, ...] = tuple(CATALOGUE.values())
    categories: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"gender": ("Man", "Vrouw")})
    shares: Mapping[str, float] = field(default_factory=lambda: {"train": 0.7, "val": 0.15, "test": 0.15})
    seed: int = 0
    least: int = 10
    per_shard: int = 1000


@dataclass(frozen=True)
class TokenConfig:
    """bins: quantiles of numeric values; depth: levels kept below a DRUG code; phases: which events count."""

    bins: int = 10
    depth: int = 1
    phases: tuple[str, ...] = ("preadmission", "admission")
    shares: Mapping[str, float] = field(default_factory=lambda: {"train": 0.7, "val": 0.15, "test": 0.15})
    seed: int = 0
