"""Small files read on the driver: feature seeds, reviewed manifests, and what lies in a folder."""

from __future__ import annotations

import csv
import glob
import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DELIMITERS = ",;\t|"


def sniffed(line: str) -> str:
    """The delimiter that a header line has most of; a comma if it has none."""
    return max(DELIMITERS, key=line.count) if any(d in line for d in DELIMITERS) else ","


def load_seed(path: str, required: Sequence[str], key: str) -> list[dict[str, str]]:
    """Rows of a delimited file with the required columns and a key that doesn't repeat, else ValueError."""
    with open(path, encoding="utf-8", newline="") as f:
        head = f.readline()
        f.seek(0)
        rows = list(csv.DictReader(f, delimiter=sniffed(head)))
    columns = list(rows[0]) if rows else head.strip().split(sniffed(head))
    lacking = [c for c in required if c not in columns]
    if lacking:
        raise ValueError(f"{path} lacks {', '.join(lacking)}")
    seen, twice = set(), set()
    for r in rows:
        (twice if r[key] in seen else seen).add(r[key])
    if twice:
        raise ValueError(f"{path} has {', '.join(sorted(twice))} twice")
    return rows


def parse_manifest(text: str) -> tuple[dict[str, dict], list[str]]:
    """(features, problems) of a reviewed Markdown manifest: a heading a feature, then `- field: value` lines.

    keep is a list of item ids (none for none), structural_zero a yes or no. A feature without a
    reconstruction_type, or described a second time, is a problem and left out.
    """
    features: dict[str, dict] = {}
    problems = []
    for block in re.split(r"(?m)^#{2,4}\s+", text)[1:]:
        name, *lines = block.split("\n")
        name = name.strip()
        fields = dict(m.groups() for line in lines if (m := re.match(r"\s*[-*]\s*([a-z_]+)\s*:\s*(.*?)\s*$", line)))
        if "reconstruction_type" not in fields:
            problems.append(f"{name}: no reconstruction_type")
        elif name in features:
            problems.append(f"{name}: described twice")
        else:
            features[name] = {"reconstruction_type": fields["reconstruction_type"], "target_unit": fields.get("target_unit") or None, "keep": [int(i) for i in re.findall(r"\d+", fields.get("keep", ""))], "structural_zero": fields.get("structural_zero", "").lower() in ("true", "yes", "1")}
    return features, problems


def lookup_frame(spark: SparkSession, features: dict[str, dict]) -> DataFrame:
    """(tag, itemid, reconstruction_type, target_unit): a row for each kept item of each feature."""
    rows = [(tag, item, f["reconstruction_type"], f["target_unit"]) for tag, f in features.items() for item in f["keep"]]
    return spark.createDataFrame(rows, "tag string, itemid long, reconstruction_type string, target_unit string")


def inventory(root: str, pattern: str) -> list[dict]:
    """name, path, bytes, delimiter and columns of the delimited files that match."""
    out = []
    for path in sorted(glob.glob(os.path.join(root, "**", pattern), recursive=True)):
        with open(path, encoding="utf-8", errors="replace") as f:
            head = f.readline().rstrip("\r\n")
        d = sniffed(head)
        out.append({"name": os.path.basename(path), "path": path, "bytes": os.path.getsize(path), "delimiter": d, "columns": [c.strip().strip('"') for c in head.split(d)]})
    return out
