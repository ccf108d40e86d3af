"""Token shards as tensor files, and back: one safetensors file a shard, written by the executors.

The format is public: the header's length in 8 bytes, a JSON header of names, types, shapes and places,
and the tensors' bytes. A shard's rows meet in one task, so a shard must fit there; how many timelines it
holds is the caller's choice.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgrid.functions.columns import c

WRITTEN = "shard long, file string, n_timelines long, n_tokens long, bytes long, sha256 string"


def encoded(tensors: Mapping[str, np.ndarray]) -> bytes:
    """A safetensors file of vectors of 64-bit whole numbers."""
    head, at = {}, 0
    for name, values in tensors.items():
        head[name] = {"dtype": "I64", "shape": [len(values)], "data_offsets": [at, at + 8 * len(values)]}
        at += 8 * len(values)
    text = json.dumps(head, separators=(",", ":")).encode()
    text += b" " * (-len(text) % 8)
    return len(text).to_bytes(8, "little") + text + b"".join(np.ascontiguousarray(v, dtype="<i8").tobytes() for v in tensors.values())


def decoded(content: bytes) -> dict[str, np.ndarray]:
    """The vectors of such a file."""
    n = int.from_bytes(content[:8], "little")
    head = json.loads(content[8 : 8 + n])
    return {name: np.frombuffer(content[8 + n + x["data_offsets"][0] : 8 + n + x["data_offsets"][1]], dtype="<i8") for name, x in head.items() if name != "__metadata__"}


def _put(folder: str, name: str, content: bytes) -> None:
    """Writes beside and renames, so a task that is run again, or twice at once, leaves one whole file."""
    from pyarrow import fs

    where, root = fs.FileSystem.from_uri(folder)
    where.create_dir(root, recursive=True)
    beside = f"{root}/.{name}.{uuid.uuid4().hex}"
    with where.open_output_stream(beside) as out:
        out.write(content)
    where.move(beside, f"{root}/{name}")


def write_tensors(tokens: DataFrame, folder: str, timeline: Sequence[str], per_token: Mapping[str, str], shard: str = "shard", seq: str = "seq", per_timeline: Mapping[str, str] | None = None) -> DataFrame:
    """Writes {shard}.safetensors to a folder (a URI that every executor can write to) and tells what was written.

    per_token: tensor -> column of whole numbers, a value a token; per_timeline: tensor -> column, the
    first value of each timeline; `offsets` is each timeline's first place. Timelines are in order of their
    keys, tokens in order of `seq`, as in timeline_index. A null number is -1. An empty table writes nothing.
    """
    per_timeline = dict(per_timeline or {})
    columns = dict.fromkeys([*timeline, seq, *per_token.values(), *per_timeline.values()])
    number = lambda name: F.coalesce(c(name).cast("long"), F.lit(-1)).alias(name)

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*timeline, seq], kind="stable")
        keys = pdf[list(timeline)].to_numpy()
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        tensors = {name: pdf[column].to_numpy() for name, column in per_token.items()}
        tensors |= {name: pdf[column].to_numpy()[first] for name, column in per_timeline.items()} | {"offsets": first}
        content = encoded(tensors)
        at = int(pdf["__shard"].iloc[0])
        _put(folder, f"{at}.safetensors", content)
        return pd.DataFrame({"shard": [at], "file": [f"{folder}/{at}.safetensors"], "n_timelines": [len(first)], "n_tokens": [len(pdf)], "bytes": [len(content)], "sha256": [hashlib.sha256(content).hexdigest()]})

    rows = tokens.select(c(shard).cast("long").alias("__shard"), *[number(name) for name in columns])
    return rows.groupBy("__shard").applyInPandas(write, WRITTEN)


def read_tensors(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, tensor, place, value) of a folder's files, each read by one task."""

    def read(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                at = int(path.rsplit("/", 1)[1].split(".")[0])
                for name, values in decoded(content).items():
                    yield pd.DataFrame({"shard": at, "tensor": name, "place": np.arange(len(values)), "value": values.astype(np.int64)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.safetensors").load(folder).select("path", "content")
    return files.mapInPandas(read, "shard long, tensor string, place long, value long")


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes, sha256) of a folder's files, read by the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
