"""Filling fixed-capacity sequences with texts of varying length.

Tokens are counted by the cluster; what the plan needs is only how many texts there are of each length,
at most `capacity` numbers. On those counts the Martello-Toth reduction fixes sets of one, two or three
lengths that dominate every other set holding the longest one, many bins at a time, and best fit
packs the rest. Texts get their bins by their rank among those of their length; a full piece needs no
rank, it is a bin by itself.
"""

from __future__ import annotations

import base64
import os
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.session import stored

# Fixed value: how the byte-level vocabularies that are given as ranks part a text before their merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of one length that are ranked in one task.
RANKED = 100_000


@dataclass(frozen=True)
class Slot:
    """The items of a size with ranks first to last - 1 (from 0) go to the bins from `bin` on, `each` per bin."""

    size: int
    first: int
    last: int
    bin: int
    each: int


def _reachable(counts: Mapping[int, int], limit: int) -> int:
    """Bit s is set if items of the counts have the sum s, s up to limit."""
    sums, mask = 1, (1 << (limit + 1)) - 1
    for size, n in counts.items():
        if size > limit:
            continue
        left, step = min(n, limit // size), 1
        while left:
            take = min(step, left)
            sums |= (sums << (size * take)) & mask
            left -= take
            step *= 2
    return sums


def reduce_by_dominance(counts: Mapping[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """(fixed sets with the number of bins each fills, counts that are left).

    From the longest size j down, with room r = capacity - j: if no other item fits, {j} is fixed. Else
    k is the largest item that fits; if k fills the bin, or no sum of other items lies above k within r,
    every set with j is at best as full as {j, k} and what it holds can take k's place: {j, k} is fixed,
    in as many bins as there are of j and k. Else, if no three others fit, l is the largest that fits
    beside j and k; if no two items above l fit beside j, whatever is with j can take the places of k
    and l one by one, and {j, k, l} is fixed. Sizes for which none of these holds are left.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    fixed: list[tuple[tuple[int, ...], int]] = []
    for j in sorted(left, reverse=True):
        while left.get(j, 0) > 0:
            room = capacity - j
            others = {s: m - (s == j) for s, m in left.items() if s <= room and m - (s == j) > 0}
            if not others:
                chosen: tuple[int, ...] = (j,)
            else:
                k = max(others)
                if k == room or not _reachable(others, room) >> (k + 1):
                    chosen = (j, k)
                else:
                    third = _third(others, k, room)
                    if third is None:
                        break
                    chosen = (j, k, third)
            bins = min(left[s] // chosen.count(s) for s in chosen)
            fixed.append((chosen, bins))
            for s in chosen:
                left[s] -= bins
            left = {s: m for s, m in left.items() if m > 0}
    return fixed, left


def _least(counts: Mapping[int, int], many: int) -> list[int]:
    """The `many` smallest items, fewer if there aren't so many."""
    out: list[int] = []
    for s in sorted(counts):
        out += [s] * min(counts[s], many - len(out))
        if len(out) == many:
            break
    return out


def _third(others: Mapping[int, int], k: int, room: int) -> int | None:
    """The item that makes a dominating set of three with j and k; None if there is none."""
    three = _least(others, 3)
    if len(three) == 3 and sum(three) <= room:
        return None
    beside = [s for s, m in others.items() if s <= room - k and m - (s == k) > 0]
    if not beside:
        return None
    third = max(beside)
    two = _least({s: m for s, m in others.items() if s > third}, 2)
    return None if len(two) == 2 and sum(two) <= room else third


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[Slot]:
    """A packing of all items of the counts (sizes 1 to capacity), as slots. Sets fixed by dominance
    come first; the rest is packed by best fit, longest first, bins of equal room handled at once."""
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("sizes must lie between 1 and the capacity")
    slots: list[Slot] = []
    used: dict[int, int] = defaultdict(int)
    bins = 0

    def put(size: int, first_bin: int, n_bins: int, each: int) -> None:
        slots.append(Slot(size, used[size], used[size] + n_bins * each, first_bin, each))
        used[size] += n_bins * each

    fixed, left = reduce_by_dominance(counts, capacity)
    for sizes, n in fixed:
        for s in sorted(set(sizes), reverse=True):
            put(s, bins, n, sizes.count(s))
        bins += n
    rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> runs of bins (first, number)
    for size in sorted(left, reverse=True):
        n = left[size]
        for room in sorted(r for r in rooms if r >= size):
            each = room // size
            while n and rooms[room]:
                first, number = rooms[room].pop()
                whole = min(number, n // each)
                if whole:
                    put(size, first, whole, each)
                    rooms[room - each * size].append((first, whole))
                    n -= whole * each
                if number > whole and n and n < each:
                    put(size, first + whole, 1, n)
                    rooms[room - n * size].append((first + whole, 1))
                    n, whole = 0, whole + 1
                if number > whole:
                    rooms[room].append((first + whole, number - whole))
            if not n:
                break
        if n:
            each = capacity // size
            whole, rest = divmod(n, each)
            for number, per in ((whole, each), (1 if rest else 0, rest)):
                if number:
                    put(size, bins, number, per)
                    rooms[capacity - per * size].append((bins, number))
                    bins += number
        rooms = defaultdict(list, {r: b for r, b in rooms.items() if b and r > 0})
    return slots


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _count(batches: Iterator[pd.DataFrame], name: str, pattern: str) -> Iterator[pd.DataFrame]:
    encode = _encoding(SparkFiles.get(name), pattern).encode_ordinary
    for pdf in batches:
        yield pd.DataFrame({"d": pdf["d"], "n": [len(encode(t)) if t else 0 for t in pdf["t"]]})


def count_tokens(df: DataFrame, key: str, text: str, tokenizer: str, pattern: str = PATTERN) -> DataFrame:
    """(key, n_tokens): tokens of each whole text; null and empty texts have none. `tokenizer` is a file of
    ranks (.tiktoken) that the driver can read; it is sent to the executors with the job."""
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = os.path.basename(tokenizer)
    c = lambda name: F.col(f"`{name}`")
    rows = df.select(c(key).cast("long").alias("d"), c(text).alias("t"))
    return rows.mapInPandas(lambda it: _count(it, name, pattern), "d long, n long").select(F.col("d").alias(key), F.col("n").alias("n_tokens"))


def pack(sizes: DataFrame, key: str, size: str, capacity: int = 2048) -> DataFrame:
    """(key, piece, first, size, bin): every item in a bin, no bin above capacity.

    An item above the capacity, and only such, is divided: into whole bins and one rest. piece counts an
    item's pieces from 0, first is the piece's first unit. Items whose size is null or below 1 need no
    bin and give no row; a null key is a key like any other; items with the same key are different
    items. An empty table gives no row. What reaches the driver are counts by size, at most `capacity`.
    Full pieces are bins by themselves, however many they are, with numbers above the others', which
    don't follow each other; pieces of any other size are ranked in parts of about RANKED.
    """
    c = lambda name: F.col(f"`{name}`")
    spark = sizes.sparkSession
    items = sizes.select(c(key).alias("k"), c(size).cast("long").alias("n")).filter("n >= 1")
    pieces = items.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(capacity)).cast("long"))))
    pieces = pieces.withColumn("first", F.col("piece") * F.lit(capacity)).withColumn("size", F.least(F.col("n") - F.col("first"), F.lit(capacity))).drop("n")
    # Numbers and ranks must not change between the count and the assignment, so the pieces are written down once.
    pieces = stored(pieces.withColumn("at", F.monotonically_increasing_id()))
    full, rest = pieces.filter(F.col("size") == capacity), pieces.filter(F.col("size") < capacity)
    counts = {r["size"]: r["n"] for r in rest.groupBy("size").agg(F.count("*").alias("n")).collect()}
    slots = plan_bins(counts, capacity)
    by_size: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    for s in slots:
        by_size[s.size].append((s.first, s.last, s.bin, s.each))
    # A row for each size, with its slots and the parts it is ranked in.
    plan = spark.createDataFrame([(s, -(-n // RANKED), by_size[s]) for s, n in counts.items()], "size long, parts long, slots array<struct<lo:long,hi:long,bin:long,each:long>>")
    salted = rest.join(plan.select("size", "parts"), "size").withColumn("salt", F.pmod(F.xxhash64("at"), F.col("parts")).cast("int")).drop("parts")
    per = salted.groupBy("size", "salt").agg(F.count("*").alias("m"))
    before = per.select("size", "salt", (F.sum("m").over(Window.partitionBy("size").orderBy("salt")) - F.col("m")).alias("before"))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("size", "salt").orderBy("at")) - 1)
    placed = ranked.join(before, ["size", "salt"]).withColumn("r", F.col("r") + F.col("before")).join(plan.select("size", "slots"), "size")
    slot = F.expr("filter(slots, s -> r >= s.lo and r < s.hi)")[0]
    found = placed.select("k", "piece", "first", "size", (slot["bin"] + F.floor((F.col("r") - slot["lo"]) / slot["each"])).cast("long").alias("bin"))
    bins = max((s.bin + -(-(s.last - s.first) // s.each) for s in slots), default=0)
    found = found.unionByName(full.select("k", "piece", "first", "size", (F.col("at") + F.lit(bins)).cast("long").alias("bin")))
    return found.select(F.col("k").alias(key), "piece", "first", "size", "bin")
