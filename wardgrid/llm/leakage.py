"""Evaluation passages leaking into a corpus, by greedy string tiling.

Shared tokens come first: every stretch of `least` words of a test passage is a key, its letters without
what stands between them, and the corpus is joined with those keys by rolling Karp-Rabin hashes. A
document and an item that share one are tiled: the longest match of letters that isn't marked yet is
found by running Karp-Rabin, with ever shorter search lengths, and marked in both, until no match of
`tile` letters is left. The share of the item that tiles cover tells of leaks in any order; a check
along the words tells how many of the item's words stand there consecutively and in order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm.textnorm import doc_words, letters, plain, spaced_words


@dataclass(frozen=True)
class LeakRules:
    """words: consecutive words of the item, as blanks part them, that must be covered; places: disturbed
    places allowed in them; tile: letters of the shortest tile; block: letters of items whose keys are
    held at once (about 20 bytes a letter)."""

    words: int = 24
    places: int = 3
    tile: int = 12
    block: int = 4_000_000

    @property
    def least(self) -> int:
        """Words of the longest run that any leak has: what `places` words at most leave of it, in places + 1 runs."""
        return max(1, -(-(self.words - self.places) // (self.places + 1)))


# Rolling hashes: sums of letters times powers of BASE, modulo 2^64. BASE is odd, so powers have inverses.
BASE = 0x9E3779B97F4A7C15


class Powers:
    """BASE^0, BASE^1, ... and their inverses, made as far as they are asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def grown(self, n: int) -> "Powers":
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(BASE, -k, 1 << 64))])
        return self


POWERS = Powers()


class Rolling:
    """Hashes of any stretch of a string of letters, from its sums of letters times powers."""

    def __init__(self, data: np.ndarray) -> None:
        self.powers = POWERS.grown(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(data * self.powers.up[: len(data)], dtype=np.uint64, out=self.sums[1:])

    def all(self, n: int) -> np.ndarray:
        """The hash of every stretch of n letters."""
        many = max(len(self.sums) - n, 0)
        return (self.sums[n:] - self.sums[:many]) * self.powers.down[:many]

    def at(self, first: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """The hashes of n letters from each place on."""
        return (self.sums[first + n] - self.sums[first]) * self.powers.down[first]


# Letters of a key's beginning that documents are searched for; the longest that fits is taken.
WINDOWS = (20, 16, 12, 8, 4, 2, 1)


class KeyTable:
    """The keys of a block of items: stretches of `least` words, by the hash of their first letters."""

    def __init__(self, rules: LeakRules, ids: Sequence[int], words: Sequence[Sequence[str]]) -> None:
        self.rules, self.ids, self.words = rules, list(ids), [list(w) for w in words]
        self.starts = [np.cumsum([0, *map(len, ws)]) for ws in self.words]
        self.letters = [np.frombuffer("".join(ws).encode(), dtype=np.uint8) for ws in self.words]
        rows = []
        for k, (own, data) in enumerate(zip(self.starts, self.letters)):
            n = len(own) - rules.least
            if n > 0:
                size = own[rules.least :] - own[:n]
                window = np.array(WINDOWS)[np.argmax(np.array(WINDOWS)[None, :] <= size[:, None], axis=1)]
                h = Rolling(data)
                rows.append(np.stack([np.full(n, k), np.arange(n), size, window, h.at(own[:n], window).view(np.int64), h.at(own[:n], size).view(np.int64)]))
        table = np.concatenate(rows, axis=1) if rows else np.zeros((6, 0), dtype=np.int64)
        self.parts = {}
        for w in WINDOWS:
            mine = table[:, table[3] == w]
            if mine.shape[1]:
                begin = mine[4].view(np.uint64)
                order = np.argsort(begin, kind="stable")
                bits = np.zeros(1 << 22, dtype=bool)
                bits[(begin >> np.uint64(42)).astype(np.int64)] = True
                self.parts[w] = (bits, begin[order], mine[5][order].view(np.uint64), mine[0][order], mine[1][order], mine[2][order])

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, its word, place of the letters) of every key that the letters contain."""
        found = [np.zeros((3, 0), dtype=np.int64)]
        rolling = Rolling(data)
        for w, (bits, begin, whole, item, word, size) in self.parts.items():
            h = rolling.all(w)
            at = np.flatnonzero(bits[(h >> np.uint64(42)).astype(np.int64)])
            h = h[at]
            low, high = np.searchsorted(begin, h, "left"), np.searchsorted(begin, h, "right")
            many = high - low
            if not many.any():
                continue
            where = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            there = np.repeat(at, many)
            fits = there + size[where] <= len(data)
            where, there = where[fits], there[fits]
            same = rolling.at(there, size[where]) == whole[where]
            found.append(np.stack([item[where[same]], word[where[same]], there[same]]))
        return tuple(np.concatenate(found, axis=1))


#: Places in b at which a stretch of a is looked for at a time.
AT_ONCE = 64


def _matches(a: Rolling, b: Rolling, free_a: np.ndarray, free_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of equal stretches of n letters, none of them marked, AT_ONCE at most for each in a."""
    upto_a, upto_b = np.r_[0, np.cumsum(~free_a)], np.r_[0, np.cumsum(~free_b)]
    at_a, at_b = np.flatnonzero(upto_a[n:] == upto_a[:-n]), np.flatnonzero(upto_b[n:] == upto_b[:-n])
    hb = b.all(n)[at_b]
    order = np.argsort(hb, kind="stable")
    hb, at_b = hb[order], at_b[order]
    ha = a.all(n)[at_a]
    low = np.searchsorted(hb, ha, "left")
    many = np.minimum(np.searchsorted(hb, ha, "right") - low, AT_ONCE)
    where = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    return np.repeat(at_a, many), at_b[where]


def tiles(a: np.ndarray, b: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two strings of letters: (place in a, place in b, length) of the tiles.

    The longest match that no tile has marked in either is marked next (ties: the first in b, then in a),
    until none of `least` letters is left. Matches are found by running Karp-Rabin: hashes of all
    unmarked stretches of a search length, which falls by halves when no match of that length is left.
    Of strings that repeat a stretch more than AT_ONCE times the matches come in turns, so a longest one
    may be marked in parts.
    """
    made: list[tuple[int, int, int]] = []
    if min(len(a), len(b)) < least:
        return made
    ra, rb = Rolling(a), Rolling(b)
    free_a, free_b = np.ones(len(a), dtype=bool), np.ones(len(b), dtype=bool)
    n = max(least, 1 << (min(len(a), len(b)).bit_length() - 1))
    while True:
        x, y = _matches(ra, rb, free_a, free_b, n)
        # Stretches that follow each other along one diagonal are one longer match.
        order = np.lexsort((x, y - x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1] + 1) | (y[1:] != y[:-1] + 1)]) if len(x) else x
        length = np.diff(np.r_[first, len(x)]) + n - 1
        heap = list(zip((-length).tolist(), y[first].tolist(), x[first].tolist()))
        heapq.heapify(heap)
        while heap:
            m, j, i = heapq.heappop(heap)
            both = free_a[i : i - m] & free_b[j : j - m]
            if both.all():
                made.append((i, j, -m))
                free_a[i : i - m] = free_b[j : j - m] = False
                continue
            # Tiles have cut it: what is left of it in a row waits its turn.
            edge = np.flatnonzero(np.diff(np.r_[0, both.astype(np.int8), 0]))
            for lo, hi in zip(edge[::2].tolist(), edge[1::2].tolist()):
                if hi - lo >= n:
                    heapq.heappush(heap, (lo - hi, j + lo, i + lo))
        if not len(x):
            if n == least:
                return made
            n = max(least, n // 2)


def _run(a: Sequence[str], b: Sequence[str], x: int, y: int, step: int) -> Iterator[tuple[int, int]]:
    """The places from a[x], b[y] onward in direction step up to which all words are equal, but for blanks."""
    n, m = len(a), len(b)
    yield x, y
    while 0 <= x < n and 0 <= y < m:
        if a[x] == b[y]:
            x, y = x + step, y + step
        else:
            glued = _glued(a, b, x, y, step)
            if not glued:
                return
            x, y = x + step * glued[0], y + step * glued[1]
        yield x, y


def _extend(a: Sequence[str], b: Sequence[str], i: int, j: int, step: int, places: int) -> list[int]:
    """Item words covered from a[i], b[j] onward in direction step with 0, 1, ... disturbed places, the last word matching."""
    n, m = len(a), len(b)
    best = [0] * (places + 1)
    states, start = {(i, j)}, i
    for e in range(places + 1):
        after = set()
        far = best[e]
        for x, y in states:
            x0 = x
            # As _run, without its calls.
            while 0 <= x < n and 0 <= y < m:
                if a[x] == b[y]:
                    x, y = x + step, y + step
                else:
                    p, q = a[x], b[y]
                    glued = (p[0] == q[0] if step > 0 else p[-1] == q[-1]) and _glued(a, b, x, y, step)
                    if not glued:
                        break
                    # Words parted otherwise may be other words by chance: a disturbance here stays open.
                    after.update(((x + step, y + step), (x + step, y), (x, y + step)))
                    x, y = x + step * glued[0], y + step * glued[1]
            if x != x0:
                far = max(far, (x - start) * step)
            if e < places:
                after.update(((x + step, y + step), (x + step, y), (x, y + step)))
        best[e] = far
        if e < places:
            best[e + 1] = far
            states = after
    return best


def _glued(a: Sequence[str], b: Sequence[str], x: int, y: int, step: int) -> tuple[int, int] | None:
    """(p, q), the least: p words of a from x on are q words of b from y on, but for blanks between them."""
    u, v, left, right = x, y, a[x], b[y]
    while left or right:
        n = min(len(left), len(right))
        if not (left[:n] == right[:n] if step > 0 else left[len(left) - n :] == right[len(right) - n :]):
            return None
        left, right = (left[n:], right[n:]) if step > 0 else (left[: len(left) - n], right[: len(right) - n])
        if left:
            v += step
            if not 0 <= v < len(b):
                return None
            right = b[v]
        elif right:
            u += step
            if not 0 <= u < len(a):
                return None
            left = a[u]
    return (u - x) * step + 1, (v - y) * step + 1


def coverage(item: Sequence[str], doc: Sequence[str], anchors: Sequence[tuple[int, int]], places: int = 3) -> int:
    """The most consecutive words of the item that the document contains in order, disturbed in at most
    `places` places by a word that is altered, left out or added.

    Anchors are pairs of words (of the item, of the document) at which equal letters may begin, parted
    alike or not; those at which none do are passed over. From each anchor that isn't marked the run of
    equal words is marked as a tile, and tiles on either side are joined to it over disturbed places, as
    far as these last; the words at both ends match.
    """
    best, marked = 0, set()
    for i, j in anchors:
        if (i, j) in marked:
            continue
        tile = list(_run(item, doc, i, j, 1))
        if len(tile) == 1:
            continue
        marked.update(tile)
        right, left = _extend(item, doc, i, j, 1, places), _extend(item, doc, i - 1, j - 1, -1, places)
        best = max(best, max(left[e] + right[places - e] for e in range(places + 1)))
    return best


def covered_words(starts: np.ndarray, made: Sequence[tuple[int, int, int]]) -> int:
    """Words of the item, by their first letters and the end, all of whose letters lie in tiles."""
    inside = np.zeros(int(starts[-1]) + 1, dtype=np.int64)
    for i, _, n in made:
        inside[i] += 1
        inside[i + n] -= 1
    upto = np.r_[0, np.cumsum(np.cumsum(inside)[:-1] > 0)]
    return int((upto[starts[1:]] - upto[starts[:-1]] == starts[1:] - starts[:-1]).sum())


def leaks_among(texts: Sequence[str], table: KeyTable) -> Iterator[tuple[int, int, int, int]]:
    """(text's number, item's number in the table, words covered by tiles, words in order) of the leaks."""
    flats = [plain(t) for t in texts]
    packed = [letters(f) for f in flats]
    # All letters in one string, a blank after each text, so that no key reaches from one into the next.
    data = np.frombuffer(b" ".join(packed) + b" ", dtype=np.uint8)
    begin = np.cumsum([0, *[len(p) + 1 for p in packed]])
    item, word, place = table.shared(data)
    if not len(item):
        return
    text = np.searchsorted(begin, place, "right") - 1
    order = np.lexsort((place, word, item, text))
    item, word, place, text = item[order], word[order], place[order], text[order]
    first = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (text[1:] != text[:-1])])
    doc, starts, of = [], np.zeros(0, dtype=np.int64), -1
    for lo, hi in zip(first, np.r_[first[1:], len(item)]):
        d, k = int(text[lo]), int(item[lo])
        if d != of:
            doc = doc_words(flats[d])
            starts, of = np.cumsum([0, *map(len, doc)]), d
        yield from ((d, k, *found) for found in _leak(table, k, doc, starts, data[begin[d] : begin[d + 1] - 1], word[lo:hi], place[lo:hi] - begin[d]))


def _leak(table: KeyTable, k: int, doc: Sequence[str], starts: np.ndarray, data: np.ndarray, word: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int]]:
    """(words covered by tiles, words in order) if the item leaks; word and place are the shared keys, in order."""
    rules, own, size = table.rules, table.starts[k], len(table.letters[k])
    # Where a word begins in both, along the keys.
    i = (word[:, None] + np.arange(rules.least)).ravel()
    goal = own[i] + np.repeat(place - own[word], rules.least)
    j = np.searchsorted(starts, goal)
    ok = starts[np.minimum(j, len(doc))] == goal
    ordered = coverage(table.words[k], doc, list(zip(i[ok].tolist(), j[ok].tolist())), rules.places)
    # Tiles that could bring the words together hold keys for as many; else only order can make a leak.
    if ordered < rules.words and len(np.unique(i)) < rules.words:
        return
    # A leak's tiles lie around its keys; what is further from all of them than twice the item is left out.
    near = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(near, np.maximum(place - 2 * size, 0), 1)
    np.add.at(near, np.minimum(place + 2 * size, len(data)), -1)
    near = np.cumsum(near)[:-1] > 0
    made = tiles(table.letters[k], np.where(near, data, 0)[near | np.r_[False, near[:-1]]], rules.tile)
    covered = covered_words(own, made)
    if max(covered, ordered) >= rules.words:
        yield covered, ordered


#: Letters of documents that are searched at once.
CHUNK = 500_000


def _scan(batches: Iterator[pd.DataFrame], table: KeyTable) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows, ids, texts, size = [], [], [], 0
        last = len(pdf) - 1
        for at, (d, t) in enumerate(zip(pdf["d"], pdf["t"])):
            ids.append(d), texts.append(t)
            size += len(t)
            if size >= CHUNK or at == last:
                rows += [(ids[n], table.ids[k], c, o) for n, k, c, o in leaks_among(texts, table)]
                ids, texts, size = [], [], 0
        yield pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 4), columns=["d", "i", "c", "o"])


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rules: LeakRules | None = None) -> DataFrame:
    """(doc_id, item_id, covered_words, ordered_words) of every document and item where tiles cover at least
    rules.words words of the item, in any order, or the document contains at least rules.words
    consecutive words of the item in order, disturbed in at most rules.places places.

    Whole texts are read. Any leak in order has a run of rules.least undisturbed words, however short
    they are, and so a key: none is lost. The items are a stated query set; their keys are held in
    blocks of at most rules.block letters, so what is sent to executors is bounded, and a set of more
    letters takes one reading of the corpus a block. Case, accents, punctuation, blanks, line breaks,
    hyphens at line ends, markup, invisible and look-alike characters don't matter. Null and empty
    texts contain nothing; items shorter than rules.words words leak nowhere; null ids are passed over.
    Repeated documents and items give one row for each pair of ids, with the most words of each kind.
    Other columns are ignored, whatever their names; empty tables give no row.
    """
    rules = rules or LeakRules()
    c = lambda name: F.col(f"`{name}`")
    docs = documents.select(c(doc_id).cast("long").alias("d"), c(text).alias("t")).filter("d is not null and t is not null")
    schema = "d long, i long, c long, o long"
    found = None
    for table in _blocks(items.select(c(item_id).cast("long").alias("i"), c(item_text).alias("t")).filter("i is not null and t is not null"), rules):
        part = docs.mapInPandas(lambda it, table=table: _scan(it, table), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], schema)
    best = found.groupBy("d", "i").agg(F.max("c").alias("c"), F.max("o").alias("o"))
    return best.select(F.col("d").alias(doc_id), F.col("i").alias(item_id), F.col("c").alias("covered_words"), F.col("o").alias("ordered_words"))


def _blocks(items: DataFrame, rules: LeakRules) -> Iterator[KeyTable]:
    """The items in tables of bounded size, read row by row."""
    ids, texts, size = [], [], 0
    for r in items.toLocalIterator():
        ws = spaced_words(plain(r["t"]))
        if len(ws) < rules.words:
            continue
        if ids and size + sum(map(len, ws)) > rules.block:
            yield KeyTable(rules, ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r["i"]), texts.append(ws)
        size += sum(map(len, ws))
    if ids:
        yield KeyTable(rules, ids, texts)
