"""Keyword-stuffed and link-list pages, by the shapes of their lines.

Lines are cut into segments at separators and ends of sentences, and each segment is reduced to a
shape: its number of words, capitals, the separator that ends it, links, numerals, and whether it
explains a term. A page's segments are grouped by shape. Shapes that aren't those of sentences and whose
words come round again and again, or that are links, are stuffed; a page dominated by few stuffed shapes
is spam by its shapes alone. Those pages then tell how much likelier each word of the corpus is in a
stuffed shape than elsewhere, and by that odds every shape of every page is judged, twice, so that
stuffing that takes the form of sentences, or has numerals among it, is found by the company it keeps.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm.textnorm import INVISIBLE, LOOKALIKES
from wardgrid.session import cut


@dataclass(frozen=True)
class SpamRules:
    """page: share of a page's words in stuffed shapes above which it is flagged; few: shapes that a page
    flagged by its shapes alone may be spread over; again: share of words that come again within `span`
    words, from which a shape that isn't a sentence's is stuffed; run: words from which a segment
    without a break is no sentence; odds: mean log odds of a shape's words from which it is stuffed;
    most: bound of one word's log odds; rounds: times the odds are taken; buckets: of words' hashes."""

    page: float = 0.5
    few: int = 4
    again: float = 0.3
    span: int = 24
    run: int = 40
    odds: float = 0.5
    most: float = 3.0
    rounds: int = 2
    buckets: int = 1 << 21


# Marks of addresses and tags in a word.
ADDRESS = re.compile(r"://|www\.|\]\(|\[url|href=|\.(?:com|org|net|info|biz|shop|invalid|test|example|nl|de|be|eu)(?:[/\]\"'>)]|$)", re.I)
MARKED = re.compile(r"^[|*•·»>-]*(?:#[^\W\d_]|tags?:\S)", re.I)
#: Signs of which every address or tag has one.
LINK_SIGNS = frozenset("/.#:[]=")
# Where a line is cut: at signs between blanks, at semicolons, and after the ends of sentences.
CUT = re.compile(r"(\s(?:(?<=[.!?]\s)\s*|[|»•·*>–-]+\s)|;\s+)")
BREAK = re.compile(r"<br\s*/?>|[\r\v\f\x85\u2028\u2029]")
COMMA = re.compile(r",\s+")
STRIP = ".,;:!?()[]{}*#|»•·<>\"'`~_-–/\\"
ODD = re.compile("[Ͱ-ӿ​-‏­⁠﻿]")
RUN = re.compile(r"[^\W_]+")
STOP, LINE, SIGN, SEMICOLON, COMMAS = range(5)
#: A shape's state: stuffed by itself, or made of links.
STUFFED, LINKS = 1, 2


def clean(text: str) -> str:
    """The text without invisible and look-alike characters."""
    return text if text.isascii() or not ODD.search(text) else INVISIBLE.sub("", text).translate(LOOKALIKES)


def is_link(word: str) -> bool:
    """Whether the word is an address or a tag, or holds one."""
    return not LINK_SIGNS.isdisjoint(word) and bool(ADDRESS.search(word) or MARKED.search(word))


def segments(text: str) -> Iterator[tuple[list[str], int]]:
    """(words as blanks part them, separator that ends them) of each segment of a text; commas cut where
    the pieces between them are short."""
    for line in BREAK.sub("\n", text).split("\n"):
        parts = CUT.split(line)
        last = len(parts) - 1
        for at in range(0, last + 1, 2):
            piece = parts[at]
            ws = piece.split()
            if not ws:
                continue
            if ws[-1][-1] in ".!?":
                sep = STOP
            elif at == last:
                sep = LINE
            else:
                sep = SEMICOLON if parts[at + 1][0] == ";" else SIGN
            if piece.count(",") >= 3:
                short = COMMA.split(piece)
                if len(short) > 3 and len(ws) <= 6 * len(short):
                    for s in short:
                        yield s.split(), COMMAS
                    continue
            yield ws, sep


class Shape(NamedTuple):
    """words: the number of words, 1 to 3 and 4 to 8 as one each; capitals, links, numerals: none, some or
    most (of numerals a fifth); term: a word with a colon that the rest explains; odd: a run of words
    that comes back to the same words, as no sentence does."""

    words: int
    capitals: int
    separator: int
    links: int
    numerals: int
    term: bool
    odd: bool

    def sentence(self, run: int) -> bool:
        return self.links < 2 and not self.odd and 3 < self.words <= run and (self.separator == STOP or self.term)


#: Bits of each count in a word's code.
BITS = 40
WORD, SIZE, CAPITAL, NUMERAL, LINKED, TERM = (1 << BITS * i for i in range(6))
LOW = WORD * ((1 << BITS) - 1)


class Lexicon(dict):
    """What each word, as blanks part them, adds to a segment: (its counts, added up in one number; buckets
    of its plain words). An address counts as many words as it has runs of letters and digits;
    numerals aren't among the plain words. At most `most` words are remembered."""

    def __init__(self, buckets: int, most: int = 500_000):
        super().__init__()
        self.mask, self.most = buckets - 1, most

    def __missing__(self, w: str) -> tuple[int, tuple[int, ...]]:
        if len(self) >= self.most:
            self.clear()
        self[w] = made = self._made(w)
        return made

    def _bucket(self, w: str) -> int:
        return zlib.crc32(w.encode("utf-8", "replace")) & self.mask

    def _made(self, w: str) -> tuple[int, tuple[int, ...]]:
        if w.isalpha():
            return WORD + SIZE + (CAPITAL if w[0].isupper() else 0), (self._bucket(w.lower()),)
        if not any(map(str.isalnum, w)):
            return 0, ()
        if is_link(w):
            parts = RUN.findall(w.lower())
            return WORD + (SIZE + LINKED) * len(parts), tuple(self._bucket(p) for p in parts if p.isalpha())
        code = WORD + SIZE + (CAPITAL if w[0].isupper() else 0) + (TERM if w[-1] == ":" else 0)
        bare = w.lower().strip(STRIP)
        return (code + NUMERAL, ()) if any(map(str.isdigit, bare)) else (code, (self._bucket(bare),))


def _degree(part: int, whole: int) -> int:
    return 0 if not part else 1 if part < whole else 2


def reduced(ws: list[str], sep: int, lexicon: Lexicon) -> tuple[Shape, int, list[int]] | None:
    """(shape, size, buckets of the plain words) of a segment; None without a word."""
    infos = [lexicon[w] for w in ws]
    code = sum([i[0] for i in infos])
    if not code:
        return None
    words = [b for i in infos for b in i[1]]
    n, size = code & LOW, code >> BITS & LOW
    capitals = code >> 2 * BITS & LOW
    rest = code >> 3 * BITS
    numerals, linked, term = (rest & LOW, rest >> BITS & LOW, rest >> 2 * BITS > 0) if rest else (0, 0, False)
    odd = len(words) >= 8 and not linked and 10 * len(set(words)) <= 7 * len(words)
    return Shape(n if n > 8 else 1 if n <= 3 else 4, _degree(2 * capitals, n + 1), sep, _degree(2 * linked, size), _degree(5 * numerals, n), term, odd), size, words


def again(words: list[int], span: int) -> float:
    """The mean share of words that repeat others within windows of `span`; 0 for less than 8 words."""
    m = len(words)
    if m < 8:
        return 0.0
    span = min(span, m)
    seen = Counter(words[:span])
    live = total = len(seen)
    for i in range(span, m):
        old, new = words[i - span], words[i]
        if old != new:
            seen[old] -= 1
            live -= not seen[old]
            live += not seen[new]
            seen[new] += 1
        total += live
    return 1 - total / (m - span + 1) / span


def page_shapes(text: str, rules: SpamRules, lexicon: Lexicon | None = None) -> list[tuple[Shape, int, int, list[int]]]:
    """(shape, state, size, buckets of the plain words) of each group of a page's segments."""
    lexicon = Lexicon(rules.buckets) if lexicon is None else lexicon
    groups: dict[Shape, list] = {}
    for ws, sep in segments(clean(text)):
        made = reduced(ws, sep, lexicon)
        if made is None:
            continue
        shape, size, words = made
        group = groups.get(shape)
        if group is None:
            groups[shape] = [size, words]
        else:
            group[0] += size
            group[1] += words
    out = []
    for shape, (size, words) in groups.items():
        if shape.links == 2:
            state = LINKS
        else:
            plain = not shape.sentence(rules.run) and not shape.numerals and not shape.term
            state = STUFFED if plain and again(words, rules.span) >= rules.again else 0
        out.append((shape, state, size, words))
    return out


def dominated(groups: list[tuple[Shape, int, int, list[int]]], rules: SpamRules) -> bool:
    """Whether `few` stuffed shapes hold more than `page` of the page's words."""
    largest = sorted((size for _, state, size, _ in groups if state), reverse=True)[: rules.few]
    return sum(largest) > rules.page * sum(size for _, _, size, _ in groups)


# A page's groups, packed: n of them, int32 each: size, state, number of words; then the words' buckets.
PACKED = "d long, sure boolean, groups binary, words binary, w array<int>, n array<long>, hits array<long>"
COUNTS = pa.schema([("d", pa.int64()), ("sure", pa.bool_()), ("groups", pa.binary()), ("words", pa.binary()), ("w", pa.list_(pa.int32())), ("n", pa.list_(pa.int64())), ("hits", pa.list_(pa.int64()))])


def _batch(ids: list, sure: list, groups: list, words: list, counts: np.ndarray | None, hits: np.ndarray | None) -> pa.RecordBatch:
    """Rows of pages, and one (d is null) with the counts of words in all and in stuffed shapes."""
    if counts is not None:
        at = np.flatnonzero(counts)
        ids, sure, groups, words = [*ids, None], [*sure, None], [*groups, None], [*words, None]
        blank = [None] * (len(ids) - 1)
        lists = [[*blank, x] for x in (at.astype(np.int32), counts[at], hits[at])]
    else:
        lists = [[None] * len(ids)] * 3
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip([ids, sure, groups, words, *lists], COUNTS.types)], schema=COUNTS)


def _shapes(batches: Iterator[pa.RecordBatch], rules: SpamRules) -> Iterator[pa.RecordBatch]:
    """The pages' groups, and the counts of words: in all, and in the stuffed shapes of dominated pages."""
    lexicon = Lexicon(rules.buckets)
    counts, hits = np.zeros(rules.buckets, dtype=np.int64), np.zeros(rules.buckets, dtype=np.int64)
    for batch in batches:
        ids, sure, groups, words, seen = [], [], [], [], []
        for d, text in zip(batch.column("d").to_pylist(), batch.column("t").to_pylist()):
            found = page_shapes(text, rules, lexicon)
            if not found:
                continue
            at = np.array([b for _, _, _, ws in found for b in ws], dtype=np.int32)
            head = np.array([(size, state, len(ws)) for _, state, size, ws in found], dtype=np.int32)
            seen.append(at)
            is_sure = dominated(found, rules)
            if is_sure:
                np.add.at(hits, at[np.repeat(head[:, 1] > 0, head[:, 2])], 1)
            ids.append(d), sure.append(is_sure), groups.append(head.tobytes()), words.append(at.tobytes())
        if seen:
            np.add.at(counts, np.concatenate(seen), 1)
        yield _batch(ids, sure, groups, words, None, None)
    if counts.any():
        yield _batch([], [], [], [], counts, hits)


def _judged(batch: pa.RecordBatch, odds: np.ndarray, rules: SpamRules) -> Iterator[tuple[int, np.ndarray, np.ndarray, float]]:
    """(d, words' buckets, whether each lies in a stuffed shape, share of the page's words that do)."""
    for d, sure, groups, words in zip(*(batch.column(c).to_pylist() for c in ("d", "sure", "groups", "words"))):
        head = np.frombuffer(groups, dtype=np.int32).reshape(-1, 3)
        at = np.frombuffer(words, dtype=np.int32)
        size, state, n = head[:, 0].astype(np.int64), head[:, 1], head[:, 2]
        upto = np.r_[0, np.cumsum(odds[at])][np.r_[0, np.cumsum(n)]]
        stuffed = ((upto[1:] - upto[:-1]) > rules.odds * np.maximum(n, 1)) | (state == LINKS) | (sure & (state > 0))
        yield d, at, np.repeat(stuffed, n), float(size[stuffed].sum() / size.sum())


def _recount(batches: Iterator[pa.RecordBatch], packed: bytes, rules: SpamRules) -> Iterator[pa.RecordBatch]:
    odds = _table(packed, rules)
    hits = np.zeros(rules.buckets, dtype=np.int64)
    for batch in batches:
        for _, at, stuffed, share in _judged(batch, odds, rules):
            if share > rules.page:
                np.add.at(hits, at[stuffed], 1)
    if hits.any():
        yield _batch([], [], [], [], hits, hits).select(["w", "hits"])


def _verdict(batches: Iterator[pa.RecordBatch], packed: bytes, rules: SpamRules) -> Iterator[pa.RecordBatch]:
    odds = _table(packed, rules)
    for batch in batches:
        found = [(d, share) for d, _, _, share in _judged(batch, odds, rules) if share > rules.page]
        yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], names=["d", "share"])


#: Steps of log odds that a table holds.
STEP = 0.05


def _table(packed: bytes, rules: SpamRules) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), dtype=np.int8) * STEP


def _odds(counts: DataFrame, hits: DataFrame, rules: SpamRules) -> bytes:
    """Log odds of each bucket's words in stuffed shapes against elsewhere, one byte a bucket, packed.

    At most `buckets` small numbers reach the driver, however large the corpus and its vocabulary."""
    both = counts.join(hits, "w", "left").fillna(0, ["hits"])
    all_, stuffed = both.agg(F.sum("n"), F.sum("hits")).first()
    table = np.zeros(rules.buckets, dtype=np.int8)
    if stuffed and all_ > stuffed:
        # A word never seen has odds 0; one that is, at most those of its counts.
        ratio = stuffed / (all_ - stuffed)
        log = F.log((F.col("hits") + F.lit(ratio)) / (F.col("n") - F.col("hits") + F.lit(1.0)) / F.lit(ratio))
        steps = F.round(F.greatest(F.least(log, F.lit(rules.most)), F.lit(-rules.most)) / F.lit(STEP)).cast("byte")
        rows = both.select("w", steps.alias("s")).filter("s <> 0").toArrow()
        table[rows.column("w").to_numpy()] = rows.column("s").to_numpy()
    return zlib.compress(table.tobytes(), 1)


def find_spam(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: SpamRules | None = None) -> DataFrame:
    """(doc_id, stuffed_share) of the documents more than rules.page of whose words lie in stuffed shapes.

    Whole texts are read once and reduced to shapes and hashed words, about four bytes a word, written to
    the shared folder; the rounds read those. Nothing is shuffled but counts of at most rules.buckets
    buckets of words, summed per partition first, and the table sent to executors has a byte a bucket:
    its size is fixed whatever the corpus. Words that share a bucket share its odds; with 2^21 buckets
    rare words give way to common ones, which decide.

    Null and empty texts, and texts without words, aren't flagged; null ids are passed over; of repeated
    ids the larger share is given. Without any page dominated by stuffed shapes no word has odds, and
    links alone decide. Other columns are ignored, whatever their names; an empty table gives no row.
    """
    rules = rules or SpamRules()
    docs = documents.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t")).filter("d is not null and t is not null")
    made = cut(docs.mapInArrow(lambda it: _shapes(it, rules), PACKED))
    pages = made.filter("d is not null").select("d", "sure", "groups", "words")
    each = made.filter("d is null").select(F.explode(F.arrays_zip("w", "n", "hits")).alias("x")).select("x.w", "x.n", "x.hits")
    sums = cut(each.groupBy("w").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")))
    counts, hits = sums.select("w", "n"), sums.select("w", "hits")
    for _ in range(rules.rounds - 1):
        packed = _odds(counts, hits, rules)
        found = pages.mapInArrow(lambda it, p=packed: _recount(it, p, rules), "w array<int>, hits array<long>")
        hits = found.select(F.explode(F.arrays_zip("w", "hits")).alias("x")).select("x.w", "x.hits").groupBy("w").agg(F.sum("hits").alias("hits"))
    packed = _odds(counts, hits, rules)
    flagged = pages.mapInArrow(lambda it: _verdict(it, packed, rules), "d long, share double")
    return flagged.groupBy("d").agg(F.max("share").alias("s")).select(F.col("d").alias(doc_id), F.col("s").alias("stuffed_share"))
