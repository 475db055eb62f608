"""Benchmark decontamination by pigeonhole edit matching.

Text and items are folded: lower case, each run of characters that are no letters
or digits is one space.  An item of m characters may differ by k = floor(rate * m)
edits.  It is cut into k + 1 pieces; where a passage lies within k edits, at least
one piece stands there unchanged.  One Aho-Corasick pass finds all piece hits of
all items; around a hit Myers' bit-parallel search gives the least edit distance.

Any k + 1 pieces will do, so an item is cut where it differs from the others: each
piece gets about as many places whose six characters few items hold.  A question stem
that thousands of items share then lies in pieces that also hold some of the item's own
words.  Where an item has too few of its own, its pieces may be shared; a hit of such a
piece is first held against all its items by counts of shared character triples.

An item whose budget is no edit (at 5 %: under 20 characters) must stand as whole
words: ``art`` is found in ``the art of`` and not in ``cartwright``.  Longer items
match wherever they stand, also where a quoted passage breaks off within a word.

Items go out in blocks of ``block_bytes``, each one pass over the documents, so
neither the driver nor a task holds more of them at once.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.worker import keep_only

FOLD = re.compile(r"[\W_]+")
MATCHES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def fold(text: str) -> str:
    return FOLD.sub(" ", text.lower())


def fold_places(text: str) -> list[int]:
    """For each character of ``fold(text)``, its place in ``text``."""
    places, gap = [], False
    for i, ch in enumerate(text):
        for c in ch.lower():
            if FOLD.match(c):
                if not gap:
                    places.append(i)
                gap = True
            else:
                places.append(i)
                gap = False
    return places


def best_match(pattern: str, text: str) -> tuple[int, int]:
    """(least edit distance of ``pattern`` to any part of ``text``, first end of such a part)."""
    m, masks = len(pattern), {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        ph = down | ~(xh | up) & full
        mh = up & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & full  # the search may start anywhere: no cost flows in at the first row
        mh = mh << 1 & full
        up = mh | ~(xv | ph) & full
        down = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


EDGES = ("", " ")
GRAM, SLOTS, CROWD = 6, 1 << 22, 32


def grams(text: str, size: int = GRAM, slots: int = SLOTS) -> np.ndarray:
    """A slot number for the ``size`` characters from each place of ``text``; a shorter text has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    n = max(0, len(codes) - size + 1)
    mixed = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        mixed = (mixed ^ codes[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed & np.uint64(slots - 1)).astype(np.int64)


def short_grams(text: str) -> np.ndarray:
    return np.unique(grams(text, 3, 1 << 16)).astype(np.uint16)


def cuts_by_rarity(held_by: np.ndarray, length: int, pieces: int) -> list[int]:
    """``pieces + 1`` places that cut ``length`` characters into pieces with about as many rare grams each.

    ``held_by``: for each place with a gram, how many items hold it.  Rare is what at most 1, 4, 16, ... items hold:
    the least bound that gives every piece ``GRAM`` rare places (or an even cut's length, where that is less).
    """
    least = min(GRAM, length // pieces)
    bound = 1
    while len(held_by) and bound < held_by.max():
        rare = np.append(held_by <= bound, np.full(length - len(held_by), held_by[-1] <= bound))
        sums = np.cumsum(rare)
        if sums[-1] >= pieces * least:
            return [0, *(np.searchsorted(sums, sums[-1] * np.arange(1, pieces) // pieces) + 1).tolist(), length]
        bound *= 4
    return [length * i // pieces for i in range(pieces + 1)]


class Crowd:
    """The uses of a piece that more than ``CROWD`` items hold; ``promising`` says which of them a hit may belong to.

    An edit changes at most three of an item's three-character grams, so within k edits all but 3 k of its distinct
    ones stand in the text around the hit.  Grams are hashed to 16 bits: a collision only lets more items through.
    """

    def __init__(self, uses: list[tuple[int, int]], matcher: Matcher):
        self.uses, self.matcher = uses, matcher
        self.items, self.offsets = np.array(uses, dtype=np.int64).T
        sizes = np.array([len(matcher.items[i][0]) for i in self.items.tolist()])
        edits = np.array([matcher.items[i][2] for i in self.items.tolist()])
        self.before, self.after = int((self.offsets + edits).max()), int((sizes - self.offsets + edits).max())
        self.least = np.array([len(matcher.short[i]) for i in self.items.tolist()]) - 3 * edits

    def promising(self, text: str, place: int) -> list[tuple[int, int]]:
        here = self.matcher.mask
        around = short_grams(text[max(0, place - self.before):place + self.after])
        here[around] = True
        short, out = self.matcher.short, []
        for lo in range(0, len(self.uses), 4096):
            part = [short[i] for i in self.items[lo:lo + 4096].tolist()]
            sizes = np.array([len(g) for g in part])
            ends = np.cumsum(sizes)
            sums = np.append(0, np.cumsum(here[np.concatenate(part)]))
            enough = sums[ends] - sums[ends - sizes] >= self.least[lo:lo + 4096]
            out += [self.uses[lo + j] for j in np.flatnonzero(enough).tolist()]
        here[around] = False
        return out


class Matcher:
    """All items of a block: finds their passages in folded texts.

    With ``whole_words`` an item whose budget is no edit only matches between spaces or the text's edges.
    """

    def __init__(self, items: list[tuple[int, str]], rate: float, whole_words: bool = False):
        import ahocorasick
        self.whole_words = whole_words
        self.items: list[tuple[str, list[int], int]] = []
        by_text: dict[str, list[int]] = {}
        for item_id, text in items:
            folded = fold(text).strip()
            if folded:
                by_text.setdefault(folded, []).append(item_id)
        pieces: dict[str, list[tuple[int, int]]] = {}
        counts = np.zeros(SLOTS, dtype=np.int32)
        for text in by_text:
            counts[np.unique(grams(text))] += 1
        for text, ids in by_text.items():
            k = min(math.floor(rate * len(text)), len(text) - 1)
            cuts = cuts_by_rarity(counts[grams(text)], len(text), k + 1)
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(text[a:b], []).append((len(self.items), a))
            self.items.append((text, ids, k))
        self.mask = np.zeros(1 << 16, dtype=bool)
        crowded = {piece: uses for piece, uses in pieces.items() if len(uses) > CROWD}
        self.short = {i: short_grams(self.items[i][0]) for i in {i for uses in crowded.values() for i, _ in uses}}
        self.automaton = ahocorasick.Automaton()
        for piece, uses in pieces.items():
            self.automaton.add_word(piece, (len(piece), Crowd(uses, self) if piece in crowded else uses))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item -> (distance, start, end) of its best passage in the folded ``text``."""
        found: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, tuple[int, int]] = {}
        if not self.items:
            return found
        for last, (size, uses) in self.automaton.iter(text):
            for item, offset in uses.promising(text, last + 1 - size) if isinstance(uses, Crowd) else uses:
                if item in found and found[item][0] == 0:
                    continue
                pattern, _, k = self.items[item]
                at = last + 1 - size - offset  # where the item would start without edits
                if not k and self.whole_words and not (text[max(0, at - 1):at] in EDGES and text[last + 1:last + 2] in EDGES):
                    continue  # the one piece of this item is all of it
                if at >= 0 and text.startswith(pattern, at):
                    found[item] = (0, at, at + len(pattern))
                    continue
                searched = tried.get(item, (0, -1))
                if searched[0] <= at <= searched[1]:
                    continue  # its window lies in the one that was searched last
                low, high = max(0, at - k), at + len(pattern) + k
                # search on a little further: hits of the same passage fall in one window
                distance, end = best_match(pattern, text[low:high + k])
                tried[item] = (at, at + k)
                if distance <= k and (item not in found or distance < found[item][0]):
                    found[item] = (distance, max(0, low + end - len(pattern)), low + end)
        return found

    def item_ids(self, item: int) -> list[int]:
        return self.items[item][1]


def _matcher(items, rate: float) -> Matcher:
    """One matcher per worker and block."""
    key, block = items.value
    kept = keep_only("matcher")
    if (key, rate) not in kept:
        kept.clear()
        kept[key, rate] = Matcher(block, rate, whole_words=True)
    return kept[key, rate]


def item_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items with a text, in blocks of about ``block_bytes``."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").filter("item_id is not null and text is not null")
    n = math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / block_bytes)
    for k in range(n):
        block: Column = F.pmod(F.xxhash64("item_id"), F.lit(n)) == k
        yield [(r.item_id, r.text) for r in items.filter(block).collect()]


def find_passages(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, block_bytes: int = 16 << 20) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, start, end (characters of the text).

    Null or empty texts hold nothing; items without a letter or digit match
    nothing, those of no edit budget match whole words; repeated rows are reported each; an item that stands in a document
    more than once is reported at its best place.  Documents without a match have
    no row.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), "text").filter("text is not null")
    out = spark.createDataFrame([], "doc_id long, item_id long, distance long, start long, end long")
    for items in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, items))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared, rate)
            for b in batches:
                rows = []
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    found = matcher.find(fold(text))
                    if found:
                        places = [*fold_places(text), len(text)]
                        rows += [(doc_id, i, d, places[s], places[e - 1] + 1) for item, (d, s, e) in found.items() for i in matcher.item_ids(item)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=MATCHES)

        out = out.unionByName(texts.mapInArrow(work, out.schema))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05, block_bytes: int = 16 << 20) -> DataFrame:
    """``docs`` without the documents that hold a passage within the edit budget of an item; all columns kept.

    Nothing is shuffled: each block of items filters the rows in place.  Null and empty texts stay, as does every row
    where no item has a text; rows with a null or a repeated doc_id are judged each by its own text.
    """
    spark = docs.sparkSession
    columns, at = docs.columns, docs.columns.index("text")
    for items in item_blocks(benchmark, block_bytes):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, items))

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared, rate)
            for b in batches:
                yield b.filter(pa.array([not (t and matcher.find(fold(t))) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(work, docs.schema)
    return docs.select(*columns)
