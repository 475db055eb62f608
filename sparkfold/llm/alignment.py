"""Alignment of two tokenizations of the same bytes, by diagonal run skipping.

Both token sequences of a text are given by the byte offsets where their tokens end.
From a common end on, the end arrays are compared at the current index shift, in
stretches of doubling length: as long as they agree the tokens stand one to one and
the stretch is jumped.  At the first difference the group is irregular: the side that
ends earlier takes its next token until both end together, and the shift is updated.
Many stretches of text go through these steps side by side, as lanes of one array.

``align_documents`` links the tokens of both sides whose bytes overlap, counts each
id pair over the whole corpus, and gives every document the figures of its links.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm import scratch
from sparkfold.llm.bpe import byte_letters
from sparkfold.llm.chunk_encode import LONGEST_KEPT, slices
from sparkfold.llm.spelling import Spelling

SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
LANE = 64


# --- the alignment itself -------------------------------------------------------------------------------------------
def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All integers of the ranges [start, start + size), one range after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def align(ends_a: np.ndarray, ends_b: np.ndarray, lanes_a: np.ndarray, lanes_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of A, and of B, are the last of their group (two boolean arrays).

    ``ends_a``, ``ends_b``: ascending end offsets.  ``lanes_a[k]``, ``lanes_b[k]``: the
    first token of lane k on either side, with the total behind the last lane; a lane
    starts where both sides start a token, and holds no token on both sides or on neither.
    """
    last_a, last_b = np.zeros(len(ends_a), dtype=bool), np.zeros(len(ends_b), dtype=bool)
    stop_a, stop_b = lanes_a[1:], lanes_b[1:]
    a, b = lanes_a[:-1].copy(), lanes_b[:-1].copy()
    lanes = np.flatnonzero(a < stop_a)
    while len(lanes):
        # one-to-one stretches, compared in doubling lengths
        probing, width = lanes, 1
        while len(probing):
            i, j = a[probing], b[probing]
            size = np.minimum(width, np.minimum(stop_a[probing] - i, stop_b[probing] - j))
            at = ranges(i, size)
            unequal = ends_a[at] != ends_b[at + np.repeat(j - i, size)]
            starts = np.cumsum(size) - size
            wrong = np.flatnonzero(unequal)
            # matched tokens before the first difference of each lane
            near = np.searchsorted(wrong, starts)
            matched = size.copy()
            some = near < len(wrong)
            matched[some] = np.minimum(size[some], wrong[near[some]] - starts[some])
            run = ranges(i, matched)
            last_a[run] = True
            last_b[run + np.repeat(j - i, matched)] = True
            a[probing], b[probing] = i + matched, j + matched
            probing = probing[(matched == size) & (a[probing] < stop_a[probing]) & (b[probing] < stop_b[probing])]
            width *= 2
        lanes = lanes[a[lanes] < stop_a[lanes]]
        # irregular groups: the side that ends earlier goes on
        i, j, turn = a[lanes], b[lanes], lanes
        while len(turn):
            x, y = ends_a[i], ends_b[j]
            met = x == y
            if met.any():
                last_a[i[met]] = True
                last_b[j[met]] = True
                a[turn[met]], b[turn[met]] = i[met] + 1, j[met] + 1
                turn, i, j, x, y = turn[~met], i[~met], j[~met], x[~met], y[~met]
            i, j = i + (x < y), j + (y < x)
        lanes = lanes[a[lanes] < stop_a[lanes]]
    return last_a, last_b


def links(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (token of A, token of B) whose bytes overlap, in the order of the text.

    Within a group the overlaps step from its first pair to its last: each token end but
    the group's last moves one side on.
    """
    a, b = np.arange(len(ends_a)), np.flatnonzero(~last_b)
    # a token end inside a group lies in one token of the other side; groups meet at their ends
    group_a = np.cumsum(last_a) - last_a
    first_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
    partner = first_b[group_a]
    single = np.diff(first_b)[group_a] == 1
    rest = np.flatnonzero(~single)
    partner[rest] = np.searchsorted(ends_b, ends_a[rest])
    other = np.searchsorted(ends_a, ends_b[b])
    left, right = np.concatenate([a, other]), np.concatenate([partner, b])
    order = np.lexsort((right, left))
    return left[order], right[order]


# --- both tokenizers ------------------------------------------------------------------------------------------------
class TwoTokenizers:
    """Token ids of a text (with one space in front) by a byte-level BPE file and a sentencepiece model.

    A single space between two non-white characters starts a token on both sides, since
    no token of either side holds a space behind another character (checked on loading),
    so texts are cut there and the pieces' ids remembered (``most`` pieces).
    """

    def __init__(self, path_a: str, path_b: str, most: int = 800_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = {c: i for i, c in enumerate(byte_letters())}
        words_a = {i: bytes(letters[c] for c in t) if set(t) <= letters.keys() else t.encode() for t, i in self.a.get_vocab().items()}
        words_b = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        words_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(words_b)]
        words_a = [words_a.get(i, b"") for i in range(max(words_a) + 1)]
        if any(re.search(r"\S ", w.decode(errors="replace")) for w in [*words_a, *words_b]):
            raise ValueError("a token holds a space behind a character that is not white")
        self.bytes_a, self.bytes_b = Spelling(words_a), Spelling(words_b)
        self.numbers = Spelling([b"%d%c" % (i, c) for n, marks in ((len(words_a), b",|"), (len(words_b), b",;")) for c in marks for i in range(n)])
        self.most = most
        self.memory: dict[str, tuple[bytes, bytes] | None] = {}

    def _learn(self, pieces: set[str]) -> list[str]:
        new = list(pieces.difference(self.memory))
        if not new:
            return []
        sides = []
        for found, table in (([e.ids for e in self.a.encode_batch_fast([" " + p for p in new], add_special_tokens=False)], self.bytes_a),
                             (self.b.encode(new, num_threads=1), self.bytes_b)):
            ends = np.cumsum([len(f) for f in found], dtype=np.int64)
            ids = np.fromiter((i for f in found for i in f), dtype="<u4", count=int(ends[-1]))
            data, stops = ids.tobytes(), [0, *(4 * ends).tolist()]
            sides.append(([data[x:y] for x, y in zip(stops, stops[1:])], table.texts(ids, ends)))
        (ids_a, texts_a), (ids_b, texts_b) = sides
        for p, x, y, s, t in zip(new, ids_a, ids_b, texts_a, texts_b):
            self.memory[p] = (x, y) if s == t == b" " + p.encode() else None
        return [p for p in new if len(p) > LONGEST_KEPT]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of A, ids of B, first token of each lane in A and in B, first lane of each text); lanes start
        where both sides start a token.  A text that is empty or that either side does not spell has no tokens."""
        if len(self.memory) > self.most:
            self.memory.clear()
        cut = [SAFE_SPACE.split(t) if t else [] for t in texts]
        long = self._learn(set().union(*cut))
        get = self.memory.__getitem__
        parts_a, parts_b, lanes = [], [], [0]
        for pieces in cut:
            found = list(map(get, pieces))
            if None not in found:
                for at in range(0, len(found), LANE):
                    x, y = zip(*found[at:at + LANE])
                    parts_a.append(b"".join(x))
                    parts_b.append(b"".join(y))
            lanes.append(len(parts_a))
        for p in long:
            del self.memory[p]
        first = [np.cumsum([0, *(len(x) // 4 for x in parts)]) for parts in (parts_a, parts_b)]
        return (np.frombuffer(b"".join(parts_a), "<u4"), np.frombuffer(b"".join(parts_b), "<u4"), *first, np.array(lanes))

    def spell_groups(self, ids_a: np.ndarray, ids_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray,
                     edges_a: np.ndarray, edges_b: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text: groups apart by ``;``, sides by ``|``, decimal ids by ``,``."""
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        stops_a = np.concatenate([[0], np.flatnonzero(last_a) + 1])
        stops_b = np.concatenate([[0], np.flatnonzero(last_b) + 1])
        n_a = len(self.bytes_a.sizes)
        n_b = len(self.bytes_b.sizes)
        codes = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        codes[np.arange(len(ids_a)) + stops_b[group_a]] = ids_a + n_a * last_a
        codes[np.arange(len(ids_b)) + stops_a[group_b + 1]] = 2 * n_a + ids_b + n_b * last_b
        return self.numbers.texts(codes, edges_a[1:] + edges_b[1:], cut=1)


_PAIRS: dict[tuple[str, str], TwoTokenizers] = {}


def tokenizers(path_a: str, path_b: str) -> TwoTokenizers:
    """One pair for each Python worker, so its memory serves later tasks too."""
    if (path_a, path_b) not in _PAIRS:
        _PAIRS[path_a, path_b] = TwoTokenizers(path_a, path_b)
    return _PAIRS[path_a, path_b]


# --- links of a block of documents -----------------------------------------------------------------------------------
def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers below 2**32, compressed by byte places."""
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of each run ``values[ends[k-1]:ends[k]]``."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[ends], prepend=0)


BLOCK = pa.schema([
    ("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())), ("groups", pa.list_(pa.binary())),
    ("packed", pa.list_(pa.binary())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
BLOCK_SQL = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
             "groups array<binary>, packed array<binary>, pairs array<long>, counts array<long>")


def block_row(block: int, ids: list, texts: list[str], both: TwoTokenizers, as_text: bool) -> pa.RecordBatch:
    """One block's documents: their figures and groups, the block's distinct id pairs with the number of their links,
    and (``packed``) each document's pairs as ascending places in those, how often, and where each document's end."""
    ids_a, ids_b, first_a, first_b, lanes = both.encode(texts)
    ends_a, ends_b = np.cumsum(both.bytes_a.sizes[ids_a]), np.cumsum(both.bytes_b.sizes[ids_b])
    last_a, last_b = align(ends_a, ends_b, first_a, first_b)
    left, right = links(ends_a, ends_b, last_a, last_b)
    edges_a, edges_b = first_a[lanes], first_b[lanes]
    n_a, n_b = np.diff(edges_a), np.diff(edges_b)
    n_groups = sums(last_a, edges_a[1:])
    spelled = both.spell_groups(ids_a, ids_b, last_a, last_b, edges_a, edges_b)
    groups = spelled if as_text else [hashlib.sha256(g).hexdigest().encode() if g else b"" for g in spelled]
    kinds = len(both.bytes_b.sizes)
    pair, place = np.unique(ids_a[left].astype(np.int64) * kinds + ids_b[right], return_inverse=True)
    owner = np.repeat(np.arange(len(texts)), n_a)[left]
    keys = np.sort(owner * len(pair) + place)
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    often = np.diff(np.append(new, len(keys)))
    owner, place = np.divmod(keys[new], max(1, len(pair)))
    ends = np.searchsorted(owner, np.arange(len(texts)), side="right")
    steps = np.diff(place, prepend=0)
    steps[ends[:-1][ends[:-1] < len(place)]] = 0
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    steps[heads] = place[heads]
    counts = np.bincount(place, weights=often, minlength=len(pair)).astype(np.int64)
    packed = [pack(steps), pack(often), pack(ends)]
    row = [block, ids, n_a, n_b, n_groups, n_a + n_b - n_groups, groups, packed, pair, counts]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCK)], schema=BLOCK)


def block_results(rows: pa.Table, known: pa.Table) -> pa.Table:
    """Documents of one block with ``n_best`` and ``count_sum``, from the block's row and its pairs' corpus counts."""
    order = np.argsort(known.column("pair").to_numpy())
    count, top = (known.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "top"))
    out = []
    for r in rows.to_pylist():
        steps, often, ends = map(unpack, r["packed"])
        # places ascend within a document: the running sum, from each document's first step on
        total = np.concatenate([[0], np.cumsum(steps)])
        starts = np.concatenate([[0], ends[:-1]])
        place = total[1:] - np.repeat(total[starts], ends - starts)
        out.append(pa.table([
            pa.array(r["doc_ids"], pa.int64()), *(pa.array(r[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
            pa.array(sums(often * top[place], ends)), pa.array(sums(often * count[place], ends)), pa.array(r["groups"], pa.binary())], schema=RESULT))
    return pa.concat_tables(out) if out else RESULT.empty_table()


RESULT = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups", pa.binary())])
RESULT_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups binary"


def align_documents(docs: DataFrame, path_a: str, path_b: str, as_text: bool = True) -> DataFrame:
    """Per document: tokens of both sides, groups, links, ``n_best`` and ``count_sum`` over its links, and its groups.

    ``groups``: UTF-8 text ``a1,a2|b1;a3|b2,b3``, or with ``as_text=False`` its sha256 in
    hex; empty where there are no tokens.  An id pair's count is the number of links in
    the whole corpus that join the two ids; ``n_best`` counts a document's links whose
    count is the highest of their B id (ties included), ``count_sum`` adds the counts.

    A null or empty text, and one that either vocabulary does not give back byte for byte
    with a space in front, has no tokens: zeros.  Null and repeated doc_ids and repeated
    rows stay, each row counted; other columns are ignored; an empty table gives no rows.

    A block is about 2,000,000 characters of one partition, or one longer text.  Only its
    distinct pairs are shuffled to be counted; the counts come back to the block by its
    number.  The best count of each B id is broadcast: one row for each id of B's
    vocabulary at most (32,000 in the query).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, task, number = tokenizers(path_a, path_b), TaskContext.get().partitionId(), 0
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                yield block_row(task << 32 | number, ids[lo:hi], texts[lo:hi], both, as_text)
                number += 1

    kinds = tokenizers(path_a, path_b).b.get_piece_size()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = scratch.stored(rows.mapInArrow(run, BLOCK_SQL), "aligned")
    pairs = blocks.select("block", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))))
    totals = scratch.stored(pairs.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    best = totals.groupBy((F.col("pair") % kinds).alias("b")).agg(F.max("count").alias("best"))
    known = totals.join(F.broadcast(best), F.col("pair") % kinds == F.col("b")).select("pair", "count", (F.col("count") == F.col("best")).alias("top"))
    back = pairs.select(F.col("block").alias("home"), "pair").join(known, "pair").select("home", "pair", "count", "top")
    held = blocks.drop("pairs", "counts")
    return held.groupBy("block").cogroup(back.groupBy("home")).applyInArrow(block_results, RESULT_SQL)
