"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

The documents of a batch are one array of word codes, each code made distinct for its
document, so no two documents share a suffix.  Prefix doubling gives the suffix array;
the ranks of each doubling step stay, and two suffixes share 2**k words exactly if
their ranks of step k are equal.  From neighbouring suffixes come the LCP values, from
the nearest smaller values on both sides the LCP intervals, as slot ranges only: no
tree is built.  For an interval of depth q, the suffixes i of all children but the
largest look up the ranks of i + q and i - q; if they lie in the interval, two equal
stretches of q words stand side by side, and where the words after them differ, the
square ends a run.  Squares are rotated to the left, in steps of falling powers of
two, as far as the period holds, and squares of one stretch are one run with the
smallest of their periods.

A run of ``times`` periods holds ``times`` suffixes of its last interval, so smaller
intervals are passed over; nothing else is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.shingles import slices


def suffix_ranks(keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by the first 2**k symbols for k = 0, 1, ...); the last ranks are all different.

    Every suffix must differ from the others before the array ends.
    """
    suffixes = np.argsort(keys)
    ordered = keys[suffixes]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    rank = np.empty(len(keys), dtype=np.int32 if len(keys) < 2**31 else np.int64)  # one array for each step stays
    rank[suffixes] = first
    levels, step = [rank], 1
    alone = new & np.concatenate([new[1:], [True]])
    slots = np.flatnonzero(~alone)
    while len(slots):
        here = suffixes[slots]
        pair = rank[here].astype(np.int64) * len(keys) + rank[here + step]
        order = np.argsort(pair)
        here, pair = here[order], pair[order]
        suffixes[slots] = here
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))
        rank = rank.copy()
        rank[here] = slots[first]
        levels.append(rank)
        alone = new & np.concatenate([new[1:], [True]])
        slots, step = slots[~alone], step * 2
    return suffixes, levels


def common_words(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes ``a`` and ``b`` share."""
    a, b, out = a.copy(), b.copy(), np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][a] == levels[k][b]
        out[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return out


def interval_bounds(lcp: np.ndarray, at: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each place ``at``: the nearest place to its left with a smaller value, and the last place before one to its right."""
    table = [lcp]
    while 1 << len(table) <= longest:
        half, last = 1 << len(table) - 1, table[-1]
        table.append(np.minimum(last[:-half], last[half:]))
    left, right, value = at.copy(), at.copy(), lcp[at]
    for k in range(len(table) - 1, -1, -1):
        least, width = table[k], 1 << k
        start = right
        fits = start + width <= len(lcp)
        fits[fits] = least[start[fits]] >= value[fits]
        right = right + width * fits
        start = left - width
        fits = start >= 0
        fits[fits] = least[start[fits]] >= value[fits]
        left = left - width * fits
    return left - 1, right - 1


def squares(keys: np.ndarray, suffixes: np.ndarray, levels: list[np.ndarray], times: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of the branching squares in LCP intervals of at least ``times`` suffixes."""
    none = np.zeros(0, dtype=np.int64)
    group = levels[0][suffixes]  # slot of the first suffix with the same first symbol
    size = np.bincount(group, minlength=len(keys))
    slots = np.flatnonzero(size[group] >= times)
    if not len(slots):
        return none, none
    head = group[slots] == slots
    lcp = np.zeros(len(slots), dtype=np.int64)
    inner = np.flatnonzero(~head)
    lcp[inner] = common_words(levels, suffixes[slots[inner] - 1], suffixes[slots[inner]])
    left, right = interval_bounds(lcp, inner, int(size.max()))
    wide = right - left + 1 >= times
    inner, left, right = inner[wide], left[wide], right[wide]
    if not len(inner):
        return none, none
    order = np.argsort(left * len(slots) + right, kind="stable")
    inner, left, right = inner[order], left[order], right[order]
    # the places of one interval, in order, cut it into its children
    opens = np.concatenate([[True], (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    interval = np.cumsum(opens) - 1
    lo, hi, depth = left[opens], right[opens], lcp[inner[opens]]
    begin = np.concatenate([lo, inner])
    owner = np.concatenate([np.arange(len(lo)), interval])
    order = np.lexsort((begin, owner))
    begin, owner = begin[order], owner[order]
    last = np.concatenate([owner[1:] != owner[:-1], [True]])
    stop = np.where(last, hi[owner] + 1, np.concatenate([begin[1:], [0]]))
    width = stop - begin
    largest = np.lexsort((begin, -width, owner))
    small = np.ones(len(begin), dtype=bool)
    small[largest[np.concatenate([[True], owner[1:] != owner[:-1]])]] = False
    begin, owner, width = begin[small], owner[small], width[small]
    each = np.repeat(np.arange(len(begin)), width)
    place = np.arange(len(each)) - np.repeat(np.cumsum(width) - width, width) + begin[each]
    owner = owner[each]
    suffix, q = suffixes[slots[place]], depth[owner]
    lowest, highest = slots[lo[owner]], slots[hi[owner]]
    slot_of = levels[-1]
    starts, periods = [], []
    for start, other in ((suffix, suffix + q), (suffix - q, suffix - q)):
        at = slot_of[np.clip(other, 0, len(keys) - 1)]
        good = (other >= 0) & (other < len(keys)) & (at >= lowest) & (at <= highest)
        s, p = start[good], q[good]
        ends = keys[s + p] != keys[s + 2 * p]
        starts.append(s[ends])
        periods.append(p[ends])
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(codes: np.ndarray, ends: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start and period.

    ``codes``: word codes of the documents, one after the other; ``ends``: where each
    document's end.  A run is a longest stretch of its smallest period, at least
    ``least`` words and ``times`` periods long (``times`` of 3 or more).
    """
    n_docs = len(ends)
    sizes = np.diff(ends, prepend=0)
    kinds = int(codes.max()) + 2 if len(codes) else 1
    doc = np.repeat(np.arange(n_docs), sizes + 1)
    keys = doc * kinds  # each document's last place holds a symbol of its own
    inside = np.ones(len(keys), dtype=bool)
    inside[ends + np.arange(n_docs)] = False
    keys[inside] += codes + 1
    none = np.zeros(0, dtype=np.int64)
    if not len(codes):
        return none, none, none, none
    suffixes, levels = suffix_ranks(keys)
    start, period = squares(keys, suffixes, levels, times)
    stop = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        at = np.maximum(back, 0)
        same = (back >= 0) & (levels[k][at] == levels[k][at + period])
        start = np.where(same, back, start)
    length = stop - start
    long = length >= np.maximum(least, times * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    which = doc[start]
    return which, start - (ends - sizes + np.arange(n_docs))[which], length, period


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """(doc_id, n_words, runs array of (start, length, period), collapsed) of every whole text, without a shuffle.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, compared byte by byte and
    numbered from 0.  ``runs`` is sorted by start, then period.  ``collapsed`` (UTF-8
    bytes) joins the words that no run holds after its first period by one space.  A
    null, empty or blank text has no words, no runs and an empty ``collapsed``; null
    and repeated doc_ids and repeated rows stay as they are; other columns are ignored;
    an empty table gives no rows.  Memory holds a batch of about 1,000,000 bytes, or one
    longer text: a text is one unit, because a run may span all of it.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", run_type), ("collapsed", pa.binary())])

    def part(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        words = [t.split() for t in texts]  # bytes.split: at exactly these white bytes
        flat = [w for ws in words for w in ws]
        held = np.empty(len(flat), dtype=object)
        held[:] = flat
        codes = pd.factorize(held)[0].astype(np.int64)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        which, start, length, period = find_runs(codes, ends, least, times)
        edges = np.searchsorted(which, np.arange(len(words) + 1))
        collapsed = []
        for k, ws in enumerate(words):
            a, b = int(edges[k]), int(edges[k + 1])
            if a < b:
                depth = np.zeros(len(ws) + 1, dtype=np.int64)
                np.add.at(depth, start[a:b] + period[a:b], 1)
                np.add.at(depth, start[a:b] + length[a:b], -1)
                ws = [ws[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
            collapsed.append(b" ".join(ws))
        runs = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(ends, prepend=0)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs),
                                           pa.array(collapsed, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in slices(texts):
                yield part(b.column(0).slice(lo, hi - lo), texts[lo:hi])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
