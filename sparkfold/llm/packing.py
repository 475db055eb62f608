"""Hierarchical multi-length packing.

Documents are routed to context-size tiers by length: whole windows of the largest
size are cut off first, what is left goes to the smallest tier that holds it.  Each
tier is packed, longest first; gaps of its windows are filled from the shorter
tiers, with whole pieces where one fits and else with a cut one.  Windows of a tier
smaller than the largest are full, so they need no padding.  What cannot be filled
at the end of a block is laid end to end and cut into full windows.  Step groups
get sequences of about equal attention cost.

A block is a bounded run of a partition's documents (``block_tokens``), so nothing
is shuffled and a task's memory does not grow with the input.
"""

from __future__ import annotations

import heapq
import struct
from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.chunk_encode import encoder, slices

TIERS = (256, 512, 1024, 2048)
Piece = tuple[int, int, int]  # document (index in the block), start, length


def plan(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Sequences of one block: each a list of pieces; every token of every document lies in one piece."""
    top = tiers[-1]
    sequences: list[list[Piece]] = []
    by_tier: dict[int, list[tuple[int, int, int]]] = {t: [] for t in tiers}  # (length, document, start), ascending
    for doc, n in enumerate(lengths):
        whole = n // top * top
        sequences.extend([(doc, at, top)] for at in range(0, whole, top))
        if n > whole:
            tier = next(t for t in tiers if t >= n - whole)
            by_tier[tier].append((n - whole, doc, whole))
    for units in by_tier.values():
        units.sort()
    rest: list[Piece] = []
    for k in range(len(tiers) - 1, -1, -1):
        tier, own = tiers[k], by_tier[tiers[k]]
        shorter = sorted(u for t in tiers[:k] for u in by_tier[t]) if k else own
        while own:
            n, doc, at = own.pop()
            window, gap = [(doc, at, n)], tier - n
            while gap and shorter:
                fit = bisect_right(shorter, (gap, len(lengths), 0)) - 1
                if fit >= 0:
                    m, doc, at = shorter.pop(fit)
                    window.append((doc, at, m))
                    gap -= m
                else:  # all are longer than the gap: cut the longest
                    m, doc, at = shorter.pop()
                    window.append((doc, at, gap))
                    insort(shorter, (m - gap, doc, at + gap))
                    gap = 0
            if gap:
                rest.extend(window)
            else:
                sequences.append(window)
        if k:
            for t in tiers[:k]:
                by_tier[t] = []
            for u in shorter:
                by_tier[next(t for t in tiers if t >= u[0])].append(u)
    # what no shorter piece could fill: end to end, into full windows; the tail goes to ever smaller tiers
    left = sum(p[2] for p in rest)
    size = gap = next((t for t in reversed(tiers) if t <= left), tiers[0])
    window: list[Piece] = []
    for doc, at, n in rest:
        while n:
            take = min(n, gap)
            window.append((doc, at, take))
            at, n, gap, left = at + take, n - take, gap - take, left - take
            if not gap:
                sequences.append(window)
                window = []
                size = gap = next((t for t in reversed(tiers) if t <= left), tiers[0])
    if window:
        sequences.append(window)
    return sequences


def step_groups(sequences: list[list[Piece]], tokens: int) -> list[int]:
    """A group for each sequence: the costliest first, each to the group with the least cost so far."""
    total = [sum(p[2] for p in s) for s in sequences]
    cost = [sum(p[2] * p[2] for p in s) + 64 * n for s, n in zip(sequences, total)]
    loads = [(0, g) for g in range(max(1, round(sum(total) / tokens)))]
    out = [0] * len(sequences)
    for i in sorted(range(len(sequences)), key=lambda i: -cost[i]):
        load, g = heapq.heappop(loads)
        out[i] = g
        heapq.heappush(loads, (load + cost[i], g))
    return out


def pack(docs: DataFrame, vocabulary: str, end_id: int, tiers: tuple[int, ...] = TIERS,
         block_tokens: int = 4_000_000, step_tokens: int = 32_768, keeps_space: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, sequence_tokens, tier,
    step_group, ids (little-endian uint32 bytes).

    A null text is empty (its end id alone is packed); repeated rows are packed
    each; null ids stay null; an empty table gives no rows.  ``tier`` is the window
    a sequence needs; only a block's last sequence can be shorter than it.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64()),
                        ("tier", pa.int64()), ("step_group", pa.int64()), ("ids", pa.binary())])

    def rows(doc_ids: list, data: list[bytes], first: int) -> Iterator[pa.RecordBatch]:
        sequences = plan([len(d) // 4 for d in data], tiers)
        groups = step_groups(sequences, step_tokens)
        out: list[tuple] = []
        for k, (s, g) in enumerate(zip(sequences, groups)):
            offset, total = 0, sum(p[2] for p in s)
            tier = next(t for t in tiers if t >= total)
            for doc, at, n in s:
                out.append((doc_ids[doc], at, n, len(data[doc]) // 4, first + k, offset, total, tier, first + g, data[doc][4 * at:4 * (at + n)]))
                offset += n
            if len(out) >= 4000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary, keeps_space).encode, struct.pack("<I", end_id)
        first, held, ids, data = TaskContext.get().partitionId() << 36, 0, [], []
        for b in batches:
            own, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo, hi in slices(texts):
                ids += own[lo:hi]
                data += [d + end for d in encode(texts[lo:hi])]
                held += sum(len(d) for d in data[lo - hi:]) // 4
                if held >= block_tokens:
                    yield from rows(ids, data, first)
                    first, held, ids, data = first + held, 0, [], []
        if ids:
            yield from rows(ids, data, first)

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(work, ", ".join(f"{f.name} {'binary' if f.name == 'ids' else 'long'}" for f in schema))
