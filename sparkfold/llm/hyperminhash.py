"""Near-duplicate documents by HyperMinHash sketches, banding and exact verification.

A document's set of word shingles is hashed into 128 buckets; a bucket keeps, of its
smallest hash, the count of leading zeros and the next ten bits: 16 bits a register.
An empty bucket borrows from others in an order that is the same for all documents.
32 bands of 4 registers propose links: a pair of similarity 0.8 shares none of the
bands with probability (1 - 0.8**4)**32, about 5e-8.  Documents with one set are a
class and only its smallest doc_id goes on.  Each band bucket has a lead, the member
whose buckets are largest (in a group of near copies, the one most like all others).
A member is first held against its best lead; only members that this does not
connect are held against the rest of their buckets, as pairs where those are few,
else in blocks inside tasks that yield links and no pairs.  A pair is verified on
the full sets; before that, for leads and for pairs, the sketch estimate, corrected for
the collisions of compressed registers, skips those far below the threshold.  Blocks
count all their common shingles at once, so there is nothing for it to skip.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm import scratch
from sparkfold.llm.shingles import shingle_sets, slices
from sparkfold.llm.worker import keep_only

BUCKET_BITS, MANTISSA_BITS = 7, 10
BUCKETS, BANDS = 1 << BUCKET_BITS, 32
CHUNK, FEW_PAIRS = 500, 256
BAND_BYTES = 2 * BUCKETS // BANDS
PROBES = np.stack([np.random.default_rng(7 + b).permutation(BUCKETS) for b in range(BUCKETS)])


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit registers for each non-empty sorted set: zeros * 2**10 + inverted mantissa + 1."""
    out = np.zeros((len(sets), BUCKETS), dtype=np.uint16)
    edges = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKET_BITS)
    for row, s in zip(out, sets):
        first = np.searchsorted(s, edges)
        has = first < np.append(first[1:], len(s))
        rest = (s[first[has]] << np.uint64(BUCKET_BITS)) | np.uint64(1 << (BUCKET_BITS - 1))
        part, exponent = np.frexp(rest.astype(np.float64))
        zeros = np.maximum(64 - exponent, 0)
        mantissa = ((part - 0.5) * 2 * (1 << MANTISSA_BITS)).astype(np.int64)
        row[has] = (zeros << MANTISSA_BITS) + ((1 << MANTISSA_BITS) - 1 - mantissa) + 1
    own = out.copy()
    for attempt in range(BUCKETS):
        gaps = out == 0
        if not gaps.any():
            break
        out = np.where(gaps, own[:, PROBES[:, attempt]], out)
    return out


@lru_cache(maxsize=4096)
def expected_collisions(log_n: int, log_m: int) -> float:
    """Registers that agree by chance between disjoint sets of 2**log_n and 2**log_m shingles."""
    n, m = 2.0**log_n, 2.0**log_m
    j = np.arange(1 << MANTISSA_BITS)
    total = 0.0
    for zeros in range(40):
        low = (j / (1 << MANTISSA_BITS) + 1) / 2.0**(BUCKET_BITS + zeros + 1)
        high = low + 1 / 2.0**(BUCKET_BITS + zeros + 1 + MANTISSA_BITS)
        a = np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-high))
        b = np.exp(m * np.log1p(-low)) - np.exp(m * np.log1p(-high))
        total += float((a * b).sum())
    return total * BUCKETS


def estimate(equal: int, n: int, m: int) -> float:
    """Jaccard similarity from the count of equal registers, less the expected chance collisions."""
    chance = expected_collisions(int(n).bit_length() - 1, int(m).bit_length() - 1)
    return max(0.0, (equal - chance) / (BUCKETS - chance))


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, fingerprint (16 bytes of the set's hash), registers (256 bytes; null if the set is empty)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("fingerprint", pa.binary()), ("registers", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("sketch")
        for b in batches:
            ids, texts = b.column(0), [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
            for lo, hi in slices(texts):
                sets = shingle_sets(texts[lo:hi], width)
                filled = [s for s in sets if len(s)]
                rows = iter(registers(filled))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(lo, hi - lo).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([next(rows).tobytes() if len(s) else None for s in sets], pa.binary())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(work, "doc_id long, n_shingles long, fingerprint binary, registers binary")


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimate is not six standard deviations below the threshold (small sets: all).

    A doc_id that stands for several sets (repeated rows) has no estimate: its pairs all pass.
    """
    share = percent / 100
    floor = share - 6 * (share * (1 - share) / BUCKETS) ** 0.5
    # 0 shingles: several sets
    one = nodes.groupBy("rep").agg(F.when(F.count(F.lit(1)) == 1, F.first("n_shingles")).otherwise(0).alias("n"), F.first("registers").alias("r"))
    one = scratch.stored(one, "one")  # a join of two plain exchanges is one whose crowded leads Spark can split
    side = lambda c: one.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("r").alias(f"r_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    # a pair of such different sizes can't reach the threshold
    low, high = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    both = both.filter((low == 0) | (low * 100 >= high * percent))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = b.column(2).to_numpy(), b.column(3).to_numpy()
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS) for c in (4, 5))
            equal = (x == y).sum(axis=1)
            keep = [min(p, q) < 2 * BUCKETS or estimate(e, p, q) >= floor for e, p, q in zip(equal.tolist(), n.tolist(), m.tolist())]
            yield b.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return both.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(work, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    both = (pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("t_a")), "a")
            .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("t_b")), "b").select("a", "b", "t_a", "t_b"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("verify")
        for batch in batches:
            x, y = (batch.column(c).cast(pa.binary()).to_pylist() for c in (2, 3))
            keep: list[bool] = []
            for lo, hi in slices([p + q for p, q in zip(x, y)]):
                for p, q in zip(shingle_sets(x[lo:hi], width), shingle_sets(y[lo:hi], width)):
                    common = len(np.intersect1d(p, q, assume_unique=True))
                    keep.append(common > 0 and 100 * common >= percent * (len(p) + len(q) - common))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return both.mapInArrow(work, "a long, b long")


def dealt_blocks(groups: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lead, m, q, rep, label, text) of the members, each once for every chunk of queries, and of the queries, each
    once for every chunk of members: a few queries do not multiply a large group's members."""
    chunks = {c: F.ceil(F.col(n) / CHUNK).cast("int") for c, n in (("m_chunks", "n"), ("q_chunks", "queries"))}
    dealt = groups.filter("queries > 0").join(texts, "rep").withColumns(chunks)
    own = lambda c: F.pmod(F.xxhash64("rep"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    members = dealt.select("lead", own("m_chunks").alias("m"), every("q_chunks").alias("q"), "rep", "label", "text")
    fresh = [F.col(c).alias(c) for c in ("rep", "label", "text")]  # columns of their own: both sides come from one frame
    queries = dealt.filter("is_query").select(F.col("lead").alias("lead"), every("m_chunks").alias("m"), own("q_chunks").alias("q"), *fresh)
    return members, queries


def linked_in_blocks(groups: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between a group's queries and all its members with another label, by full sets.

    ``groups``: lead, rep, label, is_query, n (members of the lead), queries (those that are one).
    Both are dealt into chunks of about ``CHUNK``, each by its own count; each task gets one chunk of
    either, counts common shingles through an inverted list, and yields one link
    for each query and label.
    """
    members, queries = dealt_blocks(groups, texts)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        keep_only("blocks")
        found: list[tuple[int, int]] = []
        if left.num_rows and right.num_rows:
            member_sets, query_sets = ([s for lo, hi in slices(t) for s in shingle_sets(t[lo:hi], width)]
                                       for t in (x.column("text").cast(pa.binary()).to_pylist() for x in (left, right)))
            size = np.array([len(s) for s in member_sets])
            values, owner = np.concatenate(member_sets), np.repeat(np.arange(len(size)), size)
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            reps, labels = left.column("rep").to_numpy(), left.column("label").to_numpy()
            for s, rep, label in zip(query_sets, right.column("rep").to_pylist(), right.column("label").to_pylist()):
                lo, hi = np.searchsorted(values, s), np.searchsorted(values, s, side="right")
                n = hi - lo
                places = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                common = np.bincount(owner[places], minlength=len(size))
                hit = np.flatnonzero((common > 0) & (100 * common >= percent * (size + len(s) - common)) & (labels != label))
                _, one = np.unique(labels[hit], return_index=True)
                found += [(rep, r) for r in reps[hit[one]].tolist()]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return members.groupBy("lead", "m", "q").cogroup(queries.groupBy("lead", "m", "q")).applyInArrow(work, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each linked node reaches.

    Every round takes the smallest label among the neighbours, then the label of
    that label; rounds end when no label changes.  Each round is stored.
    """
    both = scratch.stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = scratch.stored(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        after = scratch.stored(step.join(jump, "next").select("node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved")), "labels")
        labels = after.select("node", "label")
        if not after.filter("moved").limit(1).count():
            return labels


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents without words are linked with nothing.  A null doc_id can't be named
    in a link: component_id is null and kept true.  Rows that repeat a doc_id are
    judged each by its own text; classes with the same smallest doc_id count as
    one.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    own = scratch.stored(sketch(docs, width), "sketch")
    named = own.filter("doc_id is not null and n_shingles > 0")
    classes = named.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"))
    nodes = scratch.stored(named.join(classes.withColumnRenamed("rep", "doc_id"), ["fingerprint", "doc_id"])
                           .dropDuplicates(["fingerprint", "doc_id"])
                           .select(F.col("doc_id").alias("rep"), "fingerprint", "n_shingles", "registers"), "nodes")
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("registers", b * BAND_BYTES + 1, BAND_BYTES)) for b in range(BANDS)])
    bands = nodes.select("rep", F.explode(keys).alias("key"))
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = scratch.stored(bands.join(sizes, "key"), "shared")
    scores = shared.groupBy("rep").agg(F.sum("size").alias("score"))
    scored = scratch.stored(shared.select("key", "rep").join(scores, "rep"), "scored")
    best = F.max(F.struct("score", (-F.col("rep")).alias("rep")))
    leads = scored.groupBy("key").agg(best.alias("top")).select("key", F.col("top.score").alias("top"), (-F.col("top.rep")).alias("lead"))
    members = scratch.stored(scored.select("key", "rep").join(leads, "key"), "members")
    scratch.release(spark)
    texts = scratch.stored(docs.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
                           .select(F.col("doc_id").alias("rep"), "text").filter("text is not null"), "texts")
    scratch.release(spark)

    # each against its best lead
    stars = (members.filter("rep != lead").groupBy(F.col("rep").alias("a")).agg(F.max(F.struct("top", (-F.col("lead")).alias("lead"))).alias("best"))
             .select("a", (-F.col("best.lead")).alias("b")))
    hopeful = scratch.stored(likely(stars, nodes, percent), "stars")
    links = scratch.stored(verified(hopeful, texts, width, percent), "links")
    labels = components(links)
    # buckets whose members are not all connected: who is not connected with the lead is held against all others
    labelled = scratch.stored(members.join(labels, members.rep == labels.node, "left")
                              .select("key", "rep", "lead", F.coalesce("label", "rep").alias("label")), "labelled")
    split = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("key")
    main = labelled.filter("rep = lead").select("key", F.col("label").alias("main")).distinct().join(split, "key")
    open_ = labelled.join(main, "key").groupBy("lead", "rep").agg(F.max(F.col("label") != F.col("main")).alias("is_query"), F.min("label").alias("label"))
    open_ = scratch.stored(open_, "open")
    # stored first: a join of two plain exchanges is one whose crowded leads Spark can split
    counts = scratch.stored(open_.groupBy("lead").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_query").cast("long")).alias("queries")), "counts")
    open_ = scratch.stored(open_.join(counts, "lead"), "open")
    few = open_.filter(F.col("n") * F.col("queries") <= FEW_PAIRS)
    left, right = few.filter("is_query").alias("x"), few.alias("y")
    pairs = (left.join(right, (F.col("x.lead") == F.col("y.lead")) & (F.col("x.label") != F.col("y.label"))
                       & (~F.col("y.is_query") | (F.col("x.rep") < F.col("y.rep"))))
             .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct())
    by_pair = scratch.stored(verified(likely(pairs, nodes, percent), texts, width, percent), "links")
    by_block = scratch.stored(linked_in_blocks(open_.filter(F.col("n") * F.col("queries") > FEW_PAIRS), texts, width, percent), "links")
    labels = components(links.union(by_pair).union(by_block))

    ids = nodes.join(labels, nodes.rep == labels.node, "left").select("fingerprint", F.coalesce("label", "rep").alias("component"))
    return (own.select("doc_id", "n_shingles", "fingerprint").join(ids, "fingerprint", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each near-duplicate group (the smallest doc_id), all columns kept.

    Of rows that repeat both doc_id and text one stays; rows with a null doc_id all stay.
    """
    judged = scratch.stored(near_duplicates(docs.select("doc_id", "text"), width, percent), "judged")
    gone = judged.filter("not kept").select("doc_id").distinct()
    again = scratch.stored(judged.filter("kept and doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again")
    if again.isEmpty():  # ids are unique, as they should be: one pass over the texts is enough
        return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    once = docs.join(gone.union(again), "doc_id", "left_anti")
    repeats = docs.join(again.join(gone, "doc_id", "left_anti"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeats).select(*docs.columns)
