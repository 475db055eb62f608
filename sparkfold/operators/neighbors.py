"""Exact k-nearest-neighbour vote (I9 / M12), pruned by pivots.

Every training row belongs to the cell of its nearest pivot (at most ``pivots``
rows of the training side, the first by a hash of the id) and keeps its distance
to it, its gap.  A query is answered in two rounds:

1. It meets the nearest cells that together hold k rows.  The k-th distance
   found there is an upper bound on the true one.
2. It meets only the other cells that can hold something nearer.  A cell is
   skipped where the triangle inequality over the cell's least and greatest gap,
   or the plane half way between its pivot and the query's own, puts all its rows beyond the bound.

Inside a block the rows are in the order of their gaps, and tiles of them are
skipped in the same way while the bound shrinks.  Nothing that could be a neighbour
is skipped (bounds are widened by more than the rounding error), so the result is that of
brute force; ``knn_work`` counts the distances that were computed.

A cell is dealt into parts of at most ``block_rows`` rows, and the queries of a
cell into chunks of the same size; one Arrow-batched pandas function for each
(cell, part, chunk) keeps only the block's k nearest.  A hot cell is thus many
bounded groups, and no pair of rows is ever a row itself.  The per-query candidate lists are
merged by a keyed window.

Ties: neighbours ordered by (squared distance, id); the vote goes to the most
frequent label, ties to the smallest label.

NULLs: a training row without a label or a vector is left out; a test row without a
vector, or one that no training row is left for, gets the prediction NULL.  Vectors of
different lengths, or with NULL elements, are an error.  Ids of test rows are unique.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.session import cut_lineage

CAND_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType()),
    T.StructField("computed", T.LongType()),
    T.StructField("cands", T.ArrayType(T.StructType([
        T.StructField("d2", T.DoubleType()), T.StructField("rid", T.LongType()),
        T.StructField("label", T.LongType())]))),
])


#: A tile of distances is QUERY_TILE x REF_TILE x dimension doubles: 34 MB at 64 dimensions, and as much
#: again for the squares, whatever the block sizes.
QUERY_TILE, REF_TILE = 32, 2048

#: Bounds are widened by this share of the distances they come from; their rounding error is below 1e-12 of them.
SLACK = 1e-9


def _candidates(Q: np.ndarray, own: np.ndarray, rows: np.ndarray, squares: np.ndarray, n: int, limit: np.ndarray,
                beyond: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, squared distance) of all pairs of a tile that may be among a query's ``n`` nearest: not farther than
    ``limit`` (its n-th so far) or ``beyond``, and not than the tile's own n-th.  ``own``, ``squares``: squared lengths.

    One matrix product gives all distances up to a rounding error that is bounded; only
    pairs within it of the limit get their distance as it is returned, by differences.
    """
    with np.errstate(invalid="ignore", over="ignore"):
        near = own[:, None] + squares[None, :] - 2 * (Q @ rows.T)
        error = 8 * (Q.shape[1] + 8) * np.finfo(np.float64).eps * (own + squares.max())
        if not np.isfinite(near).all() or not np.isfinite(error).all():  # too large for products
            near, error = ((Q[:, None, :] - rows[None]) ** 2).sum(axis=2), np.zeros(len(Q))
    limit = np.minimum(limit, beyond)
    loose = np.flatnonzero(np.isinf(limit))
    if len(loose):
        n = min(n, len(rows))
        limit[loose] = np.partition(near[loose], n - 1, axis=1)[:, n - 1] + error[loose]
    hits, cols = np.nonzero(near <= (limit + error)[:, None])
    d2 = ((Q[hits] - rows[cols]) ** 2).sum(axis=1)
    kept = d2 <= np.minimum(limit, beyond)[hits]
    return hits[kept], cols[kept], d2[kept]


def _block_topk(k: int, tile: int = REF_TILE):
    """The k nearest rows of a block for each of its queries.  ``_gap`` (distance to the cell's pivot, both sides) and
    ``_bound`` (the queries' k-th distance so far) let tiles be skipped; without them all distances are computed."""
    def fn(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ref = pdf[pdf["_side"] == 1]
        qry = pdf[pdf["_side"] == 0]
        if ref.empty or qry.empty:
            return pd.DataFrame({"qid": pd.Series([], dtype="int64"), "computed": pd.Series([], dtype="int64"),
                                 "cands": pd.Series([], dtype=object)})
        if "_gap" in pdf:
            ref = ref.sort_values("_gap", kind="stable")
            ref_gap, all_gaps = ref["_gap"].to_numpy(np.float64), qry["_gap"].to_numpy(np.float64)
            all_bounds = qry["_bound"].to_numpy(np.float64)
        else:
            ref_gap, all_gaps, all_bounds = np.zeros(len(ref)), np.zeros(len(qry)), np.full(len(qry), np.inf)
        R = np.stack(ref["vec"].to_numpy()).astype(np.float64)
        squares = (R ** 2).sum(axis=1)
        rid = ref["id"].to_numpy(np.int64)
        lab = ref["label"].to_numpy(np.int64)
        tiles = [(at, ref_gap[at], ref_gap[min(at + tile, len(R)) - 1]) for at in range(0, len(R), tile)]
        out_q, out_n, out_c = [], [], []
        kk = min(k, len(R))
        ids = qry["id"].to_numpy(np.int64)
        for start in range(0, len(qry), QUERY_TILE):
            Q = np.stack(qry["vec"].iloc[start:start + QUERY_TILE].to_numpy()).astype(np.float64)
            own = (Q ** 2).sum(axis=1)
            gap, bound = all_gaps[start:start + QUERY_TILE], all_bounds[start:start + QUERY_TILE].copy()
            # the bound it came with: k rows of other blocks are that near, so what is farther is no neighbour
            beyond = bound ** 2 * (1 + SLACK)
            best_d, best_at = np.full((len(Q), kk), np.inf), np.zeros((len(Q), kk), dtype=np.int64)
            have, computed = np.zeros(len(Q), dtype=np.int64), np.zeros(len(Q), dtype=np.int64)
            middle = float(np.median(gap))
            for at, low, high in sorted(tiles, key=lambda t: max(t[1] - middle, middle - t[2])):  # nearest shells first
                live = np.flatnonzero(np.maximum(low - gap, gap - high) <= bound + SLACK * (gap + high))
                if not len(live):
                    continue
                rows = R[at:at + tile]
                computed[live] += len(rows)
                hits, cols, d2 = _candidates(Q[live], own[live], rows, squares[at:at + tile], kk,
                                             np.where(have[live] == kk, best_d[live, -1], np.inf), beyond[live])
                if not len(hits):
                    continue
                # the nearest so far and the new ones, each query's in the order of (squared distance, id)
                changed, counts = np.unique(live[hits], return_counts=True)
                old_q, old_c = np.nonzero(np.arange(kk) < have[changed][:, None])
                q = np.concatenate([changed[old_q], live[hits]])
                d, where = np.concatenate([best_d[changed[old_q], old_c], d2]), np.concatenate([best_at[changed[old_q], old_c], at + cols])
                order = np.lexsort((rid[where], d, q))
                q, d, where = q[order], d[order], where[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                kept = place < kk
                best_d[q[kept], place[kept]], best_at[q[kept], place[kept]] = d[kept], where[kept]
                have[changed] = np.minimum(kk, have[changed] + counts)
                if kk == k:
                    whole = changed[have[changed] == k]
                    bound[whole] = np.minimum(bound[whole], np.sqrt(best_d[whole, -1]))
            for r, qid in enumerate(ids[start:start + QUERY_TILE].tolist()):
                near = best_at[r, :have[r]]
                out_q.append(qid)
                out_n.append(int(computed[r]))
                out_c.append([{"d2": d, "rid": i, "label": v} for d, i, v in zip(best_d[r].tolist(), rid[near].tolist(), lab[near].tolist())])
        return pd.DataFrame({"qid": out_q, "computed": out_n, "cands": out_c})
    return fn


def _gaps(vecs: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, in steps of bounded memory."""
    step = max(1, 4_000_000 // max(1, pivots.size))
    return np.concatenate([np.sqrt(((vecs[a:a + step, None, :] - pivots[None]) ** 2).sum(axis=2)) for a in range(0, len(vecs), step)])


def _assign(pivots: np.ndarray):
    """Each training row's nearest pivot (the first of equal ones) and its distance to it."""
    def fn(frames):
        for pdf in frames:
            if len(pdf):
                gaps = _gaps(np.stack(pdf["vec"].to_numpy()).astype(np.float64), pivots)
                cell = gaps.argmin(axis=1)
                yield pdf.assign(_cell=cell.astype(np.int32), _gap=gaps[np.arange(len(cell)), cell])
    return fn


def _home(order_gaps: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """True for the nearest cells that together hold k rows, a row of flags for each query."""
    order = np.argsort(order_gaps, axis=1, kind="stable")
    before = np.cumsum(counts[order], axis=1) - counts[order]
    home = np.zeros(order_gaps.shape, dtype=bool)
    np.put_along_axis(home, order, before < k, axis=1)
    return home


#: Queries whose cells are listed together: with 256 pivots 3 MB, as Arrow arrays.
QUERIES_AT_ONCE = 1024


def _cells_of_queries(pivots: np.ndarray, between: np.ndarray, counts: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, second: bool):
    """The cells a query must meet: its home cells, or (second round) the others that its bound can't rule out."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERIES_AT_ONCE):
                yield cells(batch.slice(at, QUERIES_AT_ONCE))

    def cells(batch: pa.RecordBatch) -> pa.RecordBatch:
        gaps = _gaps(np.stack(batch.column("vec").to_pandas().to_numpy()).astype(np.float64), pivots)
        meet = _home(gaps, counts, k) & (counts > 0)
        if second:
            own = gaps.argmin(axis=1)
            nearest = gaps[np.arange(len(own)), own][:, None]
            apart = between[own]  # from the query's own pivot to each other one
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(apart > 0, (gaps**2 - nearest**2) / (2 * apart), 0.0)
            least = np.maximum(np.maximum(low - gaps, gaps - high), plane)
            # the plane's error grows with gaps * gaps / apart, so the slack does too
            with np.errstate(divide="ignore", invalid="ignore"):
                slack = SLACK * (gaps + high + np.where(apart > 0, gaps**2 / apart, 0.0))
            meet = ~meet & (counts > 0) & (least <= batch.column("_bound").to_numpy(zero_copy_only=False)[:, None] + slack)
        query, cell = np.nonzero(meet)
        met = pa.StructArray.from_arrays([pa.array(cell, pa.int32()), pa.array(gaps[query, cell], pa.float64())], ["cell", "gap"])
        ends = np.concatenate([[0], np.cumsum(meet.sum(axis=1))])
        return pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), met)], [*batch.schema.names, "_cells"])
    return fn


class _Cells:
    """The training side, dealt into cells and stored once."""

    def __init__(self, train: DataFrame, id_col: str, vec_col: str, label_col: str, cell_rows: int, pivots: int, block_rows: int):
        self.block_rows = block_rows
        rows = (train.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull())
                .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                        F.col(label_col).cast("long").alias("label")))
        self.n_rows = rows.count()
        self.n_pivots = 0
        if not self.n_rows:
            return
        wanted = min(pivots, math.ceil(self.n_rows / cell_rows))
        chosen = rows.orderBy(F.xxhash64("id"), "id").select("vec").limit(wanted).collect()  # at most ``pivots`` rows
        self.pivots = np.array([r.vec for r in chosen], dtype=np.float64)
        self.n_pivots = len(chosen)
        self.between = _gaps(self.pivots, self.pivots)
        schema = "id long, vec array<double>, label long, _salt long, _cell int, _gap double"
        self.rows = cut_lineage(rows.withColumn("_salt", F.monotonically_increasing_id()).mapInPandas(_assign(self.pivots), schema))
        self.counts = np.zeros(self.n_pivots, dtype=np.int64)
        self.low, self.high = np.zeros(self.n_pivots), np.zeros(self.n_pivots)
        for r in self.rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.min("_gap").alias("lo"), F.max("_gap").alias("hi")).collect():
            self.counts[r["_cell"]], self.low[r["_cell"]], self.high[r["_cell"]] = r["n"], r["lo"], r["hi"]

    def round(self, queries: DataFrame, k: int, second: bool) -> DataFrame:
        """(qid, computed, cands) of every block; ``queries`` has id, vec, _bound."""
        spark = queries.sparkSession
        fn = _cells_of_queries(self.pivots, self.between, self.counts, self.low, self.high, k, second)
        sent = cut_lineage(queries.select("id", "vec", "_bound", F.monotonically_increasing_id().alias("_salt"))
                           .mapInArrow(fn, "id long, vec array<double>, _bound double, _salt long, _cells array<struct<cell:int,gap:double>>"))
        asked = sent.select(F.explode("_cells.cell").alias("_cell")).groupBy("_cell").count().collect()  # a row for each pivot
        plan = F.broadcast(spark.createDataFrame(
            [(r["_cell"], math.ceil(int(self.counts[r["_cell"]]) / self.block_rows), math.ceil(r["count"] / self.block_rows)) for r in asked],
            "_cell int, _parts int, _chunks int"))
        columns = ["id", "vec", "label", "_gap", "_bound", "_cell", "_part", "_chunk", "_side"]
        ref = (self.rows.join(plan, "_cell")
               .withColumn("_part", F.pmod(F.xxhash64("_salt"), F.col("_parts")).cast("int"))
               .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
               .withColumn("_bound", F.lit(None).cast("double")).withColumn("_side", F.lit(1)))
        qry = (sent.withColumn("_c", F.explode("_cells")).withColumn("_cell", F.col("_c.cell")).withColumn("_gap", F.col("_c.gap")).join(plan, "_cell")
               .withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
               .withColumn("_chunk", F.pmod(F.xxhash64("_salt"), F.col("_chunks")).cast("int"))
               .withColumn("label", F.lit(None).cast("long")).withColumn("_side", F.lit(0)))
        return (ref.select(*columns).unionByName(qry.select(*columns)).groupBy("_cell", "_part", "_chunk")
                .applyInPandas(_block_topk(k, PRUNED_TILE), CAND_SCHEMA))


#: Rows that a block's search skips or computes together.
PRUNED_TILE = 256


def _nearest(cands: DataFrame, k: int) -> DataFrame:
    """(qid, d2, rid, label) of the k nearest candidates."""
    from pyspark.sql import Window
    flat = cands.select("qid", F.explode("cands").alias("c")).select("qid", "c.d2", "c.rid", "c.label")
    w = Window.partitionBy("qid").orderBy("d2", "rid")
    return flat.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def _search(train: DataFrame, test: DataFrame, k: int, id_col: str, vec_col: str, label_col: str, block_rows: int,
            cell_rows: int, pivots: int) -> tuple[_Cells, DataFrame | None]:
    """The cells, and (qid, computed, cands) lists that together hold every query's k nearest rows."""
    cells = _Cells(train, id_col, vec_col, label_col, cell_rows, pivots, block_rows)
    if not cells.n_rows:
        return cells, None
    queries = (test.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull())
               .select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec")))
    first = cells.round(queries.withColumn("_bound", F.lit(float("inf"))), k, second=False)
    if cells.n_pivots == 1:
        return cells, first
    first = cut_lineage(first)
    bound = (_nearest(first, k).groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("d2"))
             .select(F.col("qid").alias("id"), F.when(F.col("n") == k, F.sqrt("d2")).otherwise(F.lit(float("inf"))).alias("_bound")))
    return cells, first.unionByName(cells.round(queries.join(bound, "id"), k, second=True))


def knn_vote(train: DataFrame, test: DataFrame, k: int = 7, id_col: str = "id", vec_col: str = "vec",
             label_col: str = "label", block_rows: int = 20000, cell_rows: int = 2048, pivots: int = 256) -> DataFrame:
    """(id, pred) for every test row: majority label of its k nearest training rows.

    There is a pivot for each ``cell_rows`` training rows, at most ``pivots``.  Groups are (cell part, query chunk)
    pairs, each holding at most about ``block_rows`` rows of either side, so no task sees an unbounded group.
    """
    asked = test.select(F.col(id_col).cast("long").alias("_id"))
    _, cands = _search(train, test, k, id_col, vec_col, label_col, block_rows, cell_rows, pivots)
    if cands is None:
        return asked.select(F.col("_id").alias(id_col), F.lit(None).cast("long").alias("pred"))
    votes = _nearest(cands, k).groupBy("qid", "label").agg(F.count(F.lit(1)).alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("v"), F.col("label").alias("l")))
    found = votes.groupBy("qid").agg(best.alias("b")).select("qid", F.col("b.l").alias("pred"))
    return asked.join(found, F.col("_id") == F.col("qid"), "left").select(F.col("_id").alias(id_col), "pred")


def knn_work(train: DataFrame, test: DataFrame, k: int = 7, id_col: str = "id", vec_col: str = "vec",
             label_col: str = "label", block_rows: int = 20000, cell_rows: int = 2048, pivots: int = 256) -> DataFrame:
    """One row: n_queries, n_rows, n_pivots, n_brute (distances of brute force), n_computed (distances of this search, those
    to pivots included, the queries' once for each round) and saved (share; below 0 where pruning costs more than it saves, 0 without pairs)."""
    cells, cands = _search(train, test, k, id_col, vec_col, label_col, block_rows, cell_rows, pivots)
    rounds = 1 if cells.n_pivots <= 1 else 2
    n = test.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).agg(F.count(F.lit(1)).alias("n_queries"))
    done = n.select(F.lit(0).cast("long").alias("done")) if cands is None else cands.agg(F.coalesce(F.sum("computed"), F.lit(0)).alias("done"))
    out = n.crossJoin(done).withColumn("n_rows", F.lit(cells.n_rows).cast("long")).withColumn("n_pivots", F.lit(cells.n_pivots).cast("long"))  # two one-row tables
    out = out.withColumn("n_brute", F.col("n_queries") * F.col("n_rows"))
    out = out.withColumn("n_computed", F.col("done") + F.col("n_pivots") * (F.col("n_rows") + rounds * F.col("n_queries")))
    saved = F.when(F.col("n_brute") > 0, 1 - F.col("n_computed") / F.col("n_brute")).otherwise(F.lit(0.0))
    return out.select("n_queries", "n_rows", "n_pivots", "n_brute", "n_computed", saved.alias("saved"))
