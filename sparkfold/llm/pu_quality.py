"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are labelled documents of quality 1; the unlabelled side is web
text as it comes, good and bad: every document outside the held-out fold.  The class
prior (share of good text) is estimated from how the two differ under a first scorer: the
least ratio, over thresholds, of unlabelled to positive mass above a threshold, counted over all
documents.  The scorer minimises

    prior * E_pos[l(f)] + max(0, E_unl[l(-f)] - prior * E_pos[l(-f)])

with the logistic loss l; where the second part turns negative, its gradient is
turned round instead (the non-negative correction).

The unlabelled rows are stored once on shared storage; their moments, the masses above
thresholds and the unlabelled part of risk and gradient are sums over all of them.  The steps
between two such sums run on the driver over a bounded sample, whose risk and gradient are
shifted by what the whole corpus had more at the last sum.  A fixed number of sums is taken, so
the end is near the whole corpus's own, not equal to it.

A text is described by how often each three-character pattern of character classes
occurs in it, and by its repetition: neighbouring equal words, repeated word pairs,
repeated lines and distinct words.  Nothing depends on a language's vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm import scratch
from sparkfold.llm.samples import first_by_hash, fold, labelled_ids
from sparkfold.llm.shingles import PLACES, mix, slices, word_hashes
from sparkfold.llm.worker import keep_only
from sparkfold.ml.sums import total

PATTERNS, EXTRA = 1024, 6
DIMS = PATTERNS + EXTRA


def _classes() -> np.ndarray:
    """Letters by case, digits, white space, bytes of longer characters; every sign is a class of its own."""
    out = np.arange(256, dtype=np.uint64) + np.uint64(16)
    for k, group in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\x0b\x0c\r", "\n")):
        out[[ord(c) for c in group]] = k
    out[128:] = 5
    return out


CLASSES = _classes()


def features(texts: list[bytes]) -> np.ndarray:
    """A row of ``DIMS`` numbers for each text: square roots of pattern shares, then the repetition shares."""
    out = np.zeros((len(texts), DIMS), dtype=np.float32)
    data = np.frombuffer(b"\n".join(texts) + b"\n\n\n", dtype=np.uint8)
    kinds = CLASSES[data]
    pattern = (mix(kinds[:-2] * PLACES[0] + kinds[1:-1] * PLACES[1] + kinds[2:] * PLACES[2]) >> np.uint64(54)).astype(np.int64)
    words, ends = word_hashes(texts, lower=False)
    start = first = 0
    for row, t, end in zip(out, texts, ends.tolist()):
        n = max(0, len(t) - 2)
        if n:
            row[:PATTERNS] = np.sqrt(np.bincount(pattern[start:start + n], minlength=PATTERNS) / n)
        own = words[first:end]
        k = len(own)
        if k:
            pairs = np.unique(mix(own[:-1] * PLACES[0] + own[1:] * PLACES[1]))
            lines = [x for x in t.split(b"\n") if x.strip()]
            row[PATTERNS:] = (1.0, np.mean(own[1:] == own[:-1]) if k > 1 else 0, 1 - len(pairs) / (k - 1) if k > 1 else 0,
                              1 - len(np.unique(own)) / k, 1 - len(set(lines)) / max(1, len(lines)), min(1.0, len(t) / k / 40))
        start, first = start + len(t) + 1, end
    return out


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x = (features(texts) - self.mean) / self.spread
        return 1 / (1 + np.exp(-np.clip(x @ self.weights + self.bias, -60, 60)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def single(v: np.ndarray) -> np.ndarray:
    """As float32, so that a product with the rows makes no wider copy of them."""
    return v.astype(np.float32)


def descend(gradient, start: np.ndarray, rounds: int, rate: float) -> np.ndarray:
    """Adam from ``start``, the weights and the bias as one vector; ``gradient(w, b)`` gives both parts."""
    theta, m, v = start.copy(), np.zeros(len(start)), np.zeros(len(start))
    for step in range(1, rounds + 1):
        gw, gb = gradient(theta[:-1], theta[-1])
        g = np.append(gw, gb)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return theta


class Rows:
    """Sums over unlabelled rows held as an array (``half`` is 0 or 1 for each)."""

    def __init__(self, x: np.ndarray, half: np.ndarray):
        self.x, self.half = x, half

    def batches(self, job) -> np.ndarray:
        return job([(self.x, self.half)])

    def moments(self) -> np.ndarray:
        """Rows, sums and sums of squares of each column."""
        dims = DIMS if self.x is None else self.x.shape[1]

        def job(parts):
            out = np.zeros(2 * dims + 1)
            for x, _ in parts:
                wide = x.astype(np.float64)
                out += np.concatenate([[len(x)], wide.sum(axis=0), (wide * wide).sum(axis=0)])
            return out
        return self.batches(job)

    def above(self, scorers: dict[int, tuple[np.ndarray, float, np.ndarray]]) -> dict[int, np.ndarray]:
        """For each half: its rows, and how many of them its scorer (weights, bias) puts at or above each cut."""
        at, size = {}, 0
        for half, (_, _, cuts) in scorers.items():
            at[half], size = size, size + len(cuts) + 1

        def job(parts):
            out = np.zeros(size)
            for x, halves in parts:
                for half, (w, b, cuts) in scorers.items():
                    scores = np.sort(x[halves == half].astype(np.float32) @ single(w) + b)
                    out[at[half]:at[half] + len(cuts) + 1] += np.append(len(scores), len(scores) - np.searchsorted(scores, cuts))
            return out
        got = self.batches(job)
        return {half: got[at[half]:at[half] + len(cuts) + 1] for half, (_, _, cuts) in scorers.items()}

    def risk(self, w: np.ndarray, b: float) -> np.ndarray:
        """Rows, and the sums of log(1 + e^f), of sigmoid(f) and of sigmoid(f) times the row."""
        def job(parts):
            out = np.zeros(len(w) + 3)
            for x, _ in parts:
                x = x.astype(np.float32)
                f = x @ single(w) + b
                up = sigmoid(f)
                out += np.concatenate([[len(x), np.logaddexp(0, f).sum(), up.sum()], x.T @ single(up)])
            return out
        return self.batches(job)


class StoredRows(Rows):
    """The same sums over a stored table (half, row), in tasks; only the sums come to the driver."""

    def __init__(self, table: DataFrame):
        self.x, self.table = None, table.select("half", "row")

    def batches(self, job) -> np.ndarray:
        size = len(job([]))

        def add(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            parts = (b.slice(at, 2000) for b in batches for at in range(0, b.num_rows, 2000))
            return job((matrix_of(b.column(1)), b.column(0).to_numpy()) for b in parts)
        return total(self.table, add, size)


def matrix_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.float16).reshape(-1, DIMS)


def class_prior(pos: np.ndarray, pos_half: np.ndarray, unl: np.ndarray, unl_half: np.ndarray, above, rounds: int = 150) -> float:
    """Share of positives among the unlabelled.  On each half of both a scorer of positive against unlabelled is
    fitted; on the other half (of all unlabelled rows, by ``above``) the least ratio of masses above a threshold is
    taken, each widened by its sampling error.  The result is the mean of both; 0.5 where no half has rows of both kinds."""
    scorers, masses = {}, {}
    for half in (0, 1):
        p, u, other = pos[pos_half == half], unl[unl_half == half], pos[pos_half != half]
        if not len(p) or not len(u) or not len(other):
            continue
        x = np.concatenate([p, u])
        y = np.concatenate([np.ones(len(p)), np.zeros(len(u))])
        share = np.where(y == 1, 0.5 / len(p), 0.5 / len(u))

        def gradient(w, b, x=x, y=y, share=share):
            g = (sigmoid(x @ single(w) + b) - y) * share
            return x.T @ single(g) + 1e-3 * w, g.sum()

        theta = descend(gradient, np.zeros(x.shape[1] + 1), rounds, 0.05)
        scores = np.sort(other @ single(theta[:-1]) + theta[-1])
        cuts = np.quantile(scores, np.linspace(0, 0.9, 91))
        scorers[1 - half] = (theta[:-1], theta[-1], cuts)
        masses[1 - half] = (len(scores), 1 - np.searchsorted(scores, cuts) / len(scores))
    found = []
    for half, counts in (above(scorers) if scorers else {}).items():
        n, above_p = masses[half]
        if counts[0]:
            above_u = counts[1:] / counts[0]
            error = 0.5 * (1 / n**0.5 + 1 / counts[0] ** 0.5)
            best = np.argmin((above_u + error) / above_p)
            found.append(above_u[best] / above_p[best])
    return float(np.clip(np.mean(found), 0.01, 0.99)) if found else 0.5


def fit(pos: np.ndarray, unl: np.ndarray, whole: Rows | None = None, pos_half: np.ndarray | None = None, unl_half: np.ndarray | None = None,
        rounds: int = 400, sums: int = 8, more: int = 100, rate: float = 0.03, l2: float = 1e-3) -> Model:
    """``unl`` is a sample of ``whole``, or all there is.  ``rounds`` steps on the sample; then ``sums`` times the
    sum over all rows, each followed by ``more`` shifted steps."""
    pos_half = np.arange(len(pos)) % 2 if pos_half is None else pos_half
    unl_half = np.arange(len(unl)) % 2 if unl_half is None else unl_half
    whole = whole or Rows(unl.astype(np.float32), unl_half)
    dims = pos.shape[1]
    own = Rows(pos, pos_half).moments() + whole.moments()
    mean = own[1:dims + 1] / own[0]
    spread = np.sqrt(np.maximum(own[dims + 1:] / own[0] - mean**2, 0)) + 1e-3
    pos, unl = ((part.astype(np.float32) - single(mean)) / single(spread) for part in (pos, unl))

    def raw(w, b):  # the same scorer on rows that are not scaled
        return w / spread, b - (mean * w / spread).sum()

    prior = class_prior(pos, pos_half, unl, unl_half,
                        lambda scorers: whole.above({h: (*raw(w, b), cuts) for h, (w, b, cuts) in scorers.items()}))
    shift_risk, shift_b, shift_w = 0.0, 0.0, np.zeros(dims)

    def gradient(w, b):
        fp, fu = pos @ single(w) + b, unl @ single(w) + b
        negative_risk = np.logaddexp(0, fu).mean() + shift_risk - prior * np.logaddexp(0, fp).mean()
        up_p, up_u = sigmoid(fp), sigmoid(fu)
        gp, gu = -prior * up_p / len(fp), up_u / len(fu)  # of the negative part
        if negative_risk < 0:
            return -(pos.T @ single(gp) + unl.T @ single(gu) + shift_w) + l2 * w, -(gp.sum() + gu.sum() + shift_b)
        gp = gp + prior * (up_p - 1) / len(fp)
        return pos.T @ single(gp) + unl.T @ single(gu) + shift_w + l2 * w, gp.sum() + gu.sum() + shift_b

    theta = descend(gradient, np.zeros(dims + 1), rounds, rate)
    for _ in range(sums):
        w, b = theta[:-1], theta[-1]
        n, risk, up, tilted = np.split(whole.risk(*raw(w, b)), [1, 2, 3])
        fu = unl @ single(w) + b
        up_u = sigmoid(fu)
        shift_risk = float(risk[0] / n[0] - np.logaddexp(0, fu).mean())
        shift_b = float(up[0] / n[0] - up_u.mean())
        shift_w = (tilted - mean * up) / spread / n - unl.T @ single(up_u / len(fu))
        theta = descend(gradient, theta, more, rate / 3)
    return Model(single(mean), single(spread), theta[:-1], float(theta[-1]), prior)


def unlabelled_rows(docs: DataFrame, modulus: int, held_out: int) -> DataFrame:
    """(doc_id, place, half, row) of every document outside the held-out fold, stored: the features as float16; place
    is a hash of id and text, whose low end is the sample; half splits the rows for the prior."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("quality")
        for b in batches:
            texts = b.column(3).cast(pa.binary()).to_pylist()
            for lo, hi in slices(texts):
                rows = features(texts[lo:hi]).astype(np.float16)
                yield pa.RecordBatch.from_arrays([*(b.column(c).slice(lo, hi - lo) for c in range(3)), pa.array([r.tobytes() for r in rows], pa.binary())],
                                                 names=["doc_id", "place", "half", "row"])

    web = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).filter("doc_id is not null").filter(fold(modulus) != held_out)
    web = web.withColumn("place", F.xxhash64("doc_id", "text")).withColumn("half", F.pmod(F.shiftright("place", 20), F.lit(2)).cast("int"))
    return scratch.stored(web.select("doc_id", "place", "half", "text").mapInArrow(work, "doc_id long, place long, half int, row binary"), "features")


def first_rows(rows: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, halves) of the ``most`` rows first in the order of their places: the same in every run."""
    got = rows.orderBy("place", "row").limit(most).select("half", "row").toArrow()
    x = np.frombuffer(b"".join(got.column("row").to_pylist()), dtype=np.float16).reshape(-1, DIMS)
    return x, got.column("half").to_numpy()


def train(docs: DataFrame, labels: DataFrame, most: int = 6000, modulus: int = 5, held_out: int = 0) -> Model | None:
    """Fit on at most ``most`` labelled positives and on all unlabelled documents, none of the held-out fold.

    ``labels.quality`` 1 marks the positives; labels of 0 are not used.  ``most`` also bounds the sample that steers
    the steps between two sums over all rows.  Rows without a doc_id are not learned from; null texts count as empty;
    repeated rows count each.  None without positives or documents.
    """
    ids = first_by_hash(labelled_ids(labels, "quality", fold(modulus) != held_out).filter("label = 1"), most).select("doc_id")
    rows = unlabelled_rows(docs, modulus, held_out)
    pos, pos_half = first_rows(rows.join(F.broadcast(ids), "doc_id"), most)
    if not len(pos):
        return None
    unl, unl_half = first_rows(rows, most)
    return fit(pos, unl, StoredRows(rows), pos_half, unl_half)


def score(docs: DataFrame, model: Model | None, modulus: int = 5, held_out: int = 0, cut: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; whole texts; null counts as empty.

    Null ids and repeated rows are scored like any other; an empty table gives no rows.
    Without a model every score is 0.5, so nothing is rejected.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("quality")
        for b in batches:
            texts = [t or b"" for t in b.column(2).cast(pa.binary()).to_pylist()]
            out: list[float] = []
            for lo, hi in slices(texts, 500_000):
                out += shared.value.scores(texts[lo:hi]).tolist() if shared.value else [0.5] * (hi - lo)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), (fold(modulus) == held_out).alias("held_out"), "text")
    return (rows.mapInArrow(work, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= cut).cast("int")))


def classify(docs: DataFrame, labels: DataFrame, most: int = 6000) -> DataFrame:
    """``score`` by a model that ``train`` fits on the same documents; odd rows as there."""
    return score(docs, train(docs, labels, most))


def keep_good(docs: DataFrame, labels: DataFrame, most: int = 6000, cut: float = 0.3) -> DataFrame:
    """``docs`` without the documents scored below ``cut``; all columns kept, the documents are not shuffled.

    Null texts are judged as empty ones, null ids and repeated rows like any other; without a model all are kept.
    """
    model = train(docs, labels, most)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only("quality")
        for b in batches:
            texts = [t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()]
            keep: list[bool] = []
            for lo, hi in slices(texts, 500_000):
                keep += (shared.value.scores(texts[lo:hi]) >= cut).tolist() if shared.value else [True] * (hi - lo)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
