"""Toxicity by a counterfactually regularised word scorer.

A word's score is the sum of learned weights of its hashed features (the word and
its first 4, 5 and 6 bytes, so inflections share what was learned); a document's
logit is a bias plus its ``TOP`` highest distinct word scores, so a few toxic words
count alike in short and long texts.  Fitted on a bounded sample of labelled rows by
full-batch Adam on the logistic loss.  For every sampled document that names a
group, a copy with the term swapped for another of the same kind is made, and for a
part of the documents a copy with a term put in; the squared difference of the two
logits is added to the loss, so that naming a group does not move the score.
Features of fewer than ``MIN_DOCS`` sampled documents are not learned, whatever the sample's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfold.llm.samples import first_by_hash, fold, labelled_ids, texts_of
from sparkfold.llm.shingles import BASE, INVERSE, LOWER, mix, powers, slices

DIMS, TOP, PREFIXES = 1 << 18, 5, (4, 5, 6)
MIN_DOCS = 2
LETTERS = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])

#: Identity terms by kind; a term is swapped for the next of its kind.
IDENTITY_TERMS = {
    "religion": "christian muslim jewish hindu buddhist atheist chrétien musulman juif hindou christ moslem jude cristiano musulmán judío budista".split(),
    "orientation": "gay lesbian straight bisexual queer heterosexual homosexual schwul lesbisch lesbienne lesbiana".split(),
    "gender": "women men woman man female male transgender femmes hommes frauen männer mujeres hombres".split(),
    "origin": "american mexican african asian european arab chinese indian german french spanish african-american immigrant refugee".split(),
    "ability": "blind deaf disabled autistic aveugle sourd taub gehörlos ciego sordo".split(),
    "age": "old young elderly teenage vieux jeune jung viejo joven".split(),
}


def word_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, features (words x 4) below ``DIMS``, end of each text's words)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    gap = ~LETTERS[data]
    before = np.concatenate([[True], gap[:-1]])
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(LOWER[data] * powers(BASE, len(data)), dtype=np.uint64)])
    back = powers(INVERSE, len(data))[starts]
    words = mix((sums[ends] - sums[starts]) * back)
    columns = [words] + [mix((sums[np.minimum(starts + n, ends)] - sums[starts]) * back + np.uint64(n)) for n in PREFIXES]
    features = np.stack([(c >> np.uint64(40)).astype(np.uint32) & np.uint32(DIMS - 1) for c in columns], axis=1)
    return words, features, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))


def swaps() -> dict[int, np.ndarray]:
    """Hash of each identity term -> the features of the next term of its kind."""
    out = {}
    for terms in IDENTITY_TERMS.values():
        terms = [t for t in terms if t.replace("-", "").isalpha() and "-" not in t]
        words, features, _ = word_features([t.encode() for t in terms])
        for i, w in enumerate(words.tolist()):
            out[w] = features[(i + 1) % len(terms)]
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[bytes]) -> list[float]:
        words, features, ends = word_features(texts)
        values = self.weights[features].sum(axis=1)
        out, start = [], 0
        for end in ends.tolist():
            own = values[start:end]
            if end - start > TOP:
                _, first = np.unique(words[start:end], return_index=True)
                own = own[first]
                own = np.partition(own, -TOP)[-TOP:] if len(own) > TOP else own
            elif end > start:
                own = own[np.unique(words[start:end], return_index=True)[1]]
            out.append(1 / (1 + np.exp(-np.clip(self.bias + own.sum(), -60, 60))))
            start = end
        return out


def fit(rows: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, variants: list[tuple[int, np.ndarray]],
        min_docs: int = MIN_DOCS, rounds: int = 120, rate: float = 0.08, l2: float = 2e-4, even: float = 1.0) -> Model:
    """``rows``: each document's distinct words' features; ``variants``: (document, its counterfactual's features)."""
    docs = rows + [v for _, v in variants]
    n, pairs = len(rows), np.array([i for i, _ in variants], dtype=np.int64)
    # only features of several documents are learned: what one text has alone can't be judged
    seen = np.zeros(DIMS, dtype=np.int32)
    toxic = np.zeros(DIMS)
    for r, y in zip(rows, labels):
        own = np.unique(r)
        seen[own] += 1
        toxic[own] += y
    learned = seen >= min_docs
    n_toxic = labels.sum()
    theta = np.where(learned, 0.5 * np.log((toxic + 0.5) / (n_toxic + 1) / ((seen - toxic + 0.5) / (n - n_toxic + 1))), 0)
    theta = np.clip(theta, -1, 1).astype(np.float32)
    flat = np.concatenate(docs) if docs else np.zeros((0, 1 + len(PREFIXES)), np.uint32)
    ends = np.cumsum([len(d) for d in docs])
    share = weights / weights.sum()
    prior = float((share * labels).sum())
    bias = np.log(prior / (1 - prior)) - 1.0
    m, v, mb, vb = np.zeros(DIMS, np.float32), np.zeros(DIMS, np.float32), 0.0, 0.0
    for step in range(1, rounds + 1):
        values = theta[flat].sum(axis=1)
        tops, start = [], 0
        for end in ends.tolist():
            own = values[start:end]
            tops.append(start + (np.argpartition(own, -TOP)[-TOP:] if end - start > TOP else np.arange(end - start)))
            start = end
        counts = np.array([len(t) for t in tops])
        picked = np.concatenate(tops).astype(np.int64)
        owner = np.repeat(np.arange(len(docs)), counts)
        logit = bias + np.bincount(owner, values[picked], minlength=len(docs))
        push = np.zeros(len(docs))
        push[:n] = (1 / (1 + np.exp(-np.clip(logit[:n], -60, 60))) - labels) * share
        if len(pairs):
            gap = 2 * even * (logit[pairs] - logit[n:]) / len(pairs)
            np.add.at(push, pairs, gap)
            push[n:] -= gap
        grad = np.bincount(flat[picked].ravel(), np.repeat(push[owner], flat.shape[1]), minlength=DIMS).astype(np.float32)
        grad = np.where(learned, grad + l2 * theta / 10, 0)
        grad_b = float(push[:n].sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.99 * vb + 0.01 * grad_b**2
        c1, c2 = 1 - 0.9**step, 1 - 0.99**step
        theta = theta - rate * (m / c1) / (np.sqrt(v / c2) + 1e-6)
        bias -= rate * (mb / c1) / ((vb / c2) ** 0.5 + 1e-6)
    return Model(theta.astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, most: int = 4000, modulus: int = 3, held_out: int = 1) -> Model:
    """Fit on at most ``most`` toxic and ``most`` other labelled documents outside the held-out fold."""
    ids = labelled_ids(labels, "toxic", fold(modulus) != held_out)
    sizes = {r.label: r["count"] for r in ids.groupBy("label").count().collect()}
    sample = texts_of(docs, first_by_hash(ids.filter("label = 1"), most).union(first_by_hash(ids.filter("label = 0"), most)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            for lo, hi in slices(texts):
                words, features, ends = word_features(texts[lo:hi])
                w, f, start = [], [], 0
                for end in ends.tolist():
                    own, first = np.unique(words[start:end], return_index=True)
                    w.append(own.tobytes())
                    f.append(features[start:end][first].tobytes())
                    start = end
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo).cast(pa.int32()), pa.array(w, pa.binary()), pa.array(f, pa.binary())], names=["doc_id", "label", "words", "features"])

    got = sample.select("doc_id", "label", "text").mapInArrow(work, "doc_id long, label int, words binary, features binary").toArrow().sort_by("doc_id")
    y = np.array(got.column("label").to_pylist(), dtype=np.float64)
    if not (0 < y.sum() < len(y)):
        return Model(np.zeros(DIMS, np.float32), -60.0 if not y.sum() else 60.0)
    width = 1 + len(PREFIXES)
    words = [np.frombuffer(w, np.uint64) for w in got.column("words").to_pylist()]
    rows = [np.frombuffer(f, np.uint32).reshape(-1, width) for f in got.column("features").to_pylist()]
    weight = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (len(y) - y.sum()))
    to_swap = swaps()
    terms = np.array(list(to_swap), dtype=np.uint64)
    variants = []
    for i, (w, r) in enumerate(zip(words, rows)):
        named = np.flatnonzero(np.isin(w, terms))
        if len(named):  # each named group becomes the next of its kind
            other = r.copy()
            for k in named.tolist():
                other[k] = to_swap[int(w[k])]
            variants.append((i, other))
        elif i % 8 == 0:  # the document with a term put in
            variants.append((i, np.concatenate([r, to_swap[int(terms[i // 8 % len(terms)])][None]])))
    return fit(rows, y, weight, variants)


def score(docs: DataFrame, model: Model, modulus: int = 3, held_out: int = 1, cut: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text; a null or empty text has the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column(2).cast(pa.binary()).to_pylist()]
            out: list[float] = []
            for lo, hi in slices(texts):
                out += shared.value.scores(texts[lo:hi])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.float64())], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), (fold(modulus) == held_out).alias("held_out"), "text")
    return (rows.mapInArrow(work, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= cut).cast("int")))


def classify(docs: DataFrame, labels: DataFrame, most: int = 4000) -> DataFrame:
    """Fit on the labelled sample, score all documents.  No labels or one class only: a constant score."""
    return score(docs, train(docs, labels, most))
