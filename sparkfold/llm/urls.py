"""URL filter: explicit rules first, else logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS = 1 << 16
SIZES = (4, 5)
#: How much host and path count.
SHARES = (1.0, 0.15)
A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Folds of whole hosts that set the threshold, and the share of allowed hosts it may block there.
FOLDS, FALSE_SHARE = 5, 0.05


def labelled_table() -> list[tuple[str, int]]:
    """The small table beside this file that the model learns from by default: (url without scheme, 1 = to be blocked)."""
    with open(Path(__file__).with_name("url_labels.csv"), encoding="utf-8", newline="") as f:
        return [(r["url"], int(r["blocked"])) for r in csv.DictReader(f)]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path: from there up to
    ``?``, ``#`` or the end.  Both empty without ``://`` and for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, A_Z, a_z), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule ``host/path`` that fits, else nulls.

    A rule fits its host and all subdomains where the path starts with its own.
    Of equally long rules the alphabetically first wins.
    """
    rule = verdict = F.lit(None).cast("string")
    for text, action in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        own_host, _, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def grams(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of the host and of the path; digits count as one.

    A host falls into words at dots and hyphens; its n-grams do not cross them, and a whole
    word is one more, so a word means the same in any host.
    """
    out = []
    for kind, words in (("h", re.split(r"[.-]", host)), ("p", [path])):
        own = set()
        for word in words:
            text = "^" + "".join("0" if c.isdigit() else c for c in word.lower()) + "$"
            own.update(f"{kind}{text[i:i + n]}" for n in SIZES for i in range(len(text) - n + 1))
            if kind == "h":
                own.add(f"w{text}")
        out.append(np.unique(np.array([xxhash.xxh32_intdigest(g) % DIMS for g in own], dtype=np.int64)))
    return out[0], out[1]


def logit(model: tuple[np.ndarray, float], host: str, path: str) -> float:
    w, b = model
    return sum(w[g].sum() / max(1, len(g)) ** 0.5 * share for g, share in zip(grams(host, path), SHARES)) + b


def split_url(url: str) -> tuple[str, str]:
    """Host and path of a url without scheme."""
    host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", url).groups()
    return host.lower(), path


def learn(labelled: list[tuple[str, int]], rounds: int = 600, rate: float = 1.0, l2: float = 0.0005) -> tuple[np.ndarray, float]:
    """Weights and bias of the logistic regression."""
    x = np.zeros((len(labelled), DIMS), dtype=np.float32)
    for i, (url, _) in enumerate(labelled):
        for g, share in zip(grams(*split_url(url)), SHARES):
            x[i, g] += share / max(1, len(g)) ** 0.5
    y = np.array([v for _, v in labelled], dtype=np.float64)
    used = np.flatnonzero(x.any(axis=0))
    x, w, b = x[:, used].astype(np.float64), np.zeros(len(used)), 0.0
    for _ in range(rounds):
        g = 1 / (1 + np.exp(-(x @ w + b))) - y
        w -= rate * (x.T @ g / len(y) * 4 + l2 * w)
        b -= rate * g.mean()
    out = np.zeros(DIMS)
    out[used] = w
    return out, b


def held_out_logits(labelled: list[tuple[str, int]], folds: int = FOLDS) -> np.ndarray:
    """Each row's logit from a model that saw no url of its host's registered name."""
    names = [".".join(split_url(u)[0].split(".")[-3:]) for u, _ in labelled]
    fold = np.array([xxhash.xxh32_intdigest(n) % folds for n in names])
    out = np.zeros(len(labelled))
    for f in range(folds):
        model = learn([row for row, k in zip(labelled, fold) if k != f])
        for i in np.flatnonzero(fold == f):
            out[i] = logit(model, *split_url(labelled[i][0]))
    return out


def fit(labelled: list[tuple[str, int]], false_share: float = FALSE_SHARE) -> tuple[np.ndarray, float, float]:
    """(weights, bias, threshold on the probability): the lowest threshold at which at most ``false_share`` of the
    allowed urls would be blocked by models that did not see their hosts."""
    w, b = learn(labelled)
    allowed = np.sort([z for z, (_, v) in zip(held_out_logits(labelled), labelled) if not v])
    if not len(allowed) or len(allowed) == len(labelled):
        return w, b, 0.5
    edge = allowed[max(0, int(np.ceil(len(allowed) * (1 - false_share))) - 1)]
    return w, b, float(np.nextafter(1 / (1 + np.exp(-edge)), 1.0))


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: list[tuple[str, int]] | None = None, block_at: float | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row of ``pages``.

    ``verdict`` is the fitting rule's, else ``block`` where the model's probability
    is ``block_at`` or more (None: the threshold that :func:`fit` finds).  Null urls and such without ``://`` have empty host and
    path and are judged by the model's bias on them.  An empty labelled table
    blocks nothing by itself.
    """
    table = labelled_table() if labelled is None else labelled
    w, b, threshold = fit(table) if table else (np.zeros(DIMS), -60.0, 0.5)
    block_at = threshold if block_at is None else block_at
    shared = pages.sparkSession.sparkContext.broadcast((w, b))
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [logit(shared.value, h, p) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            score = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=np.float64), -60, 60)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=["page_id", "host", "path", "score"])

    scored = rows.mapInArrow(work, "page_id long, host string, path string, score double")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") >= block_at, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "score")
