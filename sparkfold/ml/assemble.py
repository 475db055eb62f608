"""Feature assembly by column role, sparse and with names (G6), and selection by name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame

from sparkfold.functions import exprs
from sparkfold.operators import encode, impute, scale


def assemble(df: DataFrame, num_cols: Sequence[str], cat_cols: Sequence[str], where: str, out: str = "features") -> DataFrame:
    """Add one feature vector, fitted on the rows of ``where``.

    Numerics: missing takes the median, then (x - mean) / population standard deviation
    (1 where that is 0).  Categoricals: missing counts as ``Missing``, one-hot without
    centring, so the vector stays sparse; a value that the fitted rows lack is all zeros.
    Columns that are in neither list are not used.  The names of the vector's places are in
    its metadata, see :func:`feature_names`: the numeric column, or ``<column>_ohe_<value>``.
    """
    raw = {c: f"_raw_{c}" for c in num_cols}
    work = df.withColumns({r: df[c].cast("double") for c, r in raw.items()})
    work = impute.apply_fill(work, impute.fit_median(work, list(raw.values()), where=where), list(raw.values()))
    work = scale.apply_standard(work, scale.fit_standard(work, list(raw.values()), where=where), list(raw.values()))
    cats = {c: f"_cat_{c}" for c in cat_cols}
    work = exprs.fill_constant(work.withColumns({n: df[c].cast("string") for c, n in cats.items()}), list(cats.values()), "Missing")
    work = encode.onehot_model(work.where(where), list(cats.values())).transform(work)
    # the assembler names places after its inputs: give them the columns' own names
    hot = {f"{n}_ohe": f"{c}_ohe" for c, n in cats.items()}
    inputs = {**{r: c for c, r in raw.items()}, **hot}
    both = work.select(*[work[c].alias(f"_own_{c}") for c in df.columns], *[work[c].alias(name) for c, name in inputs.items()])
    vector = VectorAssembler(inputCols=[*num_cols, *hot.values()], outputCol="_vector", handleInvalid="keep").transform(both)
    return vector.select(*[vector[f"_own_{c}"].alias(c) for c in df.columns], vector["_vector"].alias(out))


def feature_names(df: DataFrame, col: str = "features") -> list[str]:
    """Names of a vector column's places, from its metadata."""
    groups = df.schema[col].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])]


def top_names(importances: Sequence[float], names: Sequence[str], k: int) -> list[tuple[int, str, float]]:
    """(rank, name, importance) of the k most important features, ties by place; k is capped at their number."""
    order = sorted(range(len(names)), key=lambda i: (-float(importances[i]), i))[:k]
    return [(r + 1, names[i], float(importances[i])) for r, i in enumerate(order)]


def select_features(df: DataFrame, names: Sequence[str], col: str = "features", out: str = "selected") -> DataFrame:
    """The named places of a vector column, in the given order; an unknown name is an error."""
    return VectorSlicer(inputCol=col, outputCol=out, names=list(names)).transform(df)
