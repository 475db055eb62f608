"""Column expressions: cleaning, casts, text normalisation, thresholds.

All of these are plain Catalyst expressions - they stay inside whole-stage
codegen and never call Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonfinite_to_null(c: str | Column) -> Column:
    """NaN, +inf, -inf -> NULL (C1).  SQL NULL is the only missing marker."""
    x = col(c)
    return F.when(F.isnan(x) | (x == F.lit(float("inf"))) | (x == F.lit(float("-inf"))),
                  F.lit(None).cast("double")).otherwise(x)


def try_double(c: str | Column) -> Column:
    """Coercing numeric cast: bad text -> NULL (C2); non-finite -> NULL."""
    return nonfinite_to_null(col(c).cast("string").try_cast("double"))


def clean_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """C1 + C2 over the columns that exist (B2)."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: try_double(c) for c in present})


def norm_text(c: str | Column) -> Column:
    """strip + lower of the text form."""
    return F.lower(F.trim(col(c).cast("string")))


def fill_constant(df: DataFrame, cols: Iterable[str], value: str = "Missing") -> DataFrame:
    """Text constant fill (C10): NULL -> ``value``, everything else as text."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in present})


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL when b is 0 or NULL (numpy would give inf; inf is missing here)."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def ratio_plus_one(a: str | Column, b: str | Column) -> Column:
    """a / (b + 1) - the shape of every ratio feature."""
    return safe_div(a, col(b).cast("double") + F.lit(1.0))


def log1p_guarded(c: str | Column) -> Column:
    """log1p for x > -1, NULL otherwise."""
    x = col(c).cast("double")
    return F.when(x > -1, F.log1p(x))


def threshold_label(p: str | Column, t: float | Column, pos: str = "1", neg: str = "0") -> Column:
    """(p >= t) -> class name."""
    tt = t if isinstance(t, Column) else F.lit(float(t))
    return F.when(col(p) >= tt, F.lit(pos)).otherwise(F.lit(neg))


def threshold_tag(t: Column, digits: int = 4) -> Column:
    """Threshold formatted for a file tag, '.' -> 'p' (D20)."""
    return F.replace(F.format_string(f"%.{digits}f", t.cast("double")), F.lit("."), F.lit("p"))


def grid(start_int: int, stop_int: int, denom: float) -> Column:
    """Threshold grid as i / denom (D18): built the same way in every engine."""
    return F.transform(F.sequence(F.lit(start_int), F.lit(stop_int)),
                       lambda i: i.cast("double") / F.lit(float(denom)))


def round_cols(df: DataFrame, digits: int = 6, cols: Sequence[str] | None = None) -> DataFrame:
    """Round double columns for reporting."""
    names = cols if cols is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(F.col(c), digits) for c in names})
