"""Declarative engineered features (D1-D15) and fixed-edge bins.

A feature is ``(name, inputs, builder)``.  :func:`add_features` emits a
feature only when all its inputs exist (B2) - so one spec list serves data
that lacks some columns - and adds everything in one projection chain that
Catalyst collapses into a single ``Project``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfold.functions.exprs import log1p_guarded, norm_text, ratio_plus_one, safe_div


@dataclass(frozen=True)
class Feature:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., Column]
    optional: dict[str, float] = field(default_factory=dict)  # input -> default when absent (B3)


def add_features(df: DataFrame, specs: Sequence[Feature]) -> DataFrame:
    """Add every feature whose required inputs are present, in spec order."""
    out = df
    for s in specs:
        cols = set(out.columns)
        if not all(i in cols or i in s.optional for i in s.inputs):
            continue
        args = [F.col(i) if i in cols else F.lit(float(s.optional[i])) for i in s.inputs]
        out = out.withColumn(s.name, s.build(*args))
    return out


def _ratio(name: str, a: str, b: str) -> Feature:
    return Feature(name, (a, b), ratio_plus_one)


def _prod(name: str, a: str, b: str) -> Feature:
    return Feature(name, (a, b), lambda x, y: x.cast("double") * y.cast("double"))


def _diff(name: str, a: str, b: str) -> Feature:
    return Feature(name, (a, b), lambda x, y: x.cast("double") - y.cast("double"))


# --- D1: ratio family F, each a / (b + 1) -----------------------------------
RATIOS_F = [
    _ratio("experience_ratio", "years_with_startup", "founder_age"),
    _ratio("funding_per_year", "funding_rounds_led", "years_since_founding"),
    _ratio("revenue_per_year", "monthly_revenue_generated", "years_since_founding"),
    _ratio("dependents_ratio", "num_dependents", "founder_age"),
    _ratio("distance_adjusted", "distance_from_investor_hub", "years_since_founding"),
]

# --- D2: pooled-frame ratios --------------------------------------------------
RATIOS_F_POOLED = [
    _ratio("revenue_per_year", "monthly_revenue_generated", "years_since_founding"),
    _ratio("dependents_ratio", "num_dependents", "founder_age"),
    _ratio("tenure_ratio", "years_with_startup", "years_since_founding"),
    _ratio("age_per_dependent", "founder_age", "num_dependents"),
]

# --- D3: differences ----------------------------------------------------------
DIFFERENCES = [
    _diff("age_at_founding", "founder_age", "years_since_founding"),
    _diff("balance_gap", "stress_level", "work_life_balance_rating"),
]

# --- D4: log ---------------------------------------------------------------
LOGS = [Feature("monthly_revenue_log", ("monthly_revenue_generated",), log1p_guarded)]

# --- D5 / D6: ratio family S -----------------------------------------------------
RATIOS_S = [
    _ratio("stress_per_hour", "stress_level", "hours_worked_per_week"),
    _ratio("revenue_per_member", "revenue", "team_size"),
    _ratio("funding_per_member", "funding_amount", "team_size"),
    _ratio("salary_revenue_ratio", "salary", "revenue"),
    _ratio("workload_ratio", "hours_worked_per_week", "work_life_balance_rating"),
    _ratio("revenue_div_salary", "revenue", "salary"),
    _ratio("funding_div_revenue", "funding_amount", "revenue"),
]

# --- D7: products ------------------------------------------------------------
PRODUCTS_S = [
    _prod("stress_x_hours", "stress_level", "hours_worked_per_week"),
    _prod("salary_x_stress", "salary", "stress_level"),
]

# --- D8: rating text -> ordinal, strip + lower, unmapped -> NULL ----------------
# Fixed values (must equal the reference's maps).
RATING_MAP = {"poor": 1, "average": 2, "medium": 2, "good": 3, "excellent": 4}
SATISFACTION_MAP = {"low": 1, "medium": 2, "neutral": 2, "high": 3, "satisfied": 3}
REPUTATION_MAP = {"poor": 1, "fair": 2, "moderate": 2, "good": 3, "excellent": 4,
                  "high": 4, "low": 1}
VISIBILITY_MAP = {"low": 1, "medium": 2, "high": 3}

# --- D9: one case-sensitive map, unmapped or missing -> 1 -----------------------
# Fixed values (must equal the reference's map).
RATING_MAP_CASED = {"Poor": 0, "Fair": 1, "Average": 1, "Moderate": 1, "Good": 2,
                    "Very Good": 3, "Excellent": 4, "High": 3, "Medium": 2, "Low": 1,
                    "Satisfied": 3, "Neutral": 2, "Dissatisfied": 1}

SCORE_SOURCES = [  # output, input column, map for D8
    ("wlb_score", "work_life_balance_rating", RATING_MAP),
    ("satisfaction_score", "venture_satisfaction", SATISFACTION_MAP),
    ("performance_score", "startup_performance_rating", RATING_MAP),
    ("reputation_score", "startup_reputation", REPUTATION_MAP),
    ("visibility_score", "founder_visibility", VISIBILITY_MAP),
]


def map_literal(mapping: dict[str, float]) -> Column:
    """A constant-folded map literal."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(float(v))]
    return F.create_map(*kv)


def ordinal(c: Column, mapping: dict[str, float]) -> Column:
    """Normalised text looked up in a literal map; unmapped -> NULL."""
    return F.try_element_at(map_literal(mapping), norm_text(c))


def ordinal_default(c: Column, mapping: dict[str, float], default: float = 1.0) -> Column:
    """Exact-text lookup, unmapped or missing -> default."""
    return F.coalesce(F.try_element_at(map_literal(mapping), c.cast("string")), F.lit(default))


ORDINAL_SCORES = [Feature(o, (i,), (lambda m: lambda c: ordinal(c, m))(m)) for o, i, m in SCORE_SOURCES]
ORDINAL_SCORES_DEFAULT = [
    Feature(o, (i,), lambda c: ordinal_default(c, RATING_MAP_CASED)) for o, i, _ in SCORE_SOURCES]

# --- D10: yes-flags -------------------------------------------------------------
FLAG_SOURCES = ["working_overtime", "remote_operations", "innovation_support"]


def yes_flag(c: Column) -> Column:
    """lower(text) == 'yes' -> 1, anything else or missing -> 0."""
    return F.coalesce((F.lower(c.cast("string")) == F.lit("yes")).cast("int"), F.lit(0))


FLAGS = [Feature(f"{c}_flag", (c,), yes_flag) for c in FLAG_SOURCES]

# --- D11: flag / score interactions (pooled frame, D9 scores) ------------------
INTERACTIONS_POOLED = [
    _prod("remote_and_overtime", "remote_operations_flag", "working_overtime_flag"),
    _prod("wlb_overtime_interaction", "wlb_score", "working_overtime_flag"),
    _prod("satisfaction_performance_interaction", "satisfaction_score", "performance_score"),
    _prod("reputation_visibility_interaction", "reputation_score", "visibility_score"),
]

# --- D12 / D14: score interactions (D8 scores); absent inputs count as 0 (B3) ---
INTERACTIONS = [
    Feature("stress_factor", ("wlb_score",), lambda w: safe_div(F.lit(1.0), w + F.lit(1.0))),
    Feature("satisfaction_x_visibility", ("satisfaction_score", "visibility_score"),
            lambda a, b: a * b, optional={"satisfaction_score": 0.0, "visibility_score": 0.0}),
    Feature("performance_x_reputation", ("performance_score", "reputation_score"),
            lambda a, b: a * b, optional={"performance_score": 0.0, "reputation_score": 0.0}),
    _prod("investment_distance_risk", "distance_adjusted", "performance_score"),
]

# --- D15: conjunctive rule flags; any missing input -> 0 -------------------------


def all_true(*conds: Column) -> Column:
    acc = conds[0]
    for c in conds[1:]:
        acc = acc & c
    return F.coalesce(acc, F.lit(False)).cast("int")


RULE_FLAGS = [
    Feature("high_risk_flag", ("wlb_score", "satisfaction_score", "performance_score"),
            lambda w, s, p: all_true(w <= 2, s <= 2, p <= 2)),
    Feature("high_stable_flag", ("wlb_score", "satisfaction_score", "performance_score"),
            lambda w, s, p: all_true(w >= 3, s >= 2, p >= 3)),
]

# --- E1 / E2: fixed-edge bins, right-closed, lowest edge included -------------
# Fixed values (edges and labels must equal the reference's).
AGE_EDGES_LABELLED = [0, 25, 35, 45, 60, 100]
AGE_LABELS = ["very_young", "young", "mid", "senior", "old"]
YSF_EDGES_LABELLED = [-1, 1, 3, 5, 10, 100]
YSF_LABELS = ["new", "early", "growing", "mature", "old"]
AGE_EDGES_CODED = [0, 30, 40, 50, 60, 100]
YWS_EDGES_CODED = [-1, 3, 7, 15, 100]
YSF_EDGES_CODED = [-1, 2, 5, 10, 100]


def cut(c: Column, edges: Sequence[float], labels: Sequence | None = None,
        include_lowest: bool = True, outside=None) -> Column:
    """Right-closed bins (a, b]; the first bin also holds its left edge.

    Returns the label (or code 0..k-1); outside / missing -> ``outside``.
    """
    x = c.cast("double")
    vals = list(labels) if labels is not None else list(range(len(edges) - 1))
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        cond = ((x >= lo) if (i == 0 and include_lowest) else (x > lo)) & (x <= hi)
        expr = F.when(cond, F.lit(vals[i])) if expr is None else expr.when(cond, F.lit(vals[i]))
    return expr.otherwise(F.lit(outside))


BINS_LABELLED = [
    Feature("founder_age_bin", ("founder_age",), lambda c: cut(c, AGE_EDGES_LABELLED, AGE_LABELS)),
    Feature("years_since_founding_bin", ("years_since_founding",),
            lambda c: cut(c, YSF_EDGES_LABELLED, YSF_LABELS)),
]
BINS_CODED = [
    Feature("founder_age_bin", ("founder_age",), lambda c: cut(c, AGE_EDGES_CODED, outside=-1)),
    Feature("years_with_startup_bin", ("years_with_startup",),
            lambda c: cut(c, YWS_EDGES_CODED, outside=-1)),
    Feature("years_since_founding_bin", ("years_since_founding",),
            lambda c: cut(c, YSF_EDGES_CODED, outside=-1)),
]

# Named bundles matching the reference's feature functions.
ENGINEER_TUNED = RATIOS_F + ORDINAL_SCORES + INTERACTIONS[:3]   # + revenue_pressure (needs codes)
ENGINEER_POOLED = BINS_CODED + LOGS + RATIOS_F_POOLED + DIFFERENCES[:1] + ORDINAL_SCORES_DEFAULT \
    + FLAGS + INTERACTIONS_POOLED
ENGINEER_S = RATIOS_S + PRODUCTS_S + DIFFERENCES[1:]
