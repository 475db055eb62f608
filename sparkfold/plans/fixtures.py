"""Stand-in views built from the driver's tables.

Each view is one SQL text that both Spark (``spark.sql(text, name=DataFrame)``)
and DuckDB (a ``WITH`` chain over the pre-registered tables) run unchanged, so
the operator under test is the only thing that differs between the engine and
its oracle.  Fold columns are produced by ``sparkfold.operators.split`` on the
Spark side and by a window in the oracle.

Views
-----
entity_base   one row per customer, target ``status`` (Left / Stayed)
founder_base  entity_base renamed onto the reference's family-F columns
founder_s     order_base renamed onto the family-S columns
order_base    one row per order, lineitem aggregates by a left join
quality_base  documents joined with labels
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SEED = 42
N_FOLDS = 5

# ---------------------------------------------------------------------------
# Shared SQL texts.  ``{name}`` refers to a table or an earlier view.
# ---------------------------------------------------------------------------
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}

VIEWS["entity_base"] = (("orders", "customer", "nation", "region"), """
with o as (
  select o_custkey, count(*) n_orders, avg(o_totalprice) avg_price,
         sum(o_totalprice) total_spend, max(o_orderdate) last_order
  from {orders} group by o_custkey)
select c_custkey id,
       case when c_custkey % 7  = 0 then null else c_acctbal    end acctbal,
       n_orders, avg_price, total_spend,
       case when c_custkey % 11 = 0 then null else c_mktsegment end segment,
       n_name nation, r_name region,
       case when last_order >= timestamp '2000-12-24' then 'Stayed' else 'Left' end status
from {customer} join o on o_custkey = c_custkey
join {nation} on n_nationkey = c_nationkey
join {region} on r_regionkey = n_regionkey
""")

VIEWS["order_base"] = (("orders", "lineitem"), """
with li as (
  select l_orderkey, sum(l_quantity) sum_qty, avg(l_discount) avg_disc,
         count(*) n_lines
  from {lineitem} group by l_orderkey)
select o_orderkey id, o_totalprice, o_orderpriority,
       cast((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 as bigint) month_idx,
       sum_qty, avg_disc, n_lines,
       cast(case when o_orderstatus = 'F' then 1 else 0 end as int) status
from {orders} left join li on l_orderkey = o_orderkey
""")

VIEWS["quality_base"] = (("documents", "labels"), """
select d.doc_id id, d.lang, d.source, d.n_chars, l.quality
from {documents} d join {labels} l on l.doc_id = d.doc_id
""")

# Family-F columns of the reference, filled from entity_base.  Text columns
# carry the messy spellings the rating maps must handle (case, blanks, junk).
VIEWS["founder_base"] = (("entity_base",), """
select id founder_id,
  case when id % 13 = 0 then null else cast(n_orders * 4 as double) end founder_age,
  cast(n_orders % 10 as double) years_with_startup,
  case when id % 17 = 0 then null else avg_price / 997.0 end monthly_revenue_generated,
  cast(n_orders % 5 as double) funding_rounds_led,
  acctbal / 100.0 distance_from_investor_hub,
  cast(n_orders % 4 as double) num_dependents,
  total_spend / 190000.0 years_since_founding,
  case when id % 19 = 0 then null
       when n_orders <= 6 then 'Poor' when n_orders <= 9 then ' average'
       when n_orders <= 11 then 'Good ' when n_orders <= 14 then 'EXCELLENT'
       when n_orders <= 17 then 'Medium' else '??' end work_life_balance_rating,
  case region when 'AFRICA' then 'Low' when 'AMERICA' then 'Medium' when 'ASIA' then 'High'
       when 'EUROPE' then 'Neutral' else 'Satisfied' end venture_satisfaction,
  case when avg_price < 200000 then 'Poor' when avg_price < 240000 then 'Average'
       when avg_price < 280000 then 'Good' else 'Excellent' end startup_performance_rating,
  case when acctbal is null then null when acctbal < 0 then 'Poor' when acctbal < 2500 then 'Fair'
       when acctbal < 5000 then 'Moderate' when acctbal < 7500 then 'Good'
       else 'Excellent' end startup_reputation,
  case when total_spend < 2000000 then 'Low' when total_spend < 3000000 then 'Medium'
       else 'High' end founder_visibility,
  segment founder_role,
  nation education_background,
  region personal_status,
  case n_orders % 3 when 0 then 'Seed' when 1 then 'Growth' else 'Mature' end startup_stage,
  case when id % 23 = 0 then null when n_orders < 8 then 'Small'
       when n_orders < 12 then 'Medium' else 'Large' end team_size_category,
  case when id % 2 = 0 then 'Male' else 'Female' end founder_gender,
  case when n_orders > 10 then 'Yes' else 'No' end working_overtime,
  case when acctbal is null then null when acctbal > 5000 then 'yes' else 'No' end remote_operations,
  case when avg_price > 250000 then 'YES' else 'no' end innovation_support,
  status retention_status
from {entity_base}
""")

# Family-S columns (numeric work-life rating), filled from order_base.
VIEWS["founder_s"] = (("order_base",), """
select id founder_id,
  avg_disc * 100.0 stress_level,
  sum_qty hours_worked_per_week,
  o_totalprice / 997.0 revenue,
  cast(n_lines as double) team_size,
  cast(month_idx as double) funding_amount,
  cast(month_idx % 12 as double) * 1000.0 + 500.0 salary,
  cast(substr(o_orderpriority, 1, 1) as double) work_life_balance_rating,
  status
from {order_base}
""")


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out or n in TABLES:
            return
        for d in VIEWS[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def duck_with(*names: str) -> str:
    """``WITH`` prefix defining the given views (and their dependencies) for DuckDB."""
    parts = []
    for n in _order(list(names)):
        deps, text = VIEWS[n]
        parts.append(f"{n} AS ({text.format(**{d: d for d in deps}).strip()})")
    return "WITH " + ",\n".join(parts) + "\n"


def duck_fold_expr(key: str = "id", label: str = "status", seed: int = SEED, k: int = N_FOLDS) -> str:
    """Oracle form of the stratified hash fold (see operators.split)."""
    return (f"cast((row_number() over (partition by {label} order by "
            f"md5(cast({key} as varchar) || '|{seed}'), {key}) - 1) % {k} as int)")


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a stand-in view lazily from the parquet tables."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    deps, text = VIEWS[name]
    args = {d: view(spark, sf_dir, d) for d in deps}
    return spark.sql(text, **args)


# md5-derived uniform in [0, 1): first 6 hex digits / 16^6.
def spark_u(expr: str) -> str:
    return f"cast(conv(substr(md5({expr}), 1, 6), 16, 10) as double) / 16777216.0D"


def duck_u(expr: str) -> str:
    return f"cast(('0x' || substr(md5({expr}), 1, 6)) as bigint) / 16777216.0"
