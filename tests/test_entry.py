"""Driver contract: every registered query runs on sf0.001, and those with an oracle agree with it."""

import sys
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import duckdb
import __spark_entry__ as E
from conftest import SF001

sys.path.insert(0, str(Path(E.__file__).parent / "tools"))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 1 and "target_rate" in df.columns


def test_every_oracle_has_a_query():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 100


def test_every_query_runs_and_agrees_with_its_oracle(spark, monkeypatch):
    """The library's own queries (those of ``llm`` have tests there); boosting is cut to two rounds here."""
    from check_oracle import canon

    from sparkfold.ml import boosting
    from sparkfold.plans import catalog, fixtures as fx
    boost = boosting.boost
    monkeypatch.setattr(boosting, "boost", lambda *a, **kw: boost(*a, **{**kw, "rounds": min(2, kw["rounds"])}))
    con = duckdb.connect()
    for t in fx.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()

    def check(name):
        try:
            got = qs[name](spark, SF001).toPandas()
            if name in sqls and canon(got) != canon(con.cursor().execute(sqls[name]).df()):
                return f"{name}: another result than its oracle"
            return None if len(got.columns) else f"{name}: no columns"
        except Exception as e:
            return f"{name}: {type(e).__name__} {str(e)[:200]}"

    with ThreadPoolExecutor(6) as pool:
        wrong = [w for w in pool.map(check, catalog.load_all()) if w]
    assert not wrong, wrong
