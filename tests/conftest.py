import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sparkfold.session import get_spark
    return get_spark(master="local[*]", shuffle_partitions=8)


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from sparkfold.plans import fixtures as fx
    con = duckdb.connect()
    for t in fx.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con
