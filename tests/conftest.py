from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from leafmill.session import get_spark

    s = get_spark("tests", "local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def compare(spark):
    """compare(name): rows of a query on the smallest test tables, and of its SQL in DuckDB; skipped without the tables."""
    import duckdb

    import __spark_entry__ as e

    if not DATA.exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")

    def run(name: str):
        df = e.queries()[name](spark, str(DATA))
        cols = sorted(df.columns)
        plain = lambda rows: sorted(tuple(f"{v:.6g}" if isinstance(v, float) else str(v) for v in r) for r in rows)
        mine = plain(df.select(*cols).collect())
        rel = con.sql(e.oracle_sql()[name])
        assert sorted(rel.columns) == cols
        return mine, plain(rel.select(*(f'"{c}"' for c in cols)).fetchall())

    return run
