"""Every registered query at the smallest scale, against its check SQL where it has one."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from tests.conftest import SMALL

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# Long fits are left to check.py; these tests cover the same code with lighter settings.
HEAVY = {
    "q_ml_gbt", "q_ml_forest", "q_ml_train_all", "q_ml_factory", "q_ml_importance", "q_snk_model", "q_ev_balance_compare",
}
# The training-data queries have tests of their own in tests/llm.
HEAVY |= {k for k in QUERIES if not k.startswith("q_")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        path = Path(SMALL) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="module")
def results(spark):
    """All queries, a few at a time: at this scale most of each is planning, which overlaps well."""

    def run(key):
        df = QUERIES[key](spark, SMALL)
        return df.columns, [tuple(r) for r in df.collect()]

    with ThreadPoolExecutor(6) as pool:
        yield {key: pool.submit(run, key) for key in QUERIES if key not in HEAVY}


@pytest.mark.parametrize("key", sorted(set(ORACLES) - HEAVY))
def test_matches_check_sql(results, duck, key):
    columns, rows = results[key].result()
    got, names = rows_of(columns, rows)
    result = duck.execute(ORACLES[key])
    want, expected = rows_of([d[0] for d in result.description], result.fetchall())
    assert names == expected
    assert got == want


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES) - HEAVY))
def test_returns_rows(results, key):
    _, rows = results[key].result()
    assert rows


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0]["churn_rate"] >= rows[-1]["churn_rate"]
