"""Driver contract and a DuckDB oracle pass at sf0.001."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry_mod  # noqa: E402
from tickbar.plans.catalog import QUERIES as CATALOG  # noqa: E402
from tools.oracle_check import TABLES, digest  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["symbol", "trade_date", "open", "high", "low", "close", "volume"]
    assert df.count() > 0


def test_keys():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert set(CATALOG) - set(o) == {"forecast_gbt", "model_comparison_gbt"}  # grown trees: no SQL; tests of their own


def test_without_the_optional_folder(tmp_path):
    root = os.path.dirname(os.path.abspath(entry_mod.__file__))
    shutil.copytree(os.path.join(root, "tickbar"), tmp_path / "tickbar", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(entry_mod.__file__, tmp_path)
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    assert told.split() == [str(len(CATALOG)), str(len(CATALOG) - 2)]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_oracle_matches(spark, con, name):
    df = entry_mod.queries()[name](spark, SMOKE)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
