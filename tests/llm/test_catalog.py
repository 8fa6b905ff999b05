import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402

from zonalis.llm import catalog  # noqa: E402
from zonalis.session import drop_staged  # noqa: E402


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_rows_as_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    status, note = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], sf_small)
    drop_staged(spark)
    assert status == "ok", note


def test_every_operator_has_one_query():
    names = [n.split("_")[0] for n in contract.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in contract.queries()
