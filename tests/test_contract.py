import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402

SMALL = "/root/testdata/sf0.001"
# every SQL-checked query with ZONALIS_ALL=1, a cross-section otherwise
CORE = """date_spine risk_binning temporal_features urbanization_index zone_summary kpis last_state panel_profile
classification_report residual_histogram engineer_features rolling_zscore gap_fill expanding_folds stratified_folds
bounded_balance residual_acf recursive_forecast scenario_projection idw_exact whatif_vector""".split()
NAMES = sorted(contract.oracle_sql()) if os.environ.get("ZONALIS_ALL") else CORE


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES.split():
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, con, name):
    status, note = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SMALL)
    assert status == "ok", note


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 25


def test_some_cells_are_exact_hits(con):
    sql = contract.oracle_sql()["idw_exact"]
    inner = sql[: sql.rindex("SELECT ix, iy, (round")] + "SELECT count(*) FROM mesh, points WHERE x = gx AND y = gy"
    assert con.execute(inner).fetchall()[0][0] > 0
