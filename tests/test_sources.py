import pytest
from helpers import make_panel

from zonalis.operators import selection
from zonalis.plans import catalog
from zonalis.session import drop_staged, fresh_path, shared_dir, stage
from zonalis.sources import panel as io
from zonalis.sources import tables

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_missing_path_is_an_error_unless_asked_for(spark):
    path = fresh_path(spark, "nothing")
    with pytest.raises(FileNotFoundError):
        io.read_panel(spark, path)
    empty = io.read_panel(spark, path, empty_if_missing=True)
    assert empty.columns == io.PANEL_COLUMNS and empty.count() == 0


def test_globs_name_partitions(spark):
    path = fresh_path(spark, "years")
    io.write_panel(make_panel(spark, zones=3, months=30), path, by_year=True)
    assert io.read_panel(spark, f"{path}/year=*").count() == 90


def test_csv_columns_must_be_the_declared_ones(spark):
    path = fresh_path(spark, "swapped")
    panel = make_panel(spark, zones=2, months=3)
    swapped = panel.select(*[{"latitude": "longitude", "longitude": "latitude"}.get(c, c) for c in panel.columns])
    swapped.write.option("header", True).csv(path)
    with pytest.raises(Exception):
        io.read_panel(spark, path, "csv").collect()


def test_round_trips(spark):
    panel = make_panel(spark, zones=2, months=14)
    want = sorted(panel.collect())
    for fmt, by_year in [("parquet", False), ("parquet", True), ("csv", False)]:
        path = fresh_path(spark, fmt)
        io.write_panel(panel, path, fmt, by_year)
        assert sorted(io.read_panel(spark, path, fmt).collect()) == want


def test_filters_and_columns_reach_the_scan(spark):
    path = fresh_path(spark, "pushed")
    io.write_panel(make_panel(spark, zones=3, months=14), path)
    sliced = selection.in_zones(selection.in_year(io.read_panel(spark, path), 2000), ["Zone 1"])
    text = plan(sliced.select("groundwater_level"))
    assert "PushedFilters" in text and "GreaterThanOrEqual(date" in text
    schema = text[text.index("ReadSchema"):]
    assert "rainfall_mm" not in schema and "groundwater_level" in schema


def rows_read(spark, query):
    """Rows that the scans of all jobs of a query read, from Spark's status store."""
    store = spark._jsc.sc().statusStore()
    before = {s.stageId() for s in _stages(spark, store)}
    query().collect()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    return [s.inputRecords() for s in _stages(spark, store) if s.stageId() not in before]


def _stages(spark, store):
    jvm = spark._jvm
    found = store.stageList(None, False, False, spark._sc._gateway.new_array(jvm.double, 0), None)
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("name", ["annual_trend", "zone_summary", "rolling_zscore", "kpis", "panel_sorted"])
def test_raw_tables_are_read_once(spark, name):
    lines = tables.table(spark, SMALL, "lineitem").count()
    scans = rows_read(spark, lambda: catalog.queries()[name](spark, SMALL))
    assert sum(n >= lines for n in scans) <= 1 and max(scans) >= lines
    drop_staged(spark)


def test_staged_rows_are_in_the_shared_folder(spark):
    staged = stage(make_panel(spark, zones=1, months=3))
    assert shared_dir(spark).split("://")[-1] in staged.inputFiles()[0]


def test_staged_rows_can_be_dropped(spark):
    path = stage(make_panel(spark, zones=1, months=3)).inputFiles()[0].rsplit("/", 1)[0]
    assert io._matches(spark, path) and drop_staged(spark) >= 1
    assert not io._matches(spark, path) and drop_staged(spark) == 0
