import pytest
from helpers import make_panel
from pyspark.sql import functions as F

from zonalis.operators import scenarios, spatial, summaries


def points(spark, rows):
    return spark.createDataFrame(rows, "zone string, longitude double, latitude double, v double")


def test_interpolation_between_and_on_stations(spark):
    # margins of 0.05 and step 1.05: node 1 of three lies midway, stations lie off the nodes
    df = points(spark, [("a", 0.0, 0.0, 10.0), ("b", 2.0, 0.0, 20.0)])
    got = {(r.ix, r.iy): r.value for r in spatial.interpolate(df, "v", cells=3).collect()}
    assert got[(1, 1)] == pytest.approx(15.0)
    assert all(10.0 <= v <= 20.0 for v in got.values())


def test_exact_hit_takes_the_first_station(spark):
    # the box is 0.1 wide around one spot, so the middle node is the spot itself
    df = points(spark, [("b", 1.0, 1.0, 30.0), ("a", 1.0, 1.0, 10.0)])
    got = {(r.ix, r.iy): r.value for r in spatial.interpolate(df.repartition(2), "v", cells=3).collect()}
    assert got[(1, 1)] == 10.0
    assert got[(0, 0)] == pytest.approx(20.0)


def test_interpolation_equals_brute_force_on_any_partitioning(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(f"z{i:03d}", float(x), float(y), float(v)) for i, (x, y, v) in enumerate(rng.random((40, 3)))]
    frames = [points(spark, rows).repartition(n) for n in (1, 5)]
    got = [{(r.ix, r.iy): r.value for r in spatial.interpolate(f, "v", cells=9).collect()} for f in frames]
    xs, ys, vs = (np.array([r[k] for r in rows]) for k in (1, 2, 3))
    gx = np.linspace(xs.min() - 0.05, xs.max() + 0.05, 9)
    gy = np.linspace(ys.min() - 0.05, ys.max() + 0.05, 9)
    for ix in range(9):
        for iy in range(9):
            w = 1 / ((xs - gx[ix]) ** 2 + (ys - gy[iy]) ** 2)
            want = (w * vs).sum() / w.sum()
            assert got[0][(ix, iy)] == pytest.approx(want) and got[1][(ix, iy)] == pytest.approx(want)


def test_scenarios_cover_every_zone_year_month(spark):
    panel = make_panel(spark, zones=3, months=24)
    rows = scenarios.project(panel, n_years=5)
    assert rows.count() == 3 * 3 * 5 * 12
    ends = rows.agg(F.min("gw_level_proj"), F.max("gw_level_proj"), F.min("year"), F.max("urban_proj")).first()
    assert ends[0] >= 0.5 and ends[1] <= 40.0 and ends[2] == 2002 and ends[3] <= 1.0


def test_summary_and_map_rows(spark):
    summary = summaries.zone_summary(make_panel(spark, zones=4, months=24), 2001)
    rows = spatial.map_features(summary).collect()
    assert len(rows) == 4 and max(r.heat for r in rows) == 1.0
    assert all(r.colour.startswith("#") and "Risk:" in r.popup for r in rows)


def test_distribution_keeps_empty_labels(spark):
    rows = summaries.risk_distribution(make_panel(spark, zones=1, months=12)).collect()
    assert len(rows) == 3 and sum(r.n for r in rows) == 1 and sum(r.percent for r in rows) == 100.0
