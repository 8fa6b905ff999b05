import datetime as dt

import pytest
from helpers import make_panel, month, series
from pyspark.sql import functions as F

from zonalis.functions import measures as m
from zonalis.operators import blocks, calendar, evaluation, features, selection, summaries, timeseries


def test_risk_bins_are_right_closed(spark):
    levels = [0.0, 12.0, 12.001, 20.0, 20.001, 36.0, 36.5, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(levels)], "i int, v double")
    got = [r.r for r in df.select("i", m.risk_level(F.col("v")).alias("r")).orderBy("i").collect()]
    assert got == [None, "Low", "Medium", "Medium", "High", "High", None, None]


def test_rounding_and_bounds(spark):
    df = spark.createDataFrame([(2.345,), (-2.5,), (None,), (-0.0001,)], "v double")
    rows = df.select(m.rounded(F.col("v"), 0).alias("r"), m.bounded(F.col("v"), -1, 2).alias("b")).collect()
    assert [r.r for r in rows] == [2.0, -3.0, None, 0.0]
    assert [r.b for r in rows] == [2.0, -1.0, None, -0.0001]


def test_seasons_and_slugs(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    got = [r.s for r in df.select("month", m.season(F.col("month")).alias("s")).orderBy("month").collect()]
    assert got == [0, 0, 0, 0, 0, 1, 1, 1, 1, 2, 2, 2]
    row = spark.sql("select 'North Hill' as z").select(m.slug(F.col("z")).alias("s")).first()
    assert row.s == "North_Hill"


def test_first_row_std_is_zero_and_z_is_zero(spark):
    df = series(spark, [7.0])
    assert features.add_trailing_std(df).first().gw_roll_std_6 == 0.0
    row = timeseries.rolling_zscore(df).first()
    assert row.gw_rolling_std == 1.0 and row.z_score == 0.0 and row.z_anomaly == 0


def test_constant_level_gives_no_z(spark):
    rows = timeseries.rolling_zscore(series(spark, [5.0] * 6), 0.5).orderBy("date").collect()
    assert rows[-1].z_score is None and rows[-1].z_anomaly == 0


def test_prior_window_can_fire_above_the_bound(spark):
    df = series(spark, [5, 5.1, 4.9, 5, 5.1, 4.9, 30])
    with pytest.raises(ValueError):
        timeseries.rolling_zscore(df, 3.0)
    prior = timeseries.rolling_zscore(df, 3.0, prior_only=True).orderBy("date").collect()
    assert prior[-1].z_anomaly == 1


def test_gap_interpolation(spark):
    df = series(spark, [10, 20, 50], months=[1, 2, 5])
    got = [(r.groundwater_level, r.filled) for r in calendar.fill_gaps(df).orderBy("date").collect()]
    assert got == [(10.0, 0), (20.0, 0), (30.0, 1), (40.0, 1), (50.0, 0)]


def test_gap_ends(spark):
    df = series(spark, [None, 4, None, 8, None])
    got = [r.groundwater_level for r in calendar.fill_gaps(df).orderBy("date").collect()]
    assert got == [None, 4.0, 6.0, 8.0, 8.0]
    unknown = calendar.fill_gaps(series(spark, [None, None, None])).orderBy("date").collect()
    assert [r.groundwater_level for r in unknown] == [None, None, None]


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([(c,) for c in [2, 2, 1, 1, 0]], "risk_code int")
    assert df.agg(summaries.modal_risk().alias("c")).first().c == 1
    assert df.filter("risk_code > 5").agg(summaries.modal_risk().alias("c")).first().c == 1


def test_cutoff_is_in_the_training_rows(spark):
    dates = [(d,) for d in ["2019-06-01", "2020-12-01", "2021-01-01", "2023-12-01"]]
    df = spark.createDataFrame(dates, "d string").select(F.to_date("d").alias("date"))
    roles = {r.date: r.role for r in selection.split_by_time(df).collect()}
    assert roles[dt.date(2020, 12, 1)] == "train" and roles[dt.date(2021, 1, 1)] == "test"


def test_last_state_takes_last_known_value_per_column(spark):
    rows = [("A", month(0), 1.0, 7.5), ("A", month(1), 2.0, None), ("A", month(2), 3.0, None)]
    df = spark.createDataFrame(rows, "zone string, date date, level double, rain double")
    row = summaries.last_state(df, ["level", "rain"]).first()
    assert (row.level, row.rain) == (3.0, 7.5)


def test_bounded_balance(spark):
    df = series(spark, [0, 0, 0]).withColumn(
        "delta", F.element_at(F.array(F.lit(-5.0), F.lit(40.0), F.lit(-3.0)), F.month("date"))
    )
    rows = timeseries.bounded_balance(df, "delta", 8.0).orderBy("date").collect()
    assert [r.balance for r in rows] == [3.0, 35.0, 32.0]


def test_bounded_balance_equals_a_plain_loop_over_years(spark):
    import random

    rng = random.Random(5)
    steps = [rng.uniform(-9, 9) for _ in range(100)]
    df = series(spark, steps).withColumnRenamed("groundwater_level", "delta")
    got = [r.balance for r in timeseries.bounded_balance(df, "delta", 18.0).orderBy("date").collect()]
    x, want = 18.0, []
    for s in steps:
        x = min(35.0, max(1.0, x + s))
        want.append(x)
    assert got == pytest.approx(want, abs=1e-9)


def test_classification_report_with_an_unclaimed_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (2, 2)], "y int, p int")
    cells = {(r.actual, r.predicted): r.n for r in evaluation.confusion_counts(df).collect()}
    assert len(cells) == 9 and cells[(1, 2)] == 1 and cells[(0, 1)] == 0 and sum(cells.values()) == 4
    report = {r.label: r for r in evaluation.classification_report(df).collect()}
    assert report["Medium"].precision == 0.0 and report["Medium"].f1 == 0.0
    assert report["High"].recall == 1.0 and report["accuracy"].f1 == 0.75


def test_expanding_folds_train_before_test(spark):
    df = series(spark, [0] * 7)
    rows = selection.expanding_folds(df, 2).collect()
    sizes = {(f, role): sum(r.fold == f and r.role == role for r in rows) for f in (1, 2) for role in ("train", "test")}
    assert sizes == {(1, "train"): 3, (1, "test"): 2, (2, "train"): 5, (2, "test"): 2}
    for f in (1, 2):
        train = max(r.date for r in rows if r.fold == f and r.role == "train")
        assert train < min(r.date for r in rows if r.fold == f and r.role == "test")


def test_row_folds_follow_zone_then_date(spark):
    df = series(spark, [0] * 3, "B").union(series(spark, [0] * 4, "A"))
    rows = selection.row_folds(df, 2).collect()
    train = sorted((r.zone, r.date) for r in rows if r.fold == 1 and r.role == "train")
    assert train == [("A", month(0)), ("A", month(1)), ("A", month(2))]
    test = sorted((r.zone, r.date) for r in rows if r.fold == 2 and r.role == "test")
    assert test == [("B", month(1)), ("B", month(2))]


def test_stratified_folds_are_balanced(spark):
    panel = make_panel(spark)
    counts = selection.stratified_folds(panel).groupBy("risk_code", "fold").count().collect()
    for code in {r.risk_code for r in counts}:
        sizes = [r["count"] for r in counts if r.risk_code == code]
        assert max(sizes) - min(sizes) <= 1


def test_metrics_of_a_constant_target(spark):
    df = spark.createDataFrame([("m", 2.0, 2.0), ("m", 2.0, 2.0)], "model string, y double, p double")
    row = evaluation.regression_metrics(df).first()
    assert (row.RMSE, row.MAE, row.R2) == (0.0, 0.0, 1.0)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    values = [float(x) for x in np.random.default_rng(1).integers(0, 40, 999)]
    df = spark.createDataFrame([(v, v * 2) for v in values], "a double, b double")
    rows = summaries.exact_quantiles(df, ["a", "b"], [0.25, 0.5, 0.9]).collect()
    for r in rows:
        want = np.quantile(values, r.p) * (2 if r.measure == "b" else 1)
        assert r.quantile == pytest.approx(want)


def test_min_max_inverse_is_identity(spark):
    panel = make_panel(spark, zones=2, months=24)
    scaled = timeseries.minmax(panel, ["groundwater_level"])
    back = timeseries.minmax_inverse(F.col("groundwater_level_scaled"), "groundwater_level")
    worst = scaled.agg(F.max(F.abs(back - F.col("groundwater_level")))).first()[0]
    assert worst < 1e-9


def test_sequences_are_complete(spark):
    panel = make_panel(spark, zones=2, months=20)
    rows = timeseries.sequences(panel).collect()
    assert len(rows) == 2 * (20 - 12 - 3 + 1)
    assert all(len(r.history) == 12 and len(r.target) == 3 for r in rows)


def test_features_do_not_depend_on_row_order(spark):
    panel = make_panel(spark, zones=3, months=30)
    shuffled = panel.orderBy(F.rand(4)).repartition(7)
    a = features.engineer(panel).select("zone", "date", "gw_lag_12", "rain_roll_mean_6").collect()
    b = features.engineer(shuffled).select("zone", "date", "gw_lag_12", "rain_roll_mean_6").collect()
    assert sorted(a) == sorted(b) and len(a) == 3 * 18


def test_blocks_give_the_same_rows_for_one_long_series(spark):
    panel = make_panel(spark, zones=1, months=200).union(make_panel(spark, zones=3, months=9).filter("zone <> 'Zone 0'"))
    whole = features.add_window_features(panel).collect()
    cut = blocks.window_features(panel, block_rows=12)
    assert sorted(cut.select(*whole[0].asDict()).collect(), key=str) == sorted(whole, key=str)
    ahead = lambda df, keys=features.SERIES: df.withColumn(
        "next", F.lead("groundwater_level", 3).over(features.series(keys))
    )
    got = blocks.on_blocks(panel, ahead, before=0, after=3, block_rows=7).select("zone", "date", "next").collect()
    assert sorted(got, key=str) == sorted(ahead(panel).select("zone", "date", "next").collect(), key=str)
    with pytest.raises(ValueError):
        blocks.on_blocks(panel, ahead, before=0, after=30, block_rows=7)


def test_metrics_leave_out_rows_without_a_value(spark):
    df = spark.createDataFrame([("m", 1.0, 0.0), ("m", 2.0, 0.0), ("m", None, 1.0), ("m", 1.0, None)], "model string, y double, p double")
    row = evaluation.regression_metrics(df).first()
    assert row.n == 2 and row.RMSE == pytest.approx(2.5**0.5) and row.MAE == 1.5


def test_stratified_folds_keep_rows_without_a_label(spark):
    rows = [(f"z{i % 3}", month(i), None if i % 4 == 0 else i % 2) for i in range(24)]
    folded = selection.stratified_folds(spark.createDataFrame(rows, "zone string, date date, risk_code int"), 3)
    got = folded.groupBy("risk_code", "fold").count().collect()
    assert sum(r["count"] for r in got) == 24 and {r.fold for r in got} == {0, 1, 2}
    assert all(r["count"] == 2 for r in got if r.risk_code is None)


def test_one_hot_slots_follow_the_names(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "zone string")
    got = sorted([(r.zone or "", r.slot, r.slots) for r in features.one_hot_zone(df).collect()], key=str)
    assert got == [("", None, 3), ("a", 0, 3), ("a", 0, 3), ("b", 1, 3), ("c", 2, 3)]
