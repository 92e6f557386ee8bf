"""Split, scaling, lags, and the two forecasts against numpy loops."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickbar.operators import features as FE
from tickbar.operators import forecast as FC

BSCHEMA = "symbol string, trade_date date, open double, high double, low double, close double, volume long"


def _series(spark, closes, symbol="A"):
    start = dt.date(2020, 1, 1)
    rows = [(symbol, start + dt.timedelta(days=i), c, c, c, c, 1) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, BSCHEMA)


@pytest.mark.parametrize("n,valid", [(1, 0), (5, 0), (9, 0), (10, 1), (20, 2), (173, 17)])
def test_split_sizes(spark, n, valid):
    s = FE.train_valid_split(_series(spark, [float(i) for i in range(n)]))
    got = s.where("split = 'valid'").count()
    assert got == valid == n - math.ceil(0.9 * n)


def test_scale_inverse_and_constant(spark):
    s = FE.minmax_inverse(FE.minmax_scale(FE.train_valid_split(_series(spark, [3.0, 7.0, 5.0, 11.0]))))
    rows = s.orderBy("trade_date").collect()
    assert [r["scaled"] for r in rows] == [0.0, 0.5, 0.25, 1.0]
    assert all(abs(r["unscaled"] - r["close"]) < 1e-12 for r in rows)
    const = FE.minmax_scale(FE.train_valid_split(_series(spark, [4.0] * 5))).collect()
    assert all(r["scaled"] == 0.0 for r in const)


def test_lag_windows(spark):
    s = FE.minmax_scale(FE.train_valid_split(_series(spark, [float(i) for i in range(20)])))
    tr = FE.lag_windows(s, "train").orderBy("trade_date").collect()
    va = FE.lag_windows(s, "valid").orderBy("trade_date").collect()
    assert len(tr) == 13 and len(va) == 2  # train rows 5..17, validation 18..19
    assert va[0]["lag_1"] == s.orderBy("trade_date").collect()[17]["scaled"]
    d = FE.diff_series(_series(spark, [1.0, 4.0, 9.0])).orderBy("trade_date").collect()
    assert [r["diff"] for r in d] == [None, 3.0, 5.0]


def _closes(n, seed=7):
    rng = np.random.default_rng(seed)
    return [float(x) for x in np.round(1000 + np.cumsum(rng.normal(0, 5, n)), 2)]


def test_ar_walkforward_matches_numpy(spark):
    closes = _closes(80)
    got = {r["trade_date"]: r["prediction_raw"] for r in FC.ar_walkforward(_series(spark, closes), tick=0.01).collect()}
    y = np.round(np.array(closes) * 100)
    dy = np.diff(y, prepend=np.nan)
    n = len(y)
    train_len = math.ceil(0.9 * n)
    start = dt.date(2020, 1, 1)
    assert len(got) == n - train_len
    for t in range(train_len, n):
        X = np.array([[dy[s - i] for i in range(1, 6)] for s in range(6, t)])
        phi = np.linalg.lstsq(X, dy[6:t], rcond=None)[0]
        pred = (y[t - 1] + phi @ np.array([dy[t - i] for i in range(1, 6)])) * 0.01
        assert abs(got[start + dt.timedelta(days=t)] - pred) < 1e-6


def test_lag_ols_matches_numpy(spark):
    closes = _closes(60, seed=3)
    got = {r["trade_date"]: r["prediction_raw"] for r in FC.lag_ols(_series(spark, closes), tick=0.01).collect()}
    y = np.round(np.array(closes) * 100)
    n, train_len = len(y), math.ceil(0.9 * len(y))
    X = np.array([[1.0] + [y[s - i] for i in range(1, 6)] for s in range(5, train_len)])
    c = np.linalg.lstsq(X, y[5:train_len], rcond=None)[0]
    start = dt.date(2020, 1, 1)
    for t in range(train_len, n):
        pred = (c @ np.array([1.0] + [y[t - i] for i in range(1, 6)])) * 0.01
        assert abs(got[start + dt.timedelta(days=t)] - pred) < 1e-4


@pytest.mark.parametrize("scale", [1.0, 1e-4, 4e5])
def test_raw_prices_match_numpy(spark, scale):
    """No tick: sub-cent moves are seen, and large prices don't overflow."""
    closes = [c * scale for c in _closes(80)]
    wide = {r["trade_date"]: r for r in FC.predictions(_series(spark, closes)).collect()}
    y, n = np.array(closes), 80
    train_len, start, dy = math.ceil(0.9 * 80), dt.date(2020, 1, 1), np.diff(np.array(closes), prepend=np.nan)
    x = np.array([[1.0] + [y[s - i] for i in range(1, 6)] for s in range(5, train_len)])
    mid = y[:train_len].mean()
    c = np.linalg.lstsq(np.column_stack((x[:, :1], x[:, 1:] - mid)), y[5:train_len] - mid, rcond=None)[0]
    for t in range(train_len, n):
        r = wide[start + dt.timedelta(days=t)]
        lag = np.array([[dy[s - i] for i in range(1, 6)] for s in range(6, t)])
        phi = np.linalg.lstsq(lag, dy[6:t], rcond=None)[0]
        assert r["pred_ar5"] == pytest.approx(y[t - 1] + phi @ np.array([dy[t - i] for i in range(1, 6)]), rel=1e-7)
        assert r["pred_lag_ols"] == pytest.approx(mid + c @ np.array([1.0] + [y[t - i] - mid for i in range(1, 6)]), rel=1e-7)


@pytest.mark.parametrize("tick", [None, 0.01])
def test_large_prices_do_not_overflow(spark, tick):
    big = _series(spark, [4.0e7 + c for c in _closes(60)])
    assert all(r["pred_lag_ols"] is not None and r["pred_ar5"] is not None for r in FC.predictions(big, tick=tick).collect())


def test_missing_predictions_are_not_counted(spark):
    r = FC.rmse(FC.predictions(_series(spark, [5.0] * 30))).collect()
    assert {(x["model"], x["n_valid"], x["rmse_raw"]) for x in r} == {("ar5", 0, None), ("lag_ols", 0, None)}


def test_mllib_keeps_rows_with_gaps(spark):
    closes = _closes(60)
    b = _series(spark, closes)
    gap = b.withColumn("close", F.when(F.col("trade_date") != dt.date(2020, 1, 1) + dt.timedelta(days=56), F.col("close")))
    got = FC.lag_mllib(gap).collect()
    assert len(got) == 6 and sum(r["prediction_raw"] is None for r in got) == 4


def test_short_and_constant_series(spark):
    assert FC.ar_walkforward(_series(spark, [1.0] * 9)).count() == 0
    const = FC.ar_walkforward(_series(spark, [5.0] * 30)).collect()
    assert const and all(r["prediction_raw"] is None for r in const)


def test_rmse_and_comparison(spark):
    b = _series(spark, _closes(50)).unionByName(_series(spark, _closes(50, seed=9), symbol="B"))
    both = FC.predictions(b)
    cmp = FC.model_comparison(FC.rmse(both)).collect()
    assert sorted((r["symbol"], r["rank"]) for r in cmp) == [("A", 1), ("A", 2), ("B", 1), ("B", 2)]
    rep = FC.rmse_report(FC.rmse(both)).collect()
    assert all(r["report"].startswith("Test RMSE: ") for r in rep)
    last = FC.forecast_last(both).collect()
    assert {r["trade_date"] for r in last} == {dt.date(2020, 1, 1) + dt.timedelta(days=49)}


def test_mllib_fit_equals_normal_equations_before_rounding(spark):
    import duckdb
    from __spark_entry__ import oracle_sql
    from tickbar.sources.fixtures import bars_v

    sf = "/root/testdata/sf0.01"
    head, last = oracle_sql()["forecast_lag_mllib"].rsplit("round((", 1)
    assert " + x_min, 2) AS prediction" in last
    con = duckdb.connect()
    for t in ("orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rows = con.execute(head + "((" + last.replace(" + x_min, 2) AS", " + x_min) AS")).fetchall()
    want = {(r[0], r[1]): r[3] for r in rows}
    got = {(r["symbol"], r["trade_date"]): r["prediction_raw"] for r in FC.lag_mllib(bars_v(spark, sf)).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-6


def test_trees_follow_a_series_that_no_line_fits(spark):
    rows, x = [], {"LOGI": 0.31, "STIC": 0.62}
    for i in range(600):
        for s in x:
            x[s] = 3.9 * x[s] * (1 - x[s])  # the next value is a parabola of the last one, with no linear part to find
            rows.append((s, dt.date(2020, 1, 1) + dt.timedelta(i), 100 + 50 * x[s]))
    bars = spark.createDataFrame(rows, "symbol string, trade_date date, close double")
    trees, line = FC.lag_gbt(bars), FC.predictions(bars, ("lag_ols",))
    found = {r["symbol"]: r for r in FC.rmse_of(trees, "gbt").collect()}
    for r in FC.rmse(line, ("lag_ols",)).collect():
        assert found[r["symbol"]]["n_valid"] == r["n_valid"] == 60
        assert found[r["symbol"]]["rmse_raw"] < 0.35 * r["rmse_raw"]
    ranks = FC.model_comparison(FC.rmse_of(trees, "gbt").unionByName(FC.rmse(line, ("lag_ols",)))).collect()
    assert {(r["model"], r["rank"]) for r in ranks} == {("gbt", 1), ("lag_ols", 2)}


def test_trees_keep_rows_with_gaps(spark):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(i), None if i == 95 else float(i % 7)) for i in range(100)]
    got = FC.lag_gbt(spark.createDataFrame(rows, "symbol string, trade_date date, close double"), trees=5).collect()
    assert len(got) == 10 and sum(r["prediction_raw"] is None for r in got) == 5


def test_trees_on_the_bars(spark):
    import __spark_entry__ as entry_mod

    smoke = "/root/testdata/sf0.01"
    q = entry_mod.queries()
    pred = {(r["symbol"], r["trade_date"]): r for r in q["forecast_gbt"](spark, smoke).collect()}
    other = {(r["symbol"], r["trade_date"]) for r in q["forecast_lag_ols"](spark, smoke).collect()}
    assert set(pred) == other
    err = {}
    for (s, _), r in pred.items():
        err.setdefault(s, []).append((r["close"] - r["prediction"]) ** 2)
    ranked = q["model_comparison_gbt"](spark, smoke).collect()
    assert len(ranked) == 3 * len(err)
    for r in ranked:
        if r["model"] == "gbt":
            assert r["rmse"] == pytest.approx((sum(err[r["symbol"]]) / len(err[r["symbol"]])) ** 0.5, abs=0.01)
    assert all(sorted(r["rank"] for r in ranked if r["symbol"] == s) == [1, 2, 3] for s in err)
