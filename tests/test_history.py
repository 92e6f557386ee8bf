"""Ranges, presets, KPI, correlation (pages' data frames)."""

import datetime as dt

from tickbar.operators import history as H

BSCHEMA = "symbol string, trade_date date, open double, high double, low double, close double, volume long"


def _bars(spark, rows):
    return spark.createDataFrame(rows, BSCHEMA)


def test_presets_clamp(spark):
    days = [dt.date(2023, 2, 27), dt.date(2023, 2, 28), dt.date(2024, 1, 29), dt.date(2024, 1, 30),
            dt.date(2024, 2, 22), dt.date(2024, 2, 29)]
    b = _bars(spark, [("A", d, 1.0, 1.0, 1.0, 1.0, 1) for d in days])
    year = sorted(r["trade_date"] for r in H.preset_range(b, "last_year").collect())
    assert year[0] == dt.date(2023, 2, 28)  # 2024-02-29 minus 12 months clamps to 2023-02-28
    month = sorted(r["trade_date"] for r in H.preset_range(b, "last_month", as_of="2024-03-31").collect())
    assert month == [dt.date(2024, 2, 29)]
    week = sorted(r["trade_date"] for r in H.preset_range(b, "last_week").collect())
    assert week == [dt.date(2024, 2, 22), dt.date(2024, 2, 29)]
    rng = H.date_range(b, "2024-01-30", "2024-02-22").count()
    assert rng == 2


def test_kpi(spark):
    b = _bars(spark, [("A", dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 1), ("A", dt.date(2024, 1, 2), 2.0, 4.0, 1.0, 3.0, 1),
                      ("B", dt.date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1)])
    k = {r["symbol"]: r for r in H.kpi_latest(b).collect()}
    assert (k["A"]["open_delta"], k["A"]["high_delta"], k["A"]["low_delta"], k["A"]["close_delta"]) == (1.0, 2.0, 0.5, 1.5)
    assert k["B"]["close_delta"] is None


def test_corr_properties(spark):
    rows = [("A", dt.date(2024, 1, i), float(i), float(i * 2 % 7), float(i % 3), 5.0, i * 10) for i in range(1, 20)]
    c = {(r["row_col"], r["col_col"]): r["corr"] for r in H.corr_matrix(_bars(spark, rows)).collect()}
    assert c[("open", "open")] == 1.0
    assert c[("close", "close")] is None  # constant column
    assert c[("open", "volume")] is not None and abs(c[("open", "volume")] - 1.0) < 1e-12
    assert c[("high", "low")] == c[("low", "high")]
    assert c[("open", "close")] is None


def test_bround_half_even(spark):
    rows = [("A", dt.date(2024, 1, i), float(i), float(i), float(i), float(i), i) for i in range(1, 5)]
    c = H.corr_matrix(_bars(spark, rows), decimals=2).collect()
    assert all(r["corr"] in (1.0, None) for r in c)
    assert spark.sql("select bround(CAST(0.125 AS DOUBLE), 2) a").collect()[0]["a"] == 0.12


def test_chart_long(spark):
    b = _bars(spark, [("A", dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5, 1)])
    assert sorted(r["series"] for r in H.chart_prices_long(b).collect()) == ["close", "high", "low", "open"]
