"""One-step-ahead forecasts for every symbol at once.

* ``lag_ols``: linear regression of the close on its 5 previous closes (with an
  intercept), fitted per symbol on the train rows, applied to the validation rows.
  Min-max scaling before and its inverse after do not change an affine least-squares fit,
  so the fit runs on prices directly.
* ``ar5``: AR(p) on first differences (the ARIMA(p,1,0) mean model, conditional least
  squares, no constant).  At every validation row the coefficients are re-fitted on all
  earlier rows: the normal-equation sums are an expanding window ending one row back, so the
  walk-forward loop becomes one sorted pass plus a p x p solve per row.

Both models come from one frame of lags: one scan, one sort per symbol, no join.  Prices are
taken as they are (doubles, centred on the train mean for the regression).  With ``tick`` they
are integer multiples of it and the sums are exact decimals; that suits prices quoted in ticks
and makes results equal to the last digit on every engine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.linalg import solve_columns
from .features import train_valid_split

AR_ORDER = 5
PRED_DECIMALS = 2
RMSE_DECIMALS = 4
MODELS = ("ar5", "lag_ols")


def _all_present(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def predictions(bars: DataFrame, models: tuple[str, ...] = MODELS, p: int = AR_ORDER, value_col: str = "close",
                tick: float | None = None) -> DataFrame:
    """Validation rows with ``pred_<model>`` of every model (NULL where a fit is not possible)."""
    whole = Window.partitionBy("symbol")
    by_date = whole.orderBy("trade_date")
    before = by_date.rowsBetween(Window.unboundedPreceding, -1)
    s = train_valid_split(bars, value_col)
    if tick is None:
        mean = F.avg(F.when(F.col("split") == "train", F.col(value_col))).over(whole)
        s = s.withColumn("mid", mean).withColumn("y", F.col(value_col) - F.col("mid"))
        number = lambda c: F.col(c).cast("double")
        price = lambda e: e + F.col("mid")
    else:
        s = s.withColumn("y", F.round(F.col(value_col) / F.lit(tick)).cast("bigint"))
        number = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  the product has 38 digits
        price = lambda e: e * F.lit(tick)
    s = s.withColumns({f"y{i}": F.lag("y", i).over(by_date) for i in range(1, p + 2)})
    s = s.withColumns({"one": F.lit(1), "dy": F.col("y") - F.col("y1"),
                       **{f"x{i}": F.col(f"y{i}") - F.col(f"y{i + 1}") for i in range(1, p + 1)}})

    ar, ols = [f"x{i}" for i in range(1, p + 1)], ["one", *[f"y{i}" for i in range(1, p + 1)]]
    sums: dict[str, Column] = {}

    def normal(prefix: str, xs: list[str], y: str, use: Column, window) -> None:
        for i, a in enumerate(xs):
            for j in range(i, len(xs)):
                sums[f"{prefix}{i}_{j}"] = F.sum(F.when(use, number(a) * number(xs[j]))).over(window)
            sums[f"{prefix}b{i}"] = F.sum(F.when(use, number(a) * number(y))).over(window)

    if "ar5" in models:
        normal("a", ar, "dy", _all_present([*ar, "dy"]), before)
    if "lag_ols" in models:
        normal("o", ols, "y", (F.col("split") == "train") & _all_present([*ols, "y"]), whole)
    keep = ["symbol", "trade_date", value_col, "y1", *ar, *ols[2:], *(["mid"] if tick is None else [])]
    out = s.select(*keep, "split", *[e.alias(k) for k, e in sums.items()]).where(F.col("split") == "valid").drop("split")
    for name, prefix, xs in (("ar5", "a", ar), ("lag_ols", "o", ols)):
        if name not in models:
            continue
        n = len(xs)
        rest = [c for c in out.columns if not (c.startswith(prefix) and c in sums)]
        coef = [f"{prefix}_c{i}" for i in range(n)]
        out = solve_columns(out, [[f"{prefix}{min(i, j)}_{max(i, j)}" for j in range(n)] for i in range(n)],
                            [f"{prefix}b{i}" for i in range(n)], coef, rest)
        terms = [F.col(c) if x == "one" else F.col(c) * F.col(x).cast("double") for c, x in zip(coef, xs)]
        if name == "ar5":
            terms = [F.col("y1").cast("double"), *terms]
        out = out.withColumn(f"pred_{name}", price(reduce(lambda a, b: a + b, terms))).drop(*coef)
    return out.select("symbol", "trade_date", value_col, *[f"pred_{m}" for m in models])


def of_model(wide: DataFrame, model: str, value_col: str = "close") -> DataFrame:
    """One model's predictions as ``prediction_raw``."""
    return wide.select("symbol", "trade_date", value_col, F.col(f"pred_{model}").alias("prediction_raw"))


def ar_walkforward(bars: DataFrame, p: int = AR_ORDER, value_col: str = "close", tick: float | None = None) -> DataFrame:
    """Validation rows with the walk-forward AR(p) prediction of ``value_col``."""
    return of_model(predictions(bars, ("ar5",), p, value_col, tick), "ar5", value_col)


def lag_ols(bars: DataFrame, k: int = AR_ORDER, value_col: str = "close", tick: float | None = None) -> DataFrame:
    """Validation rows with the per-symbol lag-regression prediction of ``value_col``."""
    return of_model(predictions(bars, ("lag_ols",), k, value_col, tick), "lag_ols", value_col)


def finish(pred: DataFrame, value_col: str = "close", decimals: int = PRED_DECIMALS) -> DataFrame:
    return pred.select("symbol", "trade_date", value_col, F.round("prediction_raw", decimals).alias("prediction"))


def rmse(wide: DataFrame, models: tuple[str, ...] = MODELS, value_col: str = "close") -> DataFrame:
    """sqrt(mean((y - y_hat)^2)) per symbol and model over the validation rows that have a
    prediction (``n_valid`` of them), in one aggregate."""
    aggs, cells = [], []
    for m in models:
        err = F.pow(F.col(value_col) - F.col(f"pred_{m}"), 2)
        aggs += [F.count(err).alias(f"n_{m}"), F.sqrt(F.avg(err)).alias(f"e_{m}")]
        cells.append(F.struct(F.lit(m).alias("model"), F.col(f"n_{m}").alias("n_valid"), F.col(f"e_{m}").alias("rmse_raw")))
    return wide.groupBy("symbol").agg(*aggs).select("symbol", F.inline(F.array(*cells)))


def rmse_table(r: DataFrame) -> DataFrame:
    return r.select("symbol", "model", "n_valid", F.round("rmse_raw", RMSE_DECIMALS).alias("rmse"))


def rmse_report(r: DataFrame) -> DataFrame:
    return r.select("symbol", "model", F.format_string("Test RMSE: %.3f", F.col("rmse_raw")).alias("report"))


def model_comparison(rmses: DataFrame) -> DataFrame:
    """The RMSE table ranked per symbol (1 = lowest error)."""
    w = Window.partitionBy("symbol").orderBy(F.col("rmse_raw").asc_nulls_last(), "model")
    return rmses.select("symbol", "model", F.round("rmse_raw", RMSE_DECIMALS).alias("rmse"),
                        F.row_number().over(w).cast("bigint").alias("rank"))


def forecast_last(wide: DataFrame, models: tuple[str, ...] = MODELS) -> DataFrame:
    """The prediction for the newest validation date (shown as "tomorrow"), per model."""
    last = wide.groupBy("symbol").agg(
        F.max("trade_date").alias("trade_date"), *[F.max_by(f"pred_{m}", "trade_date").alias(f"last_{m}") for m in models])
    cells = [F.struct(F.lit(m).alias("model"), F.round(f"last_{m}", PRED_DECIMALS).alias("prediction")) for m in models]
    return last.select("symbol", "trade_date", F.inline(F.array(*cells))).select("symbol", "model", "trade_date", "prediction")


def forecast_chart_frame(bars: DataFrame, pred: DataFrame, model: str, value_col: str = "close") -> DataFrame:
    """Long frame (symbol, model, trade_date, series, value): train, valid, prediction."""
    s = train_valid_split(bars, value_col).select("symbol", "trade_date", F.col("split").alias("series"),
                                                  F.col(value_col).alias("value"))
    p = pred.select("symbol", "trade_date", F.lit("prediction").alias("series"),
                    F.round("prediction_raw", PRED_DECIMALS).alias("value"))
    return s.unionByName(p).withColumn("model", F.lit(model))


def _pooled(bars: DataFrame, regressor, k: int, value_col: str) -> DataFrame:
    """One MLlib model over every symbol's scaled lag windows; validation rows with its prediction on the price scale."""
    from pyspark.ml.feature import VectorAssembler

    from .features import add_lags, minmax_scale

    s = add_lags(minmax_scale(train_valid_split(bars, value_col)), "scaled", k)
    lags = [f"lag_{i}" for i in range(1, k + 1)]
    s = s.where(F.col("rn") > k)
    full = VectorAssembler(inputCols=lags, outputCol="features").transform(s.where(_all_present([*lags, "scaled"])))
    train = full.where(F.col("split") == "train").withColumnRenamed("scaled", "label")
    model = regressor.setFeaturesCol("features").setLabelCol("label").fit(train)
    inv = F.col("prediction") * (F.col("x_max") - F.col("x_min")) + F.col("x_min")
    told = model.transform(full.where(F.col("split") == "valid")).select("symbol", "trade_date", value_col, inv.alias("prediction_raw"))
    # rows with a gap in their lags have no prediction, but stay
    rest = s.where((F.col("split") == "valid") & ~_all_present([*lags, "scaled"]))
    return told.unionByName(rest.select("symbol", "trade_date", value_col, F.lit(None).cast("double").alias("prediction_raw")))


def lag_mllib(bars: DataFrame, k: int = AR_ORDER, value_col: str = "close") -> DataFrame:
    """One pooled MLlib linear regression over every symbol's scaled lag windows."""
    from pyspark.ml.regression import LinearRegression

    return _pooled(bars, LinearRegression(solver="normal"), k, value_col)


def lag_gbt(bars: DataFrame, k: int = AR_ORDER, value_col: str = "close", trees: int = 40, depth: int = 4, step: float = 0.2,
            seed: int = 7) -> DataFrame:
    """One pooled ensemble of boosted regression trees over every symbol's scaled lag windows (not linear).

    Trees are grown from per-node histograms that Spark adds up, so the training rows stay where they are;
    a prediction is at most the greatest train value of its symbol's scale.
    """
    from pyspark.ml.regression import GBTRegressor

    return _pooled(bars, GBTRegressor(maxIter=trees, maxDepth=depth, stepSize=step, seed=seed, checkpointInterval=10), k, value_col)


def rmse_of(pred: DataFrame, model: str, value_col: str = "close") -> DataFrame:
    """The RMSE table of one model's predictions (``prediction_raw``), to be united with that of others."""
    return rmse(pred.withColumnRenamed("prediction_raw", f"pred_{model}"), (model,), value_col)
