"""ANSI SQL (DuckDB dialect) equivalents of the registered queries.

The fixture views are rebuilt here from ``events`` / ``orders`` with plain
windows; column names and types match the Spark results.
"""

from __future__ import annotations

from itertools import combinations

from ..functions.linalg import solve_sql
from ..schemas import EXCHANGE_CODES, EXCHANGE_NAME, KEY_AREAS, PUBLISH_BATCH_SIZE, QUOTE_NUMERIC_FIELDS
from .catalog import (AS_OF, DAILY_CUT_START, HISTORY_CUT_END, ONE_SYMBOL, PASSTHROUGH_SQL, RANGE_END, RANGE_START,
                      SCAN_DAY, SCAN_SYMBOL)

ORACLE: dict[str, str] = {}


def _with(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes) + "\n" + final


# ------------------------------------------------------------ fixtures ----
_DERIVED = {
    "last_price": "value",
    "close_price": "value",
    "last_qtty": "CAST(user_id AS DOUBLE)",
    "open_price": "first_value(value) OVER d",
    "max_price": "max(value) OVER d",
    "min_price": "min(value) OVER d",
    "traded_quantity": "CAST(count(*) OVER d AS DOUBLE)",
}
QUOTES_V = ("quotes_v", (
    f"SELECT event_type AS symbol, '{EXCHANGE_NAME}' AS exchange_name, ts AS trade_time, "
    + ", ".join(f"{_DERIVED.get(f, 'CAST(NULL AS DOUBLE)')} AS {f}" for f in QUOTE_NUMERIC_FIELDS)
    + ", event_id AS msg_seq FROM events WINDOW d AS (PARTITION BY event_type, CAST(ts AS DATE) "
      "ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"))

BARS_V = ("bars_v", (
    "SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS trade_date, "
    "arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low, "
    "arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume FROM orders GROUP BY 1, 2"))

SYMBOLS_V = ("symbols_v", (
    "SELECT symbol, lower(regexp_replace(symbol, '[^A-Za-z0-9]', '', 'g')) AS tb FROM ("
    "SELECT o_orderpriority AS symbol FROM orders UNION SELECT event_type FROM events UNION SELECT 'ZZZ') s"))

_AREA = "CASE " + " ".join(f"WHEN instr('{a}', upper(substr(event_type, 1, 1))) > 0 THEN '{a}'" for a in KEY_AREAS) + " END"
_PAYLOAD = (
    "'|' || event_type || '|' || event_type || '_LAST_PRICE*0*f|' "
    "|| event_type || '_REF_PRICE*' || CAST(value AS VARCHAR) || '*f|' "
    "|| event_type || '_TRADED_QUANTITY*' || format('{:,}', event_id) || '*n|' "
    "|| event_type || '_OPEN_PRICE**f|' || 'LOT' || CAST(user_id AS VARCHAR) || '|' "
    "|| event_type || '_CEIL_PRICE*' || CASE WHEN event_id % 53 = 0 THEN 'n/a' WHEN event_id % 59 = 0 THEN '12.5f' "
    "WHEN event_id % 61 = 0 THEN '12d' WHEN event_id % 67 = 0 THEN event_type || '_5' ELSE CAST(user_id AS VARCHAR) END || '*f|' "
    "|| event_type || '_LAST_PRICE*' || CAST(value AS VARCHAR) || '*f|'")
RAW_V = ("raw_v", (
    "SELECT event_id AS response_id, CASE WHEN user_id % 2 = 0 THEN 'LIS' ELSE 'UPC' END AS exchange_code, "
    f"{_AREA} AS key_area, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status, ts AS fetched_at, "
    "CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN CAST([] AS VARCHAR[]) "
    "WHEN event_id % 41 = 0 THEN [p, 'nothing'] WHEN event_id % 43 = 0 THEN [p, 'x' || p] "
    "WHEN event_id % 47 = 0 THEN [p, '||'] ELSE [p] END AS obj "
    f"FROM (SELECT *, {_PAYLOAD} AS p FROM events) e"))

ITEMS = ("items", (
    "SELECT response_id, exchange_code, key_area, fetched_at, unnest(range(len(obj))) AS item_pos, "
    "unnest(obj) AS content FROM raw_v WHERE status = 200"))
TOKENS = ("tokens", (
    "SELECT response_id, item_pos, fetched_at, content, string_split(content, '|') AS toks FROM items"))
PARSED = ("parsed", (
    "SELECT response_id, item_pos, fetched_at, content, "
    "COALESCE(instr(content, '|') > 0, false) AS has_pipe, toks[1] = '' AS first_empty, toks[2] AS ticker, "
    "CASE WHEN len(toks) >= 3 THEN toks[3:] ELSE CAST([] AS VARCHAR[]) END AS body FROM tokens"))
# one row per field token, with its position; last occurrence of a name wins
FIELDS = ("fields", (
    "SELECT response_id, item_pos, ticker, pos, "
    "lower(replace(string_split(tok, '*')[1], ticker || '_', '')) AS k, "
    "replace(nullif(string_split(tok, '*')[2], ''), ',', '') AS v FROM ("
    "SELECT response_id, item_pos, ticker, unnest(range(len(body))) AS pos, unnest(body) AS tok "
    "FROM parsed WHERE has_pipe AND first_empty) t WHERE instr(tok, '*') > 0"))
LAST_FIELDS = ("last_fields", (
    "SELECT * FROM fields QUALIFY row_number() OVER (PARTITION BY response_id, item_pos, k ORDER BY pos DESC) = 1"))
_TYPED_COLS = ", ".join(f"TRY_CAST(max(v) FILTER (WHERE k = '{f}') AS DOUBLE) AS {f}" for f in QUOTE_NUMERIC_FIELDS)
_BAD = " OR ".join(f"(max(v) FILTER (WHERE k = '{f}') IS NOT NULL AND TRY_CAST(max(v) FILTER (WHERE k = '{f}') AS DOUBLE) IS NULL)"
                   for f in QUOTE_NUMERIC_FIELDS)
TYPED_FIELDS = ("typed_fields", (
    f"SELECT response_id, item_pos, {_TYPED_COLS}, ({_BAD}) AS any_bad FROM last_fields GROUP BY response_id, item_pos"))
TYPED = ("typed", (
    "SELECT p.response_id, p.item_pos, p.content, p.fetched_at, p.ticker, "
    + ", ".join(f"t.{f}" for f in QUOTE_NUMERIC_FIELDS)
    + ", CASE WHEN p.content IS NULL THEN 'null_content' WHEN NOT p.has_pipe THEN 'no_pipe' "
      "WHEN NOT p.first_empty THEN 'bad_frame' WHEN coalesce(p.ticker, '') = '' THEN 'missing_symbol' "
      "WHEN COALESCE(t.any_bad, false) THEN 'bad_number' END AS reject_reason "
      "FROM parsed p LEFT JOIN typed_fields t USING (response_id, item_pos)"))
FEED = [RAW_V, ITEMS, TOKENS, PARSED, FIELDS, LAST_FIELDS, TYPED_FIELDS, TYPED]

_QUOTE_COLS = "symbol, exchange_name, trade_time, " + ", ".join(QUOTE_NUMERIC_FIELDS)


def reg(name: str, sql: str) -> None:
    ORACLE[name] = sql


# ---------------------------------------------------------------- bars ----
DAILY_BARS = ("daily", (
    "SELECT q.symbol, CAST(q.trade_time AS DATE) AS trade_date, "
    "arg_max(open_price, (trade_time, msg_seq)) AS open, arg_max(max_price, (trade_time, msg_seq)) AS high, "
    "arg_max(min_price, (trade_time, msg_seq)) AS low, arg_max(close_price, (trade_time, msg_seq)) AS close, "
    "CAST(arg_max(traded_quantity, (trade_time, msg_seq)) AS BIGINT) AS volume "
    "FROM quotes_v q JOIN symbols_v s ON q.symbol = s.symbol GROUP BY 1, 2"))
reg("daily_bars", _with([QUOTES_V, SYMBOLS_V, DAILY_BARS], "SELECT * FROM daily"))
reg("daily_bars_upsert", _with([QUOTES_V, SYMBOLS_V, DAILY_BARS], "SELECT * FROM daily"))
_LATEST_FIELDS = ["exchange_name", "trade_time", *QUOTE_NUMERIC_FIELDS, "msg_seq"]
reg("latest_quote", _with([QUOTES_V], (
    "SELECT symbol, CAST(trade_time AS DATE) AS trade_date, "
    + ", ".join(f"arg_max({c}, (trade_time, msg_seq)) AS {c}" for c in _LATEST_FIELDS)
    + " FROM quotes_v GROUP BY 1, 2")))
reg("symbols_missing_today", _with([QUOTES_V, SYMBOLS_V],
                                   "SELECT * FROM symbols_v s WHERE NOT EXISTS (SELECT 1 FROM quotes_v q "
                                   f"WHERE q.symbol = s.symbol AND CAST(q.trade_time AS DATE) = DATE '{SCAN_DAY}')"))
_DAY_SCAN = _with([QUOTES_V], (
    "SELECT symbol, trade_time, open_price, max_price, min_price, close_price, traded_quantity, msg_seq, "
    "CAST(year(trade_time) AS INTEGER) AS year, CAST(month(trade_time) AS INTEGER) AS month, "
    "CAST(day(trade_time) AS INTEGER) AS day FROM quotes_v "
    f"WHERE CAST(trade_time AS DATE) = DATE '{SCAN_DAY}'"))
reg("quotes_partition_scan", _DAY_SCAN)
reg("quotes_symbol_day_scan", _DAY_SCAN + f" AND symbol = '{SCAN_SYMBOL}'")
reg("bars_quality", _with([BARS_V], (
    "SELECT symbol, count(*) AS n_bars, count(*) FILTER (WHERE high < greatest(open, close)) AS n_high_below_body, "
    "count(*) FILTER (WHERE low > least(open, close)) AS n_low_above_body, "
    "count(*) FILTER (WHERE volume = 0) AS n_zero_volume, count(*) FILTER (WHERE volume IS NULL) AS n_null_volume "
    "FROM bars_v GROUP BY symbol")))
reg("history_tsv_load", _with([BARS_V], "SELECT * FROM bars_v"))
reg("history_union", _with([BARS_V], "SELECT * FROM bars_v"))
assert HISTORY_CUT_END >= DAILY_CUT_START  # the two dumps overlap, so their union is the whole table

# ------------------------------------------------------------- symbols ----
reg("symbols_scan", _with([SYMBOLS_V], "SELECT * FROM symbols_v"))
reg("symbols_csv_load", _with([SYMBOLS_V], (
    "SELECT symbol, min(tb) AS tb FROM (SELECT * FROM symbols_v UNION ALL SELECT 'ZZZ', 'zzz_old') GROUP BY symbol")))
reg("symbols_pk_audit", _with([SYMBOLS_V], (
    "SELECT symbol, count(*) AS n_rows FROM (SELECT * FROM symbols_v UNION ALL SELECT 'ZZZ', 'zzz_old') "
    "GROUP BY symbol HAVING count(*) > 1")))

# ------------------------------------------------------------- history ----
_HISTORY = _with([BARS_V], (
    "SELECT symbol, row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) - 1 AS id, open AS Open, "
    "high AS High, low AS Low, close AS Close, volume AS Volume, trade_date AS Date FROM bars_v"))
reg("history_for_symbol", _HISTORY)
reg("history_one_symbol", _HISTORY + f" WHERE symbol = '{ONE_SYMBOL}'")
reg("sql_passthrough", _with([BARS_V, ("bars", "SELECT * FROM bars_v")], PASSTHROUGH_SQL))
reg("history_bounds", _with([BARS_V], (
    "SELECT symbol, min(trade_date) AS first_date, max(trade_date) AS last_date, count(*) AS n_bars "
    "FROM bars_v GROUP BY symbol")))
reg("bars_date_range", _with([BARS_V], (
    f"SELECT * FROM bars_v WHERE trade_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'")))
_PRESET_START = {"last_week": "a - INTERVAL 7 DAY", "last_month": "a - INTERVAL 1 MONTH",
                 "last_year": "a - INTERVAL 12 MONTH", "last_5_years": "a - INTERVAL 60 MONTH"}
for _name, _start in _PRESET_START.items():
    reg(f"bars_{_name}", _with([BARS_V, ("anch", "SELECT *, max(trade_date) OVER (PARTITION BY symbol) AS a FROM bars_v")], (
        "SELECT symbol, trade_date, open, high, low, close, volume FROM anch "
        f"WHERE trade_date BETWEEN CAST({_start} AS DATE) AND a")))
    reg(f"bars_{_name}_as_of", _with([BARS_V], (
        "SELECT symbol, trade_date, open, high, low, close, volume FROM (SELECT *, "
        f"DATE '{AS_OF}' AS a FROM bars_v) t WHERE trade_date BETWEEN CAST({_start} AS DATE) AND a")))
reg("kpi_latest", _with([BARS_V, ("k", (
    "SELECT *, lag(open) OVER w AS p_open, lag(high) OVER w AS p_high, lag(low) OVER w AS p_low, "
    "lag(close) OVER w AS p_close, row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS rn "
    "FROM bars_v WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)"))], (
    "SELECT symbol, trade_date, open, high, low, close, open - p_open AS open_delta, high - p_high AS high_delta, "
    "low - p_low AS low_delta, close - p_close AS close_delta FROM k WHERE rn = 1")))
reg("chart_volume", _with([BARS_V], "SELECT symbol, trade_date AS Date, volume AS Volume FROM bars_v"))
reg("chart_candles", _with([BARS_V], (
    "SELECT symbol, trade_date AS Date, open AS Open, high AS High, low AS Low, close AS Close FROM bars_v")))
_BARS_IN_RANGE = ("bars_r", f"SELECT * FROM bars_v WHERE trade_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}'")
reg("chart_candles_range", _with([BARS_V, _BARS_IN_RANGE], (
    "SELECT symbol, trade_date AS Date, open AS Open, high AS High, low AS Low, close AS Close FROM bars_r")))
reg("chart_volume_close", _with([BARS_V], "SELECT symbol, trade_date AS Date, volume AS Volume, close AS Close FROM bars_v"))
reg("chart_prices_long", _with([BARS_V], " UNION ALL ".join(
    f"SELECT symbol, trade_date, '{c}' AS series, {c} AS price FROM bars_v" for c in ["open", "high", "low", "close"])))

_CORR_COLS = ["open", "close", "high", "low", "volume"]


def _corr_sql(rounding: str, source: tuple = BARS_V) -> str:
    aggs = [f"stddev_pop({c}) AS sd_{c}" for c in _CORR_COLS]
    aggs += [f"covar_pop({a}, {b}) AS cv_{a}_{b}" for a, b in combinations(_CORR_COLS, 2)]
    cells = []
    for i, a in enumerate(_CORR_COLS):
        for j, b in enumerate(_CORR_COLS):
            if i == j:
                val = f"CASE WHEN sd_{a} > 0 THEN 1.0 END"
            else:
                x, y = (a, b) if i < j else (b, a)
                val = rounding.format(f"cv_{x}_{y} / NULLIF(sd_{a} * sd_{b}, 0)") + " + 0.0"
            cells.append(f"SELECT symbol, '{a}' AS row_col, '{b}' AS col_col, CAST({val} AS DOUBLE) AS corr FROM st")
    return _with(list(dict.fromkeys([BARS_V, source])) + [
        ("st", f"SELECT symbol, {', '.join(aggs)} FROM {source[0]} GROUP BY symbol")],
                 " UNION ALL ".join(cells))


reg("corr_matrix", _corr_sql("round({}, 6)"))
reg("corr_matrix_range", _corr_sql("round({}, 6)", _BARS_IN_RANGE))
reg("corr_matrix_rounded", _corr_sql("round_even({}, 2)"))

# ------------------------------------------------------------ features ----
SPLIT = ("split", (
    "SELECT symbol, trade_date, close, row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS rn, "
    "count(*) OVER (PARTITION BY symbol) AS n FROM bars_v"))
SPLIT2 = ("split2", (
    "SELECT *, (n * 9 + 9) // 10 AS train_len, CASE WHEN rn <= (n * 9 + 9) // 10 THEN 'train' ELSE 'valid' END AS split "
    "FROM split"))
SCALED = ("scaled_t", (
    "SELECT *, min(close) OVER (PARTITION BY symbol) AS x_min, max(close) OVER (PARTITION BY symbol) AS x_max FROM split2"))
SCALED2 = ("scaled2", (
    "SELECT *, CASE WHEN x_max - x_min = 0 THEN 0.0 ELSE (close - x_min) / (x_max - x_min) END AS scaled FROM scaled_t"))
LAGS = ("lags", (
    "SELECT *, " + ", ".join(f"lag(scaled, {i}) OVER (PARTITION BY symbol ORDER BY trade_date) AS lag_{i}" for i in range(1, 6))
    + " FROM scaled2"))
reg("close_series", _with([BARS_V], "SELECT symbol, trade_date, close FROM bars_v"))
reg("train_valid_split", _with([BARS_V, SPLIT, SPLIT2], "SELECT * FROM split2"))
reg("minmax_scale", _with([BARS_V, SPLIT, SPLIT2, SCALED, SCALED2],
                          "SELECT symbol, trade_date, close, x_min, x_max, scaled FROM scaled2"))
reg("minmax_inverse", _with([BARS_V, SPLIT, SPLIT2, SCALED, SCALED2],
                            "SELECT symbol, trade_date, close, scaled * (x_max - x_min) + x_min AS unscaled FROM scaled2"))
_LAG_SEL = "SELECT symbol, trade_date, " + ", ".join(f"lag_{i}" for i in range(1, 6)) + ", scaled AS label FROM lags "
reg("lag_windows_train", _with([BARS_V, SPLIT, SPLIT2, SCALED, SCALED2, LAGS], _LAG_SEL + "WHERE rn > 5 AND split = 'train'"))
reg("lag_windows_valid", _with([BARS_V, SPLIT, SPLIT2, SCALED, SCALED2, LAGS], _LAG_SEL + "WHERE split = 'valid'"))
reg("diff_series", _with([BARS_V], (
    "SELECT symbol, trade_date, close, close - lag(close) OVER (PARTITION BY symbol ORDER BY trade_date) AS diff FROM bars_v")))

# ------------------------------------------------------------ forecast ----
P = 5
_W = "(PARTITION BY symbol ORDER BY trade_date)"
_BEFORE = "(PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
AR_Y = ("ar_y", "SELECT *, CAST(round(close / 0.01) AS BIGINT) AS y FROM split2")
AR_D = ("ar_d", f"SELECT *, lag(y) OVER {_W} AS y_prev, y - lag(y) OVER {_W} AS dy FROM ar_y")
AR_X = ("ar_x", "SELECT *, " + ", ".join(f"lag(dy, {i}) OVER {_W} AS x{i}" for i in range(1, P + 1)) + " FROM ar_d")


def _num(c: str) -> str:
    return f"CAST({c} AS DECIMAL(19,0))"


_ar_sums = []
for _i in range(1, P + 1):
    for _j in range(_i, P + 1):
        _ar_sums.append(f"sum(CASE WHEN x{P} IS NOT NULL THEN {_num(f'x{_i}')} * {_num(f'x{_j}')} END) "
                        f"OVER {_BEFORE} AS g{_i}_{_j}")
    _ar_sums.append(f"sum(CASE WHEN x{P} IS NOT NULL THEN {_num(f'x{_i}')} * {_num('dy')} END) OVER {_BEFORE} AS b{_i}")
AR_S = ("ar_s", "SELECT *, " + ", ".join(_ar_sums) + " FROM ar_x")
AR_V = ("ar_v", "SELECT * FROM ar_s WHERE split = 'valid'")
_keep = ["symbol", "trade_date", "close", "y_prev"] + [f"x{i}" for i in range(1, P + 1)]
_ar_ctes, _ar_final = solve_sql(P, "ar_v", [[f"g{min(i, j)}_{max(i, j)}" for j in range(1, P + 1)] for i in range(1, P + 1)],
                                [f"b{i}" for i in range(1, P + 1)], [f"phi{i}" for i in range(1, P + 1)], _keep, "gja")
_yhat = "CAST(y_prev AS DOUBLE)" + "".join(f" + phi{i} * CAST(x{i} AS DOUBLE)" for i in range(1, P + 1))
AR_PRED = ("ar_pred", f"SELECT symbol, trade_date, close, ({_yhat}) * 0.01 AS prediction_raw FROM {_ar_final}")
AR_CTES = [BARS_V, SPLIT, SPLIT2, AR_Y, AR_D, AR_X, AR_S, AR_V, *_ar_ctes, AR_PRED]

OLS_X = ("ols_x", "SELECT *, CAST(1 AS BIGINT) AS one, "
         + ", ".join(f"lag(y, {i}) OVER {_W} AS x{i}" for i in range(1, P + 1)) + " FROM ar_y")
_xs = ["one"] + [f"x{i}" for i in range(1, P + 1)]
_ols_sums = []
for _i in range(P + 1):
    for _j in range(_i, P + 1):
        _ols_sums.append(f"sum({_num(_xs[_i])} * {_num(_xs[_j])}) AS g{_i}_{_j}")
    _ols_sums.append(f"sum({_num(_xs[_i])} * {_num('y')}) AS b{_i}")
OLS_N = ("ols_n", "SELECT symbol, " + ", ".join(_ols_sums) + " FROM ols_x WHERE split = 'train' AND rn > 5 GROUP BY symbol")
_ols_ctes, _ols_final = solve_sql(P + 1, "ols_n", [[f"g{min(i, j)}_{max(i, j)}" for j in range(P + 1)] for i in range(P + 1)],
                                  [f"b{i}" for i in range(P + 1)], [f"c{i}" for i in range(P + 1)], ["symbol"], "gjo")
_olshat = "c0" + "".join(f" + c{i} * CAST(x{i} AS DOUBLE)" for i in range(1, P + 1))
OLS_PRED = ("ols_pred", (
    f"SELECT v.symbol, v.trade_date, v.close, ({_olshat}) * 0.01 AS prediction_raw "
    f"FROM ols_x v JOIN {_ols_final} c ON v.symbol = c.symbol WHERE v.split = 'valid'"))
OLS_CTES = [BARS_V, SPLIT, SPLIT2, AR_Y, OLS_X, OLS_N, *_ols_ctes, OLS_PRED]

_FINISH = "SELECT symbol, trade_date, close, round(prediction_raw, 2) AS prediction FROM {}"
reg("forecast_ar5_walkforward", _with(AR_CTES, _FINISH.format("ar_pred")))
reg("forecast_lag_ols", _with(OLS_CTES, _FINISH.format("ols_pred")))
_RMSE = ("SELECT symbol, '{m}' AS model, count(prediction_raw) AS n_valid, sqrt(avg(pow(close - prediction_raw, 2))) AS rmse_raw "
         "FROM {src} GROUP BY symbol")
RMSE_AR = ("rmse_ar", _RMSE.format(m="ar5", src="ar_pred"))
RMSE_OLS = ("rmse_ols", _RMSE.format(m="lag_ols", src="ols_pred"))
ALL_CTES = AR_CTES + [c for c in OLS_CTES if c not in AR_CTES] + [RMSE_AR, RMSE_OLS]
reg("rmse_ar5", _with(AR_CTES + [RMSE_AR], "SELECT symbol, model, n_valid, round(rmse_raw, 4) AS rmse FROM rmse_ar"))
reg("rmse_lag_ols", _with(OLS_CTES + [RMSE_OLS], "SELECT symbol, model, n_valid, round(rmse_raw, 4) AS rmse FROM rmse_ols"))
reg("rmse_report", _with(ALL_CTES, (
    "SELECT symbol, model, printf('Test RMSE: %.3f', rmse_raw) AS report FROM "
    "(SELECT * FROM rmse_ar UNION ALL SELECT * FROM rmse_ols)")))
reg("model_comparison", _with(ALL_CTES, (
    "SELECT symbol, model, round(rmse_raw, 4) AS rmse, "
    "row_number() OVER (PARTITION BY symbol ORDER BY rmse_raw ASC NULLS LAST, model) AS rank "
    "FROM (SELECT * FROM rmse_ar UNION ALL SELECT * FROM rmse_ols)")))
_LAST = ("SELECT symbol, '{m}' AS model, max(trade_date) AS trade_date, round(arg_max(prediction_raw, trade_date), 2) "
         "AS prediction FROM {src} GROUP BY symbol")
reg("forecast_last", _with(ALL_CTES, _LAST.format(m="ar5", src="ar_pred") + " UNION ALL " + _LAST.format(m="lag_ols", src="ols_pred")))
_CHART = ("SELECT symbol, trade_date, split AS series, close AS value, '{m}' AS model FROM split2 UNION ALL "
          "SELECT symbol, trade_date, 'prediction', round(prediction_raw, 2), '{m}' FROM {src}")
reg("forecast_chart_frame", _with(AR_CTES, _CHART.format(m="ar5", src="ar_pred")))
reg("forecast_chart_frame_ols", _with(OLS_CTES, _CHART.format(m="lag_ols", src="ols_pred")))

# one regression over every symbol's scaled lag windows, by its normal equations
_ML_X = ["1.0"] + [f"lag_{i}" for i in range(1, P + 1)]
_ml_sums = [f"sum(CAST({_ML_X[i]} AS DOUBLE) * {_ML_X[j]}) AS g{i}_{j}" for i in range(P + 1) for j in range(i, P + 1)]
_ml_sums += [f"sum({_ML_X[i]} * scaled) AS b{i}" for i in range(P + 1)]
ML_N = ("ml_n", f"SELECT 1 AS one, {', '.join(_ml_sums)} FROM lags WHERE split = 'train' AND rn > 5")
_ml_ctes, _ml_final = solve_sql(P + 1, "ml_n", [[f"g{min(i, j)}_{max(i, j)}" for j in range(P + 1)] for i in range(P + 1)],
                                [f"b{i}" for i in range(P + 1)], [f"c{i}" for i in range(P + 1)], ["one"], "gjm")
_mlhat = "c0" + "".join(f" + c{i} * lag_{i}" for i in range(1, P + 1))
reg("forecast_lag_mllib", _with([BARS_V, SPLIT, SPLIT2, SCALED, SCALED2, LAGS, ML_N, *_ml_ctes], (
    f"SELECT symbol, trade_date, close, round(({_mlhat}) * (x_max - x_min) + x_min, 2) AS prediction "
    f"FROM lags JOIN {_ml_final} ON one = 1 WHERE split = 'valid' AND rn > 5")))

# ---------------------------------------------------------------- feed ----
_GRID = " UNION ALL ".join(
    f"SELECT {i + 1} AS request_seq, '{c}' AS exchange_code, '{a}' AS key_area"
    for i, (c, a) in enumerate((c, a) for c in EXCHANGE_CODES for a in KEY_AREAS))
reg("feed_requests", _with([RAW_V, ("grid", _GRID), ("cnt", (
    "SELECT exchange_code, key_area, count(*) AS n_responses, count(*) FILTER (WHERE status = 200) AS n_ok "
    "FROM raw_v GROUP BY 1, 2"))], (
    "SELECT g.request_seq, g.exchange_code, g.key_area, COALESCE(c.n_responses, 0) AS n_responses, "
    "COALESCE(c.n_ok, 0) AS n_ok FROM grid g LEFT JOIN cnt c USING (exchange_code, key_area)")))
reg("feed_explode", _with([RAW_V, ITEMS], "SELECT response_id, CAST(item_pos AS INTEGER) AS item_pos, content FROM items"))
reg("feed_union", _with([RAW_V, ITEMS], (
    "SELECT exchange_code, key_area, response_id, CAST(item_pos AS INTEGER) AS item_pos, content FROM items")))
reg("quotes_parsed", _with(FEED[:6], (
    "SELECT response_id, CAST(item_pos AS INTEGER) AS item_pos, ticker AS symbol, k AS field, v AS value FROM last_fields")))
reg("quotes_metadata", _with(FEED[:4], (
    "SELECT response_id, CAST(item_pos AS INTEGER) AS item_pos, CAST(meta_pos AS INTEGER) AS meta_pos, token FROM ("
    "SELECT response_id, item_pos, unnest(range(len(m))) AS meta_pos, unnest(m) AS token FROM ("
    "SELECT response_id, item_pos, list_filter(body, lambda x: instr(x, '*') = 0) AS m FROM parsed "
    "WHERE has_pipe AND first_empty) a) b")))
_GOOD = (f"SELECT response_id, CAST(item_pos AS INTEGER) AS item_pos, ticker AS symbol, '{EXCHANGE_NAME}' AS exchange_name, "
         f"fetched_at AS trade_time, {', '.join(QUOTE_NUMERIC_FIELDS)} FROM typed WHERE reject_reason IS NULL")
reg("quotes_typed", _with(FEED, _GOOD))
reg("quotes_stamp", _with(FEED + [("good", _GOOD)],
                          "SELECT response_id, item_pos, symbol, exchange_name, trade_time FROM good"))
reg("quotes_rejects", _with(FEED, (
    "SELECT response_id, CAST(item_pos AS INTEGER) AS item_pos, content, reject_reason FROM typed "
    "WHERE reject_reason IS NOT NULL")))
reg("publish_batches", _with(FEED + [("good", _GOOD), ("seq", (
    "SELECT row_number() OVER (ORDER BY trade_time, response_id, item_pos) AS seq FROM good"))], (
    f"SELECT CAST(ceil(seq / {PUBLISH_BATCH_SIZE}) AS BIGINT) AS batch_no, count(*) AS n_records, "
    f"min(seq) AS first_seq, max(seq) AS last_seq FROM seq GROUP BY 1")))

# ------------------------------------------------------------- framing ----
_SID = "CASE WHEN msg_seq % 2 = 0 THEN 1 ELSE 2 END"
# the message body: the writer schema's non-null fields as JSON, in schema order
_JSON_FIELDS = "".join(f" || CASE WHEN {f} IS NULL THEN '' ELSE ',\"{f}\":' || CAST({f} AS VARCHAR) END" for f in QUOTE_NUMERIC_FIELDS)
_BODY = ("'{\"symbol\":\"' || symbol || '\",\"exchange_name\":\"' || exchange_name || '\",\"trade_time\":\"' "
         "|| strftime(trade_time, '%Y-%m-%dT%H:%M:%S.%fZ') || '\"'" + _JSON_FIELDS +
         f" || CASE WHEN {_SID} = 2 THEN ',\"lot_size\":100.0' ELSE '' END || '}}'")
FRAMES = ("frames", f"SELECT CAST(msg_seq AS VARCHAR) AS key, msg_seq, {_SID} AS sid, last_price, symbol, {_BODY} AS body FROM quotes_v")
reg("frame_quotes", _with([QUOTES_V, FRAMES], (
    "SELECT key, printf('%02X%08X', 0, sid) AS header_hex, CAST(strlen(body) + 5 AS INTEGER) AS n_bytes, "
    "md5(body) AS body_md5 FROM frames")))
reg("stage_rejects", _with([QUOTES_V, FRAMES], (
    "SELECT 'bad-' || key AS key, CASE msg_seq % 6 WHEN 0 THEN 'short_frame' WHEN 1 THEN 'bad_magic' "
    "WHEN 2 THEN 'unknown_schema' WHEN 3 THEN 'bad_body' WHEN 4 THEN 'bad_body' ELSE 'missing_field' END AS reason, "
    "CAST(CASE msg_seq % 6 WHEN 0 THEN 2 WHEN 3 THEN 13 WHEN 4 THEN strlen(body) + 10 - strlen(CAST(last_price AS VARCHAR)) "
    "WHEN 5 THEN strlen(body) + 5 - strlen(symbol) ELSE strlen(body) + 5 END AS INTEGER) AS n_bytes, "
    "CASE msg_seq % 6 WHEN 0 THEN '0000' WHEN 1 THEN '0100000001' WHEN 2 THEN '0000000063' "
    "ELSE printf('%02X%08X', 0, sid) END AS header_hex FROM frames")))
reg("unframe_quotes", _with([QUOTES_V, FRAMES], (
    "SELECT key, 0 AS magic, sid AS schema_id, symbol, last_price, CAST(strlen(body) AS INTEGER) AS n_bytes, "
    "md5(body) AS payload_md5 FROM frames")))
reg("distinct_schema_ids", _with([QUOTES_V], (
    f"SELECT {_SID} AS schema_id, count(*) AS n_messages FROM quotes_v GROUP BY 1")))
_STAGED = (f"SELECT CAST(msg_seq AS VARCHAR) AS key, {_SID} AS schema_id, {_QUOTE_COLS}, "
           f"CASE WHEN msg_seq % 2 = 0 THEN NULL ELSE CAST(100.0 AS DOUBLE) END AS lot_size")
reg("stage_by_schema", _with([QUOTES_V], (
    _STAGED + ", strftime(trade_time, '%Y') AS year, strftime(trade_time, '%m') AS month, "
    "strftime(trade_time, '%d') AS day FROM quotes_v")))
reg("partition_columns", _with([QUOTES_V], (
    "SELECT symbol, msg_seq, trade_time, strftime(trade_time, '%Y') AS year, strftime(trade_time, '%m') AS month, "
    "strftime(trade_time, '%d') AS day FROM quotes_v")))

# ----------------------------------------------------------- streaming ----
reg("stream_stage", _with([QUOTES_V], (
    _STAGED + ", CAST(year(trade_time) AS INTEGER) AS year, CAST(month(trade_time) AS INTEGER) AS month, "
    "CAST(day(trade_time) AS INTEGER) AS day FROM quotes_v")))
reg("stream_daily_bars", _with([QUOTES_V, (
    "db", "SELECT q.symbol, CAST(q.trade_time AS DATE) AS trade_date, "
    "arg_max(open_price, (trade_time, msg_seq)) AS open, arg_max(max_price, (trade_time, msg_seq)) AS high, "
    "arg_max(min_price, (trade_time, msg_seq)) AS low, arg_max(close_price, (trade_time, msg_seq)) AS close, "
    "CAST(arg_max(traded_quantity, (trade_time, msg_seq)) AS BIGINT) AS volume FROM quotes_v q GROUP BY 1, 2")], (
    "SELECT * FROM db")))
reg("stream_dedup", _with([QUOTES_V], "SELECT CAST(msg_seq AS VARCHAR) AS key, symbol, trade_time, last_price FROM quotes_v"))

# staged in another way, the rows are the same
ORACLE["stream_replay"] = ORACLE["staged_compaction"] = ORACLE["stream_stage"]
ORACLE["history_one_symbol_bucketed"], ORACLE["history_for_symbol_bucketed"] = ORACLE["history_one_symbol"], ORACLE["history_for_symbol"]
reg("dump_sections_load", _with([BARS_V], (
    f"SELECT 'historical' AS database, * FROM bars_v WHERE trade_date <= DATE '{HISTORY_CUT_END}' "
    f"UNION ALL SELECT 'stock' AS database, * FROM bars_v WHERE trade_date >= DATE '{DAILY_CUT_START}'")))
for _chart in ("chart_volume", "chart_volume_close", "chart_prices_long"):  # the same frames of the filtered bars
    reg(f"{_chart}_range", ORACLE[_chart].replace(
        "FROM bars_v", f"FROM (SELECT * FROM bars_v WHERE trade_date BETWEEN DATE '{RANGE_START}' AND DATE '{RANGE_END}') r"))
