"""DuckDB SQL for every registered query (the correctness oracle).

The SQL is written for the driver's pre-registered views (``events``,
``lineitem``, ...). It states each operator in its plain textbook form
(windows partitioned by symbol, GROUP BY, joins), independent of how the
Spark side partitions the work. Derived doubles use the same rounding
form as ``tickflow.functions.numeric.rnd``.
"""

from __future__ import annotations

import math

from tickflow.schemas import (
    CHECK_MESSAGES, EVENT_ASSETS, EVENT_PRICE_RANGES, SPREAD_PCT,
)

ORDER = "event_time, tick_number"
SYM = "PARTITION BY symbol ORDER BY " + ORDER


def R(x: str, n: int) -> str:
    """SQL form of ``rnd``."""
    return f"round(({x}) + sign({x}) * {float(f'1e-{n + 5}')!r}, {n})"


def PR(x: str) -> str:
    """SQL form of ``price_round`` (forex 4 decimals, else 2)."""
    return f"CASE WHEN asset_type = 'forex' THEN {R(x, 4)} ELSE {R(x, 2)} END"


def frame(k: int) -> str:
    return f"({SYM} ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"


def asset_case(col: str = "event_type") -> str:
    whens = " ".join(f"WHEN '{s}' THEN '{t}'" for s, _p, t, _c in EVENT_ASSETS)
    return f"CASE {col} {whens} END"


def registry_values() -> str:
    rows = ", ".join(f"('{s}', {p!r}::DOUBLE, '{t}', {SPREAD_PCT[t]!r}::DOUBLE)"
                     for s, p, t, _c in EVENT_ASSETS)
    return f"(VALUES {rows}) AS reg(symbol, initial_price, reg_asset_type, spread_pct)"


def ranges_values() -> str:
    rows = ", ".join(f"('{s}', {lo!r}::DOUBLE, {hi!r}::DOUBLE)" for s, lo, hi in EVENT_PRICE_RANGES)
    return f"(VALUES {rows}) AS rng(symbol, lo, hi)"


TICKS = f"""ticks AS (
  SELECT event_type AS symbol, {asset_case()} AS asset_type, 'USD' AS currency,
         ts AS event_time, event_id AS tick_number,
         100.0::DOUBLE + value / 20.0::DOUBLE AS price,
         CAST(json_extract(props, '$.k') AS BIGINT) AS volume
  FROM events)"""

RET = "CASE WHEN _prev = 0 THEN 0.0::DOUBLE ELSE (price - _prev) / _prev END"

ENRICHED = f"""{TICKS},
e1 AS (
  SELECT *, lag(price) OVER ({SYM}) AS _prev,
         avg(price) OVER {frame(4)} AS _sma5,
         avg(price) OVER {frame(19)} AS _sma20,
         first_value(price) OVER {frame(4)} AS open,
         max(price) OVER {frame(4)} AS _hi,
         min(price) OVER {frame(4)} AS _lo,
         row_number() OVER ({SYM}) AS tick_seq
  FROM ticks),
e2 AS (SELECT *, {RET} AS _ret FROM e1),
e3 AS (SELECT *, avg(_ret * _ret) OVER {frame(9)} AS _ms FROM e2),
e4 AS (
  SELECT e3.*, {R('_ret * 100.0::DOUBLE', 4)} AS returns_pct,
         {PR('_sma5')} AS sma5, {PR('_sma20')} AS sma20,
         {PR('_hi')} AS high, {PR('_lo')} AS low,
         {R(f'sqrt(_ms) * {math.sqrt(252)!r}', 4)} AS realized_vol,
         COALESCE(abs(_ret) > 0.03, false) AS is_anomaly,
         CASE WHEN abs(_ret) > 0.03 THEN CASE WHEN _ret < 0 THEN 'flash_crash' ELSE 'price_spike' END END
           AS anomaly_type,
         reg.spread_pct
  FROM e3 LEFT JOIN {registry_values()} ON e3.symbol = reg.symbol),
enriched AS (
  SELECT symbol, asset_type, currency, event_time, tick_number, tick_seq, price, volume,
         open, high, low,
         {R('price - price * spread_pct / 2.0::DOUBLE', 4)} AS bid,
         {R('price + price * spread_pct / 2.0::DOUBLE', 4)} AS ask,
         {R('price * spread_pct', 6)} AS spread,
         returns_pct, sma5, sma20, realized_vol, is_anomaly, anomaly_type,
         CASE WHEN sma5 > sma20 THEN 'BUY' ELSE 'SELL' END AS signal
  FROM e4)"""

ALERTED = f"""{ENRICHED},
alerted AS (
  SELECT *,
    CASE WHEN returns_pct < -3.0 THEN 'FLASH_CRASH' WHEN returns_pct > 3.0 THEN 'SPIKE' END AS price_alert,
    CASE WHEN returns_pct < -8.0 THEN 'CRITICAL' WHEN returns_pct < -3.0 THEN 'HIGH'
         WHEN returns_pct > 8.0 THEN 'CRITICAL' WHEN returns_pct > 3.0 THEN 'HIGH' ELSE 'NONE' END
      AS alert_severity
  FROM enriched)"""

_UNITS = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
          "day": 86400, "days": 86400}


def seconds(interval: str) -> int:
    n, unit = interval.split()
    return int(n) * _UNITS[unit]


def bar_starts(size: str, slide: str | None, ts: str = "event_time") -> str:
    """SQL expression (unnest list) of the window starts holding ``ts``."""
    step = slide or size
    k = seconds(size) // seconds(step)
    b = f"time_bucket(INTERVAL '{seconds(step)} seconds', {ts})"
    items = [b] + [f"{b} - INTERVAL '{i * seconds(step)} seconds'" for i in range(1, k)]
    return "unnest([" + ", ".join(items) + "])"


def bars_sql(src: str, size: str, slide: str | None, source: str = "price",
             zero_volume: float | None = None, rounded: bool = True, extra: str = "") -> str:
    """Bars over CTE ``src`` (needs the alerted tick columns)."""
    if source == "price":
        o, h, l = f"arg_min(price, row({ORDER}))", "max(price)", "min(price)"  # noqa: E741
    else:
        o, h, l = f"arg_min(open, row({ORDER}))", "max(high)", "min(low)"  # noqa: E741
    vwap = "sum(price * volume) / NULLIF(sum(volume), 0)"
    extra = f", {extra}" if extra else ""
    if zero_volume is not None:
        vwap = f"CASE WHEN sum(volume) = 0 THEN {float(zero_volume)!r}::DOUBLE ELSE {vwap} END"
    r = (lambda x, n: R(x, n)) if rounded else (lambda x, n: x)
    return f"""
  SELECT ws AS window_start, ws + INTERVAL '{seconds(size)} seconds' AS window_end, symbol, asset_type,
         {o} AS open, {h} AS high, {l} AS low, arg_max(price, row({ORDER})) AS close,
         CAST(sum(volume) AS BIGINT) AS volume,
         {r(vwap, 4)} AS vwap,
         {r('avg(realized_vol)', 6)} AS avg_realized_vol,
         {r('avg(spread)', 6)} AS avg_spread,
         count(*) AS tick_count, count(price_alert) AS alert_count,
         {r('avg(returns_pct)', 4)} AS avg_return_pct,
         {r('stddev_samp(returns_pct)', 4)} AS stddev_return_pct{extra}
  FROM (SELECT *, {bar_starts(size, slide)} AS ws FROM {src} WHERE price IS NOT NULL AND event_time IS NOT NULL)
  GROUP BY ws, symbol, asset_type"""


BAR_SIZE, BAR_SLIDE = "1 hour", "30 minutes"
BARS = f"""{ALERTED},
bars AS ({bars_sql('alerted', BAR_SIZE, BAR_SLIDE)})"""

STORED = f"""{ALERTED},
rbars AS ({bars_sql('alerted', BAR_SIZE, BAR_SLIDE, rounded=False)}),
stored AS (SELECT *, window_end AS created_at FROM rbars)"""

STAGING = f"""{STORED},
stg AS (
  SELECT window_start, window_end, symbol, asset_type,
         {R('open', 4)} AS open, {R('high', 4)} AS high, {R('low', 4)} AS low, {R('close', 4)} AS close,
         volume, {R('vwap', 4)} AS vwap, {R('avg_realized_vol', 6)} AS realized_vol,
         {R('avg_spread', 6)} AS avg_spread, tick_count, alert_count,
         {R('avg_return_pct', 4)} AS avg_return_pct, {R('stddev_return_pct', 4)} AS stddev_return_pct,
         {R('CAST(alert_count AS DOUBLE) / NULLIF(tick_count, 0) * 100.0::DOUBLE', 2)} AS alert_rate_pct,
         window_end AS created_at
  FROM stored WHERE close > 0 AND volume > 0 AND high >= low)"""


def with_cte(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


ENRICHED_COLS = ("symbol, asset_type, currency, event_time, tick_number, tick_seq, price, volume, "
                 "open, high, low, bid, ask, spread, returns_pct, sma5, sma20, realized_vol, "
                 "is_anomaly, anomaly_type, signal")

__all__ = ["R", "PR", "TICKS", "ENRICHED", "ALERTED", "BARS", "STAGING", "with_cte", "bars_sql",
           "ranges_values", "registry_values", "CHECK_MESSAGES", "ENRICHED_COLS", "seconds"]


ORACLE: dict[str, str] = {}

_RET_ONLY = f"""{TICKS},
r1 AS (SELECT *, lag(price) OVER ({SYM}) AS _prev FROM ticks)"""

ORACLE["returns"] = with_cte(_RET_ONLY, f"""
SELECT symbol, event_time, tick_number, price, _prev AS prev_price,
       {R(f'({RET}) * 100.0::DOUBLE', 4)} AS returns_pct
FROM r1""")

ORACLE["sma_signal"] = with_cte(f"""{TICKS},
s1 AS (SELECT *, {PR(f'avg(price) OVER {frame(4)}')} AS sma5,
              {PR(f'avg(price) OVER {frame(19)}')} AS sma20 FROM ticks)""", """
SELECT symbol, event_time, tick_number, price, sma5, sma20,
       CASE WHEN sma5 > sma20 THEN 'BUY' ELSE 'SELL' END AS signal
FROM s1""")

ORACLE["realized_vol"] = with_cte(f"""{_RET_ONLY},
r2 AS (SELECT *, {RET} AS _ret FROM r1),
r3 AS (SELECT *, avg(_ret * _ret) OVER {frame(9)} AS _ms FROM r2)""", f"""
SELECT symbol, event_time, tick_number, price,
       {R(f'sqrt(_ms) * {math.sqrt(252)!r}', 4)} AS realized_vol
FROM r3""")

ORACLE["rolling_ohlc5"] = with_cte(f"""{TICKS},
o1 AS (SELECT *, first_value(price) OVER {frame(4)} AS open,
              max(price) OVER {frame(4)} AS _hi, min(price) OVER {frame(4)} AS _lo FROM ticks)""", f"""
SELECT symbol, event_time, tick_number, price, open, {PR('_hi')} AS high, {PR('_lo')} AS low
FROM o1""")

ORACLE["tick_number"] = with_cte(TICKS, f"""
SELECT symbol, event_time, tick_number, row_number() OVER ({SYM}) AS tick_seq FROM ticks""")

ORACLE["quote_spread"] = with_cte(TICKS, f"""
SELECT t.symbol, t.asset_type, t.tick_number, t.price,
       {R('t.price - t.price * reg.spread_pct / 2.0::DOUBLE', 4)} AS bid,
       {R('t.price + t.price * reg.spread_pct / 2.0::DOUBLE', 4)} AS ask,
       {R('t.price * reg.spread_pct', 6)} AS spread
FROM ticks t LEFT JOIN {registry_values()} ON t.symbol = reg.symbol""")

ORACLE["enriched_ticks"] = with_cte(ENRICHED, f"SELECT {ENRICHED_COLS} FROM enriched")

ORACLE["alert_classify"] = with_cte(ALERTED, """
SELECT symbol, tick_number, returns_pct, price_alert, alert_severity FROM alerted""")

ORACLE["alert_messages"] = with_cte(ALERTED, """
SELECT symbol AS key, symbol, asset_type,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS timestamp,
       price, returns_pct, volume, price_alert, alert_severity
FROM alerted WHERE price_alert IS NOT NULL""")

ORACLE["alert_severity_counts"] = with_cte(ALERTED, """
SELECT symbol, alert_severity, count(*) AS n_ticks,
       count(*) FILTER (WHERE price_alert = 'SPIKE') AS n_spike,
       count(*) FILTER (WHERE price_alert = 'FLASH_CRASH') AS n_crash
FROM alerted GROUP BY symbol, alert_severity""")

ORACLE["route_anomalies"] = with_cte(ENRICHED, """
SELECT 'market.ticks' AS topic, symbol, tick_number, is_anomaly, anomaly_type FROM enriched
UNION ALL
SELECT 'market.anomalies' AS topic, symbol, tick_number, is_anomaly, anomaly_type FROM enriched
WHERE is_anomaly""")

ORACLE["bars_sliding"] = with_cte(BARS, "SELECT * FROM bars")

ORACLE["bars_sliding_tick_ohlc"] = with_cte(
    f"{ALERTED},\nbars AS ({bars_sql('alerted', BAR_SIZE, BAR_SLIDE, source='tick_ohlc')})",
    "SELECT * FROM bars")

ORACLE["bars_tumbling"] = with_cte(
    f"{ALERTED},\nbars AS ({bars_sql('alerted', BAR_SIZE, None)})", "SELECT * FROM bars")

ORACLE["bars_bollinger"] = with_cte(f"""{ALERTED},
b0 AS ({bars_sql('alerted', BAR_SIZE, BAR_SLIDE, rounded=False)})""", f"""
SELECT window_start, symbol, {R('vwap', 4)} AS vwap, {R('stddev_return_pct', 4)} AS stddev_return_pct,
       {R('vwap + 2.0::DOUBLE * stddev_return_pct * vwap / 100.0::DOUBLE', 4)} AS bollinger_upper,
       {R('vwap - 2.0::DOUBLE * stddev_return_pct * vwap / 100.0::DOUBLE', 4)} AS bollinger_lower
FROM b0""")

ORACLE["bars_ohlc_valid"] = with_cte(
    f"{ALERTED},\nbars AS ({bars_sql('alerted', BAR_SIZE, BAR_SLIDE, source='tick_ohlc')})", """
SELECT window_start, symbol, open, high, low, close,
       (low <= open AND open <= high AND low <= close AND close <= high AND low <= high) AS ohlc_valid
FROM bars""")


# --- stored bars, staging, marts ---------------------------------------------

AS_OF = "2024-01-30 22:00:00"
VERSION_SPLIT = "2024-01-16 00:00:00"
_NONOVERLAP = "epoch_us(window_start) % (epoch_us(window_end) - epoch_us(window_start)) = 0"

ORACLE["staging_bars"] = with_cte(STAGING, "SELECT * FROM stg")


def _risk(src_rate: str = "alert_rate_pct") -> str:
    s = f"sum(CAST(round({src_rate} * 100) AS BIGINT))"
    n = f"count({src_rate})"
    return (f"CASE WHEN {s} > 1000 * {n} THEN 'HIGH_RISK' WHEN {s} > 500 * {n} THEN 'MEDIUM_RISK' "
            f"ELSE 'NORMAL' END")


def hourly_sql(where: str = "true") -> str:
    o, c = "arg_min(open, window_start)", "arg_max(close, window_start)"
    return with_cte(STAGING, f"""
SELECT date_trunc('hour', window_start) AS hour_bucket, symbol, asset_type,
       {o} AS hour_open, max(high) AS hour_high, min(low) AS hour_low, {c} AS hour_close,
       {R(f'({c} - {o}) / NULLIF({o}, 0) * 100.0::DOUBLE', 2)} AS hour_return_pct,
       CAST(sum(volume) AS BIGINT) AS hour_volume,
       {R('avg(vwap)', 4)} AS avg_vwap, {R('avg(realized_vol)', 6)} AS avg_volatility,
       CAST(sum(alert_count) AS BIGINT) AS total_alerts, CAST(sum(tick_count) AS BIGINT) AS total_ticks,
       {R('avg(alert_rate_pct)', 2)} AS avg_alert_rate_pct,
       {_risk()} AS risk_level
FROM stg WHERE {where}
GROUP BY 1, 2, 3""")


ORACLE["mart_hourly"] = hourly_sql()
ORACLE["mart_hourly_nonoverlap"] = hourly_sql(_NONOVERLAP)

_W = "(PARTITION BY symbol, date_trunc('hour', window_start) ORDER BY window_start " \
     "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
ORACLE["mart_hourly_window_form"] = with_cte(f"""{STAGING},
hourly AS (
  SELECT date_trunc('hour', window_start) AS hour_bucket, symbol, asset_type,
         first_value(open) OVER {_W} AS hour_open, max(high) OVER {_W} AS hour_high,
         min(low) OVER {_W} AS hour_low, last_value(close) OVER {_W} AS hour_close,
         CAST(sum(volume) OVER {_W} AS BIGINT) AS hour_volume, avg(vwap) OVER {_W} AS avg_vwap,
         avg(realized_vol) OVER {_W} AS avg_volatility,
         CAST(sum(alert_count) OVER {_W} AS BIGINT) AS total_alerts,
         CAST(sum(tick_count) OVER {_W} AS BIGINT) AS total_ticks,
         avg(alert_rate_pct) OVER {_W} AS avg_alert_rate,
         sum(CAST(round(alert_rate_pct * 100) AS BIGINT)) OVER {_W} AS _rate_sum,
         count(alert_rate_pct) OVER {_W} AS _rate_n
  FROM stg)""", f"""
SELECT DISTINCT hour_bucket, symbol, asset_type, hour_open, hour_high, hour_low, hour_close,
       {R('(hour_close - hour_open) / NULLIF(hour_open, 0) * 100.0::DOUBLE', 2)} AS hour_return_pct,
       hour_volume, {R('avg_vwap', 4)} AS avg_vwap, {R('avg_volatility', 6)} AS avg_volatility,
       total_alerts, total_ticks, {R('avg_alert_rate', 2)} AS avg_alert_rate_pct,
       CASE WHEN _rate_sum > 1000 * _rate_n THEN 'HIGH_RISK' WHEN _rate_sum > 500 * _rate_n
            THEN 'MEDIUM_RISK' ELSE 'NORMAL' END AS risk_level
FROM hourly""")

ORACLE["mart_daily_anomaly"] = with_cte(STAGING, f"""
SELECT date_trunc('day', window_start) AS trading_day, symbol, asset_type,
       count(*) AS total_windows, CAST(sum(tick_count) AS BIGINT) AS total_ticks,
       CAST(sum(alert_count) AS BIGINT) AS total_anomalies,
       {R('avg(alert_rate_pct)', 2)} AS avg_anomaly_rate_pct,
       {R('max(high)', 4)} AS day_high, {R('min(low)', 4)} AS day_low,
       {R('avg(vwap)', 4)} AS day_avg_vwap, {R('avg(realized_vol)', 6)} AS avg_daily_vol,
       {R('max(stddev_return_pct)', 4)} AS max_return_stddev
FROM stg GROUP BY 1, 2, 3
ORDER BY 1 DESC, total_anomalies DESC""")

ORACLE["bars_latest_version"] = with_cte(
    f"{ALERTED},\nbars AS ({bars_sql('alerted', BAR_SIZE, BAR_SLIDE, extra='max(event_time) AS _last')})",
    f"""
SELECT * EXCLUDE (_last), CASE WHEN _last >= TIMESTAMP '{VERSION_SPLIT}' THEN 1 ELSE 0 END AS batch_id
FROM bars""")

ORACLE["bars_daily_lineitem"] = f"""
WITH lt AS (
  SELECT CAST(l_partkey % 50 AS VARCHAR) AS symbol, l_shipdate AS event_time, l_orderkey, l_linenumber,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume
  FROM lineitem)
SELECT time_bucket(INTERVAL '1 day', event_time) AS window_start,
       time_bucket(INTERVAL '1 day', event_time) + INTERVAL '1 day' AS window_end,
       symbol, 'part' AS asset_type,
       arg_min(price, row(event_time, l_orderkey, l_linenumber, price)) AS open,
       max(price) AS high, min(price) AS low,
       arg_max(price, row(event_time, l_orderkey, l_linenumber, price)) AS close,
       CAST(sum(volume) AS BIGINT) AS volume,
       {R('sum(price * volume) / NULLIF(sum(volume), 0)', 4)} AS vwap,
       count(*) AS tick_count
FROM lt WHERE price IS NOT NULL AND event_time IS NOT NULL
GROUP BY 1, 2, 3"""


# --- data quality --------------------------------------------------------------

def _msg(name: str, *vals: str) -> str:
    parts = CHECK_MESSAGES[name].split("{}")
    out = []
    for i, p in enumerate(parts):
        if p:
            out.append("'" + p.replace("'", "''") + "'")
        if i < len(vals):
            out.append(f"CAST({vals[i]} AS VARCHAR)")
    return " || ".join(out)


def checks_sql(lookback: str, coverage: str, ohlc: str = "tolerant",
               min_symbols: int = 4, n_symbols: int = 5) -> str:
    asof = f"TIMESTAMP '{AS_OF}'"
    recent = f"created_at > {asof} - INTERVAL '{lookback}'"
    bad_ohlc = ("low > high * 1.01" if ohlc == "tolerant" else
                "NOT (low <= open AND open <= high AND low <= close AND close <= high AND low <= high)")
    return f"""{STORED},
b AS (SELECT stored.*, rng.lo, rng.hi FROM stored LEFT JOIN {ranges_values()} ON stored.symbol = rng.symbol
      WHERE window_start <= {asof}),
c AS (
  SELECT count(*) FILTER (WHERE window_start > {asof} - INTERVAL '{lookback}') AS fresh,
         count(*) FILTER (WHERE {recent} AND (close < lo OR close > hi)) AS bad_price,
         count(*) FILTER (WHERE {recent} AND volume <= 0) AS bad_volume,
         count(*) FILTER (WHERE {recent} AND {bad_ohlc}) AS bad_ohlc,
         count(DISTINCT CASE WHEN window_start > {asof} - INTERVAL '{coverage}' THEN symbol END) AS symbols
  FROM b),
checks AS (
  SELECT 'data_freshness' AS name, fresh > 0 AS passed, {_msg('data_freshness', 'fresh')} AS detail FROM c
  UNION ALL SELECT 'price_range_validity', bad_price = 0, {_msg('price_range_validity', 'bad_price')} FROM c
  UNION ALL SELECT 'positive_volume', bad_volume = 0, {_msg('positive_volume', 'bad_volume')} FROM c
  UNION ALL SELECT 'ohlc_consistency', bad_ohlc = 0, {_msg('ohlc_consistency', 'bad_ohlc')} FROM c
  UNION ALL SELECT 'symbol_coverage', symbols >= {min_symbols},
                   {_msg('symbol_coverage', 'symbols', str(n_symbols))} FROM c)"""


ORACLE["dq_checks"] = with_cte(checks_sql("2 hours", "1 hour"), "SELECT * FROM checks")
ORACLE["dq_checks_wide"] = with_cte(checks_sql("240 hours", "240 hours"), "SELECT * FROM checks")
ORACLE["dq_checks_strict"] = with_cte(checks_sql("240 hours", "240 hours", "strict"), "SELECT * FROM checks")

ORACLE["dq_not_null"] = with_cte(STORED, " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"count(*) FILTER (WHERE {c} IS NULL) = 0 AS passed FROM stored"
    for c in ("symbol", "window_start", "close", "volume")))

ORACLE["dq_unknown_symbols"] = f"""
SELECT event_type AS symbol, count(*) AS n_ticks FROM events
WHERE event_type NOT IN ({", ".join(repr(s) for s, *_ in __import__('tickflow.schemas', fromlist=['x']).MARKET_ASSETS)})
   OR event_type IS NULL
GROUP BY 1"""

ORACLE["dq_report"] = with_cte(checks_sql("240 hours", "240 hours"), f"""
SELECT date_trunc('hour', TIMESTAMP '{AS_OF}') AS report_hour,
       count(*) FILTER (WHERE passed) AS checks_passed,
       count(*) FILTER (WHERE NOT passed) AS checks_failed,
       '{{"checks":[' || string_agg('{{"name":"' || name || '","passed":' ||
            CASE WHEN passed THEN 'true' ELSE 'false' END || ',"detail":"' || detail || '"}}', ','
            ORDER BY name) ||
       '],"passed":' || CAST(count(*) FILTER (WHERE passed) AS VARCHAR) ||
       ',"failed":' || CAST(count(*) FILTER (WHERE NOT passed) AS VARCHAR) || '}}' AS details,
       TIMESTAMP '{AS_OF}' AS created_at
FROM checks""")


# --- market views ------------------------------------------------------------------

_LATEST = f"""{TICKS},
latest AS (SELECT symbol, arg_max(price, row({ORDER})) AS price FROM ticks GROUP BY symbol)"""

ORACLE["price_board"] = with_cte(_LATEST, f"""
SELECT reg.symbol, reg.reg_asset_type AS asset_type, coalesce(l.price, reg.initial_price) AS price, reg.initial_price,
       {R('(coalesce(l.price, reg.initial_price) / reg.initial_price - 1.0::DOUBLE) * 100.0::DOUBLE', 2)} AS pnl_pct
FROM {registry_values()} LEFT JOIN latest l ON l.symbol = reg.symbol""")

_MOVERS = f"""{_RET_ONLY},
r2 AS (SELECT *, {R(f'({RET}) * 100.0::DOUBLE', 4)} AS returns_pct FROM r1),
latest AS (SELECT symbol, arg_max(returns_pct, row({ORDER})) AS returns_pct FROM r2 GROUP BY symbol),
ranked AS (SELECT symbol, returns_pct,
                  row_number() OVER (ORDER BY returns_pct DESC NULLS LAST, symbol) AS rank,
                  count(*) OVER () AS _n FROM latest)"""
ORACLE["top_movers"] = with_cte(_MOVERS, """
SELECT 'gainer' AS side, rank, symbol, returns_pct AS return_pct FROM ranked WHERE rank <= 3
UNION ALL
SELECT 'loser' AS side, rank, symbol, returns_pct AS return_pct FROM ranked WHERE rank > _n - 3""")

ORACLE["market_summary"] = with_cte(f"""{ENRICHED},
latest AS (
  SELECT symbol, max(event_time) AS event_time,
         arg_max_null(returns_pct, row({ORDER})) AS returns_pct, arg_max_null(volume, row({ORDER})) AS volume,
         arg_max_null(is_anomaly, row({ORDER})) AS is_anomaly, arg_max_null(anomaly_type, row({ORDER})) AS anomaly_type
  FROM enriched GROUP BY symbol),
ranked AS (SELECT *, row_number() OVER (ORDER BY returns_pct DESC NULLS LAST, symbol) AS rank, count(*) OVER () AS n FROM latest)""", """
SELECT max(event_time) AS timestamp, CAST(sum(volume) AS BIGINT) AS total_volume, count(*) AS n_symbols,
       count(*) FILTER (WHERE returns_pct > 0) AS n_advancing,
       CASE WHEN count(*) FILTER (WHERE returns_pct > 0) > count(*) / 2.0 THEN 'BULLISH' ELSE 'BEARISH' END
         AS market_mood,
       string_agg(symbol, ',' ORDER BY rank) FILTER (WHERE rank <= 3) AS top_gainers,
       string_agg(symbol, ',' ORDER BY rank) FILTER (WHERE rank > n - 3) AS top_losers,
       max(returns_pct) FILTER (WHERE rank = 1) AS best_return, max(returns_pct) FILTER (WHERE rank = n) AS worst_return,
       COALESCE(string_agg(CASE WHEN is_anomaly THEN symbol || ':' || anomaly_type END, ','
                           ORDER BY CASE WHEN is_anomaly THEN symbol || ':' || anomaly_type END), '')
         AS anomalies
FROM ranked""")

ORACLE["assets_by_type"] = with_cte(TICKS, """
SELECT asset_type, count(DISTINCT symbol) AS n_symbols,
       string_agg(DISTINCT symbol, ',' ORDER BY symbol) AS symbols
FROM ticks GROUP BY asset_type""")

ORACLE["symbol_filter_latest_n"] = with_cte(TICKS, """
SELECT symbol, event_time, tick_number, price, volume FROM ticks WHERE symbol = 'click'
ORDER BY event_time DESC, tick_number DESC LIMIT 50""")

ORACLE["tick_totals"] = with_cte(ENRICHED, """
SELECT symbol, count(*) AS sent_ticks, count(*) FILTER (WHERE is_anomaly) AS sent_anomalies
FROM enriched GROUP BY symbol""")

ORACLE["market_snapshot"] = with_cte(f"""{ENRICHED},
per AS (
  SELECT time_bucket(INTERVAL '1 hour', event_time) AS b, symbol,
         arg_max_null(tick_number, row({ORDER})) AS tick_number, arg_max_null(price, row({ORDER})) AS price,
         arg_max_null(returns_pct, row({ORDER})) AS returns_pct, arg_max_null(volume, row({ORDER})) AS volume
  FROM enriched GROUP BY 1, 2),
buckets AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL '1 hour')) AS b FROM per),
filled AS (
  SELECT buckets.b, per.* EXCLUDE (b), row_number() OVER (PARTITION BY buckets.b, symbol ORDER BY per.b DESC) AS k
  FROM buckets JOIN per ON per.b <= buckets.b)""", """
SELECT b + INTERVAL '1 hour' AS snapshot_end, symbol AS entry_symbol, tick_number, price, returns_pct, volume
FROM filled WHERE k = 1""")


# --- streaming: same answers as the batch forms ----------------------------------

ORACLE["stream_bars"] = ORACLE["bars_sliding"]
ORACLE["stream_alerts"] = ORACLE["alert_messages"]
ORACLE["stream_raw_ticks"] = with_cte(ALERTED, """
SELECT symbol, tick_number, event_time, price, volume, returns_pct, price_alert, alert_severity
FROM alerted""")
ORACLE["stream_indicators"] = with_cte(ENRICHED, f"SELECT {ENRICHED_COLS}, false AS late FROM enriched")
ORACLE["stream_dedup"] = with_cte(TICKS, """
SELECT symbol, asset_type, event_time, tick_number, price, volume FROM ticks""")


# --- topic codec, quarantine, store layout, hourly job -------------------------------

ORACLE["tick_decode_json"] = with_cte(ENRICHED, """
SELECT symbol, asset_type, currency, event_time, event_time AS kafka_ts, tick_number, price, volume,
       open, high, low, bid, ask, spread, returns_pct, sma5, sma20, realized_vol,
       is_anomaly, anomaly_type, signal
FROM enriched""")

ORACLE["tick_bad_records"] = """
SELECT 'ok' AS reason, count(*) AS n FROM events
UNION ALL SELECT 'no_symbol', count(*) FROM events
UNION ALL SELECT 'malformed', count(*) FROM events"""

ORACLE["bars_partitioned_read"] = ORACLE["bars_sliding"]

ORACLE["hourly_job_report"] = with_cte(checks_sql("2 hours", "1 hour"), f"""
SELECT date_trunc('hour', TIMESTAMP '{AS_OF}') AS report_hour,
       count(*) FILTER (WHERE passed) AS checks_passed,
       count(*) FILTER (WHERE NOT passed) AS checks_failed,
       '{{"checks":[' || string_agg('{{"name":"' || name || '","passed":' ||
            CASE WHEN passed THEN 'true' ELSE 'false' END || ',"detail":"' || detail || '"}}', ','
            ORDER BY name) ||
       '],"passed":' || CAST(count(*) FILTER (WHERE passed) AS VARCHAR) ||
       ',"failed":' || CAST(count(*) FILTER (WHERE NOT passed) AS VARCHAR) || '}}' AS details,
       TIMESTAMP '{AS_OF}' AS created_at
FROM checks""")

# every hour of 30 min tumbling bars, the last ones too; each bar sits in one hour
ORACLE["stream_hourly_rollup"] = with_cte(f"""{ALERTED},
b30 AS ({bars_sql('alerted', '30 minutes', None, rounded=False)})""", """
SELECT time_bucket(INTERVAL '3600 seconds', window_start) AS hour_start, symbol, asset_type,
       CAST(sum(volume) AS BIGINT) AS hour_volume, CAST(sum(tick_count) AS BIGINT) AS hour_ticks,
       CAST(sum(alert_count) AS BIGINT) AS hour_alerts, count(*) AS n_bars
FROM b30
GROUP BY 1, 2, 3""")

ORACLE["dq_not_null_violated"] = with_cte(STORED, """
SELECT 'symbol' AS column_name, count(*) FILTER (WHERE symbol = 'error') AS null_count,
       count(*) FILTER (WHERE symbol = 'error') = 0 AS passed FROM stored
UNION ALL SELECT 'window_start', count(*) FILTER (WHERE window_start IS NULL), count(*) FILTER (WHERE window_start IS NULL) = 0 FROM stored
UNION ALL SELECT 'close', count(*) FILTER (WHERE close IS NULL), count(*) FILTER (WHERE close IS NULL) = 0 FROM stored
UNION ALL SELECT 'volume', count(*) FILTER (WHERE volume IS NULL), count(*) FILTER (WHERE volume IS NULL) = 0 FROM stored""")

# the replay's edges: the span in quarters, to the microsecond; the second half is in time, the first comes late
_EDGE = "(SELECT min(event_time) + 2 * to_microseconds(CAST(round_even((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 4.0, 0) AS BIGINT)) FROM alerted)"
ORACLE["stream_late_data"] = with_cte(f"""{ALERTED},
kept AS (SELECT * FROM alerted WHERE event_time >= {_EDGE}),
b AS ({bars_sql('kept', BAR_SIZE, BAR_SLIDE)})""", f"""
SELECT *, (SELECT {seconds(BAR_SIZE) // seconds(BAR_SLIDE)} * count(*) FROM alerted WHERE event_time < {_EDGE}) AS dropped_window_rows FROM b""")
ORACLE["bars_sliding_1min"] = with_cte(ALERTED, bars_sql("alerted", "1 minute", "30 seconds"))

ORACLE["stream_late_ticks"] = with_cte(ALERTED, f"""
SELECT symbol, asset_type, event_time, tick_number, price, volume, w AS window_start,
       w + INTERVAL '{seconds(BAR_SIZE)} seconds' AS window_end
FROM (SELECT *, unnest([time_bucket(INTERVAL '{seconds(BAR_SLIDE)} seconds', event_time) - k * INTERVAL '{seconds(BAR_SLIDE)} seconds'
                        FOR k IN range({seconds(BAR_SIZE) // seconds(BAR_SLIDE)})]) AS w FROM alerted WHERE event_time < {_EDGE})""")

ORACLE["stream_indicators_sliced"] = ORACLE["stream_indicators"]

# the bounds of the access paths' query are those of plans.registered
_SPAN = "BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'"
ORACLE["bars_access_paths"] = with_cte(STAGING, f"""
SELECT 'symbol, window_start' AS access_path, count(*) AS n_rows, CAST(sum(volume) AS BIGINT) AS total
FROM stored WHERE symbol = 'click' AND window_start {_SPAN}
UNION ALL SELECT 'asset_type, window_start', count(*), CAST(sum(volume) AS BIGINT)
FROM stored WHERE asset_type = 'crypto' AND window_start {_SPAN}
UNION ALL SELECT 'symbol, hour_bucket', count(DISTINCT date_trunc('hour', window_start)), CAST(sum(volume) AS BIGINT)
FROM stg WHERE symbol = 'click' AND date_trunc('hour', window_start) {_SPAN}
UNION ALL SELECT 'report_hour', 1, (SELECT checks_passed FROM ({ORACLE["dq_report"]}))""")

ORACLE["stream_tick_totals"] = ORACLE["tick_totals"]
ORACLE["stream_distinct_symbols"] = with_cte(TICKS, """
SELECT strftime(event_time, '%Y-%m-%d') AS day, count(DISTINCT symbol) AS n_symbols FROM ticks WHERE event_time IS NOT NULL GROUP BY 1""")

ORACLE["stream_market_snapshot"] = ORACLE["market_snapshot"]
