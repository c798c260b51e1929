"""DuckDB SQL for every registered check, from named common table expressions."""

from __future__ import annotations

from tickloom.checks import AUDITED, COLUMNS, CUT, DIGITS
from tickloom.operators import breadth, earnings, price, regime, risk, strength, volume

# Intermediate columns that the dictionary leaves out; every other audited column is described.
UNDESCRIBED = {"INDEX_CLOSE_20D_AGO", "PREV_RS_20D"}

_TRADES = """
trades AS (
  SELECT *, cast(l_suppkey AS varchar) AS "SYMBOL",
         cast(date_trunc('week', cast(l_shipdate AS date)) AS date) AS "DATE",
         isodow(cast(l_shipdate AS date)) AS weekday,
         l_extendedprice / l_quantity AS price
  FROM lineitem)"""

_PRICES = """
supplier_bars AS (
  SELECT "SYMBOL", "DATE",
         arg_min(price, row(weekday, l_extendedprice, l_quantity)) AS "OPEN_PRICE",
         max(price) AS "HIGH_PRICE", min(price) AS "LOW_PRICE",
         arg_max(price, row(weekday, l_extendedprice, l_quantity)) AS "CLOSE_PRICE",
         cast(sum(l_quantity) AS bigint) AS "VOLUME"
  FROM trades GROUP BY "SYMBOL", "DATE"),
index_bars AS (
  SELECT 'SPY' AS "SYMBOL", "DATE",
         arg_min(price, row(weekday, l_extendedprice, l_quantity)) AS "OPEN_PRICE",
         max(price) AS "HIGH_PRICE", min(price) AS "LOW_PRICE",
         arg_max(price, row(weekday, l_extendedprice, l_quantity)) AS "CLOSE_PRICE",
         cast(sum(l_quantity) AS bigint) AS "VOLUME"
  FROM trades GROUP BY "DATE"),
prices AS (
  SELECT *, "CLOSE_PRICE" AS "CLOSE_ADJUSTED_PRICE", 1.0::double AS "SPLIT_COEFFICIENT"
  FROM (SELECT * FROM supplier_bars UNION ALL SELECT * FROM index_bars))"""

_EARNINGS = """
quarters AS (
  SELECT "SYMBOL", year("DATE") AS y, quarter("DATE") AS q, max("DATE") AS "DATE",
         cast(sum(cast(l_extendedprice AS decimal(18,2))) AS double)
           / cast(sum(cast(l_quantity AS bigint)) AS double) AS "EPS"
  FROM trades GROUP BY "SYMBOL", y, q),
earnings AS (
  SELECT "SYMBOL", "DATE", 'Q' || q || ' ' || y AS "QUARTER",
         lag("EPS") OVER (PARTITION BY "SYMBOL" ORDER BY y, q) AS "EPS_ESTIMATE",
         "EPS", 'post' AS "RELEASE_TIME"
  FROM quarters)"""

_SILVER = """
dividends AS (
  SELECT "SYMBOL", "DATE", max(l_tax) AS "DIVIDENDS"
  FROM trades WHERE l_returnflag = 'R' AND l_tax >= 0.07 GROUP BY "SYMBOL", "DATE"),
silver AS (
  SELECT * FROM prices LEFT JOIN earnings USING ("SYMBOL", "DATE") LEFT JOIN dividends USING ("SYMBOL", "DATE"))"""

_PRICE = """
price_lags AS (
  SELECT *, lag("CLOSE_PRICE") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE") AS "PREV_CLOSE_PRICE",
         "HIGH_PRICE" - "LOW_PRICE" AS "INTRADAY_RANGE_AMT",
         ("HIGH_PRICE" - "LOW_PRICE") / nullif("CLOSE_PRICE", 0) * 100 AS "INTRADAY_RANGE_PCT"
  FROM prices),
price AS (
  SELECT "SYMBOL", "DATE", "PREV_CLOSE_PRICE",
         ("CLOSE_PRICE" - "PREV_CLOSE_PRICE") / nullif("PREV_CLOSE_PRICE", 0) * 100 AS "DAILY_RETURN_PCT",
         "OPEN_PRICE" - "PREV_CLOSE_PRICE" AS "GAP_AMOUNT",
         CASE WHEN "OPEN_PRICE" > "PREV_CLOSE_PRICE" THEN 'UP'
              WHEN "OPEN_PRICE" < "PREV_CLOSE_PRICE" THEN 'DOWN' ELSE 'NO_GAP' END AS "GAP_DIRECTION",
         CASE WHEN "CLOSE_PRICE" > "PREV_CLOSE_PRICE" THEN 'UP'
              WHEN "CLOSE_PRICE" < "PREV_CLOSE_PRICE" THEN 'DOWN' ELSE 'FLAT' END AS "DAILY_DIRECTION",
         "INTRADAY_RANGE_AMT", "INTRADAY_RANGE_PCT",
         avg("INTRADAY_RANGE_PCT") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE"
           ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS "20_DAY_AVG_INTRADAY_RANGE_PCT"
  FROM price_lags)"""

_VOLUME = """
volume_lags AS (
  SELECT "SYMBOL", "DATE", "VOLUME",
         lag("VOLUME") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE") AS "PREV_VOLUME",
         avg("VOLUME") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE"
           ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS "5_DAY_AVG_VOLUME",
         avg("VOLUME") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE"
           ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS "20_DAY_AVG_VOLUME"
  FROM prices),
volume AS (
  SELECT "SYMBOL", "DATE", "PREV_VOLUME",
         cast("VOLUME" - "PREV_VOLUME" AS double) / nullif("PREV_VOLUME", 0) * 100 AS "VOLUME_CHANGE_PCT",
         CASE WHEN "VOLUME" > "PREV_VOLUME" THEN 'UP'
              WHEN "VOLUME" < "PREV_VOLUME" THEN 'DOWN' ELSE 'FLAT' END AS "VOLUME_DIRECTION",
         "5_DAY_AVG_VOLUME", "20_DAY_AVG_VOLUME"
  FROM volume_lags)"""

_RISK = """
priced AS (
  SELECT s."SYMBOL", s."DATE", s."CLOSE_PRICE", p."DAILY_RETURN_PCT"
  FROM prices s LEFT JOIN price p USING ("SYMBOL", "DATE")
  WHERE s."SYMBOL" IS NOT NULL AND s."DATE" IS NOT NULL AND s."CLOSE_PRICE" IS NOT NULL),
levels AS (
  SELECT *, lag("CLOSE_PRICE", 20) OVER (PARTITION BY "SYMBOL" ORDER BY "DATE") AS "CLOSE_PRICE_20D",
         avg("DAILY_RETURN_PCT") OVER w AS "AVG_RETURN_20D",
         max("CLOSE_PRICE") OVER w AS "ROLLING_MAX_CLOSE_20D"
  FROM priced
  WINDOW w AS (PARTITION BY "SYMBOL" ORDER BY "DATE" ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
measured AS (
  SELECT *, "CLOSE_PRICE" / nullif("ROLLING_MAX_CLOSE_20D", 0) - 1 AS "DRAWDOWN_TODAY",
         "CLOSE_PRICE" / nullif("CLOSE_PRICE_20D", 0) - 1 AS "ROLLING_RETURN_20D"
  FROM levels),
nested AS (
  SELECT *, avg(pow("DAILY_RETURN_PCT" - "AVG_RETURN_20D", 2)) OVER w AS "VARIANCE_20D",
         sqrt(avg(pow("DAILY_RETURN_PCT" - "AVG_RETURN_20D", 2)) OVER w) AS "ROLLING_VOLATILITY_20D",
         min("DRAWDOWN_TODAY") OVER w AS "MAX_DRAWDOWN_LOOKBACK"
  FROM measured
  WINDOW w AS (PARTITION BY "SYMBOL" ORDER BY "DATE" ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
risk AS (
  SELECT *, CASE WHEN "ROLLING_VOLATILITY_20D" > 0
                 THEN "ROLLING_RETURN_20D" / "ROLLING_VOLATILITY_20D" END AS "RISK_ADJUSTED_RETURN_20D"
  FROM nested)"""

_INDEX = """
index_lags AS (
  SELECT "SYMBOL", "DATE", "CLOSE_PRICE",
         lag("CLOSE_PRICE", 20) OVER (ORDER BY "DATE") AS "INDEX_CLOSE_20D_AGO"
  FROM prices WHERE "SYMBOL" = 'SPY' AND "DATE" IS NOT NULL AND "CLOSE_PRICE" IS NOT NULL),
index_returns AS (
  SELECT *, "CLOSE_PRICE" / nullif("INDEX_CLOSE_20D_AGO", 0) - 1 AS "INDEX_RETURN_20D" FROM index_lags)"""

_STRENGTH = """
compared AS (
  SELECT r."SYMBOL", r."DATE", i."INDEX_RETURN_20D", r."ROLLING_RETURN_20D",
         r."ROLLING_RETURN_20D" - i."INDEX_RETURN_20D" AS "RELATIVE_STRENGTH_20D"
  FROM risk r LEFT JOIN index_returns i ON r."DATE" = i."DATE"),
strength_lags AS (
  SELECT *, lag("RELATIVE_STRENGTH_20D") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE") AS "PREV_RS_20D"
  FROM compared),
strength AS (
  SELECT *,
         CASE WHEN "RELATIVE_STRENGTH_20D" > 0 THEN 'OUTPERFORM'
              WHEN "RELATIVE_STRENGTH_20D" < 0 THEN 'UNDERPERFORM'
              WHEN "RELATIVE_STRENGTH_20D" = 0 THEN 'NEUTRAL' END AS "RELATIVE_STRENGTH_DIRECTION",
         CASE WHEN "PREV_RS_20D" IS NULL THEN NULL
              WHEN "PREV_RS_20D" < "RELATIVE_STRENGTH_20D" THEN 'STRENGTHENING'
              WHEN "PREV_RS_20D" > "RELATIVE_STRENGTH_20D" THEN 'WEAKENING' ELSE 'STABLE' END AS "RS_TREND"
  FROM strength_lags)"""

_REGIME = """
averages AS (
  SELECT s."SYMBOL", s."DATE", p."INTRADAY_RANGE_PCT" AS span, p."20_DAY_AVG_INTRADAY_RANGE_PCT" AS usual,
         avg("CLOSE_PRICE") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE"
           ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS "30_DAYS_AVG_SMA",
         avg("CLOSE_PRICE") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE"
           ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS "100_DAYS_AVG_SMA",
         avg("CLOSE_PRICE") OVER (PARTITION BY "SYMBOL" ORDER BY "DATE"
           ROWS BETWEEN 180 PRECEDING AND 1 PRECEDING) AS "6_MONTHS_AVG_SMA"
  FROM prices s LEFT JOIN price p USING ("SYMBOL", "DATE")),
regime AS (
  SELECT *, ("30_DAYS_AVG_SMA" - lag("30_DAYS_AVG_SMA", 5) OVER w) / 5 AS "5_DAY_TREND_SLOPE",
         ("30_DAYS_AVG_SMA" - lag("30_DAYS_AVG_SMA", 10) OVER w) / 10 AS "10_DAY_TREND_SLOPE",
         ("30_DAYS_AVG_SMA" - lag("30_DAYS_AVG_SMA", 30) OVER w) / 30 AS "30_DAY_TREND_SLOPE",
         CASE WHEN span IS NULL OR span = 0 OR usual IS NULL OR usual = 0 THEN NULL
              WHEN span > 1.5::double * usual THEN 'HIGH'
              WHEN span < 0.7::double * usual THEN 'LOW' ELSE 'NORMAL' END AS "VOLATILITY_REGIME_FLAG"
  FROM averages WINDOW w AS (PARTITION BY "SYMBOL" ORDER BY "DATE"))"""

_REACTION = """
event_base AS (
  SELECT s."SYMBOL", s."DATE", s."OPEN_PRICE", s."CLOSE_PRICE", s."VOLUME", e."EPS", e."EPS_ESTIMATE",
         p."INTRADAY_RANGE_PCT", p."20_DAY_AVG_INTRADAY_RANGE_PCT",
         v."VOLUME_CHANGE_PCT", v."VOLUME_DIRECTION", v."5_DAY_AVG_VOLUME", v."20_DAY_AVG_VOLUME"
  FROM prices s LEFT JOIN earnings e USING ("SYMBOL", "DATE")
  LEFT JOIN volume v USING ("SYMBOL", "DATE") LEFT JOIN price p USING ("SYMBOL", "DATE")
  WHERE s."SYMBOL" IS NOT NULL AND s."DATE" IS NOT NULL
    AND s."OPEN_PRICE" IS NOT NULL AND s."CLOSE_PRICE" IS NOT NULL),
event_context AS (
  SELECT *,
         lag("CLOSE_PRICE") OVER w AS "PRE_EARNINGS_CLOSE", lag("VOLUME") OVER w AS "PRE_EARNINGS_VOLUME",
         lead("OPEN_PRICE") OVER w AS "POST_EARNINGS_OPEN", lead("CLOSE_PRICE") OVER w AS "POST_EARNINGS_CLOSE",
         lead("VOLUME") OVER w AS "POST_EARNINGS_VOLUME",
         "EPS" - "EPS_ESTIMATE" AS "EPS_SURPRISE_AMT",
         ("EPS" - "EPS_ESTIMATE") / nullif("EPS_ESTIMATE", 0) * 100 AS "EPS_SURPRISE_PCT",
         CASE WHEN "20_DAY_AVG_VOLUME" IS NULL OR "20_DAY_AVG_VOLUME" = 0 OR "VOLUME" IS NULL THEN NULL
              WHEN "VOLUME" > 1.5::double * "20_DAY_AVG_VOLUME" THEN 'SPIKE' ELSE 'NORMAL' END AS "VOLUME_SPIKE_FLAG"
  FROM event_base WINDOW w AS (PARTITION BY "SYMBOL" ORDER BY "DATE")),
event_returns AS (
  SELECT *,
         CASE WHEN "EPS_SURPRISE_PCT" > 0 THEN 'POSITIVE' WHEN "EPS_SURPRISE_PCT" < 0 THEN 'NEGATIVE'
              WHEN "EPS_SURPRISE_PCT" = 0 THEN 'NO_SURPRISE' END AS "SURPRISE_DIRECTION",
         CASE WHEN "POST_EARNINGS_CLOSE" > "PRE_EARNINGS_CLOSE" THEN 'UP'
              WHEN "POST_EARNINGS_CLOSE" < "PRE_EARNINGS_CLOSE" THEN 'DOWN'
              WHEN "POST_EARNINGS_CLOSE" = "PRE_EARNINGS_CLOSE" THEN 'FLAT' END AS "EARNING_DIRECTION",
         ("POST_EARNINGS_CLOSE" - "PRE_EARNINGS_CLOSE") / nullif("PRE_EARNINGS_CLOSE", 0) * 100
           AS "EVENT_WINDOW_RETURN_PCT",
         ("CLOSE_PRICE" - "PRE_EARNINGS_CLOSE") / nullif("PRE_EARNINGS_CLOSE", 0) * 100 AS "EARNINGS_DAY_RETURN_PCT",
         ("POST_EARNINGS_CLOSE" - "CLOSE_PRICE") / nullif("CLOSE_PRICE", 0) * 100 AS "NEXT_DAY_RETURN_PCT",
         CASE WHEN "20_DAY_AVG_INTRADAY_RANGE_PCT" IS NULL OR "20_DAY_AVG_INTRADAY_RANGE_PCT" = 0
                OR "INTRADAY_RANGE_PCT" IS NULL THEN NULL
              WHEN "INTRADAY_RANGE_PCT" > 1.5::double * "20_DAY_AVG_INTRADAY_RANGE_PCT" THEN 'SPIKE'
              ELSE 'NORMAL' END AS "VOLATILITY_SPIKE_FLAG",
         "INTRADAY_RANGE_PCT" / nullif("20_DAY_AVG_INTRADAY_RANGE_PCT", 0) AS "VOLATILITY_MULTIPLIER"
  FROM event_context),
event_drift AS (
  SELECT *,
         "EVENT_WINDOW_RETURN_PCT" / nullif("20_DAY_AVG_INTRADAY_RANGE_PCT", 0) AS "EARNINGS_REACTION_STRENGTH",
         CASE WHEN "NEXT_DAY_RETURN_PCT" > 0 THEN 'UP' WHEN "NEXT_DAY_RETURN_PCT" < 0 THEN 'DOWN'
              WHEN "NEXT_DAY_RETURN_PCT" = 0 THEN 'FLAT' END AS "DRIFT_DIRECTION"
  FROM event_returns),
reaction AS (
  SELECT *,
         CASE WHEN "SURPRISE_DIRECTION" IS NULL OR "EARNING_DIRECTION" IS NULL THEN NULL
              WHEN "SURPRISE_DIRECTION" = 'POSITIVE' AND "EARNING_DIRECTION" = 'UP' THEN 'ALIGNED'
              WHEN "SURPRISE_DIRECTION" = 'NEGATIVE' AND "EARNING_DIRECTION" = 'DOWN' THEN 'ALIGNED'
              WHEN "SURPRISE_DIRECTION" = 'NO_SURPRISE' OR "EARNING_DIRECTION" = 'FLAT' THEN 'NEUTRAL'
              ELSE 'MISALIGNED' END AS "REACTION_ALIGNMENT_FLAG",
         CASE WHEN "VOLUME_SPIKE_FLAG" IS NULL OR "EARNING_DIRECTION" IS NULL OR "EARNING_DIRECTION" = 'FLAT'
              THEN 'NEUTRAL'
              WHEN "VOLUME_SPIKE_FLAG" = 'SPIKE' THEN 'CONFIRMED' ELSE 'WEAK' END AS "VOLUME_CONFIRMATION_FLAG",
         CASE WHEN "EARNING_DIRECTION" IS NULL OR "DRIFT_DIRECTION" IS NULL THEN NULL
              WHEN "EARNING_DIRECTION" = 'FLAT' OR "DRIFT_DIRECTION" = 'FLAT' THEN 'NEUTRAL'
              WHEN "EARNING_DIRECTION" = "DRIFT_DIRECTION" THEN 'CONTINUATION'
              ELSE 'REVERSAL' END AS "DRIFT_ALIGNMENT_FLAG"
  FROM event_drift)"""

_BREADTH = """
market AS (
  SELECT p.*, r.* EXCLUDE ("SYMBOL", "DATE", "DAILY_RETURN_PCT"),
         t.* EXCLUDE ("SYMBOL", "DATE", "ROLLING_RETURN_20D")
  FROM price p LEFT JOIN risk r USING ("SYMBOL", "DATE") LEFT JOIN strength t USING ("SYMBOL", "DATE")),
daily AS (
  SELECT "DATE", count(DISTINCT "SYMBOL") AS "TOTAL_STOCKS",
         avg(CASE WHEN "DAILY_DIRECTION" = 'UP' THEN 1 ELSE 0 END) AS "PCT_STOCKS_UP",
         avg(CASE WHEN "DAILY_DIRECTION" = 'DOWN' THEN 1 ELSE 0 END) AS "PCT_STOCKS_DOWN",
         avg(CASE WHEN "RELATIVE_STRENGTH_DIRECTION" = 'OUTPERFORM' THEN 1 ELSE 0 END) AS "PCT_STOCKS_OUTPERFORMING",
         avg(CASE WHEN "RS_TREND" = 'STRENGTHENING' THEN 1 ELSE 0 END) AS "PCT_RS_STRENGTHENING",
         avg("ROLLING_VOLATILITY_20D") AS "AVG_MARKET_VOLATILITY"
  FROM market WHERE "SYMBOL" IS NOT NULL AND "DATE" IS NOT NULL GROUP BY "DATE"),
breadth AS (
  SELECT *, CASE WHEN "PCT_STOCKS_UP" >= 0.70::double THEN 'STRONG_BULL'
                 WHEN "PCT_STOCKS_UP" >= 0.50::double THEN 'BULL'
                 WHEN "PCT_STOCKS_UP" >= 0.40::double THEN 'NEUTRAL'
                 WHEN "PCT_STOCKS_UP" >= 0.25::double THEN 'BEAR' ELSE 'STRONG_BEAR' END AS "BREADTH_REGIME"
  FROM daily)"""

_STRENGTH_PATH = [_TRADES, _PRICES, _PRICE, _RISK, _INDEX, _STRENGTH]
_NEEDS = {
    "trades": [_TRADES],
    "prices": [_TRADES, _PRICES],
    "earnings": [_TRADES, _EARNINGS],
    "silver": [_TRADES, _PRICES, _EARNINGS, _SILVER],
    "dividends": [_TRADES, _PRICES, _EARNINGS, _SILVER],
    "price": [_TRADES, _PRICES, _PRICE],
    "volume": [_TRADES, _PRICES, _VOLUME],
    "risk": [_TRADES, _PRICES, _PRICE, _RISK],
    "index_returns": [_TRADES, _PRICES, _INDEX],
    "strength": _STRENGTH_PATH,
    "regime": [_TRADES, _PRICES, _PRICE, _REGIME],
    "reaction": [_TRADES, _PRICES, _EARNINGS, _PRICE, _VOLUME, _REACTION],
    "breadth": [*_STRENGTH_PATH, _BREADTH],
    "all": [*_STRENGTH_PATH, _EARNINGS, _SILVER, _VOLUME, _REGIME, _REACTION, _BREADTH],
}

_SOURCE = {
    "price_returns": "price",
    "price_gaps": "price",
    "intraday_range": "price",
    "volume_change": "volume",
    "volume_averages": "volume",
    "silver_prices": "prices",
    "silver_earnings": "earnings",
    "silver_dividends": "dividends",
    "silver_enriched": "silver",
    "bronze_ingest": "silver",
    "rolling_return": "risk",
    "rolling_volatility": "risk",
    "rolling_drawdown": "risk",
    "risk_metrics": "risk",
    "index_return_20d": "index_returns",
    "relative_strength": "strength",
    "rs_trend": "strength",
    "regime_sma": "regime",
    "regime_slope": "regime",
    "volatility_regime": "regime",
    "eps_surprise": "reaction",
    "volume_spike": "reaction",
    "earnings_context": "reaction",
    "earnings_returns": "reaction",
    "volatility_normalised": "reaction",
    "reaction_flags": "reaction",
    "drift_flags": "reaction",
    "earnings_reaction": "reaction",
    "table_roundtrip": "price",
    "bucketed_silver": "risk",
    "market_regime": "regime",
    "risk_in_parts": "risk",
    "earnings_in_parts": "reaction",
}


def _with(source: str, body: str) -> str:
    return f"WITH {','.join(_NEEDS[source])}\n{body}"


def _shown(name: str) -> str:
    if name == "DATE":
        return 'cast("DATE" AS varchar) AS "DATE"'
    if name in CUT:
        unit = f"1e{DIGITS.get(name, 4)}"
        return f'floor("{name}" * {unit} + 0.5e0) / {unit} AS "{name}"'
    return f'"{name}"'


def _select(columns: list[str]) -> str:
    return "SELECT " + ", ".join(_shown(c) for c in columns)


def _latest() -> str:
    columns = COLUMNS["latest_complete_rs"]
    known = " AND ".join(f'"{c}" IS NOT NULL' for c in columns)
    return (
        f"{_select(['SYMBOL', 'DATE', *columns])} FROM strength WHERE {known} "
        'QUALIFY row_number() OVER (PARTITION BY "SYMBOL" ORDER BY strength."DATE" DESC) = 1'
    )


def _audit() -> str:
    tables = {
        "silver": "silver",
        "price_metrics": "price",
        "volume_liquidity": "volume",
        "earnings_reaction": "reaction",
        "relative_strength": "market",
        "benchmark": "index_returns",
        "market_regime": "regime",
        "market_breadth": "breadth",
    }
    parts = []
    for name, source in tables.items():
        for c in AUDITED[name]:
            parts.append(
                f"SELECT '{name}' AS \"TABLE_NAME\", '{c}' AS \"COLUMN_NAME\", count(\"{c}\") AS \"KNOWN_VALUES\", "
                f'{str(c not in UNDESCRIBED).lower()} AS "DESCRIBED" FROM {source}'
            )
    return "\nUNION ALL ".join(parts)


TEXT = ("SYMBOL", "DATE", "QUARTER", "RELEASE_TIME")


def _row_text(name: str) -> str:
    if name in TEXT or name.endswith(("_DIRECTION", "_FLAG", "_TREND", "_REGIME", "_STRENGTH_TEXT")):
        return f"coalesce(cast(\"{name}\" AS varchar), '-')"
    unit = f"1e{DIGITS.get(name, 4)}"
    return f"coalesce(cast(cast(floor(cast(\"{name}\" AS double) * {unit} + 0.5e0) AS bigint) AS varchar), '-')"


def _batch() -> str:
    tables = {
        "price_metrics": "price",
        "volume_liquidity": "volume",
        "earnings_reaction": "reaction",
        "risk_metrics": "risk",
        "relative_strength": "strength",
        "market_regime": "regime",
        "market_breadth": "breadth",
    }
    outputs = {
        "price_metrics": price.OUTPUT,
        "volume_liquidity": volume.OUTPUT,
        "earnings_reaction": earnings.OUTPUT,
        "risk_metrics": risk.OUTPUT,
        "relative_strength": strength.OUTPUT,
        "market_regime": regime.OUTPUT,
        "market_breadth": breadth.OUTPUT,
    }
    parts = []
    for name, source in tables.items():
        texts = ", ".join(_row_text(c) for c in outputs[name])
        symbols = "cast(0 AS bigint)" if source == "breadth" else 'count(DISTINCT "SYMBOL")'
        parts.append(
            f"SELECT '{name}' AS \"TABLE_NAME\", count(*) AS \"ROW_COUNT\", {symbols} AS \"SYMBOLS\", "
            f'cast(min("DATE") AS varchar) AS "FIRST_DAY", cast(max("DATE") AS varchar) AS "LAST_DAY", '
            f"cast(sum(cast('0x' || md5(concat_ws('|', {texts}))[1:8] AS bigint)) AS bigint) AS \"CHECKSUM\" FROM {source}"
        )
    return "\nUNION ALL ".join(parts)


def _losses() -> str:
    lost = {
        ("prices", "DATE"): '"VOLUME" % 11 = 0',
        ("prices", "OPEN_PRICE"): '"VOLUME" % 7 = 0',
        ("prices", "VOLUME"): '"VOLUME" % 5 = 0',
        ("earnings", "EPS"): """"QUARTER" LIKE 'Q1%' AND "EPS" IS NOT NULL""",
    }
    typed = {
        "prices": ["DATE", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE", "CLOSE_ADJUSTED_PRICE", "VOLUME", "SPLIT_COEFFICIENT"],
        "earnings": ["DATE", "EPS_ESTIMATE", "EPS"],
        "dividends": ["DATE", "DIVIDENDS"],
    }
    parts = [
        f"SELECT '{table}' AS \"TABLE_NAME\", '{c}' AS \"COLUMN_NAME\", "
        f'cast(count(*) FILTER (WHERE {lost.get((table, c), "false")}) AS bigint) AS "UNREADABLE" FROM {table}'
        for table, columns in typed.items()
        for c in columns
    ]
    return "\nUNION ALL ".join(parts)


ORACLE = {
    **{
        key: _with(source, f"{_select(['SYMBOL', 'DATE', *COLUMNS[key]])} FROM {source}")
        for key, source in _SOURCE.items()
    },
    "latest_complete_rs": _with("strength", _latest()),
    "market_breadth": _with("breadth", f"{_select(breadth.OUTPUT)} FROM breadth"),
    "breadth_in_parts": _with("breadth", f"{_select(breadth.OUTPUT)} FROM breadth"),
    "typing_losses": _with("dividends", _losses()),
    "dictionary_audit": _with("all", _audit()),
    "batch_tables": _with("all", _batch()),
}
