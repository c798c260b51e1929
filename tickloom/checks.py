"""The registered checks: each operator on the feed, and the same in DuckDB SQL.

The SQL side is written separately from the library: it joins whole tables
back together on (SYMBOL, DATE) where the library chains windows.

Means over doubles depend on the order of summation, so both sides cut them with
the same formula, to four digits or, where values are small, to ten. Flags come from
the uncut values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.operators import breadth, earnings, price, regime, risk, strength, volume
from tickloom.operators.silver import KEY, SILVER, enrich, type_dividends, type_earnings, type_prices
from tickloom.plans import batch, tables
from tickloom.sources import feed
from tickloom.sources.dictionary import Audit, with_comments
from tickloom.sources.tables import (
    GOLD_TABLES,
    freeing_shuffles,
    read_table,
    scratch_dir,
    table_path,
    write_by_symbol,
    write_table,
)

# Columns that rest on a mean over doubles.
CUT = {
    "20_DAY_AVG_INTRADAY_RANGE_PCT",
    "AVG_RETURN_20D",
    "ROLLING_VOLATILITY_20D",
    "RISK_ADJUSTED_RETURN_20D",
    "30_DAYS_AVG_SMA",
    "100_DAYS_AVG_SMA",
    "6_MONTHS_AVG_SMA",
    "5_DAY_TREND_SLOPE",
    "10_DAY_TREND_SLOPE",
    "30_DAY_TREND_SLOPE",
    "VOLATILITY_MULTIPLIER",
    "EARNINGS_REACTION_STRENGTH",
    "AVG_MARKET_VOLATILITY",
}

#: Digits kept of the columns in ``CUT``, where these are not four.
DIGITS = {"RISK_ADJUSTED_RETURN_20D": 10}

Query = Callable[[SparkSession, str], DataFrame]

COLUMNS = {
    "price_returns": ["PREV_CLOSE_PRICE", "DAILY_RETURN_PCT", "DAILY_DIRECTION"],
    "price_gaps": ["GAP_AMOUNT", "GAP_DIRECTION"],
    "intraday_range": ["INTRADAY_RANGE_AMT", "INTRADAY_RANGE_PCT", "20_DAY_AVG_INTRADAY_RANGE_PCT"],
    "volume_change": ["PREV_VOLUME", "VOLUME_CHANGE_PCT", "VOLUME_DIRECTION"],
    "volume_averages": ["5_DAY_AVG_VOLUME", "20_DAY_AVG_VOLUME"],
    "silver_prices": SILVER[2:9],
    "silver_earnings": ["QUARTER", "EPS_ESTIMATE", "EPS", "RELEASE_TIME"],
    "silver_dividends": ["DIVIDENDS"],
    "silver_enriched": SILVER[2:],
    "bronze_ingest": SILVER[2:],
    "rolling_return": ["CLOSE_PRICE_20D", "ROLLING_RETURN_20D"],
    "rolling_volatility": ["AVG_RETURN_20D", "ROLLING_VOLATILITY_20D"],
    "rolling_drawdown": ["ROLLING_MAX_CLOSE_20D", "DRAWDOWN_TODAY", "MAX_DRAWDOWN_LOOKBACK"],
    "risk_metrics": risk.OUTPUT[2:],
    "index_return_20d": ["CLOSE_PRICE", "INDEX_CLOSE_20D_AGO", "INDEX_RETURN_20D"],
    "relative_strength": strength.OUTPUT[2:],
    "rs_trend": ["RELATIVE_STRENGTH_20D", "RS_TREND"],
    "latest_complete_rs": strength.OUTPUT[2:],
    "regime_sma": ["30_DAYS_AVG_SMA", "100_DAYS_AVG_SMA", "6_MONTHS_AVG_SMA"],
    "regime_slope": ["5_DAY_TREND_SLOPE", "10_DAY_TREND_SLOPE", "30_DAY_TREND_SLOPE"],
    "volatility_regime": ["VOLATILITY_REGIME_FLAG"],
    "eps_surprise": ["EPS", "EPS_ESTIMATE", "EPS_SURPRISE_AMT", "EPS_SURPRISE_PCT", "SURPRISE_DIRECTION"],
    "volume_spike": ["VOLUME", "20_DAY_AVG_VOLUME", "VOLUME_SPIKE_FLAG"],
    "earnings_context": [c for c in earnings.OUTPUT if c.startswith(("PRE_", "POST_"))],
    "earnings_returns": [
        "EARNING_DIRECTION",
        "EVENT_WINDOW_RETURN_PCT",
        "EARNINGS_DAY_RETURN_PCT",
        "NEXT_DAY_RETURN_PCT",
    ],
    "volatility_normalised": ["VOLATILITY_SPIKE_FLAG", "VOLATILITY_MULTIPLIER", "EARNINGS_REACTION_STRENGTH"],
    "reaction_flags": ["REACTION_ALIGNMENT_FLAG", "VOLUME_CONFIRMATION_FLAG"],
    "drift_flags": ["DRIFT_DIRECTION", "DRIFT_ALIGNMENT_FLAG"],
    "earnings_reaction": earnings.OUTPUT[2:],
    "table_roundtrip": price.OUTPUT[2:],
    "bucketed_silver": risk.OUTPUT[2:],
    "market_regime": regime.OUTPUT[2:],
    "risk_in_parts": risk.OUTPUT[2:],
    "earnings_in_parts": earnings.OUTPUT[2:],
}


def _emit(df: DataFrame, columns: list[str]) -> DataFrame:
    """The checked columns: days as text, means cut to four digits."""

    def shown(name: str) -> str:
        if name == "DATE":
            return "cast(DATE AS string) AS DATE"
        unit = f"1e{DIGITS.get(name, 4)}D"
        return f"floor(`{name}` * {unit} + 0.5D) / {unit} AS `{name}`" if name in CUT else f"`{name}`"

    return df.selectExpr(*[shown(c) for c in columns])


def _symbol_days(key: str, build: Query) -> Query:
    return lambda spark, sf_dir: _emit(build(spark, sf_dir), ["SYMBOL", "DATE", *COLUMNS[key]])


def _price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.price_metrics(feed.prices(feed.trades(spark, sf_dir)), feed.LONGEST)


def _volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.volume_liquidity(feed.prices(feed.trades(spark, sf_dir)), feed.LONGEST)


def _regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.market_regime(feed.prices(feed.trades(spark, sf_dir)), feed.LONGEST)


def _risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.risk_frame(feed.prices(feed.trades(spark, sf_dir)), feed.LONGEST)


def _index(trades: DataFrame) -> DataFrame:
    return tables.index_frame(feed.index_bars(trades), longest=feed.LONGEST)


def _index_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(feed.trades(spark, sf_dir))


def _strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feed.trades(spark, sf_dir)
    return tables.relative_strength(feed.prices(trades), longest=feed.LONGEST, index=_index(trades))


def _latest_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strength.latest_complete(_strength(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feed.trades(spark, sf_dir)
    return enrich(feed.prices(trades), feed.earnings(trades), feed.dividends(trades))


def _earnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Dividends are not read by this table, so only earnings are joined.
    trades = feed.trades(spark, sf_dir)
    silver = feed.prices(trades).join(feed.earnings(trades), KEY, "left")
    return tables.earnings_reaction(silver, feed.LONGEST)


def market_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feed.trades(spark, sf_dir)
    daily = tables.market_breadth(feed.prices(trades), longest=feed.LONGEST, index=_index(trades))
    return _emit(daily, breadth.OUTPUT)


def _typed(name: str, typing: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: typing(feed.raw_tables(feed.trades(spark, sf_dir))[name])


def _write_raw_csv(spark: SparkSession, sf_dir: str, base_dir: str) -> None:
    # A bar's prices are often alike, so the texts take about a fifth of their size.
    with freeing_shuffles(spark):
        for name, raw in feed.raw_tables(feed.trades(spark, sf_dir)).items():
            raw.write.csv(table_path(base_dir, f"raw_{name}"), header=True, compression="gzip")


def _ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as CSV, landed as bronze, then typed and joined."""
    base_dir = scratch_dir(spark)
    _write_raw_csv(spark, sf_dir, base_dir)
    batch.ingest_bronze(spark, base_dir)
    return enrich(**batch.typed_bronze(spark, base_dir))


def _roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base_dir = scratch_dir(spark)
    write_table(with_comments(_price(spark, sf_dir)), table_path(base_dir, "price_metrics"))
    return read_table(spark, base_dir, "price_metrics")


def _bucketed_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk table from a silver that is stored in buckets of the catalog."""
    name = f"tickloom_silver_{uuid.uuid4().hex}"
    write_by_symbol(_silver(spark, sf_dir), table_path(scratch_dir(spark), "silver"), name, 8)
    return tables.risk_frame(spark.table(name), feed.LONGEST)


def _row_text(name: str, kind: str) -> str:
    """A value as text: numbers in whole units of their cut, so that both sides write them alike."""
    if kind in ("string", "date"):
        return f"coalesce(cast(`{name}` AS string), '-')"
    unit = f"1e{DIGITS.get(name, 4)}D"
    return f"coalesce(cast(cast(floor(cast(`{name}` AS double) * {unit} + 0.5D) AS bigint) AS string), '-')"


def batch_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run from CSV to gold, read back: rows, symbols, days and a checksum of each gold table.

    The checksum sums 32 bits of a hash of each row, over all columns; a wrong value changes it.
    """
    base_dir = scratch_dir(spark)
    _write_raw_csv(spark, sf_dir, base_dir)
    batch.run_all(spark, base_dir)
    found = None
    for name in GOLD_TABLES:
        table = read_table(spark, base_dir, name)
        symbols = "count(DISTINCT SYMBOL)" if "SYMBOL" in table.columns else "0L"
        texts = ", ".join(_row_text(c, kind) for c, kind in table.dtypes)
        summary = table.selectExpr(
            f"'{name}' AS TABLE_NAME",
            "count(*) AS ROW_COUNT",
            f"{symbols} AS SYMBOLS",
            "cast(min(DATE) AS string) AS FIRST_DAY",
            "cast(max(DATE) AS string) AS LAST_DAY",
            f"sum(cast(conv(substring(md5(concat_ws('|', {texts})), 1, 8), 16, 10) AS bigint)) AS CHECKSUM",
        )
        found = summary if found is None else found.unionByName(summary)
    return found


def dictionary_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of every table, with the intermediates: its known values and whether its stored files explain it.

    Values are counted while silver, the frame of all tables, the benchmark and breadth are written; nothing is
    read again for it but the schemas.
    """
    base_dir, longest, found = scratch_dir(spark), feed.LONGEST, []

    def stored(name: str, df: DataFrame, audited: dict[str, tuple[list[str], str]]) -> DataFrame:
        audit = Audit(audited)
        write_table(with_comments(audit.counting(df)), f"{base_dir}/{name}")
        written = spark.read.parquet(f"{base_dir}/{name}")
        found.extend(audit.rows(written))
        return written

    every = {name: (columns, "true") for name, columns in AUDITED.items()}
    silver = stored("silver", _silver(spark, sf_dir), {"silver": every["silver"]})
    index = stored("benchmark", tables.index_frame(silver, longest=longest), {"benchmark": every["benchmark"]})
    rows = {"earnings_reaction": "HAS_TRADE", "relative_strength": "HAS_CLOSE"}
    names = ("price_metrics", "volume_liquidity", "earnings_reaction", "relative_strength", "market_regime")
    audited = {name: (AUDITED[name], rows.get(name, "true")) for name in names}
    with tables.wide_rows(spark):
        market = tables.market_frame(silver, longest=longest, index=index, bars=silver.count())
        frame = stored("market_frame", market, audited)
    stored("market_breadth", tables.table_of(frame, "market_breadth"), {"market_breadth": every["market_breadth"]})
    schema = "TABLE_NAME string, COLUMN_NAME string, KNOWN_VALUES long, DESCRIBED boolean"
    return spark.createDataFrame(found, schema)


def typing_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of spoilt raw tables that become NULL, as building silver counts them: a row per table and typed column."""
    base_dir = scratch_dir(spark)
    for name, raw in feed.spoilt_tables(feed.trades(spark, sf_dir)).items():
        raw.write.csv(table_path(base_dir, f"raw_{name}"), header=True)
    batch.ingest_bronze(spark, base_dir)
    losses = batch.build_silver(spark, base_dir).losses
    rows = [(table, column, n) for table, counts in losses.items() for column, n in counts.items()]
    return spark.createDataFrame(rows, "TABLE_NAME string, COLUMN_NAME string, UNREADABLE long")


def _in_parts(name: str) -> Query:
    """A table out of the frame of all tables, with every series cut into parts of about ``CUT_ROWS`` rows."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        trades = feed.trades(spark, sf_dir)
        silver = feed.prices(trades).join(feed.earnings(trades), KEY, "left")
        bars = feed.prices(trades).count()
        frame = tables.market_frame(silver, longest=feed.LONGEST, index=_index(trades), parts=CUT_ROWS, bars=bars)
        return tables.table_of(frame, name)

    return build


#: Below the length of most series of the feed, and of some reaches.
CUT_ROWS = 60

AUDITED = {
    "silver": SILVER,
    "price_metrics": price.OUTPUT,
    "volume_liquidity": volume.OUTPUT,
    "earnings_reaction": earnings.OUTPUT,
    "relative_strength": [
        *dict.fromkeys(risk.OUTPUT + strength.OUTPUT),
        "CLOSE_PRICE_20D",
        "AVG_RETURN_20D",
        "VARIANCE_20D",
        "ROLLING_MAX_CLOSE_20D",
        "DRAWDOWN_TODAY",
        "PREV_RS_20D",
    ],
    "benchmark": ["SYMBOL", "DATE", "CLOSE_PRICE", "INDEX_CLOSE_20D_AGO", "INDEX_RETURN_20D"],
    "market_regime": regime.OUTPUT,
    "market_breadth": breadth.OUTPUT,
}

_BUILDERS: dict[str, Query] = {
    "price_returns": _price,
    "price_gaps": _price,
    "intraday_range": _price,
    "volume_change": _volume,
    "volume_averages": _volume,
    "silver_prices": _typed("prices", type_prices),
    "silver_earnings": _typed("earnings", type_earnings),
    "silver_dividends": _typed("dividends", type_dividends),
    "silver_enriched": _silver,
    "bronze_ingest": _ingested,
    "rolling_return": _risk,
    "rolling_volatility": _risk,
    "rolling_drawdown": _risk,
    "risk_metrics": _risk,
    "index_return_20d": _index_bars,
    "relative_strength": _strength,
    "rs_trend": _strength,
    "latest_complete_rs": _latest_strength,
    "regime_sma": _regime,
    "regime_slope": _regime,
    "volatility_regime": _regime,
    "eps_surprise": _earnings,
    "volume_spike": _earnings,
    "earnings_context": _earnings,
    "earnings_returns": _earnings,
    "volatility_normalised": _earnings,
    "reaction_flags": _earnings,
    "drift_flags": _earnings,
    "earnings_reaction": _earnings,
    "table_roundtrip": _roundtrip,
    "bucketed_silver": _bucketed_risk,
    "market_regime": _regime,
    "risk_in_parts": _in_parts("risk_metrics"),
    "earnings_in_parts": _in_parts("earnings_reaction"),
}

QUERIES: dict[str, Query] = {
    **{key: _symbol_days(key, build) for key, build in _BUILDERS.items()},
    "market_breadth": market_breadth,
    "breadth_in_parts": lambda spark, sf_dir: _emit(_in_parts("market_breadth")(spark, sf_dir), breadth.OUTPUT),
    "typing_losses": typing_losses,
    "dictionary_audit": dictionary_audit,
    "batch_tables": batch_tables,
}
