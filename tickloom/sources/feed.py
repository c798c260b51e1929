"""A market feed made from the order lines: suppliers trade as symbols.

One bar per supplier and week plus an index over all suppliers, one earnings
record per supplier and quarter, and a dividend for weeks with a heavily taxed
return. All aggregates combine on the map side, so a supplier with a large
part of the trades still reaches the shuffle as one row per task and week.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.series import add_columns
from tickloom.operators.silver import DIVIDENDS, EARNINGS, PRICES
from tickloom.operators.strength import BENCHMARK

# Bars are grouped by symbol and week, and a DATE holds the years 1 to 9999:
# no symbol can have more bars than this, whatever the data.
LONGEST = 9999 * 366 // 7 + 1

# All buffers are plain numbers, so this is a hash aggregate. Ordering trades
# by a struct would sort every row before the shuffle.
_BAR = {
    "OPEN_PRICE": "min_by(price, place)",
    "HIGH_PRICE": "max(price)",
    "LOW_PRICE": "min(price)",
    "CLOSE_PRICE": "max_by(price, place)",
    "VOLUME": "cast(sum(l_quantity) AS bigint)",
}


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their week, price and place in the week.

    The place orders trades by (weekday, extended price in cents, quantity),
    packed into one number: cents stay below 10^12 and quantities below 100.
    Trades with the same place have the same price, so ties cannot matter.
    """
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    dated = lines.selectExpr(
        "l_suppkey",
        "l_quantity",
        "l_tax",
        "l_returnflag",
        "cast(l_shipdate AS date) AS day",
        "floor(l_extendedprice * 100 + 0.5D) AS cents",
        "l_extendedprice / l_quantity AS price",
    )
    return add_columns(
        dated,
        {
            "DATE": "trunc(day, 'week')",
            "place": "weekday(day) * 100000000000000L + cents * 100 + cast(l_quantity AS bigint)",
        },
    )


def _bars(grouped, symbol: str) -> DataFrame:
    bars = grouped.agg(*[F.expr(f"{sql} AS {name}") for name, sql in _BAR.items()])
    return bars.selectExpr(
        f"{symbol} AS SYMBOL",
        "DATE",
        "OPEN_PRICE",
        "HIGH_PRICE",
        "LOW_PRICE",
        "CLOSE_PRICE",
        "CLOSE_PRICE AS CLOSE_ADJUSTED_PRICE",
        "VOLUME",
        "1.0D AS SPLIT_COEFFICIENT",
    )


def supplier_bars(trades: DataFrame) -> DataFrame:
    return _bars(trades.groupBy("l_suppkey", "DATE"), "cast(l_suppkey AS string)")


def index_bars(trades: DataFrame) -> DataFrame:
    return _bars(trades.groupBy("DATE"), f"'{BENCHMARK}'")


def prices(trades: DataFrame) -> DataFrame:
    return supplier_bars(trades).unionByName(index_bars(trades))


def earnings(trades: DataFrame) -> DataFrame:
    """Revenue per unit of the quarter, expected to equal that of the quarter before."""
    quarterly = trades.groupBy("l_suppkey", F.expr("year(DATE) AS year"), F.expr("quarter(DATE) AS quarter")).agg(
        F.expr("max(DATE) AS DATE"), F.expr("(sum(cents) / 100) / sum(cast(l_quantity AS bigint)) AS EPS")
    )
    return quarterly.selectExpr(
        "cast(l_suppkey AS string) AS SYMBOL",
        "DATE",
        "concat('Q', quarter, ' ', year) AS QUARTER",
        "lag(EPS) OVER (PARTITION BY l_suppkey ORDER BY year, quarter) AS EPS_ESTIMATE",
        "EPS",
        "'post' AS RELEASE_TIME",
    )


def dividends(trades: DataFrame) -> DataFrame:
    taxed = trades.filter("l_returnflag = 'R' AND l_tax >= 0.07D")
    highest = taxed.groupBy("l_suppkey", "DATE").agg(F.expr("max(l_tax) AS DIVIDENDS"))
    return highest.selectExpr("cast(l_suppkey AS string) AS SYMBOL", "DATE", "DIVIDENDS")


def as_raw(typed: DataFrame, rules: dict) -> DataFrame:
    """The typed frame as the text table it would have been read from."""
    return typed.selectExpr(*[f"cast({target} AS string) AS {name}" for name, (target, _) in rules.items()])


def raw_tables(trades: DataFrame) -> dict[str, DataFrame]:
    return {
        "prices": as_raw(prices(trades), PRICES),
        "earnings": as_raw(earnings(trades), EARNINGS),
        "dividends": as_raw(dividends(trades), DIVIDENDS),
    }


def spoilt_tables(trades: DataFrame) -> dict[str, DataFrame]:
    """The raw tables with texts that no value can be read from, and blanks, in places that the volume and the quarter name."""
    raw = raw_tables(trades)
    prices = {
        "date": "if(volume % 11 = 0, concat(date, '?'), date)",
        "open": "if(volume % 7 = 0, 'n/a', open)",
        "high": "if(volume % 3 = 0, '  ', high)",
        "volume": "if(volume % 5 = 0, concat(volume, 'e1'), volume)",
    }
    earnings = {"eps": "if(qtr LIKE 'Q1%', concat(eps, ' USD'), eps)"}
    return {
        "prices": raw["prices"].selectExpr(*[f"{prices.get(c, c)} AS {c}" for c in raw["prices"].columns]),
        "earnings": raw["earnings"].selectExpr(*[f"{earnings.get(c, c)} AS {c}" for c in raw["earnings"].columns]),
        "dividends": raw["dividends"],
    }
