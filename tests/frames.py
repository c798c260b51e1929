"""Small frames of bars for the unit tests."""

from __future__ import annotations

from datetime import date, timedelta

START = date(2020, 1, 1)
SCHEMA = (
    "SYMBOL string, DATE date, OPEN_PRICE double, HIGH_PRICE double, LOW_PRICE double, CLOSE_PRICE double, "
    "VOLUME bigint, EPS double, EPS_ESTIMATE double"
)


def day(n: int) -> date:
    return START + timedelta(days=n)


def bar(symbol, n, close, *, open=None, high=None, low=None, volume=100, eps=None, estimate=None):
    """A bar on day n; open, high and low equal the close unless given."""
    opened = close if open is None else open
    when = None if n is None else day(n)
    return (symbol, when, opened, close if high is None else high, close if low is None else low, close,
            volume, eps, estimate)


def bars(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(df, *columns):
    """Rows as {(SYMBOL, DATE): value or tuple of values}."""
    found = {}
    for row in df.select("SYMBOL", "DATE", *columns).collect():
        values = tuple(row[2:])
        found[(row[0], row[1])] = values if len(columns) > 1 else values[0]
    return found


def column(df, name, symbol="A"):
    """One column of one symbol in day order."""
    picked = df.filter(df.SYMBOL == symbol).select("DATE", name).collect()
    return [value for _, value in sorted(picked, key=lambda r: r[0])]
