"""Hand-computed cases, one small frame per rule."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException

from tests.frames import bar, bars, column, day, table
from tickloom.operators import breadth, earnings, risk, strength
from tickloom.operators.long_series import profile_keys, require_unique_key
from tickloom.operators.silver import SILVER, enrich, type_dividends, type_earnings, type_prices
from tickloom.plans import tables

WHOLE = 1


def test_first_row_and_null_labels(spark):
    df = tables.price_metrics(bars(spark, [bar("A", 0, 10.0), bar("A", 1, 11.0, open=10.5), bar("A", 2, 11.0)]), WHOLE)
    assert column(df, "PREV_CLOSE_PRICE") == [None, 10.0, 11.0]
    assert column(df, "DAILY_RETURN_PCT") == [None, pytest.approx(10.0), 0.0]
    assert column(df, "GAP_AMOUNT") == [None, 0.5, 0.0]
    assert column(df, "GAP_DIRECTION") == ["NO_GAP", "UP", "NO_GAP"]
    assert column(df, "DAILY_DIRECTION") == ["FLAT", "UP", "FLAT"]


def test_zero_prices_give_null_not_errors(spark):
    rows = [bar("A", 0, 0.0, high=2.0, low=1.0), bar("A", 1, 10.0), bar("A", 2, 0.0)]
    silver = bars(spark, rows)
    price = tables.price_metrics(silver, WHOLE)
    assert column(price, "DAILY_RETURN_PCT") == [None, None, -100.0]
    assert column(price, "INTRADAY_RANGE_AMT")[0] == 1.0
    assert column(price, "INTRADAY_RANGE_PCT") == [None, 0.0, None]
    reaction = tables.earnings_reaction(silver, WHOLE)
    assert column(reaction, "NEXT_DAY_RETURN_PCT") == [None, -100.0, None]
    assert column(reaction, "EVENT_WINDOW_RETURN_PCT") == [None, None, None]
    assert column(reaction, "EARNING_DIRECTION") == [None, "FLAT", None]


def test_trailing_frames_leave_today_out_and_may_be_partial(spark):
    rows = [bar("A", n, 100.0, high=100.0 + n, low=100.0, volume=n) for n in range(23)]
    silver = bars(spark, rows)
    usual = column(tables.price_metrics(silver, WHOLE), "20_DAY_AVG_INTRADAY_RANGE_PCT")
    assert usual[:4] == [None, 0.0, 0.5, 1.0]
    assert usual[22] == pytest.approx(sum(range(2, 22)) / 20)
    volume = tables.volume_liquidity(silver, WHOLE)
    assert column(volume, "5_DAY_AVG_VOLUME")[6] == pytest.approx(3.0)
    assert column(volume, "20_DAY_AVG_VOLUME")[22] == pytest.approx(11.5)


def test_volume_change(spark):
    df = tables.volume_liquidity(
        bars(spark, [bar("A", 0, 1.0, volume=0), bar("A", 1, 1.0, volume=10), bar("A", 2, 1.0, volume=5),
                     bar("A", 3, 1.0, volume=None), bar("A", 4, 1.0, volume=5)]), WHOLE)
    assert column(df, "PREV_VOLUME") == [None, 0, 10, 5, None]
    assert column(df, "VOLUME_CHANGE_PCT") == [None, None, -50.0, None, None]
    assert column(df, "VOLUME_DIRECTION") == ["FLAT", "UP", "DOWN", "FLAT", "FLAT"]


def test_missing_close_is_skipped_only_where_filtered_first(spark):
    silver = bars(spark, [bar("A", 0, 10.0), bar("A", 1, None, open=10.0, high=1.0, low=1.0), bar("A", 2, 12.0)])
    assert column(tables.price_metrics(silver, WHOLE), "PREV_CLOSE_PRICE") == [None, 10.0, None]
    reaction = tables.earnings_reaction(silver, WHOLE)
    assert column(reaction, "PRE_EARNINGS_CLOSE") == [None, 10.0]
    assert column(reaction, "POST_EARNINGS_CLOSE") == [12.0, None]
    assert tables.risk_metrics(silver, WHOLE).count() == 2


def test_eps_surprise(spark):
    cases = [(-0.5, -1.0), (1.0, 0.0), (1.0, 1.0), (None, 1.0)]
    df = earnings.add_eps_surprise(
        bars(spark, [bar("A", n, 1.0, eps=e, estimate=x) for n, (e, x) in enumerate(cases)])
    )
    assert column(df, "EPS_SURPRISE_AMT") == [0.5, 1.0, 0.0, None]
    assert column(df, "EPS_SURPRISE_PCT") == [-50.0, None, 0.0, None]
    assert column(df, "SURPRISE_DIRECTION") == ["NEGATIVE", None, "NO_SURPRISE", None]


def test_event_flags(spark):
    rows = [
        bar("A", 0, 10.0, eps=2.0, estimate=1.0),
        bar("A", 1, 11.0, eps=2.0, estimate=1.0),
        bar("A", 2, 12.0, eps=1.0, estimate=2.0),
        bar("A", 3, 12.0, eps=1.0, estimate=1.0),
        bar("A", 4, 12.0, eps=2.0, estimate=1.0),
        bar("A", 5, 11.0, eps=1.0, estimate=2.0),
        bar("A", 6, 11.5, eps=1.0, estimate=2.0),
    ]
    df = tables.earnings_reaction(bars(spark, rows), WHOLE)
    assert column(df, "EARNING_DIRECTION") == [None, "UP", "UP", "FLAT", "DOWN", "DOWN", None]
    assert column(df, "REACTION_ALIGNMENT_FLAG") == [
        None, "ALIGNED", "MISALIGNED", "NEUTRAL", "MISALIGNED", "ALIGNED", None]
    assert column(df, "DRIFT_DIRECTION") == ["UP", "UP", "FLAT", "FLAT", "DOWN", "UP", None]
    assert column(df, "DRIFT_ALIGNMENT_FLAG") == [
        None, "CONTINUATION", "NEUTRAL", "NEUTRAL", "CONTINUATION", "REVERSAL", None]
    assert column(df, "VOLUME_CONFIRMATION_FLAG") == [
        "NEUTRAL", "WEAK", "WEAK", "NEUTRAL", "WEAK", "WEAK", "NEUTRAL"]


def test_no_surprise_with_a_move_is_neutral(spark):
    rows = [bar("A", 0, 1.0), bar("A", 1, 2.0, eps=1.0, estimate=1.0), bar("A", 2, 3.0)]
    assert column(tables.earnings_reaction(bars(spark, rows), WHOLE), "REACTION_ALIGNMENT_FLAG")[1] == "NEUTRAL"


def test_volume_spike_is_strict_and_confirms(spark):
    rows = [bar(s, n, 10.0 + n, volume=100) for s in "AB" for n in range(20)]
    rows += [bar("A", 20, 30.0, volume=150), bar("B", 20, 30.0, volume=151)]
    rows += [bar(s, 21, 31.0, volume=100) for s in "AB"]
    found = table(tables.earnings_reaction(bars(spark, rows), WHOLE), "VOLUME_SPIKE_FLAG", "VOLUME_CONFIRMATION_FLAG")
    assert found[("A", day(20))] == ("NORMAL", "WEAK")
    assert found[("B", day(20))] == ("SPIKE", "CONFIRMED")
    assert found[("A", day(0))] == (None, "NEUTRAL")


def test_volatility_edges(spark):
    rows = [bar(s, n, 100.0, high=110.0, low=100.0) for s in "ABCDE" for n in range(20)]
    spans = {"A": 15.0, "B": 7.0, "C": 15.5, "D": 6.5, "E": 0.0}
    rows += [bar(s, 20, 100.0, high=100.0 + span, low=100.0) for s, span in spans.items()]
    silver = bars(spark, rows)
    regime = table(tables.market_regime(silver, WHOLE), "VOLATILITY_REGIME_FLAG")
    assert [regime[(s, day(20))] for s in "ABCDE"] == ["NORMAL", "NORMAL", "HIGH", "LOW", None]
    reaction = table(tables.earnings_reaction(silver, WHOLE), "VOLATILITY_SPIKE_FLAG", "VOLATILITY_MULTIPLIER")
    flags, factors = zip(*[reaction[(s, day(20))] for s in "ABCDE"])
    assert flags == ("NORMAL", "NORMAL", "SPIKE", "NORMAL", "NORMAL")
    assert factors == pytest.approx((1.5, 0.7, 1.55, 0.65, 0.0))
    assert reaction[("A", day(0))] == (None, None)


def trailing(values, n, size, fold):
    frame = [v for v in values[max(0, n - size):n] if v is not None]
    return fold(frame) if frame else None


def mean(values):
    return sum(values) / len(values)


def test_nested_volatility_and_drawdown(spark):
    closes = [100.0 + n + (7.0 if n % 5 == 0 else 0.0) for n in range(45)]
    df = tables.risk_frame(bars(spark, [bar("A", n, c) for n, c in enumerate(closes)]), WHOLE)
    returns = [None] + [(b - a) / a * 100 for a, b in zip(closes, closes[1:])]
    means = [trailing(returns, n, 20, mean) for n in range(45)]
    squares = [None if r is None or m is None else (r - m) ** 2 for r, m in zip(returns, means)]
    variance = [trailing(squares, n, 20, mean) for n in range(45)]
    volatility = [None if v is None else math.sqrt(v) for v in variance]
    highs = [trailing(closes, n, 20, max) for n in range(45)]
    falls = [None if h is None else c / h - 1 for c, h in zip(closes, highs)]
    assert column(df, "ROLLING_VOLATILITY_20D") == [None if v is None else pytest.approx(v) for v in volatility]
    assert volatility[:3] == [None, None, None] and volatility[3] is not None
    assert column(df, "MAX_DRAWDOWN_LOOKBACK") == [trailing(falls, n, 20, min) for n in range(45)]
    assert column(df, "ROLLING_RETURN_20D")[19:21] == [None, closes[20] / closes[0] - 1]
    last = closes[44] / closes[24] - 1
    assert column(df, "RISK_ADJUSTED_RETURN_20D")[44] == pytest.approx(last / volatility[44])


def test_drawdown_of_a_rising_series_is_positive(spark):
    df = tables.risk_metrics(bars(spark, [bar("A", n, 100.0 + n) for n in range(45)]), WHOLE)
    assert column(df, "MAX_DRAWDOWN_LOOKBACK")[44] > 0


def test_risk_adjusted_return_needs_volatility(spark):
    df = tables.risk_metrics(bars(spark, [bar("A", n, 100.0) for n in range(45)]), WHOLE)
    assert column(df, "ROLLING_VOLATILITY_20D")[44] == 0.0
    assert column(df, "ROLLING_RETURN_20D")[44] == 0.0
    assert column(df, "RISK_ADJUSTED_RETURN_20D")[44] is None


def test_strength_trend_when_the_index_is_missing(spark):
    rows = [bar("SPY", n, 100.0) for n in range(25) if n != 23]
    rows += [bar("A", n, 100.0 + n * n) for n in range(25)]
    df = tables.relative_strength(bars(spark, rows), longest=WHOLE)
    assert column(df, "RELATIVE_STRENGTH_20D")[23] is None
    assert column(df, "RS_TREND")[20:] == [None, "STRENGTHENING", "STRENGTHENING", "STABLE", None]
    assert column(df, "RELATIVE_STRENGTH_DIRECTION")[20:] == [
        "OUTPERFORM", "OUTPERFORM", "OUTPERFORM", None, "OUTPERFORM"]
    own = df.filter("SYMBOL = 'SPY' AND RELATIVE_STRENGTH_20D IS NOT NULL")
    assert {tuple(r) for r in own.select("RELATIVE_STRENGTH_20D", "RELATIVE_STRENGTH_DIRECTION").collect()} == {
        (0.0, "NEUTRAL")
    }


def test_benchmark_is_a_parameter(spark):
    rows = [bar(s, n, 100.0 + n * k) for s, k in (("DAX", 1), ("A", 2)) for n in range(21)]
    df = tables.relative_strength(bars(spark, rows), benchmark="DAX", longest=WHOLE)
    assert column(df, "RELATIVE_STRENGTH_DIRECTION")[20] == "OUTPERFORM"


def test_two_index_bars_on_a_day_raise(spark):
    rows = [bar("SPY", 0, 1.0), bar("SPY", 0, 2.0), bar("A", 0, 1.0)]
    with pytest.raises(PySparkException, match="more than one benchmark bar"):
        tables.relative_strength(bars(spark, rows), longest=WHOLE).collect()


def test_latest_complete_row(spark):
    rows = [bar(s, n, 100.0 + n) for s in ("SPY", "A", "B") for n in range(25) if not (s == "SPY" and n == 24)]
    rows += [bar("C", 0, 1.0)]
    found = table(strength.latest_complete(tables.relative_strength(bars(spark, rows), longest=WHOLE)), "RS_TREND")
    assert set(found) == {("SPY", day(23)), ("A", day(23)), ("B", day(23))}


@pytest.mark.parametrize(
    "rising,regime",
    [(14, "STRONG_BULL"), (13, "BULL"), (10, "BULL"), (9, "NEUTRAL"), (8, "NEUTRAL"), (7, "BEAR"), (5, "BEAR"),
     (4, "STRONG_BEAR")],
)
def test_breadth_bands(spark, rising, regime):
    rows = [bar(f"S{s}", n, 10.0 + (n if s < rising else -n)) for s in range(20) for n in range(2)]
    first, second = tables.market_breadth(bars(spark, rows), longest=WHOLE).orderBy("DATE").collect()
    assert (first.PCT_STOCKS_UP, first.BREADTH_REGIME) == (0.0, "STRONG_BEAR")
    assert (second.TOTAL_STOCKS, second.PCT_STOCKS_UP, second.BREADTH_REGIME) == (20, rising / 20, regime)
    assert second.PCT_STOCKS_DOWN == (20 - rising) / 20


def test_breadth_counts_bars_without_a_close(spark):
    rows = [bar("A", 0, 10.0), bar("B", 0, None, open=1.0, high=1.0, low=1.0), bar(None, 0, 1.0), bar("A", None, 1.0)]
    (row,) = tables.market_breadth(bars(spark, rows), longest=WHOLE).collect()
    assert (row.DATE, row.TOTAL_STOCKS, row.AVG_MARKET_VOLATILITY) == (day(0), 2, None)


def test_breadth_counts_repeated_bars_once(spark):
    rows = [bar("A", 0, 10.0), bar("A", 0, 10.0), bar("B", 0, 10.0)]
    (row,) = tables.market_breadth(bars(spark, rows), longest=WHOLE).collect()
    assert row.TOTAL_STOCKS == 2


def test_keyless_bars_keep_averages_but_no_regime(spark):
    rows = [bar(None, n, 100.0, high=110.0, low=100.0) for n in range(3)]
    rows += [bar("A", n, 100.0, high=110.0, low=100.0) for n in (None, 0, 1)]
    found = tables.market_regime(bars(spark, rows), WHOLE).collect()
    assert {r.VOLATILITY_REGIME_FLAG for r in found if r.SYMBOL is None or r.DATE is None} == {None}
    by_key = {(r.SYMBOL, r.DATE): r for r in found}
    assert by_key[("A", day(0))]["30_DAYS_AVG_SMA"] == 100.0
    assert by_key[("A", day(0))].VOLATILITY_REGIME_FLAG == "NORMAL"
    assert by_key[(None, day(2))]["6_MONTHS_AVG_SMA"] == 100.0


def test_regime_slopes(spark):
    df = tables.market_regime(bars(spark, [bar("A", n, float(n)) for n in range(70)]), WHOLE)
    assert column(df, "30_DAYS_AVG_SMA")[69] == pytest.approx(sum(range(39, 69)) / 30)
    for rows in (5, 10, 30):
        assert column(df, f"{rows}_DAY_TREND_SLOPE")[69] == pytest.approx(1.0)
    assert column(df, "5_DAY_TREND_SLOPE")[5] is None
    assert column(df, "5_DAY_TREND_SLOPE")[6] == pytest.approx((2.5 - 0.0) / 5)


def test_silver_from_text(spark):
    prices = spark.createDataFrame(
        [("A", "2020-1-5", "1.5", "2", "abc", "", " 7 ", "123.7", "1"), ("A", "01/05/2020", *["1"] * 7)],
        "symbol string, date string, open string, high string, low string, close string, close_adjusted string, "
        "volume string, split_coefficient string",
    )
    earnings_text = spark.createDataFrame(
        [("A", "2020-01-05", "Q1", "x", "2.5", "post")],
        "symbol string, date string, qtr string, eps_est string, eps string, release_time string",
    )
    dividends_text = spark.createDataFrame(
        [("A", "2020-01-05", "0.25"), ("Z", "2020-01-05", "9")], "symbol string, date string, dividend string"
    )
    silver = enrich(type_prices(prices), type_earnings(earnings_text), type_dividends(dividends_text))
    assert silver.columns == SILVER
    dated, undated = sorted(silver.collect(), key=lambda r: r.DATE is None)
    assert tuple(dated) == ("A", day(4), 1.5, 2.0, None, None, 7.0, 123, 1.0, "Q1", None, 2.5, "post", 0.25)
    assert undated.DATE is None and undated.DIVIDENDS is None


def test_enrichment_keeps_every_price_row_and_matches_both_tables(spark):
    def frame(rows, columns):
        return spark.createDataFrame(rows, f"SYMBOL string, DATE date, {columns}")

    days = [("A", day(0)), ("A", day(1)), ("A", day(2)), ("A", day(3)), (None, day(0)), ("A", None), (None, None)]
    prices = frame([(*k, *[1.0] * 5, 1, 1.0) for k in days], ", ".join(
        [f"{c} double" for c in SILVER[2:7]] + ["VOLUME bigint, SPLIT_COEFFICIENT double"]))
    reports = frame([("A", day(0), "Q1", 1.0, 2.0, "pre"), ("A", day(1), "Q2", 1.0, 3.0, "pre"),
                     ("Z", day(0), "Q1", 1.0, 9.0, "pre"), (None, None, "Q9", 1.0, 9.0, "pre")],
                    "QUARTER string, EPS_ESTIMATE double, EPS double, RELEASE_TIME string")
    paid = frame([("A", day(1), 0.1), ("A", day(2), 0.2), (None, day(0), 9.0), ("A", None, 9.0)], "DIVIDENDS double")
    found = enrich(prices, reports, paid).select("SYMBOL", "DATE", "EPS", "DIVIDENDS").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("A", day(0), 2.0, None), ("A", day(1), 3.0, 0.1), ("A", day(2), None, 0.2), ("A", day(3), None, None),
         (None, day(0), None, None), ("A", None, None, None), (None, None, None, None)], key=str)


def test_repeated_key_is_found_and_raises(spark):
    rows = [bar("A", 0, 1.0), bar("A", 0, 2.0), bar("A", 1, 1.0), bar(None, 0, 1.0), bar(None, 0, 1.0)]
    profile = profile_keys(bars(spark, rows))
    assert (profile.rows, profile.longest_series, profile.repeated_keys) == (5, 3, 1)
    with pytest.raises(ValueError, match="must be unique"):
        require_unique_key(profile, "prices", bars(spark, rows))
    keyless = bars(spark, [bar(None, 0, 1.0), bar(None, 0, 1.0), bar("A", None, 1.0), bar("A", None, 1.0)])
    require_unique_key(profile_keys(keyless), "prices", keyless)


def test_output_columns(spark):
    silver = bars(spark, [bar("SPY", 0, 1.0)])
    assert tables.risk_metrics(silver, WHOLE).columns == risk.OUTPUT
    assert tables.relative_strength(silver, longest=WHOLE).columns == strength.OUTPUT
    assert tables.earnings_reaction(silver, WHOLE).columns == earnings.OUTPUT
    assert len(earnings.OUTPUT) == 33
    assert tables.market_breadth(silver, longest=WHOLE).columns == breadth.OUTPUT


def test_rows_without_a_key_are_dealt_evenly(spark):
    """Half of the prices lack a key and are all alike: no task of the join gets over twice the median."""
    keyed = [(f"S{i % 500}", day(i // 500), "x") for i in range(4_000)]
    keyless = [(None, day(1), "y") if i % 2 else ("S1", None, "y") for i in range(4_000)]
    names = "SYMBOL string, DATE date, QUARTER string"
    rows = spark.createDataFrame([*keyed, *keyless], "SYMBOL string, DATE date, RELEASE string")
    typed = {c: "cast(NULL AS double) AS " + c for c in SILVER if c not in ("SYMBOL", "DATE")}
    prices = rows.selectExpr("SYMBOL", "DATE", *[typed[c] for c in SILVER[2:9]])
    events = spark.createDataFrame(keyed, names).selectExpr("SYMBOL", "DATE", "QUARTER", "1D AS EPS_ESTIMATE", "1D AS EPS", "'r' AS RELEASE_TIME")
    dividends = spark.createDataFrame([("S1", None, 1.0), (None, day(1), 1.0)], "SYMBOL string, DATE date, DIVIDENDS double")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = enrich(prices, events, dividends)
        found = joined.selectExpr("spark_partition_id() AS p", "EPS").groupBy("p").agg({"*": "count", "EPS": "count"}).collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    sizes = sorted(r["count(1)"] for r in found)
    assert sum(sizes) == 8_000 and sum(r["count(EPS)"] for r in found) == 4_000
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
