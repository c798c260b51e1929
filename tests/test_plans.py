"""Whole tables: against literal self-joins, cut into parts, and the shape of their plans."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.compare import TESTDATA, sorted_rows
from tests.frames import bar, bars
from tickloom.functions.series import BY_SYMBOL
from tickloom.operators import earnings, price, regime, risk, strength, volume
from tickloom.operators.long_series import longest_series, over_series
from tickloom.plans import tables
from tickloom.sources import feed

KEY = ["SYMBOL", "DATE"]
WHOLE = 1


def random_rows(seed=7, symbols=("SPY", "A", "B", "C"), days=260, keyless=False):
    """Prices with holes: NULL closes, opens and volumes, zero prices, missing days."""
    rnd = random.Random(seed)
    rows = []
    for symbol in symbols:
        close = 100.0
        for n in range(days):
            if rnd.random() < 0.1:
                continue
            close = max(1.0, close + rnd.choice([-2.0, -1.0, 0.0, 0.0, 1.0, 2.5]))
            shown = None if symbol != "SPY" and rnd.random() < 0.05 else 0.0 if rnd.random() < 0.01 else close
            rows.append(
                bar(symbol, n, shown, open=None if rnd.random() < 0.05 else close - 0.5, high=close + rnd.random(),
                    low=close - rnd.random(), volume=None if rnd.random() < 0.05 else rnd.randrange(0, 500),
                    eps=rnd.choice([None, 1.0, -1.0, 2.0]), estimate=rnd.choice([None, 1.0, -2.0, 0.0])))
    if keyless:
        rows += [bar(None, n, 50.0 + n, high=60.0 + n, low=50.0) for n in range(40)]
        rows += [bar(s, None, 70.0, high=75.0, low=70.0) for s in symbols]
    return rows


@pytest.fixture(scope="module")
def silver(spark):
    return bars(spark, random_rows()).repartition(4).cache()


def same(left, right, digits=9):
    def rows(df):
        shown = [F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
        return sorted_rows(df.select(*shown).collect())

    assert left.columns == right.columns
    assert rows(left) == rows(right)


# The tables as separate steps that are joined back together.


def literal_risk(silver):
    closes = silver.select(*KEY, "CLOSE_PRICE").filter(risk.PRICED_BAR)
    returns = tables.price_metrics(silver, WHOLE).select(*KEY, "DAILY_RETURN_PCT")
    return risk.add_risk_metrics(closes.join(returns, KEY, "left")).select(*risk.OUTPUT)


def literal_strength(silver):
    returns = literal_risk(silver).select(*KEY, "ROLLING_RETURN_20D")
    index = strength.add_index_return(strength.benchmark_bars(silver)).select("DATE", "INDEX_RETURN_20D")
    return strength.add_relative_strength(returns, index).select(*strength.OUTPUT)


def literal_earnings(silver):
    traded = silver.select(*KEY, "OPEN_PRICE", "CLOSE_PRICE", "VOLUME", "EPS", "EPS_ESTIMATE").filter(
        earnings.TRADED_BAR
    )
    ranges = tables.price_metrics(silver, WHOLE).select(*KEY, "INTRADAY_RANGE_PCT", "20_DAY_AVG_INTRADAY_RANGE_PCT")
    volumes = tables.volume_liquidity(silver, WHOLE).drop("PREV_VOLUME")
    joined = traded.join(volumes, KEY, "left").join(ranges, KEY, "left")
    return earnings.add_earnings_reaction(joined).select(*earnings.OUTPUT)


def literal_regime(silver):
    ranges = tables.price_metrics(silver, WHOLE).select(*KEY, "INTRADAY_RANGE_PCT", "20_DAY_AVG_INTRADAY_RANGE_PCT")
    keyed = ranges.dropna(subset=KEY)
    return regime.add_regime(silver.select(*KEY, "CLOSE_PRICE").join(keyed, KEY, "left")).select(*regime.OUTPUT)


def literal_breadth_input(silver):
    price_rows = tables.price_metrics(silver, WHOLE).select(*KEY, "DAILY_DIRECTION")
    risks = literal_risk(silver).select(*KEY, "ROLLING_VOLATILITY_20D")
    strengths = literal_strength(silver).select(*KEY, "RELATIVE_STRENGTH_DIRECTION", "RS_TREND")
    return price_rows.join(risks, KEY, "left").join(strengths, KEY, "left")


def test_risk_equals_joined_tables(silver):
    same(tables.risk_metrics(silver, WHOLE), literal_risk(silver))


def test_strength_equals_joined_tables(silver):
    same(tables.relative_strength(silver, longest=WHOLE), literal_strength(silver))


def test_earnings_equal_joined_tables(silver):
    same(tables.earnings_reaction(silver, WHOLE), literal_earnings(silver))


def test_regime_equals_joined_tables(silver, spark):
    same(tables.market_regime(silver, WHOLE), literal_regime(silver))
    keyless = bars(spark, random_rows(keyless=True))
    same(tables.market_regime(keyless, WHOLE), literal_regime(keyless))


def test_breadth_input_equals_joined_tables(silver):
    literal = literal_breadth_input(silver)
    same(tables.breadth_frame(silver, longest=WHOLE).select(*literal.columns), literal)


@pytest.mark.parametrize("name,rows", [("30_DAYS_AVG_SMA", 30), ("100_DAYS_AVG_SMA", 100), ("6_MONTHS_AVG_SMA", 180)])
def test_long_means_equal_plain_frames(silver, name, rows):
    plain = silver.selectExpr(*KEY, f"{BY_SYMBOL.mean('CLOSE_PRICE', rows)} AS `{name}`")
    same(tables.market_regime(silver, WHOLE).select(*KEY, name), plain)


# A series cut into parts gives the same values as a whole one.

STEPS = {
    "price": (price.add_price_metrics, price.REACH, False),
    "volume": (volume.add_volume_metrics, volume.REACH, False),
    "context": (earnings.add_event_context, earnings.REACH, True),
}


@pytest.mark.parametrize("name", STEPS)
@pytest.mark.parametrize("part", [20, 37, 100])
def test_step_in_parts(spark, name, part):
    step, reach, ahead = STEPS[name]
    frame = bars(spark, random_rows(keyless=True))
    cut = over_series(frame, BY_SYMBOL, step, reach, ahead, part_rows=part)
    same(cut, over_series(frame, BY_SYMBOL, step, reach, ahead))


def test_sparse_and_dense_months_in_parts(spark):
    """Buckets from 1 to 31 rows: several short months per part, and parts shorter than the reach."""
    rnd = random.Random(3)
    days = sorted(set(rnd.sample(range(4000), 150)) | set(range(1000, 1200)) | set(range(2000, 2090)))
    frame = bars(spark, [bar("A", n, 50.0 + rnd.random(), volume=n) for n in days])
    for part in (20, 21, 33):
        cut = over_series(frame, BY_SYMBOL, volume.add_volume_metrics, volume.REACH, part_rows=part)
        same(cut, over_series(frame, BY_SYMBOL, volume.add_volume_metrics, volume.REACH))


@pytest.fixture
def short_parts(monkeypatch):
    monkeypatch.setattr(tables, "MAX_ROWS", 200)
    monkeypatch.setattr(tables, "PART_ROWS", 180)


@pytest.mark.parametrize(
    "build",
    [
        tables.price_metrics,
        tables.volume_liquidity,
        tables.earnings_reaction,
        tables.risk_metrics,
        tables.relative_strength,
        tables.market_regime,
        tables.market_breadth,
    ],
)
def test_table_in_parts(silver, short_parts, build):
    assert longest_series(silver) > 200
    cut = build(silver)
    assert "_PART" in plan_of(cut)
    same(cut, build(silver, longest=WHOLE))


def test_hot_symbol_is_spread_over_tasks(spark):
    """One symbol with most of the rows: no part holds more than its share."""
    rows = [bar("HOT", n, 1.0 + n % 7) for n in range(3000)] + [bar(f"S{n}", 0, 1.0) for n in range(50)]
    seen = {}

    def step(df, series):
        seen["parts"] = df.groupBy(*series.keys).count()
        return price.add_price_metrics(df, series)

    over_series(bars(spark, rows), BY_SYMBOL, step, price.REACH, part_rows=180)
    sizes = sorted(r["count"] for r in seen["parts"].collect())
    assert len(sizes) >= 50 + 3000 // (180 + 31)
    # A part, the month that overshoots it, and the copied months its frames reach.
    assert sizes[-1] <= 180 + 31 + 20 + 31


def test_parts_must_cover_the_reach(silver):
    with pytest.raises(ValueError, match="shorter than the reach"):
        over_series(silver, BY_SYMBOL, price.add_price_metrics, price.REACH, part_rows=19)


# Plan shapes.


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan_of(df))


@pytest.fixture(scope="module")
def stored(spark, silver, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "silver")
    silver.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "build", [tables.price_metrics, tables.volume_liquidity, tables.earnings_reaction, tables.risk_metrics,
              tables.market_regime]
)
def test_symbol_tables_shuffle_once(stored, build):
    plan = plan_of(build(stored, WHOLE))
    assert len(shuffles(build(stored, WHOLE))) == 1
    assert "SortMergeJoin" not in plan and "Python" not in plan


def test_strength_broadcasts_one_row_per_day(stored):
    df = tables.relative_strength(stored, longest=WHOLE)
    plan = plan_of(df)
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
    # The bars once by SYMBOL; the benchmark's own bars by SYMBOL and by DATE.
    assert sorted(re.sub(r"#\d+", "", s) for s in shuffles(df)) == ["DATE", "SYMBOL", "SYMBOL"]


def test_breadth_needs_no_join_back(stored):
    df = tables.market_breadth(stored, longest=WHOLE)
    plan = plan_of(df)
    assert plan.count("Join") == 1
    assert sorted(re.sub(r"#\d+", "", s) for s in shuffles(df)) == ["DATE", "DATE", "SYMBOL", "SYMBOL"]


def test_benchmark_filter_reaches_the_scan(stored):
    plan = plan_of(strength.benchmark_bars(stored))
    assert "EqualTo(SYMBOL,SPY)" in plan
    assert re.search(r"ReadSchema: struct<SYMBOL:string,DATE:date,CLOSE_PRICE:double>", plan)


def test_scan_reads_only_the_needed_columns(stored):
    plan = plan_of(tables.volume_liquidity(stored, WHOLE))
    assert "ReadSchema: struct<SYMBOL:string,DATE:date,VOLUME:bigint>" in plan


def test_feed_bars_use_hash_aggregates(spark):
    plan = plan_of(feed.prices(feed.trades(spark, f"{TESTDATA}/sf0.001")))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


# Properties.


def test_row_counts(silver):
    assert tables.price_metrics(silver, WHOLE).count() == silver.count()
    assert tables.risk_metrics(silver, WHOLE).count() == silver.filter("CLOSE_PRICE IS NOT NULL").count()
    traded = silver.filter("CLOSE_PRICE IS NOT NULL AND OPEN_PRICE IS NOT NULL").count()
    assert tables.earnings_reaction(silver, WHOLE).count() == traded
    assert tables.market_breadth(silver, longest=WHOLE).count() == silver.select("DATE").distinct().count()


def test_doubling_all_prices_changes_no_return_or_flag(silver):
    prices = ["OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "CLOSE_PRICE"]
    doubled = silver.withColumns({c: F.col(c) * 2 for c in prices})
    for build, scaled in (
        (tables.price_metrics, ["PREV_CLOSE_PRICE", "GAP_AMOUNT", "INTRADAY_RANGE_AMT"]),
        (tables.risk_metrics, []),
        (tables.relative_strength, []),
        (tables.market_breadth, []),
    ):
        same(build(doubled, longest=WHOLE).drop(*scaled), build(silver, longest=WHOLE).drop(*scaled))


def test_given_index_with_a_repeated_day_raises(spark):
    silver = bars(spark, random_rows(days=30))
    index = tables.index_frame(silver, longest=1)
    same(tables.relative_strength(silver, longest=1, index=index), tables.relative_strength(silver, longest=1))
    with pytest.raises(Exception, match="more than one benchmark bar"):
        tables.relative_strength(silver, longest=1, index=index.union(index)).collect()
