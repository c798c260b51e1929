"""The frame of all tables: equal to the tables one by one, whole and in parts, from one shuffle."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tests.frames import bar, bars
from tests.test_plans import plan_of, random_rows, same, shuffles
from tickloom.functions.series import BY_SYMBOL
from tickloom.operators import long_series, price
from tickloom.operators.long_series import Reach, over_chain, profile_keys, profile_tables
from tickloom.plans import tables
from tickloom.sources.tables import GOLD_TABLES

WHOLE = 1


@pytest.fixture(scope="module")
def silver(spark):
    return bars(spark, random_rows(keyless=True)).repartition(4).cache()


@pytest.fixture(scope="module")
def frame(silver):
    return tables.market_frame(silver, longest=WHOLE).cache()


@pytest.mark.parametrize("name", GOLD_TABLES)
def test_tables_of_the_frame(silver, frame, name):
    same(tables.table_of(frame, name), getattr(tables, name)(silver, longest=WHOLE))


@pytest.mark.parametrize("name", GOLD_TABLES)
def test_tables_of_the_frame_in_parts(spark, monkeypatch, name):
    monkeypatch.setattr(tables, "MAX_ROWS", 100)
    monkeypatch.setattr(tables, "PART_ROWS", 60)
    silver = bars(spark, holed_rows())
    cut = tables.market_frame(silver)
    assert "_PART" in plan_of(cut)
    same(tables.table_of(cut, name), getattr(tables, name)(silver, longest=WHOLE))


def holed_rows():
    """Series with months that hold no close, or no trade: their reach spans many buckets."""
    rnd = random.Random(3)
    rows = []
    for symbol in ("SPY", "A", "B"):
        for n in range(420):
            month = n // 30
            close = None if symbol != "SPY" and (month % 3 == 1 or rnd.random() < 0.1) else 50.0 + rnd.randrange(9)
            opened = None if symbol == "B" and month % 4 == 2 else 50.0
            rows.append(bar(symbol, n, close, open=opened, high=70.0, low=40.0 + rnd.random(), volume=rnd.randrange(90),
                            eps=rnd.choice([None, 1.0]), estimate=2.0))
    rows += [bar(None, n, 50.0 + n) for n in range(40)]
    return rows


def test_a_chain_is_cut_once(silver, monkeypatch):
    monkeypatch.setattr(tables, "MAX_ROWS", 100)
    monkeypatch.setattr(tables, "PART_ROWS", 60)
    one = [s for s in shuffles(tables.price_metrics(silver, 10**7)) if "_PART" in s or "SYMBOL" in s]
    index = tables.index_frame(silver, longest=WHOLE)
    chain = [s for s in shuffles(tables.market_frame(silver, longest=10**7, index=index)) if "_PART" in s or "SYMBOL" in s]
    # Bars are dealt out by part once, for the whole chain as for one step; besides, counts by month are.
    assert len([s for s in chain if "_PART" in s]) == len([s for s in one if "_PART" in s]) == 1


def test_the_frame_shuffles_bars_once_and_reads_the_benchmark_once(spark, silver, tmp_path):
    silver.write.parquet(str(tmp_path / "silver"))
    stored = spark.read.parquet(str(tmp_path / "silver"))
    whole = tables.market_frame(stored, longest=WHOLE)
    found = sorted(re.sub(r"#\d+", "", s) for s in shuffles(whole))
    # The bars by SYMBOL; the benchmark's own bars by SYMBOL and by DATE.
    assert found == ["DATE", "SYMBOL", "SYMBOL"]
    assert plan_of(whole).count("EqualTo(SYMBOL,SPY)") == 1


def test_tasks_of_the_frame_are_as_many_as_its_rows_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(long_series, "TASK_ROWS", 50)
    silver = bars(spark, [bar(f"S{n}", day, 1.0 + day) for n in range(300) for day in range(4)])
    silver.write.parquet(str(tmp_path / "silver"))
    stored = spark.read.parquet(str(tmp_path / "silver"))
    index = tables.index_frame(stored, longest=WHOLE)
    dealt = tables.market_frame(stored, longest=WHOLE, index=index, bars=stored.count())
    assert len(re.findall(r"hashpartitioning\(SYMBOL#\d+, 24\)", plan_of(dealt))) == 1
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 20 and max(sizes) <= 3 * 50
    same(dealt, tables.market_frame(stored, longest=WHOLE, index=index))


def test_parts_hold_their_share_of_a_hot_symbol(spark):
    rows = [bar("HOT", n, 1.0 + n % 7) for n in range(3000)] + [bar(f"S{n}", 0, 1.0) for n in range(50)]
    seen = {}

    def step(df, series):
        seen["parts"] = df.groupBy(*series.keys).count()
        return price.add_price_metrics(df, series)

    over_chain(bars(spark, rows), BY_SYMBOL, step, [Reach("true", price.REACH)], 180)
    sizes = sorted(r["count"] for r in seen["parts"].collect())
    assert len(sizes) >= 50 + 3000 // (180 + 31) and sizes[-1] <= 180 + 31 + 20 + 62


def test_profiles_of_several_tables_in_one_job(spark):
    first = bars(spark, [bar("A", 0, 1.0), bar("A", 0, 2.0), bar("A", 1, 1.0), bar(None, 1, 1.0), bar("B", None, 1.0)])
    second, empty = bars(spark, [bar("A", n, 1.0) for n in range(40)]), bars(spark, [bar("A", 0, 1.0)]).limit(0)
    found = profile_tables({"first": first, "second": second, "empty": empty})
    assert found == {"first": profile_keys(first), "second": profile_keys(second), "empty": profile_keys(empty)}
    assert (found["first"].rows, found["first"].repeated_keys, found["empty"].rows) == (5, 1, 0)
