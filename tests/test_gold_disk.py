"""What the batch run keeps on disk: the frame by shares, compressed tables and inputs, no shuffles of earlier steps."""

from __future__ import annotations

import re
import time
from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tests.frames import bar, bars
from tests.test_plans import random_rows, same
from tickloom import checks
from tickloom.operators import breadth
from tickloom.plans import batch, tables
from tickloom.sources import feed
from tickloom.sources.tables import (
    FREE_SHUFFLES,
    GOLD_TABLES,
    freeing_shuffles,
    read_raw_csv,
    read_table,
    table_path,
    write_by_symbol,
    write_table,
)

SYMBOLS = ("SPY", *"ABCDEFGH")


@pytest.fixture
def silver(spark, tmp_path):
    rows = random_rows(symbols=SYMBOLS, days=90, keyless=True)
    write_table(bars(spark, rows), str(tmp_path / "silver"))
    return spark.read.parquet(str(tmp_path / "silver"))


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(batch, "SHARE_ROWS", 200, raising=False)
    monkeypatch.setattr(batch, "TASK_ROWS", 1, raising=False)


@pytest.fixture
def frames(spark, monkeypatch):
    """Of every table taken out of a frame: the rows of this, and the frames then in scratch."""
    shared, found, real = Path(spark.conf.get("spark.checkpoint.dir")), [], tables.table_of

    def seen(frame, name):
        found.append((frame.count(), len(list(shared.glob("*/market_frame*")))))
        return real(frame, name)

    monkeypatch.setattr(tables, "table_of", seen)
    return found


@pytest.mark.parametrize("bucketed", [False, True])
def test_one_share_of_the_frame_is_stored_at_a_time(spark, silver, tmp_path, few_rows, frames, bucketed):
    stored, total = silver, silver.count()
    if bucketed:
        write_by_symbol(silver, str(tmp_path / "by_symbol"), "silver_in_shares", 4)
        stored = spark.table("silver_in_shares")
    batch.build_gold(stored, str(tmp_path), bucketed=bucketed)
    shares = [rows for rows, _ in frames[:: len(GOLD_TABLES) - 1]]
    assert len(shares) > 2 and max(shares) < total / 2 and sum(shares) == total
    assert {n for _, n in frames} == {1}
    for name in GOLD_TABLES:
        same(read_table(spark, str(tmp_path), name), getattr(tables, name)(silver))


def test_few_bars_are_one_share(spark, silver, tmp_path, frames):
    batch.build_gold(silver, str(tmp_path))
    assert {rows for rows, _ in frames} == {silver.count()}
    same(read_table(spark, str(tmp_path), "market_breadth"), tables.market_breadth(silver))


def test_a_failure_in_a_later_share_leaves_the_old_tables(spark, silver, tmp_path, few_rows, monkeypatch):
    batch.build_gold(silver, str(tmp_path))
    before, calls, real = sorted(p.name for p in (tmp_path / "gold").iterdir()), [], tables.market_frame

    def failing(*args, **given):
        calls.append(1)
        if len(calls) > 1:
            raise OSError("no more")
        return real(*args, **given)

    monkeypatch.setattr(tables, "market_frame", failing)
    with pytest.raises(OSError, match="no more"):
        batch.build_gold(silver.filter("SYMBOL <> 'A'"), str(tmp_path))
    assert len(calls) == 2
    assert sorted(p.name for p in (tmp_path / "gold").iterdir()) == before
    same(read_table(spark, str(tmp_path), "price_metrics"), tables.price_metrics(silver))


def test_a_second_benchmark_bar_on_a_day_raises_in_shares(spark, tmp_path, few_rows):
    rows = [bar(s, n, 1.0 + n) for s in SYMBOLS for n in range(40)]
    write_table(bars(spark, [*rows, bar("SPY", 3, 9.0)]), str(tmp_path / "silver"))
    with pytest.raises(Exception, match="more than one benchmark bar on"):
        batch.build_gold(spark.read.parquet(str(tmp_path / "silver")), str(tmp_path))


def test_files_are_shared_among_the_shares(spark, silver, tmp_path, few_rows):
    shares = len(batch.shares_of(silver, silver.count()))
    batch.build_gold(silver, str(tmp_path), files=1)
    assert shares > 2 and len(list((tmp_path / "gold/risk_metrics_gold").glob("*.parquet"))) == shares


def test_counts_of_divided_bars_make_the_same_breadth(spark):
    schema = (
        "SYMBOL string, DATE int, FIRST_OF_DAY boolean, DAILY_DIRECTION string, RELATIVE_STRENGTH_DIRECTION string, "
        "RS_TREND string, ROLLING_VOLATILITY_20D double"
    )
    rows = [
        ("A", 1, True, "UP", "OUTPERFORM", "STRENGTHENING", 1.0),
        ("A", 1, False, "DOWN", None, None, None),
        ("B", 1, True, "UP", "NEUTRAL", "STABLE", 3.0),
        ("B", 2, True, None, None, None, None),
        (None, 1, True, "UP", "OUTPERFORM", "STRENGTHENING", 9.0),
        ("B", None, True, "UP", "OUTPERFORM", "STRENGTHENING", 9.0),
    ]
    whole = spark.createDataFrame(rows, schema)
    parts = [breadth.daily_counts(whole.filter(f"SYMBOL {test}")) for test in ("= 'A'", "<> 'A'", "IS NULL")]
    divided = breadth.breadth_of_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    expected = [(1, 2, 2 / 3, 1 / 3, 1 / 3, 1 / 3, 2.0, "BULL"), (2, 1, 0.0, 0.0, 0.0, 0.0, None, "STRONG_BEAR")]
    for found in (divided, breadth.market_breadth(whole)):
        assert sorted(tuple(r) for r in found.collect()) == expected


def kinds(folder):
    return {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in Path(folder).glob("*.parquet")}


def test_tables_are_compressed_as_asked_and_else_well(spark, tmp_path):
    write_table(spark.range(9), str(tmp_path / "a"))
    write_by_symbol(bars(spark, [bar("A", 1, 1.0)]), str(tmp_path / "b"), "compressed_by_symbol", 1)
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        write_table(spark.range(9), str(tmp_path / "c"))
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")
    assert [kinds(tmp_path / name) for name in "abc"] == [{"ZSTD"}, {"ZSTD"}, {"GZIP"}]


def test_inputs_made_for_the_run_are_compressed(spark, tmp_path):
    start, lines = datetime(2000, 1, 3), []
    for n in range(600):
        flag = "R" if n % 3 else "N"
        lines.append((n % 4, float(1 + n % 7), 0.08, flag, start + timedelta(days=n), 1000.0 + n / 7))
    schema = "l_suppkey long, l_quantity double, l_tax double, l_returnflag string, l_shipdate timestamp, l_extendedprice double"
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    checks._write_raw_csv(spark, str(tmp_path), str(tmp_path / "run"))
    made = feed.raw_tables(feed.trades(spark, str(tmp_path)))
    for name, raw in made.items():
        path = table_path(str(tmp_path / "run"), f"raw_{name}")
        read = read_raw_csv(spark, path)
        same(read, raw)
        text = sum(len(",".join(v or "" for v in row)) + 1 for row in read.collect())
        assert sum(p.stat().st_size for p in Path(path).glob("part-*")) < text / 2


def stored_shuffles(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", found))


def test_shuffles_of_a_step_are_gone_after_it(spark, tmp_path):
    before, had = stored_shuffles(spark), spark.conf.get(FREE_SHUFFLES, None)
    with freeing_shuffles(spark):
        kept = spark.range(1000).repartition(3, "id")
        write_table(kept, str(tmp_path / "t"))
        until = time.time() + 20
        while (left := stored_shuffles(spark) - before) and time.time() < until:
            time.sleep(0.1)
        assert not left
        assert kept.count() == 1000
    assert spark.conf.get(FREE_SHUFFLES, None) == had
