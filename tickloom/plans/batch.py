"""The full run: raw CSV to bronze, silver and the seven gold tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import partial
from queue import Empty, SimpleQueue

from pyspark import InheritableThread
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import breadth
from tickloom.operators.long_series import (
    MAX_ROWS,
    TASK_ROWS,
    Profile,
    longest_series,
    profile_tables,
    require_unique_key,
)
from tickloom.operators.silver import enrich, type_dividends, type_earnings, type_prices, typed_with_losses
from tickloom.operators.strength import BENCHMARK
from tickloom.plans import tables
from tickloom.sources.dictionary import with_comments
from tickloom.sources.tables import (
    GOLD_TABLES,
    RAW_TABLES,
    Replacement,
    freeing_shuffles,
    read_raw_csv,
    read_table,
    remove,
    scratch_dir,
    table_path,
    write_by_symbol,
    write_table,
)

TYPING = {"prices": type_prices, "earnings": type_earnings, "dividends": type_dividends}
# A task of the wide frame sorts a whole bucket several times.
ROWS_PER_BUCKET = 1_000_000
# Independent tables written at once.
WRITES = 2
# Bars whose frame of all tables lies in scratch at once, and into how many shares the bars are dealt for that at most:
# silver is read once for each.
SHARE_ROWS = 2_000_000
MOST_SHARES = 32


def _side_by_side(jobs: Iterable[Callable[[], None]], at_once: int) -> None:
    """Run independent jobs, ``at_once`` at a time, so that one fills the cores another leaves idle.

    The threads keep the caller's job group and pool. After a failure no further job is begun, and the first error is raised.
    """
    waiting: SimpleQueue[Callable[[], None]] = SimpleQueue()
    for job in jobs:
        waiting.put(job)
    errors: list[BaseException] = []

    def work() -> None:
        while not errors:
            try:
                job = waiting.get_nowait()
            except Empty:
                return
            try:
                job()
            except BaseException as error:
                errors.append(error)

    threads = [InheritableThread(target=work) for _ in range(min(at_once, waiting.qsize()))]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    if errors:
        raise errors[0]


def _write_all(
    spark: SparkSession, frames: Mapping[str, DataFrame], files: int | None = None, writes: int = WRITES
) -> None:
    """Write independent tables, ``writes`` at a time.

    The tables replace the old ones together, once all are written. After a failure the old ones stay.
    """
    replacement = Replacement(spark)
    try:
        _side_by_side([partial(replacement.write, df, path, files) for path, df in frames.items()], writes)
        replacement.publish()
    finally:
        replacement.discard()


def ingest_bronze(spark: SparkSession, base_dir: str, raw_paths: Mapping[str, str] | None = None) -> None:
    """Land the raw CSVs as text parquet. Paths not given are the layout's own."""
    given = raw_paths or {}
    raw = {name: read_raw_csv(spark, given.get(name) or table_path(base_dir, f"raw_{name}")) for name in RAW_TABLES}
    _write_all(spark, {table_path(base_dir, f"bronze_{name}"): df for name, df in raw.items()})


def typed_bronze(spark: SparkSession, base_dir: str) -> dict[str, DataFrame]:
    return {name: TYPING[name](read_table(spark, base_dir, f"bronze_{name}")) for name in RAW_TABLES}


@dataclass(frozen=True)
class Silver:
    """What building silver has measured: the prices' keys, and per table and typed column the unreadable texts."""

    profile: Profile
    losses: dict[str, dict[str, int]]


def build_silver(spark: SparkSession, base_dir: str, silver_table: str | None = None) -> Silver:
    """Check the keys of the three inputs, join them and write silver.

    The keys are profiled in one job, and texts that become NULL are counted while silver is written.
    With ``silver_table`` silver is also registered under that name, at any size. It
    is in buckets by SYMBOL, unless one series is so long that its bucket would
    be too large for a task; the name is then that of a plain table, and each
    derived table shuffles it in parts. Once registered, silver should be
    rebuilt under the same name.
    """
    typed = typed_bronze(spark, base_dir)
    observed = {name: Observation(f"{name}_losses") for name in RAW_TABLES}
    with freeing_shuffles(spark):
        profiles = profile_tables(typed)
        for name, profile in profiles.items():
            require_unique_key(profile, name, typed[name])
        counted = {n: typed_with_losses(read_table(spark, base_dir, f"bronze_{n}"), n, o) for n, o in observed.items()}
        silver = with_comments(enrich(**counted))
        path, profile = table_path(base_dir, "silver"), profiles["prices"]
        if silver_table:
            write_by_symbol(silver, path, silver_table, bucket_count(spark, profile))
        else:
            write_table(silver, path)
    return Silver(profile, {name: dict(observation.get) for name, observation in observed.items()})


def bucket_count(spark: SparkSession, profile: Profile) -> int | None:
    """Buckets for bars of this profile, within Spark's own limit; None if a series is too long for one."""
    if profile.longest_series > MAX_ROWS:
        return None
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-profile.rows // ROWS_PER_BUCKET)))


def shares_of(silver: DataFrame, bars: int) -> list[tuple[DataFrame, int]]:
    """The bars in shares of whole series, each with its number of bars; all in one share if there are few.

    A share is large enough for two tasks per core. All rows without a symbol belong to one share.
    """
    cores = silver.sparkSession.sparkContext.defaultParallelism
    shares = min(MOST_SHARES, -(-bars // max(SHARE_ROWS, 2 * cores * TASK_ROWS)))
    if shares < 2:
        return [(silver, bars)]
    share = F.expr(f"pmod(xxhash64(SYMBOL), {shares})")
    sizes = silver.groupBy(share.alias("share")).count().collect()
    return [(silver.filter(share == number), rows) for number, rows in sorted(sizes)]


def build_gold(
    silver: DataFrame,
    base_dir: str,
    longest: int | None = None,
    benchmark: str = BENCHMARK,
    files: int | None = None,
    bucketed: bool = False,
) -> None:
    """Write the seven derived tables from one frame of all their columns.

    The frame is as large as the tables together, so many bars are dealt into shares by symbol. The frame of a share is
    derived and stored once, in a scratch folder; each table then gets a choice of its columns and rows, and breadth
    their counts by day, before the frame is removed. So every bar is shuffled once for all tables, and the benchmark is read once.
    ``silver`` should be stored: it is read once for each share. ``files`` is about the number of files of a
    table, of which each share writes one at least.
    A ``bucketed`` silver is not shuffled; a task then gets a bucket.
    """
    spark = silver.sparkSession
    scratch, replacement = scratch_dir(spark), Replacement(spark)
    try:
        with freeing_shuffles(spark):
            longest = longest_series(silver) if longest is None else longest
            shares = shares_of(silver, silver.count())
            index = None
            if len(shares) > 1:
                tables.index_frame(silver, benchmark, longest).write.parquet(f"{scratch}/benchmark")
                index = spark.read.parquet(f"{scratch}/benchmark")
            each = files and -(-files // len(shares))
            for number, (share, rows) in enumerate(shares):
                path = f"{scratch}/market_frame_{number}"
                bars = None if bucketed else rows
                written = tables.market_frame(share, benchmark, longest, index, bars=bars).select(*tables.FRAME).write
                # Read once and then removed: hardly a value repeats, so dictionaries would only cost time.
                with tables.wide_rows(spark):
                    written.options(**{"parquet.enable.dictionary": "false", "compression": "lz4_raw"}).parquet(path)
                _add_share(replacement, spark.read.parquet(path), base_dir, f"{scratch}/daily_counts", each)
                remove(spark, path)
            daily = breadth.breadth_of_counts(spark.read.parquet(f"{scratch}/daily_counts"))
            replacement.write(with_comments(daily), table_path(base_dir, "market_breadth"), files)
        replacement.publish()
    finally:
        replacement.discard()
        remove(spark, scratch)


def _add_share(replacement: Replacement, frame: DataFrame, base_dir: str, counts_path: str, files: int | None) -> None:
    """Add the rows of one share's frame to the new tables, and its counts by day to those of breadth."""
    counts = breadth.daily_counts(tables.breadth_bars(frame)).write.mode("append")
    jobs = [partial(counts.parquet, counts_path)]
    for name in GOLD_TABLES:
        if name != "market_breadth":
            table = with_comments(tables.table_of(frame, name))
            jobs.append(partial(replacement.write, table, table_path(base_dir, name), files))
    _side_by_side(jobs, len(jobs))


def build_table(
    spark: SparkSession, base_dir: str, name: str, longest: int | None = None, benchmark: str = BENCHMARK
) -> None:
    """Write one derived table, by its name in ``GOLD_TABLES``, from the stored silver."""
    silver = read_table(spark, base_dir, "silver")
    given = {"benchmark": benchmark} if name in ("relative_strength", "market_breadth") else {}
    write_table(with_comments(getattr(tables, name)(silver, longest=longest, **given)), table_path(base_dir, name))


def run_all(
    spark: SparkSession,
    base_dir: str,
    raw_paths: Mapping[str, str] | None = None,
    benchmark: str = BENCHMARK,
    silver_table: str | None = None,
    files: int | None = None,
) -> Silver:
    """Raw CSVs to all tables below ``base_dir``. Returns what was measured on the way, as ``build_silver`` does.

    ``silver_table`` names a catalog table for a bucketed silver; every gold table
    is then computed without shuffling the bars again (see ``build_silver``).
    """
    ingest_bronze(spark, base_dir, raw_paths)
    built = build_silver(spark, base_dir, silver_table)
    silver = spark.table(silver_table) if silver_table else read_table(spark, base_dir, "silver")
    bucketed = silver_table is not None and bucket_count(spark, built.profile) is not None
    build_gold(silver, base_dir, built.profile.longest_series, benchmark, files, bucketed)
    return built
