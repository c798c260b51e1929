"""Line dedup: exact tables of references to lines, behind sharded cuckoo filters.

A line's key is the line without white space at its ends and with A-Z in lower
case; keys of ``MIN_CHARS`` code points and more count. The reference table has
one row per key and document, with the number of rows that hold it. Inserting
adds to these numbers and deleting takes away, so that a deleted document leaves
no trace. Keys in at least ``MIN_DOCS`` documents are hot; rows of one doc_id are one
document, and rows without a doc_id lose hot lines but make none hot. Each shard of the hot
keys has a cuckoo filter, which tells nearly all other lines apart without a join
and can forget a key that is hot no longer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm.common import Scratch, map_batches, map_rows, table

MIN_CHARS, MIN_DOCS = 40, 5
WHITE = b" \t\n\v\f\r"
#: Hot keys of one shard, on average.
SHARD_KEYS = 50_000
#: Filters beyond so many bytes are not sent to the executors; lines of their shards all go to the join.
FILTER_BYTES = 32 << 20
#: Keys in enough rows are sent to the executors up to this number of them.
BROADCAST_KEYS = 500_000

KEY = ["k1", "k2"]
MASK = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_key(line: bytes) -> tuple[int, int] | None:
    """128-bit hash of the line's key, or None if that is too short."""
    key = line.strip(WHITE).lower()
    if len(key) < MIN_CHARS or len(key.decode()) < MIN_CHARS:
        return None
    h = xxhash.xxh3_128_intdigest(key)
    return signed(h >> 64), signed(h & MASK)


class CuckooFilter:
    """Sixteen-bit fingerprints, four to a bucket, each in one of two buckets.

    ``add`` is False when no place is found; the filter must then be made anew
    with more buckets. ``remove`` is for keys that were added.
    """

    SLOTS, KICKS = 4, 500

    def __init__(self, keys: int = 0, cells: np.ndarray | None = None):
        buckets = 1 << max(4, int(np.ceil(np.log2(max(1, keys) / self.SLOTS / 0.85))))
        self.cells = np.zeros((buckets, self.SLOTS), np.uint16) if cells is None else cells

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        size = len(keys)
        while True:
            made = cls(size)
            if all(made.add(int(k)) for k in keys):
                return made
            size *= 2

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(cells=np.frombuffer(data, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.cells.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and both buckets of signed 64-bit keys."""
        h = keys.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mark = (h >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (h >> np.uint64(8)) & np.uint64(len(self.cells) - 1)
        return mark, first.astype(np.int64), self.other(first, mark)

    def other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        turned = mark.astype(np.uint64) * np.uint64(0x5BD1E995)
        return ((bucket.astype(np.uint64) ^ turned) & np.uint64(len(self.cells) - 1)).astype(np.int64)

    def add(self, key: int) -> bool:
        mark, one, two = self.places(np.array([key]))
        for bucket in (one[0], two[0]):
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = mark[0]
                return True
        bucket = one[0]
        for kick in range(self.KICKS):
            slot = kick % self.SLOTS
            mark[0], self.cells[bucket, slot] = self.cells[bucket, slot], mark[0]
            bucket = self.other(np.array([bucket]), mark)[0]
            free = np.flatnonzero(self.cells[bucket] == 0)
            if len(free):
                self.cells[bucket, free[0]] = mark[0]
                return True
        return False

    def remove(self, key: int) -> None:
        mark, one, two = self.places(np.array([key]))
        for bucket in (one[0], two[0]):
            held = np.flatnonzero(self.cells[bucket] == mark[0])
            if len(held):
                self.cells[bucket, held[0]] = 0
                return

    def holds(self, keys: np.ndarray) -> np.ndarray:
        mark, one, two = self.places(keys)
        return ((self.cells[one] == mark[:, None]) | (self.cells[two] == mark[:, None])).any(axis=1)


def own_text() -> Column:
    """A hash of the text where there is no doc_id, and 0 elsewhere: such rows are told apart by their texts."""
    return F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).cast("long")


def references(docs: DataFrame) -> DataFrame:
    """(k1, k2, doc_id, own, n): one row with n = 1 for each row of ``docs`` and key in its text."""

    def rows(batches):
        for ids, owns, texts in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for doc_id, own, text in zip(ids, owns, texts, strict=True):
                for key in {line_key(x) for x in (text or "").encode().split(b"\n")} - {None}:
                    for column, value in zip(out, (*key, doc_id, own), strict=True):
                        column.append(value)
            yield [*out, [1] * len(out[0])]

    told = docs.select("doc_id", own_text().alias("own"), "text")
    return map_batches(told, ["doc_id", "own", "text"], rows, "k1 long, k2 long, doc_id long, own long, n long")


def hot_keys(refs: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Keys in ``MIN_DOCS`` documents and more, with the largest doc_id that holds them.

    Sums and maxima combine before the shuffle, so a line that all documents
    share is one row per map task. Only keys in ``MIN_DOCS`` rows and more have their
    documents told apart, each by its own key and doc_id.
    """
    of_docs = refs.filter(F.col("doc_id").isNotNull())
    often = of_docs.groupBy(*KEY).agg(F.sum("n").alias("n_rows")).filter(F.col("n_rows") >= MIN_DOCS)
    often = scratch.store(often.select(*KEY), name)
    if often.count() <= BROADCAST_KEYS:
        often = F.broadcast(often)
    each = of_docs.select(*KEY, "doc_id").join(often, KEY, "left_semi").distinct()
    totals = each.groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
    return totals.filter(F.col("n_docs") >= MIN_DOCS)


def shard_of(shards: int):
    return F.pmod(F.col("k2"), F.lit(shards)).cast("int")


FILTERS = "shard int, cells binary"


def build_filters(hot: DataFrame, shards: int) -> DataFrame:
    """One filter per shard over its hot keys."""

    def build(keys: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.of(keys["k1"].to_numpy())
        return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "cells": [made.dump()]})

    return hot.select("k1", shard_of(shards).alias("shard")).groupBy("shard").applyInPandas(build, FILTERS)


def change_filters(filters: DataFrame, hot: DataFrame, old_hot: DataFrame, shards: int) -> DataFrame:
    """Filters with newly hot keys added and keys no longer hot removed.

    Only the changed keys are looked at. Shards whose filter is full, or had
    none, are made of all their hot keys.
    """
    added = hot.join(old_hot, KEY, "left_anti").select("k1", "k2", F.lit(1).alias("change"))
    gone = old_hot.join(hot, KEY, "left_anti").select("k1", "k2", F.lit(-1).alias("change"))
    changes = added.union(gone).withColumn("shard", shard_of(shards))

    def change(old: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        shard = int((old if len(old) else rows)["shard"].iloc[0])
        if not len(old):
            return pd.DataFrame({"shard": [shard], "cells": [None]})
        made = CuckooFilter.load(old["cells"].iloc[0])
        for key in rows.loc[rows["change"] < 0, "k1"]:
            made.remove(int(key))
        fits = all(made.add(int(key)) for key in rows.loc[rows["change"] > 0, "k1"])
        return pd.DataFrame({"shard": [shard], "cells": [made.dump() if fits else None]})

    changed = filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, FILTERS)
    full = changed.filter(F.col("cells").isNull()).select("shard")
    anew = build_filters(hot.withColumn("shard", shard_of(shards)).join(full, "shard", "left_semi"), shards)
    return changed.filter(F.col("cells").isNotNull()).union(anew)


@dataclass(frozen=True)
class LineIndex:
    """References, hot keys and filters, all stored tables of ``scratch``.

    An index is never changed in place: ``insert`` and ``delete`` return the next one.
    """

    refs: DataFrame
    hot: DataFrame
    filters: DataFrame
    shards: int
    scratch: Scratch
    version: int = 0

    @classmethod
    def create(cls, docs: DataFrame) -> LineIndex:
        scratch = Scratch(docs.sparkSession)
        refs = scratch.store(references(docs), "refs0")
        hot = scratch.store(hot_keys(refs, scratch, "often0"), "hot0")
        shards = max(1, -(-hot.count() // SHARD_KEYS))
        return cls(refs, hot, scratch.store(build_filters(hot, shards), "filters0"), shards, scratch)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._with(references(docs))

    def delete(self, docs: DataFrame) -> LineIndex:
        """``docs``: rows inserted before, with the texts they had."""
        return self._with(references(docs).withColumn("n", -F.col("n")))

    def _with(self, changes: DataFrame) -> LineIndex:
        version, store = self.version + 1, self.scratch.store
        merged = self.refs.union(changes).groupBy(*KEY, "doc_id", "own").agg(F.sum("n").alias("n"))
        refs = store(merged.filter(F.col("n") > 0), f"refs{version}")
        hot = store(hot_keys(refs, self.scratch, f"often{version}"), f"hot{version}")
        filters = store(change_filters(self.filters, hot, self.hot, self.shards), f"filters{version}")
        return replace(self, refs=refs, hot=hot, filters=filters, version=version)

    def loaded(self) -> dict[int, bytes]:
        """Filters by shard, in order and up to ``FILTER_BYTES`` in all."""
        sized = self.filters.select("shard", F.length("cells").alias("size"))
        taken, total = [], 0
        for row in sized.orderBy("shard").limit(FILTER_BYTES >> 7).collect():
            total += row["size"]
            if total > FILTER_BYTES:
                break
            taken.append(row["shard"])
        return {r["shard"]: r["cells"] for r in self.filters.filter(F.col("shard").isin(taken)).collect()}

    def drops(self) -> DataFrame:
        """(doc_id, own, keys): the keys that each document loses; documents without any have no row.

        The filters pass all hot keys and few others. The join that follows is
        exact; adaptive execution splits the rows of a very common key.
        """
        filters, shards = self.refs.sparkSession.sparkContext.broadcast(self.loaded()), self.shards

        def probe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            loaded = {shard: CuckooFilter.load(cells) for shard, cells in filters.value.items()}
            for frame in frames:
                maybe, shard = np.ones(len(frame), bool), np.mod(frame["k2"].to_numpy(), shards)
                for number, held in loaded.items():
                    at = np.flatnonzero(shard == number)
                    maybe[at] = held.holds(frame["k1"].to_numpy()[at])
                yield frame[maybe]

        numbered = self.refs.select(*KEY, "own", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"))
        passed = numbered.mapInPandas(probe, numbered.schema)
        doc_id = F.when(F.col("none"), None).otherwise(F.col("id"))
        lost = passed.join(self.hot, KEY).withColumn("doc_id", doc_id).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        return lost.groupBy("doc_id", "own").agg(F.collect_set(F.struct(*KEY)).alias("keys"))


def without_lines(text: str | None, keys: list) -> tuple[str, int, int]:
    """The text without lines of these keys, its number of lines, and how many went."""
    if not keys:
        return text or "", (text or "").count("\n") + 1, 0
    lost, lines = {(k["k1"], k["k2"]) for k in keys}, (text or "").encode().split(b"\n")
    kept = [x for x in lines if line_key(x) not in lost]
    return b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, index: LineIndex, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs``, then ``kept_text``, ``n_lines`` (before) and ``n_dropped``.

    Hot keys lose all their lines except in the largest doc_id that holds them. A
    null text is an empty line. Documents have one row of ``drops`` at most, so
    rows neither go nor multiply.
    """
    drops = index.drops()
    drops = drops.select(F.col("doc_id").alias("__from"), F.col("own").alias("__from_own"), F.col("keys").alias("__keys"))
    same = F.col("doc_id").eqNullSafe(F.col("__from")) & (F.col("__own") == F.col("__from_own"))
    marked = docs.withColumn("__own", own_text()).join(drops, same, "left")

    def rows(texts, lists):
        return (without_lines(text, keys) for text, keys in zip(texts, lists, strict=True))

    return map_rows(marked, keep, ["text", "__keys"], rows, "kept_text string, n_lines long, n_dropped long")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = dedup_lines(docs, LineIndex.create(docs), ["doc_id"])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP4_SQL = """
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
hot AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.keeper AS dropped
  FROM keyed k LEFT JOIN hot h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
