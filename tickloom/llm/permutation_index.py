"""Nearest neighbours by a permutation index.

Pivots are a sample of the vectors. A vector is represented by its nearest
pivots in order, and posted under each of them with its place in that order.
A query reads the postings of its own pivots, ranks vectors by Spearman's
footrule between the two orders, and reranks the first of them by inner product.
The last of the nearest among these then bounds the others: each vector long
enough to reach that score is compared as well, so nothing that is nearer is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.common import Scratch, table

#: Vectors that serve as pivots at most, how many of them represent a vector, and how many of those a query reads.
PIVOTS, LENGTH, READ = 128, 96, 32
NEAREST = 20
#: Vectors of one shard of the index, on average, and queries of one block.
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
#: Share of a shard's distinct vectors that is reranked first, and the least number of them.
RERANKED, LEAST_RERANKED = 0.25, 400
#: Rounding of a product of two vectors, as a share of the product of their lengths, is far below this.
SLACK = 1e-9
EVERY = 20


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that take part: no nulls, finite and not zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("embedding", lambda x: x != 0)
    return vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & nonzero).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )


def common_size(vectors: DataFrame) -> int | None:
    """The number of components that most vectors have (ties: the larger one); None without vectors."""
    sizes = vectors.groupBy(F.size("embedding").alias("components")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("components")).first()
    return most["components"] if most else None


def of_size(vectors: DataFrame, components: int) -> DataFrame:
    """One row per vec_id: its vector of ``components`` numbers, the smallest as an array if there are several."""
    fitting = vectors.filter(F.size("embedding") == components)
    return fitting.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def choose_pivots(vectors: DataFrame) -> np.ndarray:
    """Up to ``PIVOTS`` distinct vectors, scaled to length 1, the same ones at every run.

    They are drawn from the first ``4 * PIVOTS`` in a hashed order; tasks keep no
    more rows each, so that is all that comes together.
    """
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * PIVOTS).select("embedding").collect()
    distinct = list(dict.fromkeys(tuple(r["embedding"]) for r in drawn))[:PIVOTS]
    found = np.array(distinct, np.float64)
    return found / np.linalg.norm(found, axis=1, keepdims=True) if len(found) else found


def orders(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` with ``pivots``: the numbers of the nearest ``LENGTH`` pivots, nearest first."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                near = np.stack(frame["embedding"].to_numpy()) @ shared.value.T
                order = np.argsort(-near, axis=1, kind="stable")[:, :LENGTH].astype(np.int32)
                yield frame.assign(pivots=list(order))

    return vectors.mapInPandas(run, "vec_id long, embedding array<double>, pivots array<int>")


def search_shard(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """The nearest of one shard for each query of a block: query_id, vec_id, score.

    Equal vectors are ranked once and stand for all their ids, so copies, be they most
    of the shard, take no place from others.
    """
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
    if not len(rows) or not len(queries):
        return empty
    rows = rows.sort_values("vec_id", kind="stable")
    ids, vectors = rows["vec_id"].to_numpy(np.int64), np.stack(rows["embedding"].to_numpy())
    _, first, own = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    # The longest come first, so those that can reach a score are a slice.
    length = np.linalg.norm(vectors[first], axis=1)
    longest = np.argsort(-length, kind="stable")
    first, length, own = first[longest], length[longest], np.argsort(longest)[own.reshape(-1)]
    members = ids[np.argsort(own, kind="stable")]
    edge = np.concatenate([[0], np.cumsum(np.bincount(own))])
    distinct, order = vectors[first], np.stack(rows["pivots"].to_numpy())[first]
    count, width = order.shape
    # Postings: for each pivot, the vectors near it and its place in their orders.
    flat = np.argsort(order.ravel(), kind="stable")
    bounds = np.searchsorted(order.ravel()[flat], np.arange(PIVOTS + 1))
    posted, placed = flat // width, flat % width
    few = min(count, max(LEAST_RERANKED, int(np.ceil(RERANKED * count))))
    out: tuple[list, list, list] = ([], [], [])
    sizes = np.diff(edge)
    for query_id, vector, pivots in zip(queries["vec_id"], queries["embedding"], queries["pivots"], strict=True):
        # Footrule over the query's pivots; one that a vector lacks counts as right behind its order.
        gap = np.zeros(count)
        for place, pivot in enumerate(pivots[:READ]):
            low, high = bounds[pivot], bounds[pivot + 1]
            gap[posted[low:high]] += np.abs(placed[low:high] - place) - (width - place)
        near = np.argpartition(gap, few - 1)[:few] if few < count else np.arange(count)
        if few < count:  # vectors that tie with the last are all reranked
            near = np.flatnonzero(gap <= gap[near].max())
        vector = np.asarray(vector)
        score = (distinct[near] * vector).sum(axis=1)
        if few < count:
            # Not above |v| |q|, so beyond the slice none reaches the last of the nearest; in it the product tells.
            least = np.partition(score, -(NEAREST + 1))[-(NEAREST + 1)]
            reach = length * np.linalg.norm(vector) * (1 + SLACK)
            able = np.searchsorted(-reach, -least, side="right")
            near = np.flatnonzero(distinct[:able] @ vector >= least - SLACK * reach[:able])
            score = (distinct[near] * vector).sum(axis=1)
        if len(score) > NEAREST + 1:
            least = np.partition(score, -(NEAREST + 1))[-(NEAREST + 1)]
            near, score = near[score >= least], score[score >= least]
        got: list[tuple[float, int]] = []
        for s, n in zip(score.tolist(), near.tolist(), strict=True):
            for vec_id in members[edge[n] : edge[n] + min(sizes[n], NEAREST + 1)].tolist():
                if vec_id != query_id:
                    got.append((-s, vec_id))
        for s, vec_id in sorted(got)[:NEAREST]:
            out[0].append(query_id)
            out[1].append(vec_id)
            out[2].append(-s)
    return pd.DataFrame({"query_id": out[0], "vec_id": out[1], "score": out[2]}) if out[0] else empty


def search(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, rank, vec_id and score of the ``NEAREST`` found for each query, its own id left out.

    Rows that are not ``usable`` take no part on either side. Each block of
    queries meets each shard of the index once, and only the nearest of a
    shard leave it. Repeated rows of one id count as one candidate and one query;
    of different vectors under one id the smallest as an array counts. Vectors with
    another number of components than most vectors have are left out on both sides.
    """
    scratch = Scratch(vectors.sparkSession)
    components = common_size(usable(vectors))
    if components is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    candidates = of_size(usable(vectors), components)
    pivots = choose_pivots(candidates)
    index = scratch.store(orders(candidates, pivots), "index")
    asked = scratch.store(orders(of_size(usable(queries), components), pivots), "queries")
    n_shards = max(1, -(-index.count() // SHARD_ROWS))
    n_blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    part = F.pmod(F.xxhash64("vec_id"), F.lit(n_shards)).cast("int")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))
    rows = index.withColumn("shard", part).withColumn("block", every_block)
    sent = asked.withColumn("block", block).withColumn("shard", every_shard)
    key = ["shard", "block"]
    found = (
        rows.groupBy(*key)
        .cogroup(sent.groupBy(*key))
        .applyInPandas(search_shard, "query_id long, vec_id long, score double")
    )
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= NEAREST)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % EVERY == 0))
