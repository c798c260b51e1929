"""Hard negatives by cover trees over norm-augmented candidates.

Candidates are dealt into shards of about ``SHARD_ROWS`` rows, in order of their label. Each
shard holds a cover tree. To a vector v goes the coordinate sqrt(M^2 - |v|^2), M being the
greatest length of the shard, so that all lie on one sphere and a large inner product with an
anchor is a small angle to it. A node is a centre, the rows it covers and its covering radius,
the largest angle from the centre to one of them. By the triangle inequality that bounds the
inner products of all its rows from both sides.

An anchor descends level by level and leaves out nodes whose bounds lie outside all of its
windows. The leaves that remain are opened best first, by their upper bound, until no further
one can reach the scores found; their rows are compared exactly. So the result is that of a
comparison with every row.

An anchor meets each shard once, and a shard's tree is built once and read by the anchors as they
stream past it. A hot label or a vector that many rows share is dealt over shards like any other.

Rows with a null label or vector, or a null or non-finite component, take no part. Of vectors of
different lengths the shorter one counts as followed by zeros. Rows that repeat a vec_id are
rows of their own, also as anchors; equal scores of equal vec_ids are in the order of the
shards. A row without a vec_id is no anchor; as a candidate it comes after all others of its
score. An integer vector whose squared length is 2^53 or more raises, as its scores would not be exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from tickloom.llm.common import Scratch, table

#: Anchors are the vec_ids divisible by this.
EVERY = 100
#: Labels that change: those of vec_ids divisible by the first number, to the next modulo the second.
CHANGED, LABELS = 7, 10
#: Components are multiplied by this and cut down to integers.
UNIT = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least and at most these percentages of the positive's.
LEAST, MOST = 30, 90
#: Candidates of a shard on average, rows of a leaf at most unless they are equal, and children of a node at most.
SHARD_ROWS, LEAF_ROWS, CHILDREN = 2048, 32, 16
#: Leaves that are opened together at first; then twice as many each time.
TOGETHER = 8
#: Rounding of angles and products, as a share of the product of the lengths, is far below this.
SLACK = 1e-6

STREAM = ["shard", "kind", "row", "vec_id", "label", "v", "lows", "highs"]


def members(vectors: DataFrame) -> DataFrame:
    """vec_id, label and integer vector v of the rows that take part."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    vec_id, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    return rows.select(
        vec_id.alias("vec_id"),
        F.when(vec_id % CHANGED == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * UNIT)).alias("v"),
    )


def sharded(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows with ``shard`` and ``row``, a number of their own, in order of label.

    Within a label the order is that of a hash, so a hot label goes on over many shards.
    """
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    dealt = rows.withColumn("tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(shards, "label", F.xxhash64("vec_id", "v"), "tie").drop("tie")
    numbered = dealt.select(F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("row"), "*")
    return scratch.store(numbered, "candidates")


def matrix(lists: pa.ListArray, width: int | None = None) -> np.ndarray:
    """The lists as rows of doubles, filled up with zeros, or cut, to one width."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    most = int(sizes.max(initial=0)) if width is None else width
    if (sizes == most).all():
        return flat.reshape(len(sizes), most)
    out = np.zeros((len(sizes), max(most, int(sizes.max(initial=0)))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out[:, :most]


class CoverTree:
    """Cover tree of one shard.

    ``levels`` hold nodes as arrays: centre (a row), first and last place of its rows in
    ``order``, covering angle, parent's place in the level above, and whether it is a leaf. The centre of a
    node is that of its first child too; siblings are farther apart than the radius of their level, which halves from
    level to level. A node that would need more than ``CHILDREN`` of them takes the farthest ones
    and is covered more finely below.
    """

    def __init__(self, rows: np.ndarray, vec_ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.rows, self.vec_ids, self.labels, self.vectors = rows, vec_ids, labels, vectors
        squares = np.einsum("ij,ij->i", vectors, vectors)
        if squares.max(initial=0) >= 2**53:
            raise ValueError("an integer vector has a squared length of 2^53 or more")
        self.longest = float(np.sqrt(squares.max(initial=0)))
        raised = np.concatenate([vectors, np.sqrt(squares.max(initial=0) - squares)[:, None]], axis=1)
        self.raised = raised / self.longest if self.longest else raised
        self.order = np.arange(len(rows))
        self.levels: list[dict[str, np.ndarray]] = []
        self._build()

    def _distance(self, rows: np.ndarray, centre: int) -> np.ndarray:
        gap = self.raised[rows] - self.raised[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def _split(self, rows: np.ndarray, centre: int, spacing: float) -> list[tuple[int, np.ndarray, float]]:
        """Centres farther than ``spacing`` apart, each with the rows it is nearest to and its covering distance."""
        centres, nearest = [centre], self._distance(rows, centre)
        owner = np.zeros(len(rows), np.int64)
        while len(centres) < CHILDREN and nearest.max() > spacing:
            centres.append(int(rows[nearest.argmax()]))
            gap = self._distance(rows, centres[-1])
            closer = gap < nearest
            owner[closer], nearest = len(centres) - 1, np.minimum(gap, nearest)
        parts = [owner == i for i in range(len(centres))]
        return [(c, rows[p], float(nearest[p].max())) for c, p in zip(centres, parts, strict=True) if p.any()]

    def _build(self) -> None:
        if not len(self.rows):
            return
        radius = float(self._distance(self.order, 0).max())
        level, at = [(0, 0, len(self.order), radius, 0)], 0.0
        spacing = radius
        while level:
            leaf = [end - start <= LEAF_ROWS or wide == 0 for _, start, end, wide, _ in level]
            centre, start, end, wide, parent = (np.array(x) for x in zip(*level, strict=True))
            angle = 2 * np.arcsin(np.minimum(1.0, wide / 2)) + SLACK
            self.levels.append(
                {"centre": centre, "start": start, "end": end, "angle": angle, "parent": parent, "leaf": np.array(leaf)}
            )
            spacing, below = spacing / 2, []
            for i, (c, first, last, wide, _) in enumerate(level):
                if leaf[i]:
                    continue
                at = first
                for child, rows, reach in self._split(self.order[first:last], c, min(spacing, wide / 2)):
                    self.order[at : at + len(rows)] = rows
                    below.append((child, at, at + len(rows), reach, i))
                    at += len(rows)
            level = below

    def leaves(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """For each anchor the first places, last places and upper bounds of the leaves whose
        bounds meet (low, high), the largest upper bound first."""
        length = np.sqrt(np.einsum("ij,ij->i", anchors, anchors))
        scale = length * self.longest
        unit = np.divide(anchors, length[:, None], out=np.zeros_like(anchors), where=length[:, None] > 0)
        found: list[tuple[np.ndarray, ...]] = []
        above = np.ones((len(anchors), 1), bool)
        for level in self.levels:
            cosine = unit @ self.raised[level["centre"], :-1].T
            angle = np.arccos(np.clip(cosine, -1, 1))
            least = scale[:, None] * np.cos(np.minimum(np.pi, angle + level["angle"])) - SLACK * scale[:, None] - 0.5
            most = scale[:, None] * np.cos(np.maximum(0.0, angle - level["angle"])) + SLACK * scale[:, None] + 0.5
            alive = above[:, level["parent"]] & (most >= low[:, None]) & (least <= high[:, None])
            leaf = level["leaf"]
            found.append((alive[:, leaf], most[:, leaf], level["start"][leaf], level["end"][leaf]))
            above = alive
        if not found:
            alive, most = np.zeros((len(anchors), 0), bool), np.zeros((len(anchors), 0))
            start = end = np.zeros(0, np.int64)
        else:
            alive, most, start, end = (np.concatenate([f[i] for f in found], axis=-1) for i in range(4))
        for kept, bound in zip(alive, most, strict=True):
            some = np.flatnonzero(kept)
            some = some[np.argsort(-bound[some], kind="stable")]
            yield start[some], end[some], bound[some]

    def nearest(
        self, anchor: np.ndarray, own: int, label: int, same: bool, windows: np.ndarray, leaves: tuple[np.ndarray, ...], count: int
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (low, high) the best ``count`` rows within it, as places and scores, best first.

        With ``same`` the rows are the others of ``label``, else those of another label.
        """
        start, end, bound = leaves
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0))] * len(windows)
        # A window is done with once no leaf can beat its last row, or reach it at all.
        needed = windows[:, 0].copy()
        at, step = 0, TOGETHER
        while at < len(bound) and bound[at] >= needed.min(initial=np.inf):
            ends = range(at, min(at + step, len(bound)))
            places = np.concatenate([self.order[start[i] : end[i]] for i in ends])
            fits = (self.labels[places] == label) == same
            if same:
                fits &= self.rows[places] != own
            places = places[fits]
            scores = self.vectors[places] @ anchor
            for w, (low, high) in enumerate(windows):
                inside = (scores >= max(low, needed[w])) & (scores <= high)
                if not inside.any():
                    continue
                held = np.concatenate([best[w][0], places[inside]])
                score = np.concatenate([best[w][1], scores[inside]])
                first = np.lexsort((self.rows[held], self.vec_ids[held], -score))[:count]
                best[w] = held[first], score[first]
                if len(first) == count:
                    needed[w] = score[first[-1]]
            at, step = at + step, 2 * step
        return best


def search(candidates: DataFrame, asked: DataFrame, count: int) -> DataFrame:
    """The best ``count`` rows of each shard for what is asked of it: row, window, vec_id, found, score.

    ``asked`` has shard, row, label and v of an anchor and its windows as lists of lows and highs.
    Without windows the others of the anchor's label are searched, with windows the rows of other
    labels. A task gets the candidates of a shard first, and then its anchors, which it need not hold.
    """
    none = F.lit(None).cast("array<long>")
    own = candidates.select("shard", F.lit(0).alias("kind"), "row", "vec_id", "label", "v", none.alias("lows"), none.alias("highs"))
    rows = own.unionByName(asked.select("shard", F.lit(1).alias("kind"), "row", F.lit(None).cast("long").alias("vec_id"), *STREAM[4:]))
    shards = (candidates.agg(F.max("shard")).first()[0] or 0) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, tree = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("shard", "kind")]).astype(np.int64)
            cuts = np.flatnonzero((np.diff(key, axis=1) != 0).any(axis=0)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if start == end:
                    continue
                if key[0, start] != shard:
                    shard, parts, tree = key[0, start], [], None
                piece = batch.slice(start, end - start)
                if key[1, start] == 0:
                    parts.append(piece)
                else:
                    tree = tree or plant(parts)
                    parts = []
                    yield answers(tree, piece, count)

    dealt = rows.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(run, "row long, window int, vec_id long, found long, score long")


def plant(parts: list[pa.RecordBatch]) -> CoverTree:
    rows = pa.Table.from_batches(parts).combine_chunks() if parts else None
    if rows is None:
        return CoverTree(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0)))
    first = rows.to_batches()[0]
    # A row without a vec_id comes last; ``answers`` gives no id for this one.
    ids = first.column("vec_id").fill_null(NO_ID).to_numpy()
    return CoverTree(first.column("row").to_numpy(), ids, first.column("label").to_numpy(), matrix(first.column("v")))


NO_ID = 2**63 - 1


def answers(tree: CoverTree, asked: pa.RecordBatch, count: int) -> pa.RecordBatch:
    anchors = matrix(asked.column("v"), tree.vectors.shape[1])
    own, labels = asked.column("row").to_numpy(), asked.column("label").to_numpy()
    lows, highs = asked.column("lows").to_pylist(), asked.column("highs").to_pylist()
    same = [x is None for x in lows]
    windows = [np.array([[-np.inf, np.inf]] if s else [*zip(a, b, strict=True)], np.float64) for s, a, b in zip(same, lows, highs, strict=True)]
    low, high = np.array([w[:, 0].min() for w in windows]), np.array([w[:, 1].max() for w in windows])
    out: list[list[np.ndarray]] = [[], [], [], []]
    for i, leaves in enumerate(tree.leaves(anchors, low, high)):
        for w, (places, scores) in enumerate(tree.nearest(anchors[i], own[i], labels[i], same[i], windows[i], leaves, count)):
            for column, values in zip(out, (np.full(len(places), own[i]), np.full(len(places), w), places, scores), strict=True):
                column.append(values)
    row, window, place, score = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in out)
    ids = tree.vec_ids[place]
    return pa.RecordBatch.from_arrays(
        [pa.array(row), pa.array(window.astype(np.int32)), pa.array(ids, mask=ids == NO_ID), pa.array(tree.rows[place]), pa.array(score)],
        ["row", "window", "vec_id", "found", "score"],
    )


def first_of(found: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The best ``count`` over all shards, with ``rank`` from 1. Each task passes no more on to the next than that."""
    best = W.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "found")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= count)


def positives(candidates: DataFrame, anchors: DataFrame) -> DataFrame:
    """row, window (from 0), positive_id and positive_score: the first others of each anchor's label."""
    none = F.lit(None).cast("array<long>")
    places = candidates.select("label", "shard").distinct()
    asked = anchors.join(places, "label").select("shard", "row", "label", "v", none.alias("lows"), none.alias("highs"))
    best = first_of(search(candidates, asked, POSITIVES), ["row"], POSITIVES)
    return best.select("row", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score; see the module."""
    scratch = Scratch(vectors.sparkSession)
    candidates = sharded(members(vectors), scratch)
    anchors = candidates.filter(F.col("vec_id") % EVERY == 0).select("row", F.col("vec_id").alias("anchor_id"), "label", "v")
    found = scratch.store(positives(candidates, anchors), "positives")

    # Where the positive's score is below zero, no score is within 30 and 90 per cent of it.
    windows = found.filter("positive_score >= 0").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("window", "positive_score"))).alias("w"))
    shards = candidates.agg(F.max("shard")).first()[0]
    asked = anchors.join(windows, "row").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards or 0))).alias("shard"),
        "row",
        "label",
        "v",
        F.expr(f"transform(w, x -> ({LEAST} * x.positive_score + 99) div 100)").alias("lows"),
        F.expr(f"transform(w, x -> ({MOST} * x.positive_score) div 100)").alias("highs"),
    )
    best = first_of(search(candidates, asked, NEGATIVES), ["row", "window"], NEGATIVES)
    # ``window`` numbers the positives that are not below zero, which come first.
    named = found.join(anchors.select("row", "anchor_id"), "row")
    return best.join(named, ["row", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP12_SQL = f"""
WITH rows AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % {CHANGED} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
        list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * {UNIT})) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = c.label AS same, c.r, c.vec_id,
        CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
    FROM rows a JOIN rows c ON a.r <> c.r
    WHERE a.vec_id % {EVERY} = 0
), positives AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id ASC NULLS LAST, r) AS k FROM scores WHERE same
    ) WHERE k <= {POSITIVES}
), negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.vec_id ASC NULLS LAST, n.r) AS INTEGER) AS rank
    FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
        AND {LEAST} * p.score <= 100 * n.score AND 100 * n.score <= {MOST} * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= {NEGATIVES}
"""
