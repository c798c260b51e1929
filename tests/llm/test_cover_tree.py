"""op12: against a comparison with every row, and the tree's bounds."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tests.compare import connect, duck_rows, spark_rows
from tickloom.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score by comparing all rows."""
    used = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        changed = vec_id is not None and vec_id % 7 == 0
        # The remainder has the sign of the label, as in SQL.
        used.append((vec_id, int(math.fmod(label + 1, 10)) if changed else label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, (a, label, v) in enumerate(used):
        if a is None or a % 100:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), b is None, b or 0, b, k) for j, (b, k, w) in enumerate(used) if j != i]  # noqa: B905
        same = sorted(s[:4] for s in scores if s[4] == label)[:5]
        other = sorted(s[:4] for s in scores if s[4] != label)
        for positive in same:
            fit = [n for n in other if 30 * -positive[0] <= 100 * -n[0] <= 90 * -positive[0]][:10]
            out += [(a, positive[3], r, n[3], -positive[0], -n[0]) for r, n in enumerate(fit, 1)]
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    result = cover_tree.hard_negatives(frame).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r) for r in result.collect()), key=str)


def floats(values):
    return [float(x) for x in values]


def test_random_vectors_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "SHARD_ROWS", 100)
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(700, 6)) * np.exp(draw.normal(size=(700, 1)))
    rows = [(i, floats(v), int(l)) for i, (v, l) in enumerate(zip(vectors, draw.integers(0, 4, 700), strict=True))]
    assert found(spark, rows) == plain(rows)


def test_clusters_and_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "SHARD_ROWS", 150)
    monkeypatch.setattr(cover_tree, "LEAF_ROWS", 8)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(6, 8))
    rows = [(i, floats(np.round(centres[i % 6] + draw.normal(size=8) / 20, 2)), i % 3) for i in range(500)]
    rows += [(i, [0.5] * 8, 2 if i % 2 else 1) for i in range(500, 900)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [1.0, 2.0], 1), (100, [2.0, 1.0], 3), (200, [0.0, 0.0], 1),
        (300, [-1.0, -2.0], 1), (400, None, 1), (500, [1.0, None], 1), (600, [float("nan"), 1.0], 2),
        (700, [float("inf"), 1.0], 2), (800, [1.0, 1.0], None), (None, [0.5, 1.0], 2), (None, None, None), (900, [], 2),
        (1000, [0.3, 0.4, 0.5], 2), (7, [1.0, 1.0], 1), (14, [0.6, 0.7], 9), (21, [0.6, 0.7], -1), (-100, [0.7, 0.6], 1), (5, [0.004, -0.004], 2),
    ]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 2)], [(0, None, None)]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows) == []


def test_columns_of_other_meaning(spark):
    rows = [(i * 10, [float(i % 5), 1.0], i % 2) for i in range(60)]
    frame = spark.createDataFrame([(*r, 1, "x", [2]) for r in rows], SCHEMA + ", shard int, row string, v array<int>")
    result = cover_tree.hard_negatives(frame).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted((tuple(r) for r in result.collect()), key=str) == plain(rows)


def test_a_score_beyond_exact_integers_raises(spark):
    with pytest.raises(Exception, match="2\\^53"):
        found(spark, [(0, [3e30, 1.0], 1), (1, [1.0, 1.0], 1)])


def test_against_sql(spark):
    import os

    folder = f"{os.environ.get('TESTDATA_DIR', '/root/testdata')}/{os.environ.get('TEST_SF', 'sf0.01')}"
    columns, want = duck_rows(connect(folder), cover_tree.OP12_SQL)
    result = cover_tree.op12_cover_tree(spark, folder)
    assert sorted(result.columns) == columns and spark_rows(result) == want


def test_nodes_cover_their_rows_and_siblings_are_apart():
    draw = np.random.default_rng(9)
    vectors = np.floor(draw.normal(size=(600, 3)) * 100)
    tree = cover_tree.CoverTree(np.arange(600), np.arange(600), np.zeros(600, np.int64), vectors)
    assert sorted(tree.order) == list(range(600)) and len(tree.levels) > 2
    covered = 0
    for above, level in zip([None, *tree.levels], tree.levels, strict=False):
        for i in range(len(level["centre"])):
            rows = tree.order[level["start"][i] : level["end"][i]]
            assert level["centre"][i] in rows
            cosine = np.clip(tree.raised[rows] @ tree.raised[level["centre"][i]], -1, 1)
            assert (np.arccos(cosine) <= level["angle"][i] + 1e-6).all()
            covered += len(rows) if level["leaf"][i] else 0
            if above is not None:
                p = level["parent"][i]
                assert above["start"][p] <= level["start"][i] and level["end"][i] <= above["end"][p]
    assert covered == 600


def test_clustered_vectors_leave_most_leaves_closed():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 32)) * 300
    vectors = np.floor(np.repeat(centres, 50, axis=0) + draw.normal(size=(2000, 32)) * 5)
    tree = cover_tree.CoverTree(np.arange(2000), np.arange(2000), np.zeros(2000, np.int64), vectors)
    anchor = vectors[:1]
    best = float(np.sort(vectors @ anchor[0])[-20])
    ((start, end, _),) = tree.leaves(anchor, np.array([best]), np.array([np.inf]))
    assert 20 <= (end - start).sum() < 300
