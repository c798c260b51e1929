"""op3: vectors of another size are left out, and of two vectors under one id the smaller counts."""

from __future__ import annotations

import numpy as np

from tickloom.llm import permutation_index


def test_sizes_and_repeated_ids(spark):
    vectors = np.random.default_rng(3).normal(size=(60, 6))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    other = [(100, [1.0] * 5), (101, [9.0] * 7), (102, []), (40, [0.5]), (7, [50.0] * 6)]
    table = spark.createDataFrame([*rows, *other], "vec_id long, embedding array<double>").repartition(3)
    found = permutation_index.search(table, table.filter("vec_id % 20 = 0")).collect()
    held = {i: min(tuple(v), (50.0,) * 6) if i == 7 else tuple(v) for i, v in rows}
    for query in (0, 20, 40):
        score = {i: float(np.dot(held[query], v)) for i, v in held.items() if i != query}
        want = sorted(score, key=lambda i: (-score[i], i))[:20]
        got = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == query)
        assert [vec_id for _, vec_id in got] == want
    assert {r["query_id"] for r in found} == {0, 20, 40}
