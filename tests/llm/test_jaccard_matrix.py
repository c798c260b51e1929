"""What the Jaccard join posts, and how many rows its matrix joins."""

from __future__ import annotations

from itertools import combinations

import pytest

from tickloom.llm import jaccard_join
from tickloom.llm.common import Scratch
from tests.llm.frames import documents

PASSAGE = [f"p{i}" for i in range(60)]


def posted(spark, texts):
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    scratch = Scratch(spark)
    sketched = jaccard_join.sketches(docs, jaccard_join.common_hashes(docs, scratch))
    sketched = scratch.store(sketched, "sketches")
    shared = scratch.store(jaccard_join.shared_hashes(sketched), "shared")
    return shared, scratch.store(jaccard_join.postings(shared), "posted")


def test_hashes_of_the_same_sets_are_one_token(spark):
    shared, rows = posted(spark, [" ".join([*PASSAGE, f"own{i}"]) for i in range(2)] + ["alone " * 9])
    found = rows.collect()
    assert len({r["token"] for r in found}) == 1 and len(found) == 2
    assert sum(r["weight"] for r in found) == shared.count() > 2
    assert all(r["family"] == r["set_id"] and r["n"] == 57 for r in found)
    assert {r["at"] for r in found} == {min(r["places"] & 0xFFFFFFFF for r in shared.filter(f"set_id = {s['set_id']}").collect()) for s in found}


def test_a_shared_passage_joins_no_rows_of_sets_that_cannot_link(spark):
    texts = [" ".join([*PASSAGE, *[f"own{i}x{j}" for j in range(15)]]) for i in range(80)]
    shared, rows = posted(spark, texts)
    assert shared.groupBy("token").count().agg({"count": "max"}).first()[0] == 80
    members = jaccard_join.grouped(rows)
    assert members.count() == 80
    assert jaccard_join.matched(jaccard_join.contested(rows), members).count() == 0


@pytest.mark.parametrize("changed", [4, 9, 14])
def test_pairs_that_link_are_matched(spark, changed):
    """Brute force: every pair that links is opened, whatever its sizes."""
    texts = [" ".join([*PASSAGE[: 60 - i], *[f"own{i}x{j}" for j in range(i * changed // 9)]]) for i in range(12)]
    sets = [jaccard_join.shingles(t) for t in texts]
    names = [jaccard_join.name_of(s) for s in sets]
    _, rows = posted(spark, texts)
    members = jaccard_join.grouped(rows).cache()
    opened = jaccard_join.open_groups(jaccard_join.contested(rows), members)
    found = {frozenset(r) for r in jaccard_join.pairs_of(opened, members).collect()}
    size = [set(s.tolist()) for s in sets]
    linked = {frozenset((names[a], names[b])) for a, b in combinations(range(12), 2) if 100 * len(size[a] & size[b]) >= 75 * len(size[a] | size[b])}
    assert linked and linked <= found
