"""Rows that surely have no partner are told apart where they are read, so that their texts are not shuffled."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tickloom.llm import common, jaccard_join

DOCS = "doc_id long, text string, lang string, source string"


def text(number: int, words: int = 40) -> str:
    return " ".join(f"w{number}x{i}" for i in range(words))


@pytest.fixture
def joins(spark, monkeypatch):
    """(how, rows of the left side) of the joins that get texts on the left, but for those with a broadcast."""
    frame, seen = type(spark.range(1)), []
    join = frame.join

    def counted(left, right, on=None, how=None):
        if "text" in left.columns and how in ("left_anti", "left_semi"):
            seen.append((how, left.count()))
        return join(left, right, on, how)

    monkeypatch.setattr(frame, "join", counted)
    return seen


def test_all_ids_are_marked_and_few_others(spark):
    ids = spark.range(0, 3000, 3).selectExpr("id AS own")
    rows = spark.range(-3000, 3000).selectExpr("IF(id % 10 = 1, NULL, id) AS key", "cast(id AS string) AS text")
    marked = common.sifted(rows, "key", ids, 1000).collect()
    assert len(marked) == 6000
    wanted = set(range(0, 3000, 3))
    assert all(r["__maybe"] for r in marked if r["key"] in wanted)
    assert not any(r["__maybe"] for r in marked if r["key"] is None)
    assert sum(r["__maybe"] for r in marked if r["key"] not in wanted) < 300


def test_too_many_ids_mark_more_but_lose_none(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_SIFT_BITS", 64)
    rows = spark.range(2000).withColumnRenamed("id", "key")
    marked = common.sifted(rows, "key", spark.range(500), 500).collect()
    assert len(marked) == 2000 and all(r["__maybe"] for r in marked if r["key"] < 500)


def test_without_ids_nothing_is_marked(spark):
    marked = common.sifted(spark.range(50).withColumnRenamed("id", "key"), "key", spark.range(0), 0)
    assert marked.count() == 50 and marked.filter("__maybe").isEmpty()


def test_join_near_sends_few_texts_to_the_join(spark, joins):
    rows = [(i, text(i % 150), "en", "a") for i in range(160)] + [(None, text(500), "en", "a"), (None, text(3), "en", "a")]
    docs = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.join_near(spark, docs, "").select("doc_id").collect()
    # The row without a doc_id stays for its component, so doc 3 goes with its copy, doc 153.
    assert sorted((r[0] is not None, r[0] or 0) for r in kept) == [(False, 0), (False, 0)] + [(True, i) for i in range(150) if i != 3]
    assert [how for how, _ in joins] == ["left_anti"] and joins[0][1] < 40


def test_full_sets_join_no_texts(spark, joins):
    rows = [(i, text(i)) for i in range(60)] + [(5, text(70)), (80, text(5)), (None, text(6)), (90, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = [(jaccard_join.name_of(jaccard_join.shingles(text(i))), i) for i in (5, 6, 7)]
    found = jaccard_join.full_sets(docs, spark.createDataFrame(wanted, "set_id long, doc_id long")).collect()
    assert joins == []
    expected = {name: jaccard_join.shingles(text(i)).tolist() for name, i in wanted}
    assert len(found) == 3 and {r["set_id"]: r["hashes"] for r in found} == expected
