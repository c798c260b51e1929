"""What language identification holds at once, and its main language against plain Python."""

from __future__ import annotations

import tracemalloc

from tests.llm.frames import documents
from tickloom.llm import language_id


def test_letters_take_few_bytes_each():
    texts, letters = ["some words of one text " * 500] * 40, language_id.Letters()
    tracemalloc.start()
    language_id.words_of(texts, letters)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 65 * sum(map(len, texts))


def test_a_worker_holds_a_slice_of_a_batch(spark, monkeypatch, tmp_path):
    sizes, real = str(tmp_path / "sizes"), language_id.words_of

    def noted(texts, letters):
        with open(sizes, "a") as out:
            out.write(f"{sum(map(len, texts))}\n")
        return real(texts, letters)

    monkeypatch.setattr(language_id, "words_of", noted)
    rows = [(i, f"word{i % 7} und " * 2_500, "de" if i % 2 else "en", None) for i in range(200)]
    model = language_id.learn(documents(spark, rows).coalesce(1))
    assert model.languages == ["de", "en"]
    with open(sizes) as found:
        held = list(map(int, found))
    assert sum(held) == sum(len(r[1]) for r in rows) and max(held) < 1_100_000


def test_the_main_language_needs_no_python(spark):
    ddl = "doc_id long, spans array<struct<lang:string,start:long,end:long,n_letters:long>>"
    lists = [
        [],
        [("b", 0, 3, 3)],
        [("b", 0, 3, 3), ("a", 4, 7, 3)],
        [("b", 0, 3, 3), ("a", 4, 9, 5), ("b", 10, 14, 4)],
        [("é", 0, 1, 1), ("z", 1, 2, 1)],
        None,
    ]
    frame = spark.createDataFrame(list(enumerate(lists)), ddl)
    found = language_id.main_language(frame, ["doc_id"])
    assert "Python" not in found._jdf.queryExecution().toString() and "MapInArrow" not in found._jdf.queryExecution().toString()
    assert [tuple(r) for r in found.orderBy("doc_id").collect()] == [
        (0, "und", 0.0), (1, "b", 1.0), (2, "a", 0.5), (3, "b", 7 / 12), (4, "z", 0.5), (5, "und", 0.0),
    ]
