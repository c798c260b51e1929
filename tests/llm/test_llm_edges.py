"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import (
    jaccard_join,
    language_id,
    licenses,
    line_dedup,
    mixing,
    permutation_index,
    quality_classifier,
    quality_rules,
    secrets,
    unigram,
)
from tests.llm.frames import DOCS, LINE, LONG, documents


def by_id(df):
    rows = df.collect()
    return {r["doc_id"]: r for r in rows}, len(rows)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


def test_secrets(docs, none):
    rows, n = by_id(secrets.digest(secrets.scan(docs, ["doc_id"]), ["doc_id"]))
    assert n == len(DOCS) and rows[1]["spans"] == rows[2]["spans"] == ""
    assert rows[9]["spans"] == "assign:0:17,access:18:38"
    assert secrets.digest(secrets.scan(none, ["doc_id"]), ["doc_id"]).collect() == []


def test_secret_checksums():
    good = "ghp_" + "A" * 30
    body = next(b for b in (f"{'A' * 30}{x}" for x in checksums("A" * 30)))
    assert secrets.crc_holds(body) and not secrets.crc_holds("A" * 36)
    keys = secrets.automaton()
    assert [s[2] for s in secrets.find_secrets(f"x ghp_{body} y", keys)] == ["github"]
    assert secrets.find_secrets(good + "BBBBBB", keys) == []
    assert [s[2] for s in secrets.find_secrets("eyJhbGciOiJub25lIn0.eyJhIjoxfQ.sig", keys)] == ["jwt"]
    # Offsets are code points, also behind a letter that gets longer in lower case.
    assert secrets.find_secrets("İ TOKEN=abcdefgh", keys) == [(2, 16, "assign")]


def checksums(text):
    import zlib

    rest, digits = zlib.crc32(text.encode()), ""
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        digits = secrets.BASE62[digit] + digits
    return [digits]


def test_quality_rules(docs, none):
    measured = quality_rules.measures(docs, ["doc_id"])
    rows, n = by_id(quality_rules.judge(measured, ["doc_id"], quality_rules.learn(measured)))
    assert n == len(DOCS)
    assert rows[1]["base_failed"] and rows[2]["base_failed"] and not rows[1]["kept"]
    empty = quality_rules.measures(none, ["doc_id"])
    assert quality_rules.judge(empty, ["doc_id"], quality_rules.learn(empty)).collect() == []


def test_line_dedup_and_its_reverse(spark, docs, none):
    index = line_dedup.LineIndex.create(docs)
    rows, n = by_id(line_dedup.dedup_lines(docs, index, ["doc_id"]))
    assert n == len(DOCS)
    # Documents 10 to 15 hold the line; it stays in the last only.
    assert [rows[i]["n_dropped"] for i in range(10, 16)] == [1, 1, 1, 1, 1, 0]
    assert rows[15]["kept_text"].endswith(LINE) and rows[10]["kept_text"] == "own 10"
    assert rows[1]["n_lines"] == rows[2]["n_lines"] == 1
    # Without documents 14 and 15 four hold it, and no line is hot.
    gone = docs.filter(F.col("doc_id").isin(14, 15))
    less = index.delete(gone)
    rest, _ = by_id(line_dedup.dedup_lines(docs.filter(~F.col("doc_id").isin(14, 15)), less, ["doc_id"]))
    assert all(rest[i]["n_dropped"] == 0 for i in range(10, 14))
    again = less.insert(gone)
    back, _ = by_id(line_dedup.dedup_lines(docs, again, ["doc_id"]))
    assert {i: r["kept_text"] for i, r in back.items()} == {i: r["kept_text"] for i, r in rows.items()}
    assert line_dedup.dedup_lines(none, line_dedup.LineIndex.create(none), ["doc_id"]).collect() == []


def test_lines_count_documents_and_not_rows(spark):
    """A line in doc_ids 1 to 3, one of them three times, and in rows without one; and a line in five doc_ids."""
    few, many = "a line of only three documents, one of them repeated", "a line of five documents that goes from four"
    rows = [(i, few) for i in (1, 2, 3, 3, 3)] + [(i, f"{few}\n{many}") for i in (None, None)] + [(i, many) for i in range(4, 9)]
    docs = documents(spark, [(i, text, "en", "a") for i, text in [*rows, (None, f"own\n{many}")]])
    index = line_dedup.LineIndex.create(docs)
    kept = line_dedup.dedup_lines(docs, index, ["doc_id"]).collect()
    found = sorted((r["doc_id"] or 0, r["kept_text"], r["n_dropped"]) for r in kept)
    own = [(0, few, 1), (0, few, 1), (0, "own", 1)]
    assert found == [*own, (1, few, 0), (2, few, 0), *[(3, few, 0)] * 3, *((i, "", 1) for i in range(4, 8)), (8, many, 0)]
    # One row of keys for the two texts that rows without a doc_id have, not one for all of them.
    assert index.drops().filter("doc_id IS NULL").count() == 2


def test_cuckoo_filter_holds_and_forgets():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 3000)
    made = line_dedup.CuckooFilter.of(keys)
    assert made.holds(keys).all()
    others = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 20000)
    assert made.holds(others).mean() < 0.01
    for key in keys[:1000]:
        made.remove(int(key))
    assert made.holds(keys[1000:]).all() and made.holds(keys[:1000]).mean() < 0.01
    loaded = line_dedup.CuckooFilter.load(made.dump())
    assert loaded.holds(keys[1000:]).all()


def test_sentencepiece(docs, none):
    rows, n = by_id(unigram.encode_and_decode(docs))
    assert n == len(DOCS) and all(r["round_trip"] for r in rows.values())
    assert rows[1]["n_ids"] == rows[2]["n_ids"] == 0 and rows[3]["n_ids"] > 1000
    assert rows[6]["n_bytes"] > 0
    assert unigram.encode_and_decode(none).collect() == []


@pytest.mark.parametrize("text", [" ", "  a", "a ", "a  b", "▁", "a▁b", "\n\t", "漢字", "x" * 500, "é è  ñ 🙂"])
def test_blocks_segment_as_words_do(text):
    pieces = unigram.load_pieces()
    (ids,) = unigram.Encoder(pieces).encode([text])
    one = [i for c in unigram.CHUNK.findall(b" " + text.encode()) for i in unigram.segment(c, pieces, pieces.unknown)]
    assert ids == one and unigram.decode_ids(ids, pieces.data) == text


def test_quality_classifier(spark, docs, none):
    described = quality_classifier.features(docs, ["doc_id"])
    labels = spark.createDataFrame([(3, 1), (3, 1), (3, 0), (4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality_classifier.learn(described, labels)
    rows, n = by_id(quality_classifier.classify(described, ["doc_id"], model))
    assert n == len(DOCS) and all(0 <= r["score"] <= 1 for r in rows.values())
    empty = quality_classifier.learn(quality_classifier.features(none, ["doc_id"]), labels)
    assert 0 <= quality_classifier.classify(described, ["doc_id"], empty).first()["score"] <= 1


def test_licenses(docs, none):
    index = licenses.build_index(*licenses.frequencies(docs))
    rows, n = by_id(licenses.summary(licenses.scan(docs, ["doc_id"], index), ["doc_id"]))
    assert n == len(DOCS) and rows[1]["n_words"] == 0 and rows[1]["labels"] == ""
    assert (rows[8]["n_base"], rows[8]["first_word"], rows[8]["last_word"]) == (2, 1, 6)
    assert rows[8]["base_labels"] == "mit"
    assert licenses.frequencies(none) == (0, {})
    assert licenses.summary(licenses.scan(none, ["doc_id"], licenses.build_index(0, {})), ["doc_id"]).collect() == []


def test_language(docs, none):
    model = language_id.learn(docs)
    assert model.languages == ["de", "en"]
    rows, n = by_id(language_id.main_language(language_id.identify(docs, ["doc_id"], model), ["doc_id"]))
    assert n == len(DOCS)
    assert rows[1]["lang_pred"] == rows[2]["lang_pred"] == rows[7]["lang_pred"] == "und"
    assert rows[3]["lang_pred"] == "en" and rows[4]["lang_pred"] == "de"
    nothing = language_id.learn(none)
    assert language_id.main_language(language_id.identify(docs, ["doc_id"], nothing), ["doc_id"]).first()["score"] == 0


def test_spans_of_mixed_text(docs):
    model = language_id.learn(docs)
    text = "the quick brown fox and the lazy dog. " * 5 + "der schnelle braune Fuchs und der faule Hund. " * 5
    (spans,) = language_id.label([text], model, language_id.Letters())
    assert [s["lang"] for s in spans] == ["en", "de"]
    assert abs(spans[1]["start"] - 190) < 12 and spans[0]["start"] == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    scores, text = rng.normal(0, 8, (60, 3)), np.repeat([0, 2, 3], [5, 25, 30])
    path = language_id.best_path(scores, text, 5)

    def total(rows, labels):
        changes = sum(a != b for a, b in zip(labels, labels[1:], strict=False))
        return sum(scores[r, x] for r, x in zip(rows, labels, strict=True)) - language_id.PENALTY * changes

    for number in (0, 2, 3):
        rows = np.flatnonzero(text == number)
        best = {x: scores[rows[0], x] for x in range(3)}
        for r in rows[1:]:
            top = max(best.values())
            best = {x: scores[r, x] + max(best[x], top - language_id.PENALTY) for x in range(3)}
        assert total(rows, path[rows].tolist()) == pytest.approx(max(best.values()))


def test_jaccard_join(docs, none):
    rows, n = by_id(jaccard_join.join(docs))
    assert n == len(DOCS)
    assert rows[1]["n_shingles"] == rows[2]["n_shingles"] == 0 and rows[1]["component_id"] == 1
    assert rows[20]["component_id"] == rows[21]["component_id"] == rows[22]["component_id"] == 20
    assert rows[23]["component_id"] == 23
    assert rows[None]["component_id"] is None
    assert jaccard_join.join(none).collect() == []


def test_jaccard_join_of_a_large_group_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(60)]
    made = []
    for i in range(150):
        words = list(base) if i < 110 else [f"v{rng.integers(400)}" for _ in range(20)] + base[:30]
        for _ in range(rng.integers(0, 4)):
            words[rng.integers(len(words))] = f"x{rng.integers(10**6)}"
        made.append((i, " ".join(words), "en", "s"))
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.join(documents(spark, made)).collect()}
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t, _, _ in made)]
    parent = list(range(len(made)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(made)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert found == {i: root(i) for i in range(len(made))}


def test_mixing(docs, none):
    rows = mixing.mix(mixing.sizes(docs)).collect()
    assert len(rows) == len(DOCS)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    total = sum(r["size"] for r in rows)
    assert abs(sum(r["taken"] for r in rows) - 1.5 * total) < 200
    assert mixing.mix(mixing.sizes(none)).collect() == []
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixing.sizes(mixed).agg(F.sum("size")).first()[0] == pytest.approx(sum(r["taken"] for r in rows), abs=50)


def test_mixing_reaches_the_targets_without_ids(spark):
    """Equal sizes in sources of unequal targets; rows without a doc_id, of a repeated one, and copies of one row."""
    rows = [(None, " ".join(f"{s}{i}w{k}" for k in range(50)), "en", s) for s in "abc" for i in range(40)]
    rows += [(9, " ".join(f"{s}w{k}" for k in range(50)), "en", s) for s in "abc"] + [rows[0]] * 3
    docs = documents(spark, rows)
    targets = {r["source"]: r["target"] for r in mixing.source_targets(mixing.sizes(docs)).collect()}
    assert max(targets.values()) > 1.9 * min(targets.values())
    mixed = mixing.mixed(docs).collect()
    for source, target in targets.items():
        own = [len(r["text"].split()) for r in mixed if r["source"] == source]
        assert abs(sum(own) - target) <= 2 * mixing.BLOCK_WORDS
        assert sum(n < 50 for n in own) <= 1


def test_permutation_index(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(300, 8))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[100:220] = vectors[0]
    rows = [(i, [float(np.float32(x)) for x in v], i) for i, v in enumerate(vectors)]
    rows += [(300, None, 1), (301, [0.0] * 8, 1), (302, [1.0] * 7 + [None], 1), (303, [float("nan")] * 8, 1), (None, [1.0] * 8, 1)]
    rows += [rows[5], rows[20]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = permutation_index.search(table, table.filter("vec_id % 20 = 0")).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert set(got) == set(range(0, 300, 20))
    # Copies of vector 0 tie: the smaller ids come first.
    assert [got[100][k] for k in range(1, 21)] == [0, *range(101, 120)]
    assert all(sorted(x) == list(range(1, 21)) and q not in x.values() for q, x in got.items())
    small = table.filter("vec_id < 3")
    assert len(permutation_index.search(small, small.filter("vec_id = 0")).collect()) == 2
    assert permutation_index.search(table.filter("vec_id >= 300"), table).collect() == []


def test_permutation_index_of_unequal_lengths_is_exact(spark):
    """More distinct vectors than are reranked at first, and the true neighbours are long ones at a moderate angle."""
    rng = np.random.default_rng(11)
    vectors = rng.normal(size=(3000, 32))
    vectors *= np.exp(rng.normal(size=(3000, 1))) / np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors.astype(np.float32).astype(np.float64)
    vectors[1500:1540] = vectors[np.argmax(np.linalg.norm(vectors, axis=1))]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found: dict[int, dict[int, int]] = {}
    for r in permutation_index.search(table, table.filter("vec_id % 20 = 0")).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    assert set(found) == set(range(0, 3000, 20))
    for query, own in found.items():
        score = (vectors * vectors[query]).sum(axis=1)
        score[query] = -np.inf
        assert [own[k] for k in range(1, 21)] == np.lexsort((np.arange(3000), -score))[:20].tolist()


def test_clashing_columns_do_no_harm(spark, docs):
    odd = docs.withColumns({c: F.lit("odd") for c in ("n", "size", "score", "spans", "n_words", "family", "token", "k1", "n_lines", "kept_text", "lang_pred")})
    assert jaccard_join.join(odd).count() == len(DOCS)
    assert mixing.mix(mixing.sizes(odd)).count() == len(DOCS)
    assert mixing.mixed(odd).columns == odd.columns
    kept = line_dedup.dedup_lines(odd, line_dedup.LineIndex.create(odd), ["doc_id"])
    assert kept.count() == len(DOCS)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns and out.count() > 0


def test_near_copies_of_repeated_and_null_ids_leave_one(spark):
    """Doc 2 occurs with a copy of doc 1 and with the text of another group, which keeps one of its own."""
    one, two, three = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, one), (2, one), (2, two), (3, two), (4, two), (5, one), (None, three), (None, three), (6, three), (None, "")]
    docs = documents(spark, [(i, text, "en", "s") for i, text in [*rows, (None, ""), (7, None)]])
    kept = sorted(r["text"] or "" for r in corpus_pipeline.join_near(spark, docs, "").collect())
    assert kept == ["", "", "", one, two, three]


def test_pipeline_keeps_texts_with_letters_where_no_language_is_stated(spark, docs):
    unstated = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, unstated, "")
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in DOCS} - {1, 2, 7}


def test_pipeline_against_plain_steps(spark, docs, none):
    """Each stage on small documents: what goes, what stays, and that decisions take effect."""
    (_, languages), (_, lines), (_, near), (_, mix), (_, encode) = corpus_pipeline.STAGES
    told = languages(spark, docs, "")
    assert {r["doc_id"] for r in told.collect()} == {r[0] for r in DOCS} - {1, 2, 7}
    deduped = lines(spark, told, "")
    texts = {r["doc_id"]: r["text"] for r in deduped.collect()}
    assert texts[10] == "own 10" and texts[15].endswith(LINE)
    kept = near(spark, deduped, "")
    ids = [r["doc_id"] for r in kept.collect()]
    assert 20 in ids and not {21, 22} & set(ids) and ids.count(24) == 2 and None in ids
    mixed = mix(spark, kept, "")
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert all(r["round_trip"] for r in encode(spark, mixed, "").collect())
    for stage in (languages, lines, near, mix, encode):
        assert stage(spark, none, "").collect() == []
