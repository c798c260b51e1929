"""Registered queries against DuckDB, or against plain Python over the whole small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.compare import TESTDATA, connect, duck_rows, spark_rows
from tickloom.llm import licenses, quality_rules, queries, unigram

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def result(spark, name):
    return {r["doc_id"]: r for r in queries.QUERIES[name](spark, SF_DIR).collect()}


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_matches_duckdb(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    columns, rows = duck_rows(con, queries.ORACLE[name])
    assert sorted(df.columns) == columns
    assert spark_rows(df) == rows and rows


def test_secrets_hold_the_base_spans(spark, texts):
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    found = result(spark, "op1_secrets")
    assert found.keys() == texts.keys()
    for doc_id, text in texts.items():
        spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))
        row = found[doc_id]
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        kinds = Counter(s[2] for s in spans)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])


def test_quality_rules_match_plain_counts(spark, con, texts):
    found = result(spark, "op2_quality_rules")
    for doc_id, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        repeated = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
        row = found[doc_id]
        assert (row["n_words"], row["word_chars"]) == (len(words), sum(map(len, words)))
        assert row["n_symbols"] == len(re.findall(r"[#*$%&|<>]", text))
        assert row["n_repeat_words"] == len(repeated)
        assert row["base_failed"] == (len(words) < 20 or 100 * len(repeated) > 30 * len(words))
        assert not (row["base_failed"] and row["kept"])
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    good = [found[i] for i, q in labels.items() if q == 1 and not found[i]["base_failed"]]
    bad = [found[i] for i, q in labels.items() if q == 0]
    assert np.mean([r["kept"] for r in good]) > 0.98
    assert np.mean([not r["kept"] for r in bad]) > 0.9


def test_permutation_index_finds_the_nearest(spark, con):
    rows = con.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    found = defaultdict(dict)
    for r in queries.QUERIES["op3_permutation_index"](spark, SF_DIR).collect():
        found[r["query_id"]][r["rank"]] = (r["vec_id"], r["score"])
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    hits = []
    for query, own in found.items():
        at = int(np.flatnonzero(ids == query)[0])
        score = vectors @ vectors[at]
        score[at] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        assert sorted(own) == list(range(1, 21))
        for vec_id, s in own.values():
            assert s == pytest.approx(score[ids == vec_id][0], abs=1e-12)
        hits.append(len(best & {v for v, _ in own.values()}) / 20)
    assert np.mean(hits) >= 0.9


def test_sentencepiece_ids_are_the_best_path_and_decode(spark, texts):
    pieces = unigram.load_pieces()
    score = {data: pieces.score[i] for i, data in enumerate(pieces.data) if data and i not in set(pieces.byte_ids)}
    unknown = pieces.unknown

    def best_sum(chunk: str) -> float:
        best = [0.0] + [-np.inf] * len(chunk)
        for end in range(1, len(chunk) + 1):
            for start in range(max(0, end - 16), end):
                piece = chunk[start:end].encode()
                if piece in score:
                    best[end] = max(best[end], best[start] + score[piece])
            if chunk[end - 1].encode() not in score:
                best[end] = max(best[end], best[end - 1] + unknown)
        return best[-1]

    found = result(spark, "op5_sentencepiece")
    assert all(r["round_trip"] for r in found.values())
    for doc_id in sorted(texts)[::25]:
        ids, total, at = found[doc_id]["ids"], 0.0, 0
        while at < len(ids):
            if ids[at] in pieces.byte_ids:
                wide = unigram.width(pieces.data[ids[at]][0])
                total, at = total + unknown, at + wide
            else:
                total, at = total + pieces.score[ids[at]], at + 1
        chunks = re.findall(" *[^ ]+| +", " " + texts[doc_id])
        assert total == pytest.approx(sum(map(best_sum, chunks)))


def test_quality_classifier_on_held_out_rows(spark, con, texts):
    found = result(spark, "op6_quality_classifier")
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3)
    labels = con.execute("SELECT doc_id, quality FROM labels").fetchall()
    assert np.mean([found[i]["predicted"] == q for i, q in labels if found[i]["held_out"]]) > 0.9


def test_licenses_match_plain_search(spark, texts):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    found = result(spark, "op7_licenses")
    for doc_id, text in texts.items():
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = {
            (i, label)
            for phrase, label in phrases.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        }
        row = found[doc_id]
        assert (row["n_words"], row["n_base"]) == (len(words), len(at))
        assert row["first_word"] == min((i for i, _ in at), default=None)
        assert row["last_word"] == max((i for i, _ in at), default=None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in at}))
        assert set(row["base_labels"].split(",")) - {""} <= set(row["labels"].split(","))
        assert 0 <= row["score"] <= 1


def test_license_postings_lose_no_match():
    index = licenses.build_index(1000, {b"the": 900, b"license": 20, b"under": 300})
    templates = [licenses.license_words(text) for _, text, _ in licenses.TEMPLATES]
    for number, template in enumerate(templates):
        words = [b"some", b"text", *template, b"more"]
        got = licenses.match(words, licenses.starts_of(words, frozenset(index.postings)), index)
        assert {"label": licenses.TEMPLATES[number][0], "first_word": 2, "score": 1.0} in [
            {**g, "score": round(g["score"], 9)} for g in got
        ]


def test_language_of_held_out_rows(spark, con, texts):
    found = result(spark, "op8_language_id")
    assert found.keys() == texts.keys()
    held = con.execute("SELECT doc_id, lang FROM documents").fetchall()
    for doc_id, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 3 == 1)
    assert np.mean([found[i]["lang_pred"] == lang for i, lang in held if found[i]["held_out"]]) > 0.95


def test_votes_of_a_blind_rule_have_no_harm():
    patterns = np.array([[1, 1], [-1, -1], [1, -1]])
    model = quality_rules.fit(patterns, np.array([90.0, 10.0, 5.0]), ["a", "b"])
    assert model.weight("a", -1) < 0 < model.weight("a", 1) + 1e-9
