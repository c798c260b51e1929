"""op11: the files and their digest against plain encoding, document by document."""

from __future__ import annotations

import random
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

from tests.llm.frames import DOCS, documents
from tickloom.llm import token_orc
from tickloom.llm.common import slices_of

SPECIAL = [
    (30, "<|endoftext|> and <|startoftext|>x <|end", "en", "a"),
    (31, "It's WE'LL I'd x y é ́lone \x1c\x1d ΣΑΣ İstanbul 123 4.5", None, None),
    (32, "x" * 30_000 + " " + "é" * 5_000, None, None),
    (-7, "below zero", None, None),
]


def plain(rows, end=token_orc.END):
    """Rows in order, null first; texts of one doc_id in any order, so as a multiset per doc_id."""
    tokenizer = Tokenizer.from_file(token_orc.MODEL)
    return [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, end]) for d, t, *_ in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(spark, rows, tmp_path):
    path = str(tmp_path / "tokens")
    token_orc.write_tokens(documents(spark, rows), path)
    found = sorted(token_orc.checksums(spark, path).collect(), key=lambda r: r.start)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in found), key=str) == sorted(
        ((d, len(x), crc(x)) for d, x in plain(rows)), key=str
    )
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in found]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    return path


def test_digest_against_plain_encoding(spark, tmp_path):
    path = check(spark, [*DOCS, *SPECIAL], tmp_path)
    rows = token_orc.read_documents(spark, path, [31, -7]).collect()
    want = dict(plain(SPECIAL))
    assert {r.doc_id: r.ids for r in rows} == {31: want[31], -7: want[-7]}


def test_a_repeated_doc_id_goes_on_over_files(spark, tmp_path):
    rows = [(5 if i % 3 else i, f"text {i % 7}", None, None) for i in range(400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = check(spark, rows, tmp_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = token_orc.read_tokens(spark, path).groupBy("part").count().collect()
    assert len(parts) == 8 and max(p["count"] for p in parts) < 100


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_orc.write_tokens(documents(spark, [*DOCS]).limit(0), path)
    assert token_orc.checksums(spark, path).collect() == []


def test_columns_of_other_meaning_are_left_out(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_orc.write_tokens(spark.sql("SELECT 3L AS doc_id, 'a b' AS text, 'x' AS ids, 1 AS part, 2 AS at, 'q' AS tie"), path)
    assert [tuple(r) for r in token_orc.checksums(spark, path).collect()] == [(3, 0, 3, crc(plain([(3, "a b")])[0][1]))]


def test_random_texts_word_by_word(tmp_path):
    tokenizer = Tokenizer.from_file(token_orc.MODEL)
    encoder = token_orc.WordEncoder(Path(token_orc.MODEL).read_text(encoding="utf-8"))
    marks = "aB'sȩ́́ͅ \t\n\x0b\x1c\x85  ßΣ漢가각가<|>endoftext9½ﬁ🙂‍"
    draw = random.Random(5)
    texts = ["".join(draw.choices(marks, k=draw.randrange(60))) for _ in range(3_000)]
    texts += ["a<|endoftext|>b", "<|endoftext|><|startoftext|>", " <|endoftext|> "]
    visible = "".join(map(chr, range(32, 127)))
    texts += ["".join(draw.choices(visible, k=draw.randrange(90))) for _ in range(3_000)]
    texts += ["".join(draw.choices("'srtvemld <|A.", k=draw.randrange(60))) for _ in range(3_000)]
    texts += ["H\u0331 h\u0331 <|ENDOFTEXT|> <|endoftext|>X", "\x00 \x7f a\x01b", "y" * 1_000]
    latin = visible + "".join(map(chr, [*range(0xA1, 0x180), *range(0x2010, 0x2028)])) + " \t\x0b"
    texts += ["".join(draw.choices(latin, k=draw.randrange(90))) for _ in range(6_000)]
    texts += [c + x for c in latin for x in ("a", "'S", "9", " ", "")]
    for text, ids in zip(texts, encoded(encoder, texts), strict=True):
        assert ids == tokenizer.encode(text or "", add_special_tokens=False).ids, repr(text)


def encoded(encoder, texts):
    flat, sizes = encoder.encode(pa.array(texts, pa.string()))
    assert len(flat) == sizes.sum()
    return [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] if len(texts) else []


def test_remembered_words_stay_within_their_bound():
    encoder = token_orc.WordEncoder(Path(token_orc.MODEL).read_text(encoding="utf-8"))
    encoder.words.most = encoder.runs.most = 50_000
    for i in range(40):
        for mark in ("", "漢"):
            encoded(encoder, [" ".join(f"{mark}word{i}x{j}q" for j in range(100)), "z" * 9_000, None, ""])
        assert encoder.words.held < 120_000 and encoder.runs.held < 120_000
    for known in (encoder.words, encoder.runs):
        assert 0 < len(known) < 1_000 and all(len(w) < 20 for w in known)
    assert encoded(encoder, []) == [] and encoded(encoder, [None, ""]) == [[], []]


def test_files_hold_indexes_and_stripes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_orc, "STRIPE_BYTES", 1 << 15)
    rows = [(i, " ".join(f"w{(i * 31 + j) % 9973}" for j in range(300)), None, None) for i in range(2_500)]
    path = check(spark, rows, tmp_path)
    files = sorted(Path(path).glob("part-*.orc"))
    assert files and max(orc.ORCFile(f).nstripes for f in files) > 1
    # Integers of one run take far less than their four bytes each.
    total = sum(len(ids) for _, ids in plain(rows))
    assert sum(f.stat().st_size for f in files) < 3 * total
    plan = token_orc.read_documents(spark, path, [3, 77])._jdf.queryExecution().toString()
    assert "PushedFilters" in plan and "In(doc_id, [3,77])" in plan


def test_a_filter_by_doc_id_skips_stripes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_orc, "STRIPE_BYTES", 1 << 15)
    monkeypatch.setattr(token_orc, "INDEX_ROWS", 1_000)
    rows = [(2 * i, " ".join(f"w{(i * 31 + j) % 9973}" for j in range(100)), None, None) for i in range(20_000)]
    path = str(tmp_path / "tokens")
    token_orc.write_tokens(documents(spark, rows), path)

    def scanned(doc_ids):
        frame = token_orc.read_documents(spark, path, doc_ids)
        rows = frame.collect()
        scan = frame._jdf.queryExecution().executedPlan().collectLeaves().head()
        return len(rows), scan.metrics().apply("numOutputRows").value()

    found, read = scanned([4_000])
    assert found == 1 and read <= 5_000
    # An odd id lies within the ranges of index groups, so Bloom filters alone tell that it is absent.
    assert scanned([4_001]) == (0, 0)


@pytest.mark.parametrize("most", [1, 100, 10_000])
def test_slices_hold_every_row_once(most):
    texts = ["x" * (i % 300) if i % 5 else None for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    assert [t for s in slices_of(batch, "text", most) for t in s.column("text").to_pylist()] == texts
