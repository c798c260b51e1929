"""op13: against plain encoding, grouping and counting, document by document."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.frames import DOCS, documents
from tickloom.llm import pair_counts as pc

EMPTY = (0, 0, 0, 0, Counter(), "")
ODD = [
    (40, "a▁b and more", "en", "a"),
    (41, "<|endoftext|> <s> </s> <unk> <0x41>", "en", "a"),
    (42, "two  spaces\n \n  lines \t\r\n ;\r x   nbsp   em", None, None),
    (43, "\x00 null \x00byte", None, None),
    (44, "漢字 한글 🙂🙂 ﬁ Å ȩ́ é", None, None),
    (45, "a" * 5_000, None, None),
    (46, " ", None, None),
    (47, "aaaa bbbb " * 300, None, None),
]


class Plain:
    def __init__(self):
        self.a = Tokenizer.from_file(pc.MODEL_A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pc.MODEL_B)
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.byte = {chr(b) if b in kept else chr(256 + rest.index(b)): b for b in range(256)}

    def tokens(self, text):
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    def document(self, text):
        """n_a, n_b, n_groups, n_links, links of each pair, groups."""
        if not text:
            return EMPTY
        a, b = self.tokens(text)
        data = (" " + text).encode()
        if any(b"".join(x for _, x in t) != data for t in (a, b)):
            return EMPTY
        ends_a, ends_b = (set(np.cumsum([len(x) for _, x in t]).tolist()) for t in (a, b))
        groups, links = [], Counter()
        parts = {}
        for side, tokens in enumerate((a, b)):
            at, group = 0, 0
            for i, x in tokens:
                parts.setdefault(group, ([], []))[side].append(i)
                at += len(x)
                group += at in ends_a and at in ends_b
        for left, right in parts.values():
            groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
            for p, m in Counter(left).items():
                for q, n in Counter(right).items():
                    links[p, q] += m * n
        return len(a), len(b), len(groups), sum(links.values()), links, ";".join(groups)


def plain(texts):
    made = [Plain().document(t) for t in texts] if len(texts) < 5 else list(map(Plain().document, texts))
    count = Counter(pair for d in made for pair in d[4])
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for n_a, n_b, n_groups, n_links, links, groups in made:
        best = sum(n for (a, b), n in links.items() if count[a, b] == most[a])
        digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
        out.append((n_a, n_b, n_groups, n_links, best, sum(n * count[p] for p, n in links.items()), digest))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(spark, rows):
    result = pc.align(documents(spark, rows)).select("doc_id", *COLUMNS).collect()
    want = [(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]), strict=True)]
    assert sorted(map(tuple, result), key=str) == sorted(want, key=str)


def test_small_documents(spark):
    check(spark, [*DOCS, *ODD])


def test_many_tasks_and_a_hot_pair(spark, monkeypatch):
    monkeypatch.setattr(pc, "FAN", 2)
    monkeypatch.setattr(pc, "TOGETHER", 2)
    monkeypatch.setattr(pc, "HELD", 50)
    rows = [(i % 200, f"same words here {i % 17} and {'x' * (i % 9)} copy", None, None) for i in range(600)]
    result = pc.align(documents(spark, rows).repartition(20)).select("doc_id", *COLUMNS).collect()
    want = [(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]), strict=True)]
    assert sorted(map(tuple, result), key=str) == sorted(want, key=str)


def test_every_slice_is_aligned_once(spark, monkeypatch, tmp_path):
    calls, real = str(tmp_path / "calls"), pc.aligner

    def counting(held):
        with open(calls, "a") as out:
            out.write(".")
        return real(held)

    monkeypatch.setattr(pc, "aligner", counting)
    rows = [(i, f"words of text {i}", None, None) for i in range(30)]
    result = pc.align(documents(spark, rows).repartition(3)).select("doc_id", *COLUMNS).collect()
    want = [(r[0], *w) for r, w in zip(rows, plain([r[1] for r in rows]), strict=True)]
    assert sorted(map(tuple, result)) == want and len(Path(calls).read_text()) == 3


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, "", None, None), (None, "▁", None, None)]])
def test_no_tokens_at_all(spark, rows):
    check(spark, rows)


def test_columns_of_other_meaning(spark):
    frame = spark.sql("SELECT 1L AS doc_id, 'a word' AS text, 2 AS slice, 'x' AS shard, 3 AS pairs, 'y' AS n_a")
    assert [tuple(r) for r in pc.align(frame).select("doc_id", *COLUMNS).collect()] == [(1, *plain(["a word"])[0])]


def test_words_align_as_whole_texts_do():
    aligner = pc.Aligner(Path(pc.MODEL_A).read_text(encoding="utf-8"), Path(pc.MODEL_B).read_bytes())
    plain_ = Plain()
    draw = random.Random(8)
    marks = "ab'sS \t\n\r\x0b\x1c\x85\xa0   é漢🙂9,;▁é"
    texts = ["".join(draw.choices(marks, k=draw.randrange(1, 40))) for _ in range(3_000)]
    texts += ["".join(draw.choices(marks[:12] + "\0", k=draw.randrange(1, 40))) for _ in range(1_000)]
    visible = "".join(map(chr, range(32, 127))) + "    "
    texts += ["".join(draw.choices(visible, k=draw.randrange(1, 80))) for _ in range(3_000)]
    for at in range(0, len(texts), 500):
        part = texts[at : at + 500]
        found = aligner.align(pa.array(part, pa.string()))
        links = [Counter() for _ in part]
        for d, p, n in zip(found.doc.tolist(), found.pair.tolist(), found.links.tolist(), strict=True):
            links[d][p >> 32, p & 0xFFFFFFFF] += n
        for i, text in enumerate(part):
            n_a, n_b, n_groups, n_links, want, groups = plain_.document(text)
            digest = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
            got = (found.n_a[i], found.n_b[i], found.n_groups[i], found.n_links[i], found.digest[i])
            assert got == (n_a, n_b, n_groups, n_links, digest) and links[i] == want, repr(text)


def test_a_perfect_hash_is_minimal_and_tells_strange_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**48, 50_000))
    levels = pc.PerfectHash.build(keys)
    numbers = pc.PerfectHash(levels).numbers(keys)
    assert sorted(numbers.tolist()) == list(range(len(keys)))
    # Three to four bits a key, against 64 of the key itself.
    assert sum(map(len, levels)) * 8 < 4.5 * len(keys)
    placed = np.empty_like(keys)
    placed[numbers] = keys
    table = pc.PairTable(levels, placed.tobytes())
    assert (table.numbers(keys[::-1]) == numbers[::-1]).all()
    with pytest.raises(ValueError, match="not in the table"):
        table.numbers(np.array([keys[0], 2**50]))
    assert pc.PerfectHash.build(keys[:0]) == []


def test_long_groups_make_no_list_of_all_their_links():
    aligner = pc.Aligner(Path(pc.MODEL_A).read_text(encoding="utf-8"), Path(pc.MODEL_B).read_bytes())
    found = aligner.align(pa.array(["ab" * 200_000]))
    assert len(found.pair) < 1_000 and found.n_links[0] >= found.n_a[0]


def test_words_encoded_side_by_side_are_told_apart():
    aligner = pc.Aligner(Path(pc.MODEL_A).read_text(encoding="utf-8"), Path(pc.MODEL_B).read_bytes())
    tokenizer, given = aligner.a, []

    class Spy:
        def encode_batch_fast(self, texts, **how):
            given.append(len(texts))
            return tokenizer.encode_batch_fast(texts, **how)

    rng = random.Random(3)
    texts = [" " + "".join(rng.choices("abcdeé漢🙂.,'1", k=rng.randint(1, 9))) for _ in range(700)]
    texts += [" ends\n", " ", "  two  ", " a　", "none", " \x00", " <|endoftext|>", " x" * 40, " last"]
    alone = [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    aligner.a = Spy()
    assert aligner._encoded([t.encode() for t in texts], texts) == alone
    assert sum(given) < 20
    assert aligner._encoded([], []) == []
