"""How the words of op13 are aligned: each token list unpacked once, the groups' text from whole entries."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa

from tickloom.llm import pair_counts as pc


def test_tokens_are_unpacked_once(monkeypatch):
    aligner, calls, real = pc.Aligner(Path(pc.MODEL_A).read_text(encoding="utf-8"), Path(pc.MODEL_B).read_bytes()), [], pc.flattened

    def counted(lists):
        calls.append(len(lists))
        return real(lists)

    monkeypatch.setattr(pc, "flattened", counted)
    # The marker's own character is not given back, nor is its word's document.
    found = aligner.align(pa.array(["some words here", "a▁b words", None, "zwölf 漢字 words\n"]))
    assert len(calls) == 2
    assert found.n_a[0] > 0 and found.n_a[1] == 0 and found.n_a[2] == 0 and found.n_a[3] > 0
    assert set(found.doc.tolist()) == {0, 3} and found.links.sum() == found.n_links.sum()


def test_a_word_that_neither_side_gives_back_leaves_the_others():
    aligner = pc.Aligner(Path(pc.MODEL_A).read_text(encoding="utf-8"), Path(pc.MODEL_B).read_bytes())
    whole, broken = aligner._learn([b" words"])[0], aligner._learn(["a▁b".encode()])
    assert [w.whole for w in broken] == [False] and broken[0].groups == b"" and broken[0].pairs == b""
    mixed = aligner._learn([" ▁".encode(), b" words", " x▁".encode()])
    assert mixed[1] == whole and [w.whole for w in mixed] == [False, True, False]
    assert int(np.frombuffer(whole.links, np.int64).sum()) == whole.n_links
