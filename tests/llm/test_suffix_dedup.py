"""Repeated windows against all windows in a dictionary; segments; hard rows."""

from collections import Counter

import numpy as np
import pytest

from shelfproof.llm import suffix_dedup
from shelfproof.llm.words import text_bytes
from tests.llm.conftest import HARD


def brute(texts, depth):
    """Per text (n_bytes, spans, kept)."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[p:p + depth] for t in raw for p in range(len(t) - depth + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - depth + 1):
            if seen[t[p:p + depth]] > 1:
                gone[p:p + depth] = True
        edges = np.flatnonzero(np.diff(gone.astype(int), prepend=0)).tolist()
        out.append((len(t), tuple(zip(edges[::2], edges[1::2])),
                    bytes(b for b, g in zip(t, gone) if not g)))
    return out


def found(docs, depth):
    return Counter((r.n_bytes, tuple((s.begin, s.end) for s in r.spans), bytes(r.kept))
                   for r in suffix_dedup.deduplicate(docs, depth).collect())


def copies(seed):
    """Texts with copies, edited copies, shared passages, and runs of one letter or one phrase."""
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(list("abcdeé "), rng.integers(2, 9))) for _ in range(400)]
    passage = " ".join(rng.choice(words, 40))
    base = [" ".join(rng.choice(words, rng.integers(5, 160))) for _ in range(12)]
    texts = []
    for _ in range(150):
        t = list(base[rng.integers(len(base))])
        for _ in range(rng.integers(0, 5)):
            t[rng.integers(len(t))] = str(rng.choice(list("xyzß")))
        t = "".join(t)
        kind = rng.integers(6)
        if kind == 0:
            at = rng.integers(len(t) + 1)
            t = t[:at] + passage + t[at:]
        elif kind == 1:
            t = t + "z" * int(rng.integers(1, 300))
        elif kind == 2:
            t = t + "go on " * int(rng.integers(1, 60))
        elif kind == 3:
            t = " ".join(rng.choice(words, 100))
        texts.append(t)
    return texts


@pytest.mark.parametrize("depth,parts", [(48, 1), (61, 7), (200, 5)])
def test_against_all_windows(spark, depth, parts):
    texts = copies(depth)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    want = brute(texts, depth)
    assert found(docs, depth) == Counter(want)
    assert sum(len(w[1]) for w in want) > 50


def test_segments_hold_each_window_once(monkeypatch):
    """At chunk limits too; equal windows have one anchor, at one place in them."""
    import pyarrow as pa
    depth = 64
    texts = copies(9)
    data, offsets = text_bytes(pa.array(texts))
    want = [p for lo, hi in zip(offsets[:-1], offsets[1:]) for p in range(lo, hi - depth + 1)]
    for chunk in (1 << 17, 1000):
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
        s = suffix_dedup.Segments(suffix_dedup._wide(data), offsets, depth)
        got = [p for a, b in zip(s.first.tolist(), s.last.tolist()) for p in range(a, b + 1)]
        assert got == want
        assert np.all((s.anchor >= s.last) & (s.anchor + suffix_dedup.GRAM <= s.first + depth))
        place, raw = {}, data.tobytes()
        for key, anchor, a, b in zip(s.key.tolist(), s.anchor.tolist(), s.first.tolist(), s.last.tolist()):
            for p in range(a, b + 1):
                assert place.setdefault(raw[p:p + depth], (key, anchor - p)) == (key, anchor - p)


def test_a_passage_of_all_documents(spark):
    """One passage in every text, between words of its own: a row per block and digit."""
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdefgh "), 300))
    texts = [f"{i:06d} own words {i * 7919 % 100003} " + passage + f" and {i * 104729 % 99991} more" for i in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    rows = suffix_dedup.deduplicate(docs, 100).collect()
    want = brute(texts, 100)
    assert {r.doc_id: bytes(r.kept) for r in rows} == {i: w[2] for i, w in enumerate(want)}
    assert all(len(r.spans) == 1 and len(r.kept) < 80 for r in rows)


def test_hard_rows(spark, hard, empty):
    want = Counter(brute([t for _, t in HARD], 48))
    assert found(hard, 48) == want
    assert found(hard.repartition(4), 48) == want
    assert suffix_dedup.deduplicate(hard).columns == ["doc_id", "n_bytes", "spans", "kept"]
    assert suffix_dedup.deduplicate(empty).count() == 0
    nothing = spark.createDataFrame([(1, None), (None, ""), (3, "short")], "doc_id long, text string")
    assert sorted((r.n_bytes, len(r.spans), bytes(r.kept)) for r in suffix_dedup.deduplicate(nothing).collect()) \
        == [(0, 0, b""), (0, 0, b""), (5, 0, b"short")]
    with pytest.raises(ValueError):
        suffix_dedup.deduplicate(hard, 40)
