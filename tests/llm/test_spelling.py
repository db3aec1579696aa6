"""Spelling variants against brute force, rounds of small filters, hard rows."""

import re
import zlib
from collections import Counter

import numpy as np

from shelfproof.llm import spelling


def near(a, b):
    """Whether one inserted, deleted or replaced code point makes one word the other."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute(words, factor):
    out = {}
    for w, n in words.items():
        others = sorted((-m, v) for v, m in words.items() if near(w, v))
        form = others[0][1] if others and -others[0][0] >= factor * n else None
        out[w] = [form, w, n, len(others), words[form] if form else None]
    for row in out.values():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def random_words():
    rng = np.random.default_rng(5)
    words = Counter()
    for base in ("abcdéf", "aabbcc", "mississippi", "zzzzzzz", "ÿàèüßø"):
        words[base] = 4000
        for _ in range(60):
            w = list(base)
            for _ in range(rng.integers(1, 4)):
                at = int(rng.integers(len(w)))
                kind = rng.integers(3)
                if kind == 0 and len(w) > 2:
                    del w[at]
                elif kind == 1:
                    w[at] = str(rng.choice(list("abcszéÿ")))
                else:
                    w.insert(at, str(rng.choice(list("abcszéÿ"))))
            words["".join(w)] = int(rng.choice([1, 5, 5, 30, 200, 1000]))
    words["x" * 3000] = 7
    words["x" * 2999] = 50
    return dict(words)


def test_variants_against_brute_force(spark):
    words = random_words()
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    want = brute(words, 5)
    for cells in (spelling.MAX_CELLS, 9):  # all filters at once; many rounds and parts
        rows = spelling.variants(table, 5, cells).collect()
        assert {r.word: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    assert any(r[0] and r[1] != r[0] for r in want.values())


def test_shards_hold_every_part_once_and_keep_the_bound():
    rounds = spelling._shards({5: 1000, 6: 10, 7: 10, 9: 333}, 50)
    held = [(length, p) for r in rounds for length, s in r.items() for p in s["held"]]
    assert len(held) == len(set(held))
    for r in rounds:
        assert sum(s["cells"] * len(s["held"]) for s in r.values()) <= 50
        for length, s in r.items():
            assert {p for n, p in held if n == length} == set(range(s["parts"]))


def test_vocabulary_of_hard_rows(spark, hard, empty):
    rows = [(r.doc_id, r.text) for r in hard.collect()]
    want, crc = Counter(), zlib.crc32
    for i, text in rows:
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            h = crc(f"{'' if i is None else i}:{run}".encode())
            want[run if h % 2 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    got = {r.word: r.n for r in spelling.vocabulary(hard, 3, 2, every=2).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 3 and n >= 2}
    plain = {r.word: r.n for r in spelling.vocabulary(hard, 3, 1).collect()}
    assert plain["word"] == 30_000 and plain["eleven"] == 3 and "no" not in plain
    assert spelling.variants(spelling.vocabulary(empty)).count() == 0


def test_very_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE_CHARS", 10)
    between = re.compile("[^a-z]")
    text = "abc defghijklmnop qr stuvw xyz " * 3 + "a" * 50
    pieces = list(spelling._pieces(text, between))
    assert "".join(pieces) == text and len(pieces) > 3
    assert sum((re.findall("[a-z]+", p) for p in pieces), []) == re.findall("[a-z]+", text)
