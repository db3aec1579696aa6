import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfproof.llm import decontaminate, fingerprint, html_text, line_dedup, near_dedup, pitman_yor, planes
from shelfproof.llm.words import NOT_ALNUM, WHITE, Words, blocks, shingle_sets

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = st.lists(st.none() | st.text(alphabet="aB1é日 \t\n.! \x1f", max_size=30), max_size=8)


@settings(deadline=None)
@given(TEXTS)
def test_words(texts):
    for table, pattern in ((WHITE, r"[^\x20\x09-\x0D]+"), (NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = Words(pa.array(texts, pa.string()), table)
        values = [v.decode() for v in words.values.to_pylist()]
        for i, text in enumerate(texts):
            got = [values[k] for k in words.ids[words.bounds[i]:words.bounds[i + 1]]]
            assert got == re.findall(pattern, (text or "").translate(LOWER))


def test_shingles_of_short_texts():
    sets = list(shingle_sets(pa.array(["a b c d", "a b", "a  B", "", None, "b a"]), 3))
    assert [len(s) for s in sets] == [2, 1, 1, 0, 0, 1]
    assert sets[1] == sets[2] and sets[1] != sets[5]


def test_blocks_keep_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (5, 0, 90, 3, 3)]})
    parts = list(blocks(iter([batch]), limit=10))
    assert [r for p in parts for r in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert [p.num_rows for p in parts] == [2, 1, 2]


@settings(deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60), st.integers(1, 70))
def test_suffix_array(words, depth):
    order = decontaminate.suffix_array(np.array(words, np.int64), depth)
    assert sorted(order.tolist()) == list(range(len(words)))
    cut = [tuple(words[i:i + depth]) for i in order]
    assert cut == sorted(cut)


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2 ** 32, n, dtype=np.uint32)
    payload = planes.pack(ids, kind)
    assert (planes.unpack(payload) == ids).all()
    if n:
        spoilt = payload[:-1] + bytes([payload[-1] ^ 1])
        with pytest.raises(ValueError):
            planes.unpack(spoilt)
    with pytest.raises(ValueError):
        planes.unpack(b"XXXX" + payload[4:])


def test_joined_crc():
    rng = random.Random(1)
    for _ in range(50):
        parts = [rng.randbytes(rng.randrange(40)) for _ in range(rng.randrange(1, 5))]
        assert planes.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@settings(deadline=None, max_examples=300)
@given(st.lists(st.none() | st.text(alphabet="ab'sZé×ß9日 \t\n\r.!% 　 \u0085\x1c", max_size=40),
                min_size=1, max_size=4))
def test_pieces_give_the_library_s_ids(texts):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = planes._encoder(path)
    ids, counts = encoder(pa.array(texts, pa.string()), 2)
    want = [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|", "endoftext", "|>", "a", "é", "日", "'s", " ", "  ", "\n",
                                          "\t", "\u3000", "9", "!", "<|endoftext", "|endoftext|>"]),
                         max_size=12).map("".join), min_size=1, max_size=4))
def test_added_tokens_keep_their_ids(texts):
    import public_tokenizers
    encoder = planes._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*texts, "a<|endoftext|>b", "a  <|endoftext|>  <|endoftext|>\n b", "<|endof", "text|>"]
    ids, counts = encoder(pa.array(texts, pa.string()), 2)
    want = [[*encoder.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]
    assert [64, 50256, 65, 2] in want


@pytest.mark.parametrize("odd", [{}, {"lstrip": True}, {"rstrip": True}, {"single_word": True}])
def test_other_added_tokens(odd, tmp_path):
    import public_tokenizers
    from tokenizers import AddedToken, Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.add_tokens([AddedToken("PAD", normalized=False, **odd), AddedToken("PADDED", normalized=False)])
    tokenizer.save(str(tmp_path / "t.json"))
    texts = ["PAD", "a PAD b", "aPADb  PADDED  PADPADDEDx", "", "<|endoftext|>", None, " PAD", "  "]
    ids, counts = planes.Encoder(str(tmp_path / "t.json"))(pa.array(texts, pa.string()), 2)
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_white_space_at_the_end_of_a_text_stays_whole():
    import public_tokenizers
    encoder = planes._encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a" + w * n for n in range(1, 9) for w in (" ", "\n", "\t")]
    ids, _ = encoder(pa.array(texts, pa.string()), 2)
    assert ids.tolist() == [i for t in texts for i in [*encoder.tokenizer.encode(t).ids, 2]]


def test_sketches():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 123, 5000, dtype=np.uint8)
    a, b = data[:4000], data[1000:]
    sa, sb = (fingerprint.sketch(fingerprint.shingles(x)) for x in (a, b))
    whole = fingerprint.sketch(fingerprint.shingles(data))
    cut = [fingerprint.sketch(fingerprint.shingles(x)) for x in (data[:2000], data[1993:])]
    assert (fingerprint.merge(*cut) == whole).all()
    assert abs(fingerprint.resemblance(sa, sb) - 0.6) < 0.15
    assert abs(fingerprint.containment(sa, whole) - 1.0) < 0.15
    assert abs(fingerprint.distinct(whole) / 4993 - 1) < 0.3
    assert (fingerprint.from_text(fingerprint.to_text(sa)) == sa).all()
    none = fingerprint.sketch(fingerprint.shingles(data[:0]))
    assert fingerprint.resemblance(none, none) == 1.0 and fingerprint.resemblance(none, sa) == 0.0


def _lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


SEQUENCES = st.lists(st.integers(0, 4), max_size=14)


@settings(deadline=None, max_examples=300)
@given(SEQUENCES, SEQUENCES)
def test_alignments(a, b):
    kept = html_text.aligned(a, b)
    rest = iter(b)
    assert len(kept) == _lcs(a, b) and all(any(a[i] == y for y in rest) for i in kept)
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x < z and y < w for (x, y), (z, w) in zip(pairs, pairs[1:]))
    assert line_dedup.patience(a, a) == [(i, i) for i in range(len(a))]


def test_overlap_bound():
    rng = np.random.default_rng(0)
    least = near_dedup.overlap(64, 85)
    for _ in range(300):
        values = rng.permutation(2 ** 20)[:1000]
        a, b = set(values[:925]), set(values[75:])  # 85 % alike
        assert len(set(sorted(a)[:64]) & set(sorted(b)[:64])) >= least


def test_pressed_arrays():
    arrays = [np.arange(7, dtype=np.uint16), np.zeros(0, np.int64), np.array([1.5, -2.0])]
    back = pitman_yor.unpress(pitman_yor.press(*arrays))
    assert all((x == y).all() and x.dtype == y.dtype for x, y in zip(arrays, back))


def test_seats_hold_all_customers():
    rng = np.random.default_rng(5)
    customers = np.array([2, 3, 9, 40, 2000, 2])
    pull = np.array([0.5, 3.0, 0.1, 5.0, 20.0, 1e-6])
    seats = pitman_yor.Seats(customers, pull, 0.7, rng)
    for _ in range(200):
        seats.move(pull)
        held = np.bincount(seats.dish, seats.sizes, len(customers))
        assert (held == customers).all() and (seats.sizes >= 0).all()
        assert (seats.t == np.bincount(seats.dish, seats.sizes > 0, len(customers))).all()
        assert (seats.t >= 1).all()
    assert seats.t[4] > seats.t[2] and seats.t[5] == 1


def test_seating_follows_the_model():
    """Two customers: the share of seatings with two tables is known."""
    rng = np.random.default_rng(9)
    pull, d, n = 0.6, 0.4, 4000
    seats = pitman_yor.Seats(np.full(n, 2), np.full(n, pull), d, rng)
    for _ in range(20):
        seats.move(np.full(n, pull))
    assert abs((seats.t == 2).mean() - pull / (pull + 1 - d)) < 0.03


def _stirling(most, d):
    """Generalised Stirling numbers by their definition, exact fractions."""
    row = [Fraction(0), Fraction(1)]
    for c in range(1, most):
        row = [Fraction(0)] + [row[t - 1] + ((c - t * d) * row[t] if t <= c else 0) for t in range(1, c + 2)]
    return row


@pytest.mark.parametrize("count, pull", [(2, 0.6), (9, 0.05), (9, 40.0), (60, 3.0), (60, 5000.0), (200, 0.7)])
def test_reseating_draws_from_the_weights_of_all_seatings(count, pull):
    d, n = Fraction(2, 5), 40_000
    row = _stirling(count, d)
    weight = np.array([float(row[t] / row[1] * Fraction(pull) ** t / Fraction(pull)) for t in range(1, count + 1)])
    drawn = pitman_yor.reseated(np.full(n, count), np.full(n, pull), pitman_yor.Ratios(0.4), np.random.default_rng(1))
    share = np.bincount(drawn - 1, minlength=count) / n
    assert np.abs(np.cumsum(share) - np.cumsum(weight / weight.sum())).max() < 0.012


def test_reseating_agrees_with_single_moves():
    """Many moves of single customers tend to the drawn number of tables."""
    rng, n, c, pull, d = np.random.default_rng(3), 3000, 40, 8.0, 0.6
    drawn = pitman_yor.reseated(np.full(20_000, c), np.full(20_000, pull), pitman_yor.Ratios(d), rng)
    seats, means = pitman_yor.Seats(np.full(n, c), np.full(n, pull), d, rng), []
    for _ in range(40):
        for _ in range(c):
            seats.move(np.full(n, pull))
        means.append(seats.t.mean())
    assert abs(np.mean(means[20:]) / drawn.mean() - 1) < 0.02


def test_reseating_mixes_counts():
    """Dishes of all sizes in one call get what they get alone, and later turns need no luck."""
    rng = np.random.default_rng(4)
    customers = np.array([2, 5000, 3, 700, 2, 41] * 500)
    pull = np.array([0.1, 30.0, 9.0, 500.0, 1e-9, 2.0] * 500)
    ratios = pitman_yor.Ratios(0.7)
    for turn in range(3):
        t = pitman_yor.reseated(customers, pull * (1 + turn), ratios, rng)
        assert (t >= 1).all() and (t <= customers).all()
    for i in range(6):
        alone = pitman_yor.reseated(customers[i::6], 3 * pull[i::6], pitman_yor.Ratios(0.7), rng)
        assert abs(t[i::6].mean() - alone.mean()) < 0.02 + 0.03 * alone.mean()
    assert len(pitman_yor.reseated(customers[:0], pull[:0], ratios, rng)) == 0


@pytest.mark.parametrize("d", [0.1, 0.5, 0.95])
def test_leaps_over_customers_agree_with_single_steps(d, monkeypatch):
    counts, widths = np.array([3000, 12_000]), np.array([150, 150])
    leaps = pitman_yor.Ratios(d)
    leaps.hold(counts, widths)
    monkeypatch.setattr(pitman_yor, "SINGLE", 1 << 60)
    single = pitman_yor.Ratios(d)
    single.hold(counts, widths)
    for c in counts.tolist():
        assert np.abs(leaps.rows[c][:150] - single.rows[c][:150]).max() < 1e-3


@pytest.mark.parametrize("d, c, pull", [(0.1, 10_000, 500.0), (0.5, 3000, 3000.0), (0.8, 10_000, 500.0),
                                        (0.95, 20_000, 160.0)])
def test_direct_draws_agree_with_the_weights(d, c, pull):
    n = 20_000
    drawn = pitman_yor.reseated(np.full(n, c), np.full(n, pull), pitman_yor.Ratios(d), np.random.default_rng(6))
    mean, spread, _ = (x[0] for x in pitman_yor._moments(np.array([float(c)]), np.array([pull]), d))
    assert mean > pitman_yor.DIRECT
    ratios, width = pitman_yor.Ratios(d), int(min(c, mean + 12 * spread ** 0.5 + 60))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pitman_yor, "SINGLE", 1 << 60)
        ratios.hold(np.array([c]), np.array([width]))
    t = np.arange(width)
    weight = ratios.rows[c][:width] - np.concatenate([[0.0], np.cumsum(np.log(t[1:]))]) + np.log(pull / d) * t
    weight = np.exp(weight - weight.max())
    share = np.bincount(np.minimum(drawn - 1, width - 1), minlength=width) / n
    assert np.abs(np.cumsum(share) - np.cumsum(weight / weight.sum())).max() < 0.012 + 0.012


def test_ten_million_customers_take_no_longer():
    ratios, rng, begin = pitman_yor.Ratios(0.7), np.random.default_rng(8), time.perf_counter()
    t = pitman_yor.reseated(np.full(2, 10 ** 7), np.array([0.5, 5e5]), ratios, rng)
    assert t[0] < 20 and t[1] > 10 ** 5 and time.perf_counter() - begin < 5


PAGE = """<html><head><title>No</title><style>p{}</style></head><body><header>Site</header>
<nav><a>Home</a></nav><div class="cookie-notice">Yes?</div><article><header><h1>Head  &amp; line</h1></header>
<p>One <b>bold</b>
two<p>Three&nbsp;four<div class="share-buttons">Share</div><script>var t="</p>";</script></article>
<section id="comments"><article class="comment"><p>Nice, this reader's comment is long, long, long.</p></article>
</section><aside>Side</aside><form>Form</form><footer>Foot</footer>"""


def test_page_reader():
    page = html_text.read(PAGE)
    assert page.blocks == ["Head & line", "One bold two", "Three four"] and not page.open
    assert html_text.read(None).blocks == [] and html_text.read("").blocks == []
    bare = html_text.read("<body><ul><li>a<li>b</ul><p>c<!-- x --><div hidden>no</div>")
    assert bare.blocks == ["a", "b", "c"] and bare.open
