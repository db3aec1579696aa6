"""Operators on small tables: hard rows, empty tables, and brute force where SQL has no form."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfproof.llm import (
    chat,
    decontaminate,
    fingerprint,
    graph,
    html_text,
    line_dedup,
    mixing,
    near_dedup,
    pitman_yor,
    planes,
    toxicity,
)
from tests.llm.conftest import HARD
from tests.llm.test_words_and_kernels import LOWER, PAGE

SMALL = "/root/testdata/sf0.001"


def tokenizer():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(small):
    return {r.doc_id: r.text for r in small.collect()}


# ---- near duplicates -------------------------------------------------------------------------

def test_near_duplicates_of_hard_rows(hard, empty):
    rows = near_dedup.groups(hard, size=3, percent=85).collect()
    assert len(rows) == len(HARD)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got >= {(1, 9, 1, True), (5, 9, 1, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True),
                   (8, 1, 8, True), (6, 1, 6, True)}
    assert near_dedup.groups(empty).count() == 0
    kept = near_dedup.deduplicate(hard, size=3, percent=85)
    assert kept.columns == hard.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 6, 7, 8]
    assert kept.filter("doc_id IS NULL").count() == 1
    assert near_dedup.deduplicate(empty).count() == 0


def test_chains_of_near_copies(spark):
    """Each text is an edit of the one before: ends are unlike, but all are one component."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(5000)]
    rows, n = [], 0
    for length in (40, 150, 700):
        text = list(rng.choice(words, length))
        for _ in range(40):
            rows.append((n, " ".join(text)))
            n += 1
            text[rng.integers(length)] = str(rng.choice(words))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(t.split()[k:k + 3]) for k in range(len(t.split()) - 2)} for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.groups(docs, 3, 85).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in sets}


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (7, 7)]
    got = dict(tuple(r) for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(31)} | {90: 90, 95: 90, 100: 90}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- lines ---------------------------------------------------------------------------------

def test_line_dedup(spark, hard, empty, texts, small):
    rows = {r.doc_id: r for r in line_dedup.deduplicate(small).collect()}
    lines = {i: [x.strip() for x in t.split("\n")] for i, t in texts.items()}
    first, seen = {}, set()
    for i in sorted(texts):
        gone = set()
        if texts[i] in seen:
            gone = set(range(len(lines[i]))) if sum(map(len, lines[i])) >= 100 else set()
        else:
            for e in {first[x] for x in lines[i] if len(x) >= 20 and x in first}:
                gone |= set(line_dedup.repeated(lines[i], [len(x) for x in lines[i]], lines[e]))
            for x in lines[i]:
                if len(x) >= 20:
                    first.setdefault(x, i)
            seen.add(texts[i])
        left = "\n".join(x for k, x in enumerate(texts[i].split("\n")) if k not in gone)
        assert (rows[i].n_deleted, rows[i].text) == (len(gone), left)
    assert line_dedup.deduplicate(hard).count() == len(HARD)
    assert line_dedup.deduplicate(hard).filter("doc_id = 2").first().text is None
    assert line_dedup.deduplicate(empty).count() == 0


def test_line_dedup_meets_whole_blocks(spark):
    """The lines of a block may each have another first holder than the block has."""
    a, b, c = ("".join(x * 60) for x in "abc")
    rows = [(1, f"{a}\n1"), (2, f"{b}\n2"), (3, f"{a}\n{b}"), (4, f"4\n{a}\n{b}\nfour"),
            (5, f"{c}{c}\n5"), (6, f"{c}{c}\nend"), (7, f"{c}{c}\nend\n7")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in line_dedup.deduplicate(docs).collect()}
    assert left == {1: f"{a}\n1", 2: f"{b}\n2", 3: f"{a}\n{b}", 4: "4\nfour", 5: f"{c}{c}\n5", 6: "end", 7: "7"}


def test_line_dedup_is_as_good_as_all_partners(spark):
    rng = np.random.default_rng(2)
    lines = [f"{i:03d}" + "x" * int(rng.choice([0, 5, 30, 60, 120])) for i in range(60)]
    rows = []
    for i in range(120):
        picked = [lines[k] for low in sorted(rng.integers(0, 60, 3)) for k in range(low, min(low + 4, 60))]
        rows.append((i, "\n".join(dict.fromkeys(picked))))
    got = {r.doc_id: r.text for r in line_dedup.deduplicate(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        own = text.split("\n")
        gone = set()
        for _, other in rows[:i]:
            gone |= set(line_dedup.repeated(own, [len(x) for x in own], other.split("\n")))
        assert got[i] == "\n".join(x for k, x in enumerate(own) if k not in gone)


# ---- pages ---------------------------------------------------------------------------------

def test_main_text(spark):
    site = [(i, f"http://h.example/a/{i}", f"<body><p>Same menu of the site<p>Own text {i}<p>Same end</body>")
            for i in range(6)]
    rows = site + [(50, None, PAGE), (51, "http://h.example/z", None), (52, "http://o.example/1", ""),
                   (None, "http://o.example/2", "<p>x"), (53, "http://o.example/3", "<p>" + "long " * 50_000),
                   (53, "http://o.example/3", "<p>" + "long " * 50_000)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows],
                                  "page_id long, url string, html string, text string, host int")
    got = html_text.main_text(pages)
    assert got.count() == len(rows)
    found = {r.page_id: (r.text, r.n_chars) for r in got.collect()}
    assert all(found[i] == (f"Own text {i}", 10) for i in range(6))
    assert found[50][0] == "Head & line\nOne bold two\nThree four"
    assert found[51] == found[52] == ("", 0) and found[None][0] == "x" and found[53][1] == 249_999
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_articles_meet_their_neighbours(spark):
    def page(i, inside, outside=""):
        return f"<body>{outside}<article><h1>Head {i}</h1><p>Own text of page {i}, long enough</p>{inside}</article>"

    every, some = "<p>Read it in our app", "<p>This work is free to copy"
    rows = [(i, f"http://a.example/{i}", page(i, every + (some if i in (2, 3, 4) else ""))) for i in range(8)]
    # Too few pages to tell; pages that are copies; one text under many addresses.
    rows += [(10 + i, f"http://b.example/{i}", page(i, every)) for i in range(4)]
    rows += [(20 + i, f"http://c.example/{i}", page(0, every + some)) for i in range(6)]
    rows += [(30 + i, f"http://d.example/{i}", page(i if i > 5 else 0, some)) for i in range(9)]
    rows += [(60 + i, f"http://a.example/5?x={i}", page(5, every)) for i in range(4)]
    # An article page tells what is outside of articles; what is inside of its own is no evidence.
    rows += [(40, "http://e.example/0", page(0, some, "<p>Menu without a mark")),
             (41, "http://e.example/1", "<p>Menu without a mark<p>This work is free to copy<p>Open page's own text")]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string")
    parsed = html_text.staged(pages.mapInArrow(
        html_text._parse, "page_id long, row long, host string, path string, hashes array<long>, "
                          "place array<tinyint>, sizes array<int>"))
    assert parsed.filter("size(hashes) = 0").count() == 0
    assert len(html_text.deletions(parsed).collect()) == 8 + 1
    got = html_text.main_text(pages).collect()
    assert len(got) == len(rows) + 1
    found = {r.page_id: r.text.split("\n") for r in got}
    own = {i: [f"Head {i}", f"Own text of page {i}, long enough"] for i in range(10)}
    app, free = "Read it in our app", "This work is free to copy"
    assert all(found[i] == own[i] + ([free] if i in (2, 3, 4) else []) for i in range(8))
    assert all(found[60 + i] == own[5] for i in range(4))
    assert all(found[10 + i] == [*own[i], app] for i in range(4))
    assert all(found[20 + i] == [*own[0], app, free] for i in range(6))
    assert all(found[30 + i] == [*own[i if i > 5 else 0], free] for i in range(9))
    assert found[40] == [*own[0], free] and found[41] == [free, "Open page's own text"]


def test_neighbours_do_not_depend_on_ranges(spark):
    rows = [(i, "h" if i % 3 else "g", f"/{i % 10}", i) for i in range(60)]
    table = spark.createDataFrame(rows, "row long, host string, path string, page_id long")
    want = {}
    for host in "gh":
        order = sorted((p, i) for i, h, p, _ in rows if h == host)
        for k, (_, i) in enumerate(order):
            want[i] = (order[k - 1][1] if k else None, order[k + 1][1] if k + 1 < len(order) else None)
    for parts in (1, 7):
        got = {r.row: (r.before, r.after) for r in html_text.neighbours(table.repartition(parts)).collect()}
        assert got == want


# ---- toxicity ------------------------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.train(docs, labels, toxicity.remainder(F.col("_id"), 5) == 0)
    rows = toxicity.scores(docs, model).join(labels, "doc_id") \
        .withColumn("out", toxicity.remainder(F.col("doc_id"), 5) == 0).collect()
    for out in (True, False):
        bad = [r.score for r in rows if r.out == out and r.toxic]
        good = [r.score for r in rows if r.out == out and not r.toxic]
        assert np.mean([s < 0.5 for s in good]) > 0.98 and np.mean([s >= 0.5 for s in bad]) > 0.6
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_of_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame([(1, None), (5, 1), (5, 0), (6, 0), (None, 1)], "doc_id long, toxic int")
    for table in (labels, labels.limit(0)):
        model = toxicity.train(hard, table, F.lit(False))
        assert toxicity.scores(hard, model).count() == len(HARD)
        assert toxicity.clean(hard, model).columns == hard.columns
        assert toxicity.scores(empty, model).count() == 0
    assert toxicity.train(empty, labels.limit(0), F.lit(False)).terms == []


# ---- language model ------------------------------------------------------------------------

def test_language_model(small, texts, spark):
    held = toxicity.remainder(F.col("doc_id"), 7) == 2
    rows = {r.doc_id: r for r in pitman_yor.scores(small, held).collect()}
    words = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER)), None] for i, t in texts.items()}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    count = Counter(w for i in texts if not out[i] for w in words[i])
    n, v = sum(count.values()), len(count)
    for i, r in rows.items():
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words[i])
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words[i]), sum(count[w] > 0 for w in words[i]), n)
    for side in (True, False):
        assert sum(rows[i].score for i in rows if out[i] == side) > sum(
            rows[i].base_score for i in rows if out[i] == side)


def test_language_model_sums_to_one(spark):
    """All words, the unknown one and the end share the probability of what follows."""
    rng = np.random.default_rng(1)
    names = [f"w{i}zz" for i in range(30)]  # one context after any of them
    train = [(i, " ".join(rng.choice(names, 50, p=np.arange(1, 31) / 465))) for i in range(40)]
    every = [*names, "newzz"]
    asked = [(1000 + i, w) for i, w in enumerate(every)] + [(1100 + i, f"{names[3]} {w}") for i, w in enumerate(every)]
    docs = spark.createDataFrame([*train, *asked, (2000, None)], "doc_id long, text string")
    rows = {r.doc_id: 10 ** r.score for r in pitman_yor.scores(docs, F.col("doc_id") >= 1000).collect()}
    one = [rows[1000 + i] for i in range(31)]
    two = [rows[1100 + i] for i in range(31)]
    # one: p(word | start) e, two: p(third | start) p(word | context) e, e being p(end | context).
    e = 1 - sum(two) / one[3]
    assert 0 < e < 1 and abs(sum(one) / e + rows[2000] - 1) < 1e-6
    assert rows[1029] > rows[1000] > rows[1030]


def test_language_model_of_hard_rows(hard, empty):
    rows = pitman_yor.scores(hard, F.coalesce(F.col("doc_id") == 8, F.lit(False))).collect()
    assert len(rows) == len(HARD) and all(math.isfinite(r.score) for r in rows)
    assert {r.doc_id: r.n_tokens for r in rows}[2] == 1
    untrained = pitman_yor.scores(hard, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.score == 0.0 for r in untrained)
    assert pitman_yor.scores(empty, F.lit(False)).count() == 0


# ---- conversations -------------------------------------------------------------------------

def test_branches(spark):
    rows = [("t", 1, None, "user", "a", 0.0), ("t", 2, 1, "assistant", "b", 1.0), ("t", 3, 1, "assistant", "c", 5.0),
            ("t", 4, 3, "user", "d", 1.0), ("t", 5, 2, "user", None, 9.0),
            ("u", 1, None, "user", "only", None), ("v", 1, 2, "user", "x", 1.0), ("v", 2, 1, "user", "y", 1.0),
            ("w", 1, 77, "user", "orphan", 1.0), ("x", None, None, "user", "no node", 1.0)]
    table = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = {(r.tree, r.leaf): r["rank"] for r in chat.conversations(table, top=None).collect()}
    assert got == {("t", 5): 1, ("t", 4): 2, ("u", 1): 1}
    best = {r.tree: r for r in chat.conversations(table).collect()}
    assert best["t"].formatted == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n<|user|>\n<|end|>\n"
    (span,) = best["t"].loss
    assert best["t"].formatted[span.start:span.start + span.length] == "b"
    assert chat.conversations(table.limit(0)).count() == 0


@pytest.mark.parametrize("text", [
    "<|end|>\n", "<\\|end|>", "</s>[INST] ok [/INST]", "<<SYS>><</SYS>>", "<\\\\\\|<|<", "[\\/INST][INST", "\n\n",
    "日本 <|é|>", "$1 \\ $"])
def test_escapes_are_undone(spark, text):
    rows = [("t", 1, None, "a|>\n b", text, 0.0), ("t", 2, 1, "assistant", text, 0.0)]
    table = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    chats = chat.conversations(table)
    (row,) = chats.select(chat.read_back(F.col("formatted")).alias("r"),
                          chat.masked_text(F.col("formatted"), F.col("loss")).alias("m"), "formatted").collect()
    assert [(t.role, t.text) for t in row.r] == [("a|>\n b", text), ("assistant", text)] and row.m == text
    assert row.formatted.count("<|end|>") == 2 and "[INST]" not in row.formatted


# ---- token files ---------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_files(spark, hard, empty, kind):
    path = planes.write(hard, tokenizer(), 2, chunk_ids=1000, kind=kind)
    files = spark.read.parquet(path)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in planes.documents(files).collect())
    encode = planes._encoder(tokenizer()).tokenizer.encode
    want, start, stream = [], 0, []
    for i, t in sorted(HARD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*encode(t or "", add_special_tokens=False).ids, 2]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
        stream += ids
    assert got == sorted(want)
    chunks = planes.ids(files).orderBy("shard", "chunk").collect()
    assert [i for c in chunks for i in c.ids] == stream
    assert planes.documents(spark.read.parquet(planes.write(empty, tokenizer(), 2))).count() == 0


# ---- benchmark -----------------------------------------------------------------------------

def test_matches(spark, hard, empty):
    items = spark.createDataFrame(
        [(1, "Two THREE, four five six seven eight nine ten eleven"), (2, "lone"), (3, None), (4, "..."),
         (2, "lone"), (None, "word word word"), (9, "not there at all")], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.matches(hard, items).collect()}
    assert (rows[1].n_words, rows[1].n_hit, rows[1].item_ids) == (11, 10, ["1"])
    assert [tuple(m) for m in rows[1].matches] == [("1", 1, 0, 10)]
    assert (rows[8].n_hit, rows[8].item_ids) == (1, ["2"])
    assert (rows[6].n_hit, rows[6].item_ids) == (30_000, ["null"])
    assert rows[2].n_words == rows[2].n_hit == 0
    left = decontaminate.clean(hard, items)
    assert left.columns == hard.columns
    assert sorted(r.doc_id for r in left.filter("doc_id IS NOT NULL").collect()) == [2, 3, 4, 7]
    assert decontaminate.matches(empty, items).count() == 0
    assert decontaminate.clean(hard, items.limit(0)).count() == len(HARD)


def test_longest_matches(spark):
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(1, " ".join(["x", *words[5:40], "y", *words[20:35]]))], "doc_id long, text string")
    items = spark.createDataFrame([("a", " ".join(words))], "item_id string, text string")
    row = decontaminate.matches(docs, items).first()
    assert [tuple(m) for m in row.matches] == [("a", 1, 5, 35), ("a", 37, 20, 15)] and row.n_hit == 50


# ---- fingerprints --------------------------------------------------------------------------

def test_fingerprints(small, texts):
    rows = {r.doc_id: r for r in fingerprint.compare_with_next(small).collect()}
    order = sorted(texts)
    for k, i in enumerate(order):
        text, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        runs = [{t.encode()[j:j + 8] for j in range(max(1, len(t.encode()) - 7))} for t in (text, edited)]
        assert abs(rows[i].near_edited - len(runs[0] & runs[1]) / len(runs[0] | runs[1])) < 0.2
    same = {}
    for i in order:
        same.setdefault(texts[i], set()).add(rows[i].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_fingerprints_of_hard_rows(hard, empty):
    rows = fingerprint.compare_with_next(hard).collect()
    assert len(rows) == len(HARD)
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3)} == {""}
    assert fingerprint.compare_with_next(empty).count() == 0
    alone = fingerprint.compare_with_next(hard.filter("doc_id = 8")).collect()
    assert alone[0].near_next == 1.0


# ---- mixing --------------------------------------------------------------------------------

def mixture(spark):
    rows = [(i, "big" if i < 80 else "small" if i < 95 else None, "w " * (i % 7 + 1)) for i in range(100)]
    return spark.createDataFrame([(*r, 5, "k") for r in rows], "doc_id long, source string, text string, tokens int, id string")


def test_mix_meets_its_target(spark):
    docs = mixture(spark)
    rows = docs.select(F.col("doc_id").alias("id"), "source", mixing.tokens(F.col("text")).alias("tokens"))
    table = mixing.shares(rows)
    power = mixing.exponent(table, entropy=0.8)
    shares = {r.source: r.weight for r in mixing.weights(table, power).collect()}
    entropy = -sum(p * math.log(p) for p in shares.values()) / math.log(3)
    assert abs(entropy - 0.8) < 1e-4 and abs(sum(shares.values()) - 1) < 1e-9
    limited = mixing.weights(table, mixing.exponent(table, repeats=1.5)).collect()
    assert max(r.quota / r.tokens for r in limited) <= 1.51
    with pytest.raises(ValueError):
        mixing.exponent(table)
    used = mixing.mixed(docs, blocks=4, entropy=0.8).collect()
    quota = {r.source: r.quota for r in mixing.weights(table, power).collect()}
    for source, held in quota.items():
        dealt = sum(r.tokens for r in used if r.source == source)
        assert held <= dealt < held + 7
        for block in range(4):
            part = sum(r.tokens for r in used if r.source == source and r.block == block)
            assert abs(part - held / 4) <= 7
    seen = Counter((r.id, r.epoch) for r in used)
    assert max(seen.values()) == 1


def test_mixed_rows_keep_their_columns(spark, hard, empty):
    docs = mixture(spark)
    out = mixing.reweighted(docs, blocks=4, entropy=0.8)
    assert out.columns == docs.columns and out.count() == len(mixing.mixed(docs, 4, entropy=0.8).collect())
    assert mixing.reweighted(hard, entropy=0.9).columns == hard.columns
    assert mixing.reweighted(empty, entropy=0.9).count() == 0
    assert mixing.mixed(empty, 4, repeats=2.0).count() == 0
