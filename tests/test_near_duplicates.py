"""The keyed search against a comparison of all pairs."""

import random

from shelfproof.operators import near_duplicates


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for cx in x:
        new = [0]
        for j, cy in enumerate(y):
            new.append(row[j] + 1 if cx == cy else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def is_near(one, two, percent):
    """The definition, in whole numbers; gives (near, score)."""
    a, b = set(one.split()), set(two.split())
    if not a or not b:
        return False, 0.0
    both, da, db = a & b, " ".join(sorted(a - b)), " ".join(sorted(b - a))
    if both and (not da or not db):
        return True, 100.0
    s = len(" ".join(sorted(both)))
    gap = 1 if s else 0
    ratios = [(len(da) + len(db) - 2 * lcs(da, db), 2 * (s + gap) + len(da) + len(db))]
    if s:
        ratios += [(1 + len(x), 2 * s + 1 + len(x)) for x in (da, db)]
    near = any(100 * dist <= (100 - percent) * base for dist, base in ratios)
    return near, max(100 - 100 * dist / base for dist, base in ratios)


def expected(rows, percent=97):
    """(record, earliest match, number of matches)."""
    out = {}
    for b in rows:
        for a in rows:
            if not (a[0] < b[0] and a[2] is not None and a[2] == b[2]):
                continue
            if a[1] is None or b[1] is None or a[0] == b[3] or b[0] == a[3]:
                continue
            if is_near(a[1], b[1], percent)[0]:
                out.setdefault(b[0], []).append(a[0])
    return sorted((b, min(ids), len(ids)) for b, ids in out.items())


def actual(spark, rows, percent=97):
    df = spark.createDataFrame(rows, "article_id string, article_description string, "
                                     "merch_category string, parent_article_id string")
    counted = near_duplicates.match_counts(df, percent)
    named = near_duplicates.flagged(df, percent).select("record_id", "first_match")
    got = sorted((r.record_id, r.first_match, r.matches) for r in counted.collect())
    assert sorted((r.record_id, r.first_match) for r in named.collect()) == [g[:2] for g in got]
    return got


def mutated(rng, words, size, count, edits):
    """Random texts, most of them a slightly changed copy of an earlier one."""
    texts = []
    for _ in range(count):
        if texts and rng.random() < 0.8:
            text = rng.choice(texts)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(text) + 1)
                kind = rng.random()
                if kind < 0.35:
                    text = text[:at] + text[at + 1:]
                elif kind < 0.7:
                    text = text[:at] + rng.choice("abz 1") + text[at:]
                else:
                    parts = text.split()
                    rng.shuffle(parts)
                    text = " ".join(parts[:-1] if rng.random() < 0.3 else parts)
        else:
            text = " ".join(rng.choice(words) for _ in range(rng.randint(*size)))
        texts.append(text)
    return texts


WORDS = ["cola", "water", "lemon", "zero", "classic", "multipack", "750", "12", "a", "xl", "ab"]


LONG = "sparkling mineral water from the northern springs in returnable glass bottles " \
       "for the catering trade only a b c d e f g h i j k l m n o p"


def test_all_pairs_found(spark):
    """Short and long texts, a category for each kind, in one run."""
    rng = random.Random(3)
    words = WORDS + [f"w{n:03d}" for n in range(40)]
    kinds = {"few": ((1, 4), 2), "some": ((4, 8), 3), "many": ((7, 14), 5), "long": ((15, 40), 12)}
    texts = [(kind, text) for kind, (size, edits) in kinds.items()
             for text in mutated(rng, words, size, 140, edits)]
    # Serial numbers, padded and not, in texts where one or two edits are allowed.
    texts += [("serial", f"Sparkling Widget {n}") for n in range(95, 240)]
    texts += [("serial2", f"Sparkling Widget Classic Edition {n:04d}") for n in range(0, 900, 7)]
    texts += [("letters", t) for t in (
        LONG, LONG + " q r", LONG.replace(" c d ", " "), LONG.replace("water", "waters"),
        LONG[:23], LONG[:60], LONG[-31:])]
    rng.shuffle(texts)
    ids = [f"T{n:04d}" for n in range(len(texts))]
    rows = [(i, text, kind, rng.choice(ids) if rng.random() < 0.2 else None)
            for i, (kind, text) in zip(ids, texts)]
    # Some parents inside the category, so that kin occurs in groups.
    by_kind = {}
    for i, (kind, _) in zip(ids, texts):
        by_kind.setdefault(kind, []).append(i)
    rows = [(i, t, k, rng.choice(by_kind[k]) if rng.random() < 0.3 else p) for i, t, k, p in rows]
    want = expected(rows)
    assert len(want) > 300
    assert actual(spark, rows) == want


def test_candidates_of_serial_numbers_are_few(spark):
    rows = [(f"S{n:05d}", f"Sparkling Widget {n}", "a", None) for n in range(1, 3000)]
    rows += [(f"P{n:05d}", f"Sparkling Widget Classic Edition {n:06d}", "b", None)
             for n in range(1, 3000)]
    df = spark.createDataFrame(rows, "article_id string, article_description string, "
                                     "merch_category string, parent_article_id string")
    classes = near_duplicates.classes_of(near_duplicates.describe(df)).persist()
    found = near_duplicates._keyed_candidates(classes, 97).distinct().count()
    assert found <= 1.1 * near_duplicates.similar_classes(classes).count()


def test_large_class_linked_to_many(spark):
    """Copies of a word that is part of many descriptions, on either side of them."""
    rows = [(f"A{n:04d}", "Water", "c", None) for n in range(0, 300, 2)]
    rows += [(f"A{n:04d}", f"Water still {n}", "c", None) for n in range(1, 300, 2)]
    assert actual(spark, rows) == expected(rows)


def test_other_threshold(spark):
    rng = random.Random(9)
    rows = [(f"T{n:03d}", t, "c", None)
            for n, t in enumerate(mutated(rng, WORDS, (3, 6), 80, 3))]
    assert actual(spark, rows, 90) == expected(rows, 90)


def test_named_cases(spark):
    rows = [
        ("A1", "Soft Drink Range 123 - 375ml", "c", None),
        ("A2", "Soft Drink Range 123 - 600ml", "c", None),
        ("B1", "Chocolate Supreme 1234567890", "d", None),
        ("B2", "Chocolate Supremee 1234567890", "d", None),
        ("C1", "Gum Std 5", "e", None), ("C2", "Gum Std 5 V2", "e", None),
        ("C3", "Gum Std 5", "e", "C1"),  # its parent does not count, C2 does
        ("D1", "Pie", None, None), ("D2", "Pie", None, None),
        ("E1", None, "f", None), ("E2", "  ", "f", None), ("E3", "", "f", None),
    ]
    assert actual(spark, rows) == [("B2", "B1", 1), ("C2", "C1", 1), ("C3", "C2", 1)]


def test_hot_group_of_copies_stays_linear(spark):
    """Three thousand copies: a row per record, with the number of earlier copies."""
    rows = [(f"H{n:05d}", "Water Still 600ml" if n % 2 else "600ml Still Water", "c", None)
            for n in range(3000)]
    got = actual(spark, rows)
    assert [g[1] for g in got] == ["H00000"] * 2999
    assert [g[2] for g in got] == list(range(1, 3000))


def test_a_family_that_is_all_alike_stays_linear(spark, monkeypatch):
    """Long texts that differ in a serial number: all pairs match, few are compared."""
    counted = {}
    scored = near_duplicates._scored
    for size in (400, 800):
        rows = [(f"S{n:05d}", f"{LONG} serial {n:05d}", "a", None) for n in range(size)]
        df = spark.createDataFrame(rows, "article_id string, article_description string, "
                                         "merch_category string, parent_article_id string")
        seen = []

        def count(candidates, classes, threshold, seen=seen):
            seen.append(candidates.count())
            return scored(candidates, classes, threshold)

        monkeypatch.setattr(near_duplicates, "_scored", count)
        got = sorted((r.record_id, r.first_match) for r in near_duplicates.flagged(df).collect())
        assert got == [(f"S{n:05d}", "S00000") for n in range(1, size)]
        counted[size] = sum(seen)
    assert counted[800] <= 2.1 * counted[400] <= 2.1 * 2 * 400


def test_keys_are_few_and_rounds_go_on(spark, monkeypatch):
    """Ten keys a text at most where k is 2 or 3; lists longer than a round are read to their end."""
    rng = random.Random(8)
    texts = [f"{rng.randint(1, 50)} {rng.choice(['SMALL', 'LARGE'])} {rng.choice(['cold', 'blue'])} "
             f"{rng.choice(['ring', 'bolt'])} {rng.getrandbits(64):016x}{'x' * rng.choice([0, 21])}" for _ in range(900)]
    rows = [(f"T{n:04d}", t, "c", None) for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "article_id string, article_description string, "
                                     "merch_category string, parent_article_id string")
    classes = near_duplicates.classes_of(near_duplicates.describe(df))
    keys = near_duplicates._edit_keys(near_duplicates._with_features(classes, 97))
    assert keys.count() <= 10 * classes.count()
    # A shared rare word and nothing else: only the last ones match.
    rows = [(f"R{n:04d}", f"common {rng.getrandbits(90):023x}", "c", None) for n in range(150)]
    rows += [("Z1", "common 0123456789abcdef0123456", "c", None),
             ("Z2", "common 0123456789abcdef012345", "c", None), ("Z3", "common", "c", "R0000")]
    monkeypatch.setattr(near_duplicates, "ROUND", 1)
    monkeypatch.setattr(near_duplicates, "GROWTH", 3)
    monkeypatch.setattr(near_duplicates, "CHUNK", 2)
    df = spark.createDataFrame(rows, df.schema)
    named = sorted((r.record_id, r.first_match) for r in near_duplicates.flagged(df).collect())
    assert named == [e[:2] for e in expected(rows)]


def test_a_code_is_a_key_alone(spark):
    """Tokens that many descriptions share are no keys beside one too long to be missing."""
    codes = [f"{i * 2654435761 % 2 ** 64:016x}" for i in range(1, 61)]
    rows = [(f"A{i:03d}", f"large ring {i % 3} {code}", "c", None) for i, code in enumerate(codes)]
    df = spark.createDataFrame(rows, "article_id string, article_description string, "
                                     "merch_category string, parent_article_id string")
    classes = near_duplicates._with_features(
        near_duplicates.classes_of(near_duplicates.describe(df)), 97)
    keys = near_duplicates._token_keys(classes)
    assert keys.where(f"kind = {near_duplicates.RARE}").count() == len(rows)
    shared = near_duplicates._shared(keys, classes)
    assert shared.count() == 0
    again = [*rows, ("A900", f"ring large {codes[5]}", "c", None), ("A901", "large ring 1", "c", None),
             ("A902", "a b c d", "c", None), ("A903", "d c b a e", "c", None)]
    assert actual(spark, [(a, d, c, p) for a, d, c, p in again]) == expected(again)


def test_codes_in_crowded_families_have_few_keys(spark):
    """Where the lists of six keys are long, fifteen closer ones take their place, not hundreds."""
    rng = random.Random(12)
    codes = [f"{rng.getrandbits(64):016x}" for _ in range(1500)]
    rows = [(f"F{i:04d}", f"large ring LARGE {i % 2} {code}", "c", None) for i, code in enumerate(codes)]
    # One digit replaced, one taken away, two taken away.
    rows += [(f"G{i:04d}", f"large ring LARGE {i % 2} {code}", "c", None) for i, code in (
        (0, codes[0][:-1] + ("0" if codes[0][-1] != "0" else "1")), (1, codes[1][:7] + codes[1][8:]),
        (2, codes[2][1:-1]))]
    df = spark.createDataFrame(rows, "article_id string, article_description string, "
                                     "merch_category string, parent_article_id string")
    classes = near_duplicates._with_features(
        near_duplicates.classes_of(near_duplicates.describe(df)), 97).persist()
    assert near_duplicates._edit_keys(classes).count() <= (6 + 15) * classes.count()
    named = sorted((r.record_id, r.first_match) for r in near_duplicates.flagged(df).collect())
    assert named == [(f"G{i:04d}", f"F{i:04d}") for i in range(3)]


def test_postings_that_few_ask_are_not_copied(spark):
    rows = [(f"A{i:04d}", f"Sparkling Widget Classic {i // 2:06d}{' x' * (i % 2)}", "c", None) for i in range(200)]
    df = spark.createDataFrame(rows, "article_id string, article_description string, "
                                     "merch_category string, parent_article_id string")
    classes = near_duplicates._with_features(
        near_duplicates.classes_of(near_duplicates.describe(df)), 97).persist()
    postings, asks = near_duplicates._numbered(near_duplicates._keys(classes))
    assert {r.salts for r in postings.select("salts").distinct().collect()} == {1}
    assert {r.salts for r in asks.select("salts").distinct().collect()} == {1}
