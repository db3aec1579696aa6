"""Near-duplicate descriptions within a category, without comparing all pairs.

The score depends only on the set of tokens, so records with equal token sets form one class
and classes are compared instead of records. A group of copies, however large, is one class.

Which classes can be similar (n = length of the joined tokens, t = allowed share of the distance):
  A. One class, less some short tokens, is a subset of the other. Its rarest tokens, so many that
     they are too long to be missing all, meet the tokens of the other: one of them is there.
     A token too long to be missing is enough, such as a code that few others have.
  B. The texts differ by d <= k = floor(2t/(1-t) n) inserted or deleted characters (or blanks), n
     being the shorter one's length. An edit changes one character of the multiset of characters
     and three at most of the multiset of pairs of adjacent ones (blanks around tokens included;
     the order of tokens does not matter). Dealt into more groups than edits can reach, some groups
     are the same on both sides, and these are the keys:
       k = 1     the token sets after one deletion (a key per character)
       k = 2     characters in four groups, two of them the same: six keys
       k = 3     characters in five groups, two of them the same: ten keys
       k >= 4    adjacent pairs in 3k + 1 groups, one of them the same
     Where many classes share a key for k = 2, such as texts with codes, these classes get fifteen
     of characters in six groups, four of them the same. Where many share one of these, such as
     texts with serial numbers, the classes get the exact keys of one deletion on either side,
     and of two characters less, which are hundreds.
Both give candidates only. Bitmaps of tokens and of adjacent pairs rule out most of them in the join;
each other one is scored, so no hash collision can do harm.

The result has a row per record that has earlier near-duplicates, not per pair: copies may be a
third of all records, and their pairs too many to store. `first_match` is the earliest of them.
`flagged` looks for it alone: the classes of a key are numbered by their earliest record, every
class is compared with the first few of each of its keys, then with more and more, until it
has a match that no later one can precede. So a family of many classes that are all alike costs
a comparison or two per class, not one per pair. `match_counts` adds `matches`, how many there are,
so that its sum is the number of pairs; it needs all links between classes.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfproof.functions import similarity
from shelfproof.session import cut_lineage, written


def _hash40(item: Column) -> Column:
    """Of a token or character. Forty bits, so that sums of up to 2^23 of them fit a long."""
    return F.shiftrightunsigned(F.xxhash64(item), 24)


def _allowance(threshold: int) -> float:
    share = 1 - threshold / 100
    return 2 * share / (1 - share)


def describe(articles: DataFrame) -> DataFrame:
    """Articles with a category and a description, with their token set and class."""
    tokens = similarity.token_set(F.col("article_description"))
    return (articles.select("article_id", "parent_article_id", "merch_category",
                            tokens.alias("tokens"))
            .where(F.col("merch_category").isNotNull() & (F.size("tokens") > 0))
            .withColumn("class", F.unhex(F.md5(F.concat_ws("\x1f", F.col("merch_category"),
                                                           similarity.joined(F.col("tokens")))))))


def classes_of(described: DataFrame) -> DataFrame:
    """One row per class: its earliest and last record, and whether any has a parent."""
    return (described.groupBy("class")
            .agg(F.any_value("merch_category").alias("category"),
                 F.any_value("tokens").alias("tokens"), F.count(F.lit(1)).alias("members"),
                 F.min("article_id").alias("first"), F.max("article_id").alias("last"),
                 F.max("parent_article_id").alias("parent"))
            .withColumn("length", F.length(similarity.joined(F.col("tokens")))))


def _allowed(length: Column, threshold: int) -> Column:
    """floor(allowance * n) in integers: 2(100-T) n / T."""
    return F.floor(length * (2 * (100 - threshold)) / F.lit(threshold)).cast("int")


# ---- keys ----------------------------------------------------------------------------------------

#: How a class takes part in a list of classes that share a key: among its likes; or as one that
#: meets those of the other kind: with and without a deletion, by rarest tokens and by all.
ALIKE, LESS, WHOLE, RARE, ALL = range(5)
#: Words of 64 bits in the bitmap of adjacent pairs.
WORDS = 4
#: Classes with a key for k = 2 from which on more exact keys are used instead.
DENSE = 33
#: The same for the more exact keys: chance hits are fewer there.
DENSE_CLOSER = 9


def _total() -> Column:
    return F.aggregate("tokens", F.lit(0).cast("long"), lambda s, x: s + _hash40(x))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _pairs() -> Column:
    """Adjacent pairs of characters of `padded`."""
    return F.transform(F.sequence(F.lit(1), F.col("length") + 1), lambda i: F.col("padded").substr(i, F.lit(2)))


def _padded() -> Column:
    return F.concat(F.lit(" "), similarity.joined(F.col("tokens")), F.lit(" "))


def _with_features(classes: DataFrame, threshold: int) -> DataFrame:
    """Add k, and the bounds and bitmaps that candidates are judged by (`x`)."""
    spots = F.transform(_pairs(), lambda p: F.pmod(_hash40(p), F.lit(64 * WORDS)))
    bits = [F.aggregate(F.filter("spots", lambda p: F.floor(p / 64) == w), F.lit(0).cast("long"),
                        lambda s, p: s.bitwiseXOR(_bit(p % 64))) for w in range(WORDS)]
    sig = F.aggregate("tokens", F.lit(0).cast("long"),
                      lambda s, t: s.bitwiseOR(_bit(F.pmod(_hash40(t), F.lit(64)))))
    k = _allowed(F.col("length"), threshold)
    return (classes.withColumn("k", k)
            # A partner may be shorter by k, or longer; a pair looks for one another by one k.
            .withColumn("k_low", F.greatest(F.lit(1), _allowed(F.col("length") - F.col("k"), threshold)))
            .withColumn("k_high", _allowed(F.col("length") + F.col("k"), threshold))
            .withColumn("padded", _padded())
            .withColumn("spots", spots)
            .withColumn("miss", F.floor(F.col("k") / 2).cast("int"))
            .withColumn("x", F.struct("first", "class", "length", "miss", sig.alias("sig"),
                                      F.array(*bits).alias("bits")))
            .drop("spots", "padded"))


def _listed(rows: DataFrame, space: Column | int, key: Column, kind: int) -> DataFrame:
    """(list, kind, class): entries of the lists that category, space and key name."""
    space = space if isinstance(space, Column) else F.lit(space)
    return rows.select(F.xxhash64("category", space, key).alias("list"), F.lit(kind).alias("kind"), "class")


def _deletion_keys(rows: DataFrame, space: int, both: bool) -> DataFrame:
    """Token hash sums of a set and of what is left after one deletion.

    Joining is deletion of the blank between two tokens; the rests are sorted, so the lower
    token comes first. `both`: one deletion on either side as well.
    """
    summed = rows.withColumn("total", _total())
    shorter = F.flatten(F.transform("tokens", lambda x: F.transform(
        F.sequence(F.lit(1), F.length(x)),
        lambda p: F.col("total") - _hash40(x) + _hash40(F.concat(
            x.substr(F.lit(1), p - 1), x.substr(p + 1, F.length(x)))))))
    merged = F.flatten(F.transform("tokens", lambda x, i: F.transform(
        F.slice("tokens", i + 2, F.size("tokens")),
        lambda y: F.col("total") - _hash40(x) - _hash40(y) + _hash40(F.concat(x, y)))))
    less = summed.withColumn("less", F.explode(F.array_distinct(F.concat(shorter, merged))))
    keys = _listed(less, space, F.col("less"), LESS).unionByName(
        _listed(summed, space, F.col("total"), WHOLE))
    return keys.unionByName(_listed(less, space + 1, F.col("less"), ALIKE)) if both else keys


def _two_fewer_keys(rows: DataFrame, space: int) -> DataFrame:
    """Character hash sums of a text, and less any two characters."""
    summed = rows.withColumn("chars", F.transform(
        F.split(similarity.joined(F.col("tokens")), ""), _hash40)) \
        .withColumn("sum", F.aggregate("chars", F.lit(0).cast("long"), lambda s, h: s + h)) \
        .withColumn("distinct", F.array_distinct("chars"))
    two = F.flatten(F.transform("distinct", lambda h, i: F.transform(
        F.slice("distinct", i + 1, F.size("distinct")), lambda g: F.col("sum") - h - g)))
    less = summed.withColumn("less", F.explode(F.array_distinct(two)))
    return _listed(less, space, F.col("less"), LESS).unionByName(
        _listed(summed, space, F.col("sum"), WHOLE))


def _group_keys(rows: DataFrame, space: int, groups: int, same: int = 2) -> DataFrame:
    """Characters in groups; a key for any `same` groups together, the others being changed."""
    chars = F.split(similarity.joined(F.col("tokens")), "")
    sums = [F.aggregate(F.filter("chars", lambda c: F.ascii(c) % groups == g), F.lit(0).cast("long"),
                        lambda s, c: s + _hash40(c)) for g in range(groups)]
    keys = [F.struct(F.lit(n).alias("which"), reduce(Column.__add__, [F.col("sums")[g] for g in chosen]).alias("sum"))
            for n, chosen in enumerate(combinations(range(groups), same))]
    keyed = rows.withColumn("chars", chars).withColumn("sums", F.array(*sums)) \
        .withColumn("some", F.explode(F.array(*keys)))
    return _listed(keyed, space, F.col("some"), ALIKE)


def _grid(k: Column) -> Column:
    """Multiples of four, so that partners of other lengths have few more keys."""
    return (F.ceil(k / 4) * 4).cast("int")


def _pair_keys(rows: DataFrame, space: int) -> DataFrame:
    """Adjacent pairs in 3 k + 1 groups, a key each."""
    levels = F.array_distinct(F.transform(
        F.sequence(F.greatest(F.lit(4), F.col("k_low")), F.col("k")), _grid))
    keyed = (rows.withColumn("padded", _padded()).withColumn("hashes", F.transform(_pairs(), _hash40))
             .withColumn("level", F.explode(levels))
             .withColumn("group", F.explode(F.sequence(F.lit(0), 3 * F.col("level"))))
             .withColumn("sum", F.aggregate(
                 F.filter("hashes", lambda h: F.pmod(h, 3 * F.col("level") + 1) == F.col("group")),
                 F.lit(0).cast("long"), lambda s, h: s + h)))
    return _listed(keyed, space + F.col("level"), F.struct("group", "sum"), ALIKE)


def _sparse(keys: DataFrame, classes: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Entries of the lists that are not dense, and the classes that are in one that is."""
    # Read three times below.
    keys = written(keys)
    dense = keys.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= most).select("list")
    crowd = keys.join(dense, "list", "left_semi").select("class").distinct()
    return keys.join(dense, "list", "left_anti"), classes.join(crowd, "class", "left_semi")


def _edit_keys(classes: DataFrame) -> DataFrame:
    """Path B. Spaces: 1 for k = 1; 2 to 6 for k = 2; 7 for k = 3; 10 and more beyond.

    Texts of different k meet by the lower one, but by 2 if that is 1: six keys are the fewest. Two
    that share a dense list are crowded both, so they meet by the keys that crowded ones have.
    """
    of_two = classes.where("k >= 2 AND k_low <= 2 OR k = 1 AND k_high >= 2")
    two, crowded = _sparse(_group_keys(of_two, 2, 4), of_two, DENSE)
    four, alike = _sparse(_group_keys(crowded, 6, 6, same=4), crowded, DENSE_CLOSER)
    keys = [_deletion_keys(classes.where("k = 1"), 1, both=False), two, four,
            _deletion_keys(alike, 3, both=True), _two_fewer_keys(alike, 5),
            _group_keys(classes.where("k >= 3 AND k_low <= 3"), 7, 5),
            _pair_keys(classes.where("k >= 4"), 10)]
    out = keys[0]
    for more in keys[1:]:
        out = out.unionByName(more)
    return out


def _token_keys(classes: DataFrame) -> DataFrame:
    """Path A: of tokens that cannot all be missing, one must be in the other.

    The missing ones and a blank each have k characters at most: a token that is longer is a
    key alone, else the rarest are keys that together are longer. (They may be all tokens:
    one is shared at least.) Tokens that no class has as a key have no list.
    """
    tokens = classes.select("category", "class", "k", F.explode("tokens").alias("token")).select(
        F.xxhash64("category", F.lit(0), "token").alias("list"), "class", "k",
        (F.length("token") + 1).alias("size"))
    # Most tokens may be codes that one class has: these need no row.
    several = tokens.groupBy("list").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    of_class = Window.partitionBy("class")
    before = of_class.orderBy("df", "list").rowsBetween(Window.unboundedPreceding, -1)
    rare = (tokens.join(several, "list", "left").withColumn("df", F.coalesce("df", F.lit(1)))
            .withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
            .where(F.col("before") <= F.col("k"))
            .withColumn("most", F.max("size").over(of_class))
            .where((F.col("most") <= F.col("k")) | (F.col("size") > F.col("k"))))
    rare = written(rare.select("list", F.lit(RARE).alias("kind"), "class", "df"))
    asked = rare.where("df > 1").select("list").distinct()
    held = tokens.join(asked, "list", "left_semi").select("list", F.lit(ALL).alias("kind"), "class")
    return rare.drop("df").unionByName(held)


def _possible(x: Column, y: Column, kind: Column, threshold: int) -> Column:
    """What bitmaps allow; `kind` is that of x."""
    k = _allowed(F.least(x["length"], y["length"]), threshold)
    differ = sum((F.bit_count(x["bits"][w].bitwiseXOR(y["bits"][w])) for w in range(WORDS)), F.lit(0))
    edit = (F.abs(x["length"] - y["length"]) <= k) & (differ <= 3 * k)

    def inside(a: Column, b: Column) -> Column:
        return F.bit_count(a["sig"].bitwiseAND(F.bitwise_not(b["sig"]))) <= a["miss"]

    return F.when(kind == RARE, inside(x, y)).when(kind == ALL, inside(y, x)).otherwise(edit)


def _meets(kind: Column) -> Column:
    """The kind of entries that an entry of this kind is compared with."""
    return F.element_at(F.array(*[F.lit(k) for k in (ALIKE, WHOLE, LESS, ALL, RARE)]), kind + 1)


def _all_candidates(keys: DataFrame, threshold: int) -> DataFrame:
    """(a, b), a < b: all pairs of lists that bitmaps allow."""
    one = keys.where(F.col("kind").isin(ALIKE, LESS, RARE))
    other = keys.select("list", F.col("kind").alias("other_kind"), F.col("x").alias("y"))
    x, y = F.col("x"), F.col("y")
    once = F.when(F.col("kind") == ALIKE, x["class"] < y["class"]).otherwise(x["class"] != y["class"])
    return (one.join(other, "list")
            .where((F.col("other_kind") == _meets(F.col("kind"))) & once
                   & _possible(x, y, F.col("kind"), threshold))
            .select(F.least(x["class"], y["class"]).alias("a"), F.greatest(x["class"], y["class"]).alias("b"))
            .distinct())


def _shared(keys: DataFrame, featured: DataFrame) -> DataFrame:
    """(list, kind, x): entries of lists with two classes or more that meet; most keys have one."""
    keys = written(keys)

    def some(kind: int) -> Column:
        return F.bool_or(F.col("kind") == kind)

    # Numbers in place of the class, so that aggregation needs no sort.
    one, other = F.xxhash64("class"), F.hash("class")
    several = keys.groupBy("list").agg(
        ((F.min(one) != F.max(one)) | (F.min(other) != F.max(other))).alias("differ"),
        (some(ALIKE) | (some(LESS) & some(WHOLE)) | (some(RARE) & some(ALL))).alias("meet")) \
        .where("differ AND meet").select("list")
    return keys.join(several, "list", "left_semi").join(featured.select("class", "x"), "class") \
        .select("list", "kind", "x")


def _keyed_candidates(classes: DataFrame, threshold: int) -> DataFrame:
    featured = _with_features(classes, threshold)
    return _all_candidates(_shared(_edit_keys(featured), featured), threshold)


def _keys(featured: DataFrame) -> DataFrame:
    return _shared(_edit_keys(featured).unionByName(_token_keys(featured)), featured)


# ---- scores --------------------------------------------------------------------------------------

def _scored(candidates: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Candidates (a, b) that reach the threshold: score and sizes."""
    def side(name: str) -> DataFrame:
        return classes.select(F.col("class").alias(name), F.col("tokens").alias(f"tokens_{name}"),
                              F.col("members").alias(f"members_{name}"))

    pairs = candidates.join(side("a"), "a").join(side("b"), "b")
    pairs = pairs.select("a", "b", "members_a", "members_b", *[c.alias(name) for name, c in similarity.rest_lengths(
        F.col("tokens_a"), F.col("tokens_b")).items()])
    p = similarity.paths(F.col("shared_len"), F.col("rest_a"), F.col("rest_b"))

    def near(distance: Column, base: Column) -> Column:
        return 100 * distance <= (100 - threshold) * base

    def closeness(distance: Column, base: Column) -> Column:
        return F.lit(100.0) - F.lit(100.0) * distance / base

    shares = F.col("shared_len") > 0
    closed = shares & (near(p["short_a"], p["base_a"]) | near(p["short_b"], p["base_b"]))
    most = F.floor(p["indel_base"] * (100 - threshold) / F.lit(100))
    judged = pairs.withColumn("sure", p["subset"] | closed)
    measured = similarity.with_indel(judged, "rest_a", "rest_b", F.when(~p["subset"], most), "distance")

    def score(distance: Column) -> Column:
        by_edits = F.when(near(distance, p["indel_base"]) | F.col("sure"), closeness(distance, p["indel_base"]))
        return F.when(p["subset"], F.lit(100.0)).otherwise(F.greatest(
            by_edits, F.when(shares & F.col("sure"), closeness(p["short_a"], p["base_a"])),
            F.when(shares & F.col("sure"), closeness(p["short_b"], p["base_b"]))))

    # Named once, as an argument: the optimizer would repeat it in each expression that names it.
    scores = F.filter(F.transform(F.array("distance"), score), lambda x: x.isNotNull())
    return measured.withColumn("score", F.explode(scores)).select(
        "a", "b", "score", "members_a", "members_b")


def _checked(threshold: int) -> None:
    if not 50 < threshold < 100:
        raise ValueError("threshold must lie between 50 and 100")


def similar_classes(classes: DataFrame, threshold: int = 97) -> DataFrame:
    """Pairs of different classes (a < b) that reach the threshold: score and sizes."""
    _checked(threshold)
    featured = _with_features(classes, threshold)
    return _scored(_all_candidates(_keys(featured), threshold), classes, threshold)


# ---- earliest matches ----------------------------------------------------------------------------

#: Entries of each list in the first whole round; how many times more each next one takes; entries
#: that travel together; copies of these, so that the askers of a long list spread over as many tasks.
ROUND, GROWTH, CHUNK, SALTS = 64, 64, 64, 8
#: Askers of a list from which on its entries are copied.
CROWD = 1024


def _numbered(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings (list, kind, pos, salts, x) and asks (list, kind, meets, limit, total, salts, x) of all keys.

    Entries of a list are numbered by their earliest record, each kind for itself. Lists are
    range-partitioned, so that a long one spreads over many partitions: a number is the number
    in the partition plus the counts of the partitions before it. limit: how many entries of the
    kind that it meets an entry has before it, and, as `total`, in all. salts: of how many copies of
    a posting each ask takes one; where few ask there is one.
    """
    second = F.col("kind").isin(WHOLE, ALL).cast("int")
    # Written once, so that a retry cannot meet other range bounds.
    ranged = cut_lineage(
        keys.repartitionByRange(F.col("list"), F.col("x.first"), F.col("x.class"))
        .withColumn("range", F.spark_partition_id()))
    whole_list = Window.partitionBy("list")
    before = whole_list.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("list", "range").agg(F.sum(1 - second).alias("n0"), F.sum(second).alias("n1"))
    offsets = counts.select("list", "range", *[c for i in (0, 1) for c in (
        F.coalesce(F.sum(f"n{i}").over(before), F.lit(0)).alias(f"offset{i}"),
        F.sum(f"n{i}").over(whole_list).alias(f"total{i}"))])
    inside = Window.partitionBy("list", "range").orderBy("x.first", "x.class") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    placed = (ranged.withColumns({f"seen{i}": F.coalesce(F.sum(v).over(inside), F.lit(0))
                                  for i, v in ((0, 1 - second), (1, second))})
              .join(offsets, ["list", "range"])
              .withColumns({f"at{i}": F.col(f"seen{i}") + F.col(f"offset{i}") for i in (0, 1)}))
    meets = _meets(F.col("kind"))
    other = meets.isin(WHOLE, ALL)

    def salts(askers: Column) -> Column:
        return F.when(askers > CROWD, SALTS).otherwise(1)

    rows = cut_lineage(placed.select(
        "list", "kind", "x", F.when(second == 1, F.col("at1")).otherwise(F.col("at0")).alias("pos"),
        meets.alias("meets"), F.when(other, F.col("at1")).otherwise(F.col("at0")).alias("limit"),
        F.when(other, F.col("total1")).otherwise(F.col("total0")).alias("total"),
        F.when(second == 1, F.col("total1")).otherwise(F.col("total0")).alias("own")))
    # An entry is asked by those that it meets.
    postings = rows.where("total > 0").select("list", "kind", "pos", salts(F.col("total")).alias("salts"), "x")
    return postings, rows.where("total > 0").withColumn("salts", salts(F.col("own"))).drop("pos", "own")


def _bounded(firsts: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, bound): the record from which on no match of the class can be the earliest.

    firsts: (class, article_id, parent_article_id) of records that the class matches. A record
    matches neither its parent nor its children: of records without a parent, at most one does
    not count for a given record, and none if no record of the class has a parent.
    """
    parentless = F.col("parent_article_id").isNull()
    alone = F.col("members") == 1
    kin = F.col("article_id").eqNullSafe(F.col("parent")) | F.col("parent_article_id").eqNullSafe(F.col("first"))
    counts = F.when(alone, ~kin).otherwise(parentless)
    ids = F.sort_array(F.collect_set(F.when(counts, F.col("article_id"))))
    which = F.when(F.any_value("members") == 1, 0).when(F.any_value("parent").isNull(), 0).otherwise(1)
    return (firsts.join(classes.select("class", "members", "first", "parent"), "class")
            .groupBy("class").agg(F.get(ids, which).alias("bound")).where("bound IS NOT NULL"))


def _earliest_links(described: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """(class, matched_class, score) of classes with features: links among which each record's earliest match is.

    Every class asks its lists for their entries in order, in rounds; first of all, for the earliest
    of their heads alone. An ask ends where a list ends or goes on with records that cannot
    precede what the class has found.
    """
    postings, asks = _numbered(_keys(classes))
    firsts = cut_lineage(_earliest(described.select("class", "article_id", "parent_article_id")))
    own = _bounded(firsts.join(classes.where("members > 1").select("class"), "class", "left_semi"), classes)
    bounds = classes.select("class", "first", "last").join(own, "class", "left").select(
        "class", "first", F.least("last", F.coalesce("bound", "last")).alias("bound"))
    asks = cut_lineage(
        asks.withColumn("class", F.col("x.class")).join(bounds, "class")
        .withColumn("limit", F.when(F.col("bound") <= F.col("first"), F.col("limit")).otherwise(F.col("total")))
        .where("limit > 0").drop("first", "total")
        .withColumn("salt", F.pmod(F.xxhash64("class"), F.col("salts")).cast("int")).drop("salts"))
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    found: DataFrame | None = None
    low, high, heads = 0, 1, True
    while not asks.isEmpty():
        chunk = F.floor((F.col("pos") - low) / CHUNK)
        chunks = (postings.where((F.col("pos") >= low) & (F.col("pos") < high))
                  .groupBy("list", F.col("kind").alias("meets"), chunk.alias("chunk"), "salts")
                  .agg(F.collect_list("x").alias("entries")).withColumn("salt", salts).drop("salts"))
        last = F.floor((F.least(F.col("limit"), F.lit(high)) - 1 - low) / CHUNK)
        asked = asks.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        candidates = (asked.join(chunks, ["list", "meets", "chunk", "salt"])
                      .withColumn("y", F.explode("entries"))
                      .where((F.col("y.first") < F.col("bound")) & (F.col("y.class") != F.col("class"))
                             & _possible(F.col("x"), F.col("y"), F.col("kind"), threshold))
                      .select(F.col("class").alias("a"), F.col("y.class").alias("b"), "y.first").distinct())
        if heads:
            candidates = candidates.groupBy("a").agg(F.min_by("b", "first").alias("b"))
        links = cut_lineage(_scored(candidates.select("a", "b"), classes, threshold).select(
            F.col("a").alias("class"), F.col("b").alias("matched_class"), "score"))
        found = links if found is None else found.unionByName(links)
        reached = links.select("class", F.col("matched_class").alias("from")).join(
            firsts.withColumnRenamed("class", "from"), "from").drop("from")
        closer = _bounded(reached, classes).select("class", F.col("bound").alias("closer"))
        tops = postings.where(F.col("pos") == high - 1).select(
            "list", F.col("kind").alias("meets"), F.col("x.first").alias("top"), salts.alias("salt"))
        asks = cut_lineage(
            asks.where(F.col("limit") > (0 if heads else high)).join(closer, "class", "left")
            .withColumn("bound", F.least("bound", F.coalesce("closer", "bound"))).drop("closer")
            .join(tops, ["list", "meets", "salt"]).where(F.col("top") < F.col("bound")).drop("top"))
        low, high = (0, ROUND) if heads else (high, high * (GROWTH + 1))
        heads = False
    empty = classes.select("class", F.col("class").alias("matched_class"), F.lit(100.0).alias("score"))
    # A pair may meet in several rounds, but a record must be there once to be ranked.
    return found.distinct() if found is not None else empty.limit(0)


def _earliest(rows: DataFrame) -> DataFrame:
    """Per class, the few records among which the earliest allowed partner always is.

    A record may not match its parent (one record) nor its children (one group of equal parent).
    So at most two of the groups by parent can be ruled out by their first record, and in the
    right group at most one record: two records of each of the first three groups suffice.
    Both ranks are limited before the shuffle.
    """
    by_parent = Window.partitionBy("class", "parent_article_id").orderBy("article_id") \
                      .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_leader = Window.partitionBy("class").orderBy("leader")
    return (rows.withColumn("place", F.row_number().over(by_parent))
            .withColumn("leader", F.first("article_id").over(by_parent)).where("place <= 2")
            .withColumn("group_place", F.dense_rank().over(by_leader)).where("group_place <= 3")
            .drop("place", "leader", "group_place"))


def _linked(articles: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Described articles, and the links between their classes in both directions.

    A class with copies is linked to itself.
    """
    _checked(threshold)
    described = written(describe(articles))
    classes = cut_lineage(_with_features(classes_of(described), threshold))
    keys = _keys(classes)
    # Read by every list of match_counts.
    pairs = cut_lineage(_scored(_all_candidates(keys, threshold), classes, threshold))

    def link(one: str, other: str) -> Column:
        return F.struct(F.col(one).alias("class"), F.col(other).alias("matched_class"), "score",
                        F.col(f"members_{one}").alias("members"),
                        F.col(f"members_{other}").alias("matched_members"))

    both = pairs.select(F.inline(F.array(link("a", "b"), link("b", "a"))))
    own = classes.where("members > 1").select(
        "class", F.col("class").alias("matched_class"), F.lit(100.0).alias("score"), "members",
        F.col("members").alias("matched_members"))
    return described.drop("merch_category", "tokens"), both.unionByName(own)


def flagged(articles: DataFrame, threshold: int = 97) -> DataFrame:
    """record_id, first_match (the earliest record it matches) and their score."""
    _checked(threshold)
    # Read in every round below.
    described = written(describe(articles))
    classes = cut_lineage(_with_features(classes_of(described), threshold))
    links = _earliest_links(described, classes, threshold)
    own = classes.where("members > 1").select(
        "class", F.col("class").alias("matched_class"), F.lit(100.0).alias("score"))
    return _flagged(described.drop("merch_category", "tokens"), links.unionByName(own))


def _flagged(members: DataFrame, links: DataFrame) -> DataFrame:
    firsts = _earliest(members.select("class", "article_id", "parent_article_id"))
    # The earliest of the linked classes together, six records at most per class.
    reach = (links.select("class", F.col("matched_class").alias("from"), "score")
             .join(firsts.withColumnRenamed("class", "from"), "from").drop("from"))
    reach = _earliest(reach).groupBy("class").agg(F.collect_list(
        F.struct("article_id", "parent_article_id", "score")).alias("firsts"))
    me, my_parent = F.col("article_id"), F.col("parent_article_id")
    allowed = F.filter("firsts", lambda x: (x["article_id"] < me)
                       & ~x["article_id"].eqNullSafe(my_parent)
                       & ~x["parent_article_id"].eqNullSafe(me))
    first = F.array_min(F.transform(allowed, lambda x: F.struct(x["article_id"], x["score"])))
    return (members.join(reach, "class").withColumn("first", first)
            .where(F.col("first").isNotNull())
            .select(F.col("article_id").alias("record_id"),
                    F.col("first.article_id").alias("first_match"),
                    F.col("first.score").alias("score")))


def match_counts(articles: DataFrame, threshold: int = 97) -> DataFrame:
    """`flagged` with `matches`, the number of earlier records each record matches.

    Counting earlier ids is a rank in a list. For a link, either the records of the class look
    themselves up in the list of the matched class, or the records of the matched class are
    copied into a list of the class, whichever are fewer: the work stays near the number of
    links even when a large class is linked to many classes.

    Lists are range-partitioned by id, so that a long one spreads over many partitions; a rank is
    the rank in the partition plus the counts of the partitions before it.
    """
    members, links = _linked(articles, threshold)
    lookup = links.where("members <= matched_members")
    copied = links.where("members > matched_members")
    record = members.select("class", F.col("article_id").alias("id"))

    def entries(kind: str, of: DataFrame, key: str, is_member: int) -> DataFrame:
        """The records of the classes in `of`, as entries of the lists that `key` names."""
        rows = of.select(F.col(key).alias("list"), F.col("class")).distinct()
        return record.join(rows, "class").select(
            F.concat(F.lit(kind), F.hex("list")).alias("list"), "id",
            F.lit(is_member).alias("is_member"))

    looked_up = lookup.select("matched_class", F.col("matched_class").alias("class"))
    copied_from = copied.select(F.col("class").alias("owner"), F.col("matched_class").alias("class"))
    owners = copied.select("class", F.col("class").alias("owner"))
    events = (entries("own:", looked_up, "matched_class", 1)
              .unionByName(entries("own:", lookup, "matched_class", 0))
              .unionByName(entries("copy:", copied_from, "owner", 1))
              .unionByName(entries("copy:", owners, "owner", 0)))
    # Written once, so that a retry cannot meet other range bounds.
    ranged = cut_lineage(events.repartitionByRange("list", "id", "is_member")
                         .withColumn("range", F.spark_partition_id()))
    # One row per list and partition.
    before = Window.partitionBy("list").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("list", "range").agg(F.sum("is_member").alias("n")).select(
        "list", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    inside = Window.partitionBy("list", "range").orderBy("id", "is_member") \
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = (ranged.withColumn("rank", F.sum("is_member").over(inside))
               .where("is_member = 0").join(offsets, ["list", "range"])
               .groupBy(F.col("id").alias("record_id"))
               .agg(F.sum(F.col("rank") + F.col("offset")).alias("earlier")))
    return (_flagged(members, links).join(earlier, "record_id")
            .join(_kin_counts(members, links), "record_id", "left")
            .select("record_id", "first_match", "score",
                    (F.col("earlier") - F.coalesce("kin", F.lit(0))).alias("matches")))


def _kin_counts(members: DataFrame, links: DataFrame) -> DataFrame:
    """Per record, its earlier parents and children in linked classes: they do not count."""
    child = members.where(F.col("parent_article_id").isNotNull()
                          & (F.col("parent_article_id") != F.col("article_id")))
    parent = members.select(F.col("article_id").alias("parent_article_id"),
                            F.col("class").alias("parent_class"))
    child_first = F.col("article_id") < F.col("parent_article_id")
    pairs = child.join(parent, "parent_article_id").select(
        F.greatest("article_id", "parent_article_id").alias("record_id"),
        F.least("article_id", "parent_article_id").alias("earlier_id"),
        F.when(child_first, F.col("parent_class")).otherwise(F.col("class")).alias("class"),
        F.when(child_first, F.col("class")).otherwise(F.col("parent_class")).alias("matched_class"))
    return (pairs.distinct().join(links, ["class", "matched_class"], "left_semi")
            .groupBy("record_id").agg(F.count(F.lit(1)).alias("kin")))
