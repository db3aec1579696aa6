"""Near-duplicate documents by bottom-k sketches.

1. One hash function over a text's word shingles; its k smallest values are the sketch. Texts with
   equal shingle sets form a class, which goes on as one node.
2. Inverted lists: a value and the nodes whose sketches retain it. Two sets that are similar
   enough share at least `overlap()` of k values, so they meet in a list already if each node
   enters those of its rarest values only that this number leaves. Values of one node alone
   need no list, and values of passages that many documents hold are the last to be used.
3. A pair of nodes from a list is dropped if the sketch of the union of both (the k smallest
   values of the two sketches) says that it is not similar; chance drops less than one similar
   pair in 10^9. The others are confirmed on the full shingle sets.
4. Links give components. Some rounds compare the nodes of a list with heads drawn from it, which
   joins groups of copies at a cost that grows with their size; a last one looks for links
   between nodes of a list that are still in different components, by the rarest values of
   their whole sets, and confirms them. So every link between components is found, and no
   group of copies is expanded into its pairs.

Null or empty texts have no shingle and are linked with nothing. Rows that repeat a doc_id are
rows like others; rows without one take part, but give no component its name. A text with fewer
words than a shingle is one shingle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.llm.graph import components, staged
from shelfproof.llm.words import blocks, shingle_sets

KEEP = 64
#: Rounds with heads; draws of heads per round; heads that a node is confirmed with per round.
ROUNDS, EARLY_ROUNDS, DRAWS, TRIED = 1, 2, 4, 4
#: Words of 64 bits in the bitmap of a set.
BITMAP = 8


def overlap(keep: int, percent: int, miss: float = 1e-9) -> int:
    """Values that the sketches of two similar sets share, but for chance below `miss`."""
    share, total = percent / 100, 0.0
    for count in range(keep + 1):
        total += math.comb(keep, count) * share ** count * (1 - share) ** (keep - count)
        if total > miss:
            return count
    return keep


def _node(runs: np.ndarray) -> int:
    """The name of a shingle set."""
    return xxhash.xxh3_64_intdigest(runs.tobytes()) - 2 ** 63


def _signer(size: int, keep: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
                        ("sketch", pa.list_(pa.int64()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            counts, nodes, sketches = [], [], []
            for runs in shingle_sets(block.column("text"), size):
                counts.append(len(runs))
                nodes.append(_node(runs) if len(runs) else None)
                sketches.append((runs[:keep] >> np.uint64(1)).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(counts, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(sketches, pa.list_(pa.int64()))], schema=schema)
    return sign


def sign(docs: DataFrame, size: int, keep: int = KEEP) -> DataFrame:
    """Per document: doc_id, n (distinct shingles), node (name of the set), sketch."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_signer(size, keep), "doc_id long, n long, node long, sketch array<long>")


def _setter(size: int):
    schema = pa.schema([("node", pa.int64()), ("runs", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            runs = [r for r in shingle_sets(block.column("text"), size) if len(r)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(r) for r in runs], pa.int64()),
                 pa.array([r.tobytes() for r in runs], pa.binary())], schema=schema)
    return sets


def _lister(size: int):
    schema = pa.schema([("node", pa.int64()), ("runs", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])

    def bits(runs: np.ndarray) -> np.ndarray:
        """For each of 64 * BITMAP places, whether an odd number of values falls there."""
        odd = np.bincount((runs % np.uint64(64 * BITMAP)).astype(np.int64), minlength=64 * BITMAP) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            runs = [r for r in shingle_sets(block.column("text"), size) if len(r)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(r) for r in runs], pa.int64()),
                 pa.array([r.view(np.int64) for r in runs], pa.list_(pa.int64())),
                 pa.array([bits(r) for r in runs], pa.list_(pa.int64()))], schema=schema)
    return lists


def _confirmer(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            similar = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(x) + len(y) - len(np.union1d(x, y))
                similar.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(similar, pa.bool_()))
    return confirm


def _likeliest(pairs: DataFrame) -> DataFrame:
    """(a, b): the few pairs of each a that are most alike."""
    alike = F.sort_array(F.collect_list(F.struct("like", "b")), asc=False)
    return pairs.groupBy("a").agg(F.slice(alike, 1, TRIED).alias("heads")) \
        .select("a", F.explode("heads").alias("h")).select("a", F.col("h.b").alias("b"))


class Finder:
    """Links between the nodes of one table of documents."""

    def __init__(self, docs: DataFrame, size: int, percent: int, keep: int = KEEP):
        self.size, self.percent, self.keep = size, percent, keep
        self.docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        self.signed = staged(sign(docs, size, keep))
        self.nodes = staged(
            self.signed.filter("n > 0").groupBy("node").agg(
                F.min("doc_id").alias("doc_id"), F.first("n").alias("n"),
                F.first("sketch").alias("sketch")))
        self.lists = staged(self._lists())
        self.links: DataFrame | None = None

    def _lists(self) -> DataFrame:
        """(value, node, n): the inverted lists of each node's rarest values."""
        values = self.nodes.select("node", "n", F.explode("sketch").alias("value"))
        often = values.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
        held = F.least("n", F.lit(self.keep))
        # A set so small that its similar ones are held whole shares this many; else see overlap().
        whole = self.keep * self.percent // 100
        shared = F.when(F.col("n") <= whole, F.ceil(F.col("n") * self.percent / 100)) \
            .otherwise(overlap(self.keep, self.percent))
        alone = held - F.size("rare")
        return (
            values.join(often, "value").groupBy("node", "n")
            .agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("rare"))
            .withColumn("used", (held - shared + 1 - alone).cast("int"))
            .filter("used > 0")
            .select("node", "n", F.explode(F.slice("rare", 1, F.col("used"))).alias("v"))
            .select(F.col("v.value").alias("value"), "node", "n"))

    def _possible(self, n: Column, m: Column) -> Column:
        """Sizes between which a similar pair can lie."""
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def _placed(self, lists: DataFrame) -> DataFrame:
        """Lists with each node's present component, those with several components only."""
        if self.links is None:
            placed = lists.withColumn("at", F.col("node"))
        else:
            placed = lists.join(self.parts, "node", "left") \
                .select(*lists.columns, F.coalesce("component", "node").alias("at"))
        open_ = placed.groupBy("value").agg(F.min("at").alias("low"), F.max("at").alias("high")) \
            .filter("low != high").select("value")
        return placed.join(open_, "value")

    def _with_heads(self, turn: int) -> DataFrame:
        """Pairs of a node and a head, drawn from the components, of a list that it is in."""
        placed = self._placed(self.lists)
        draw = F.xxhash64("at", F.lit(turn), F.pmod("value", F.lit(DRAWS)))
        head = F.struct(draw.alias("h"), "node", "n", "at")
        heads = placed.groupBy("value").agg(F.array(F.min(head), F.max(head)).alias("heads"))
        return placed.join(heads, "value").withColumn("head", F.explode("heads")).filter(
            (F.col("at") != F.col("head.at")) & self._possible(F.col("n"), F.col("head.n"))) \
            .select(F.col("node").alias("a"), F.col("head.node").alias("b")).distinct()

    def _early(self) -> DataFrame:
        """(value, node, n, bits, rest): the rarest values of whole sets, for nodes still in question.

        These are the nodes of a list of sketch values with several components. Their sets are
        ordered from the rarest value to the most common one; rest counts the values from one
        on. A similar pair has its first common value so early in both that enough values
        follow. So a copy with many edits of its own, which make rare values, meets no other
        copy, however large its group is.
        """
        asked = staged(self._placed(self.lists).select("node", "n").distinct())
        values = self._texts(asked).mapInArrow(
            _lister(self.size), "node long, runs array<long>, bits array<long>") \
            .join(asked, "node").select("node", "n", "bits", F.explode("runs").alias("value"))
        often = values.groupBy("value").agg(F.count("*").alias("often")).filter("often > 1")
        alone = F.col("n") - F.size("rare")
        used = (F.col("n") - F.ceil(F.col("n") * self.percent / 100) + 1 - alone).cast("int")
        return values.join(often, "value").groupBy("node", "n") \
            .agg(F.sort_array(F.collect_set(F.struct("often", "value"))).alias("rare"),
                 F.first("bits").alias("bits")) \
            .withColumn("alone", alone).withColumn("used", used).filter("used > 0") \
            .select("node", "n", "bits", "alone", F.posexplode(F.slice("rare", 1, F.col("used")))) \
            .select(F.col("col.value").alias("value"), "node", "n", "bits",
                    (F.col("n") - F.col("alone") - F.col("pos")).alias("rest"))

    def _enough(self, x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        """Whether two sets can be similar: by their sizes, by the values from the first common
        one on, and by the places where their bitmaps differ, each a value of one set alone."""
        n, m = x("n"), y("n")
        differ = sum(F.bit_count(x("bits")[i].bitwiseXOR(y("bits")[i])) for i in range(BITMAP))
        return self._possible(n, m) \
            & (F.least(x("rest"), y("rest")) * (100 + self.percent) >= (n + m) * self.percent) \
            & (differ * (100 + self.percent) <= (n + m) * (100 - self.percent))

    def _with_early_heads(self, lists: DataFrame, turn: int) -> DataFrame:
        """Pairs of a node and a head as above, the likeliest few of each node."""
        placed = self._placed(lists)
        draw = F.xxhash64("at", F.lit(turn), F.pmod("value", F.lit(DRAWS)))
        head = F.struct(draw.alias("h"), F.xxhash64("node", "value").alias("i"),
                        "node", "n", "at", "rest", "bits")
        heads = placed.groupBy("value").agg(F.array(F.min(head), F.max(head)).alias("heads"))
        pairs = placed.join(heads, "value").withColumn("head", F.explode("heads")).filter(
            (F.col("at") != F.col("head.at"))
            & self._enough(F.col, lambda name: F.col(f"head.{name}")))
        shared = pairs.groupBy(F.col("node").alias("a"), F.col("head.node").alias("b")) \
            .agg(F.count("*").alias("like"))
        return _likeliest(shared)

    def _across(self, lists: DataFrame) -> DataFrame:
        """All pairs of a list's nodes in different components that can be similar."""
        placed = self._placed(lists)
        return placed.alias("x").join(placed.alias("y"), "value").filter(
            (F.col("x.at") < F.col("y.at"))
            & self._enough(lambda name: F.col(f"x.{name}"), lambda name: F.col(f"y.{name}"))) \
            .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()

    def _texts(self, named: DataFrame) -> DataFrame:
        """A text of each of these nodes (of others too, where ids repeat)."""
        ids = self.nodes.join(named, "node", "left_semi").select("doc_id").distinct()
        return self.docs.join(ids, self.docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi") \
            .select("text")

    def _estimated(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the sketch of their union does not rule out, with its estimate."""
        x = self.nodes.select(F.col("node").alias("a"), F.col("sketch").alias("x"))
        y = self.nodes.select(F.col("node").alias("b"), F.col("sketch").alias("y"))
        both = pairs.join(x, "a").join(y, "b") \
            .withColumn("u", F.slice(F.array_sort(F.array_union("x", "y")), 1, self.keep)) \
            .withColumn("shared", F.size(F.array_intersect(F.array_intersect("x", "y"), F.col("u"))))
        whole = F.size("u") < self.keep  # then it is the union itself
        least = F.when(whole, F.size("u") * self.percent / 100).otherwise(
            F.lit(overlap(self.keep, self.percent)))
        return both.filter(F.col("shared") >= least) \
            .select("a", "b", (F.col("shared") / F.size("u")).alias("like"))

    def _confirmed(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar."""
        named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = self._texts(named).mapInArrow(_setter(self.size), "node long, runs binary")
        sets = staged(sets.join(named, "node", "left_semi").dropDuplicates(["node"]))
        both = pairs.select("a", "b") \
            .join(sets.select(F.col("node").alias("a"), F.col("runs").alias("x")), "a") \
            .join(sets.select(F.col("node").alias("b"), F.col("runs").alias("y")), "b")
        return both.mapInArrow(_confirmer(self.percent), "a long, b long")

    def _add(self, links: DataFrame) -> None:
        links = staged(links)
        self.links = links if self.links is None else self.links.unionByName(links)
        self.parts = staged(components(self.links))

    def run(self) -> DataFrame:
        """(node, component): all nodes that have a link."""
        for turn in range(ROUNDS):
            self._add(self._confirmed(staged(_likeliest(self._estimated(self._with_heads(turn))))))
        early = staged(self._early())
        for turn in range(EARLY_ROUNDS):
            self._add(self._confirmed(staged(self._with_early_heads(early, turn))))
        self._add(self._confirmed(staged(self._across(early))))
        return self.parts


def groups(docs: DataFrame, size: int = 5, percent: int = 80, keep: int = KEEP) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    docs: doc_id (integer), text. Documents are linked if the shingle sets (runs of `size` words)
    have 100 * intersection >= percent * union. component_id is the least doc_id reachable.
    """
    finder = Finder(docs, size, percent, keep)
    parts = finder.run()
    named = finder.nodes.join(parts, "node", "left") \
        .select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    names = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(names, "component").select("node", "component_id")
    return finder.signed.drop("sketch").join(named, "node", "left") \
        .withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id"))
                    .otherwise(F.col("doc_id"))) \
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents, all columns, with one of each group: that with the least doc_id.

    Rows without a doc_id stay. Of rows that repeat an id and a text one stays; an id with
    several texts stays with all of them if one of these is to stay.
    """
    decided = groups(docs, size, percent)
    kept = decided.filter("kept").groupBy("doc_id").agg(F.count("*").alias("_rows"))
    kept = staged(kept)
    once = docs.join(kept.filter("_rows = 1").select("doc_id"), "doc_id", "left_semi")
    more = docs.join(kept.filter("_rows > 1").select("doc_id"), "doc_id", "left_semi")
    return once.unionByName(more.dropDuplicates(["doc_id", "text"])) \
        .unionByName(docs.filter(F.col("doc_id").isNull()))
