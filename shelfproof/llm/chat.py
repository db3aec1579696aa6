"""Reply trees to training conversations, with DataFrame functions only.

Messages refer to their parent in a tree. Pointer doubling (self-joins whose reach doubles, so their
number grows with the logarithm of the depth) gives each leaf the messages above it; branches are
ranked by the mean score of their messages; the best ones are formatted, one text each, with the
spans that a loss counts.

Template, per turn: <|role|>, line feed, text, <|end|>, line feed. Control strings inside texts (of
this template and of some common ones) get a backslash after their first character, strings that
have backslashes there one more, so that taking one off restores every text. Roles are URL-encoded.

Null texts and roles count as empty. Messages that repeat a node id are messages of one place, in
order of role and text. A message whose chain of parents leads to no root (a missing parent, a
cycle) is in no path. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged

END = "<|end|>\n"
#: What texts must not hold as it is.
CONTROL = r"\||/?s>|/?INST\]|<SYS>>|</SYS>>"


def escape(text: Column) -> Column:
    """A text in which no control string occurs."""
    return F.regexp_replace(text, rf"([<\[])(\\*)({CONTROL})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The inverse of escape()."""
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({CONTROL})", r"$1$2$3")


def paths(messages: DataFrame) -> DataFrame:
    """(tree, leaf, node, up): the messages from each leaf (up = 0) to its root.

    messages: tree, node, parent (null at a root).
    """
    nodes = messages.select("tree", "node", "parent").distinct()
    inner = nodes.select("tree", F.col("parent").alias("node")).filter("node IS NOT NULL").distinct()
    leaves = nodes.join(inner, ["tree", "node"], "left_anti").select("tree", "node").distinct()
    # ahead: where a jump of `reach` steps leads; a jump beyond the root leads nowhere.
    jumps = staged(nodes.filter("parent IS NOT NULL")
                   .select("tree", "node", F.col("parent").alias("ahead")))
    found = staged(leaves.select("tree", F.col("node").alias("leaf"), "node",
                                 F.lit(0).cast("long").alias("up")))
    reach, limit = 1, nodes.count()
    while reach <= limit and not jumps.isEmpty():
        step = found.join(jumps, ["tree", "node"]) \
            .select("tree", "leaf", F.col("ahead").alias("node"), (F.col("up") + reach).alias("up"))
        onward = jumps.select("tree", F.col("node").alias("ahead"), F.col("ahead").alias("further"))
        found = staged(found.unionByName(step))
        jumps = staged(jumps.join(onward, ["tree", "ahead"])
                       .select("tree", "node", F.col("further").alias("ahead")))
        reach *= 2
    roots = nodes.filter("parent IS NULL").select("tree", "node")
    whole = found.join(roots, ["tree", "node"], "left_semi").select("tree", "leaf").distinct()
    return found.join(whole, ["tree", "leaf"], "left_semi")


def branches(messages: DataFrame) -> DataFrame:
    """paths() with each branch's rank in its tree: best mean score, then least leaf."""
    every = paths(messages)
    scores = messages.groupBy("tree", "node").agg(F.avg("score").alias("score"))
    scored = every.join(scores, ["tree", "node"]).groupBy("tree", "leaf") \
        .agg(F.avg("score").alias("score"))
    best = Window.partitionBy("tree").orderBy(F.col("score").desc_nulls_last(), "leaf")
    ranked = scored.withColumn("rank", F.row_number().over(best))
    return every.join(ranked, ["tree", "leaf"])


def conversations(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """Per chosen branch: tree, leaf, rank, formatted, loss.

    messages: tree, node, parent, role, text, score. top: branches per tree, None for all. loss:
    spans (start, length) of formatted, in code points, that hold the assistant's texts.
    """
    chosen = branches(messages)
    chosen = chosen if top is None else chosen.filter(F.col("rank") <= top)
    texts = messages.select(
        "tree", "node", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    turn = F.concat(F.lit("<|"), F.url_encode("role"), F.lit("|>\n"))
    rows = chosen.join(texts, ["tree", "node"]) \
        .withColumn("head", turn).withColumn("body", escape(F.col("text"))) \
        .withColumn("turn", F.concat("head", "body", F.lit(END)))
    spoken = F.struct(
        (-F.col("up")).alias("at"), "role", "text", "turn", F.length("turn").cast("long").alias("size"),
        F.length("head").cast("long").alias("skip"), F.length("body").cast("long").alias("held"))
    # Where a turn begins is the running length of those before it.
    order = Window.partitionBy("tree", "leaf").orderBy("at", "role", "text") \
        .rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("tree", "leaf", "rank", spoken.alias("m")).select("tree", "leaf", "rank", "m.*")
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(order), F.lit(0)))
    span = F.struct((F.col("start") + F.col("skip")).alias("start"), F.col("held").alias("length"))
    turns = F.array_sort(F.collect_list(F.struct("start", "turn")))
    return rows.groupBy("tree", "leaf", "rank").agg(
        F.array_join(F.transform(turns, lambda t: t["turn"]), "").alias("formatted"),
        F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", span))).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text, start, length)."""
    turns = F.filter(F.split(formatted, r"<\|end\|>\n", -1), lambda t: t != "")
    parts = F.transform(turns, lambda t: F.struct(
        F.url_decode(F.regexp_extract(t, r"^<\|(.*?)\|>\n", 1)).alias("role"),
        F.regexp_replace(t, r"^<\|.*?\|>\n", "").alias("body"),
        F.length(t).cast("long").alias("size")))
    return F.transform(parts, lambda p: F.struct(
        p["role"].alias("role"), unescape(p["body"]).alias("text"), p["size"].alias("size"),
        F.length(p["body"]).cast("long").alias("length")))


def masked_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, its spans one after the other."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def digests(chats: DataFrame) -> DataFrame:
    """Per formatted conversation, read back: tree, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    said = F.transform(read_back(F.col("formatted")),
                       lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = chats.select("tree", "formatted", said.alias("said"),
                        masked_text(F.col("formatted"), F.col("loss")).alias("masked"))
    return read.select(
        "tree", F.size("said").cast("long").alias("n_turns"),
        F.sha2(F.array_join("said", ""), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
