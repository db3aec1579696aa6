"""Toxicity by weak supervision.

1. Terms (words and the first letters of words) are weighed on labelled rows; the telling ones
   become voters, alone or as members of a lexicon, beside a fixed lexicon and some patterns.
2. All documents are read once for their votes. A generative label model with two hidden classes is
   fitted to the counts of vote patterns by expectation maximisation: how often each voter fires
   in either class, and how voters fire together within a class. A voter that repeats others counts
   as much less as their correlation says.
3. The model's posterior for the labelled rows trains a linear classifier on which terms a text
   has; it scores every whole text.

Weighing terms and training use labelled rows alone, at most FIT_ROWS of them (those with the least
hashes of their ids); votes are counted over all documents. Nothing but the text is input of a score.

Null and empty texts have no terms and score as their lack of terms says. Rows that repeat an id
are scored one by one; repeated labels count once, toxic before clean, null ones not at all.
Without labels only the fixed lexicon and the patterns vote, and a base rate is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfproof.llm.graph import staged
from shelfproof.llm.words import NOT_ALNUM, Words, blocks, shingle_sets, text_bytes

#: Labelled rows that terms are weighed and the classifier is trained on, at most.
FIT_ROWS = 20_000
#: Terms: whole words (0) and the first so many bytes of words, in the order they are chosen.
KINDS = (0, 6, 5, 4)
#: Least share of toxic texts among those with a term (its lower confidence bound), for the
#: classifier's terms and for those that vote.
TELLING, PRECISE = 0.5, 0.7
TERMS, ALONE, LEXICONS, SUPPORT = 2048, 40, 8, 3
BASE_RATE, TURNS = 0.1, 6

#: A general lexicon of insults.
INSULTS = ("idiot idiots moron morons stupid dumb dumbass loser losers pathetic worthless scum trash garbage "
           "disgusting clown fool jerk ugly vermin filth bastard bitch asshole shit fuck fucking "
           "retard imbecile cretin nazi").split()
#: Patterns of bytes that raised voices, masked words and threats leave.
PATTERNS = (rb"!{3,}", rb"[A-Z]{4,}[ !]+[A-Z]{4,}[ !]+[A-Z]{4,}", rb"[A-Za-z][*#@]{2,}[A-Za-z]",
            rb"(?i)\b(kill|hurt|hate) (you|them|him|her)\b")


def _slots(values: pa.Array, terms: list[tuple[int, bytes]]) -> list[np.ndarray]:
    """For each kind, the number of the term that a word is or begins with, or -1."""
    out = []
    for kind in KINDS:
        numbers = np.array([i for i, (k, _) in enumerate(terms) if k == kind], np.int64)
        names = pa.array([t for k, t in terms if k == kind], pa.large_binary())
        found = pc.index_in(_cut(values, kind), value_set=names).fill_null(-1).to_numpy()
        out.append(np.where(found >= 0, numbers[found], -1) if len(names)
                   else np.full(len(values), -1, np.int64))
    return out


def _cut(values: pa.Array, kind: int) -> pa.Array:
    return pc.binary_slice(values, 0, kind) if kind else values


def _present(column: pa.Array, terms: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) for every term that a text has."""
    words = Words(column, NOT_ALNUM)
    if not len(words.ids):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(column)), np.diff(words.bounds))
    pairs = []
    for slots in _slots(words.values, terms):
        told = slots >= 0
        if told.any():
            at = np.flatnonzero(told[words.ids])
            pairs.append(owner[at] * len(terms) + slots[words.ids[at]])
    both = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    return both // max(len(terms), 1), both % max(len(terms), 1)


# ---- terms of the labelled rows ----------------------------------------------------------

def _weigher(kind: int, chosen: list[tuple[int, bytes]]):
    """(term, toxic, clean): texts of either label that have the term in a word that is not
    among the chosen ones, so that a beginning of words stands for what they do not tell."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, limit=16 << 20):
            words = Words(block.column("text"), NOT_ALNUM)
            if not len(words.ids):
                continue
            known = np.max(_slots(words.values, chosen), axis=0) >= 0
            at = np.flatnonzero(~known[words.ids])
            coded = _cut(words.values, kind).dictionary_encode()
            count = len(coded.dictionary)
            toxic = block.column("toxic").to_numpy(zero_copy_only=False) > 0
            owner = np.repeat(np.arange(block.num_rows), np.diff(words.bounds))[at]
            both = np.unique(owner * count + coded.indices.to_numpy()[words.ids[at]])
            bad = np.bincount(both % count, toxic[both // count], count).astype(np.int64)
            every = np.bincount(both % count, minlength=count)
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary.cast(pa.binary()), pa.array(bad),
                 pa.array((every - bad).astype(np.int64))], names=["term", "toxic", "clean"])
    return weigh


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the least and the greatest hash of their shingles, which near copies share."""
    for block in blocks(batches):
        sets = list(shingle_sets(block.column("text"), 3, NOT_ALNUM))
        low, high = ([int(r[i] >> np.uint64(1)) if len(r) else 0 for r in sets] for i in (0, -1))
        yield block.append_column("low", pa.array(low, pa.int64())) \
            .append_column("high", pa.array(high, pa.int64()))


def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(text, toxic) of labelled rows that are not held out, FIT_ROWS at most.

    Of near copies with one label mostly one is left, lest a text's words seem telling
    because it was copied.
    """
    known = labels.select(F.col("doc_id").alias("_id"), "toxic").filter("toxic IS NOT NULL") \
        .groupBy("_id").agg(F.max("toxic").cast("long").alias("toxic"))
    known = known.filter(~held_out).orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS)
    rows = docs.select(F.col("doc_id").alias("_own"), F.col("text").cast("string")) \
        .join(F.broadcast(known), F.col("_own") == F.col("_id")).select("text", "toxic") \
        .mapInArrow(_ends, "text string, toxic long, low long, high long")
    for end, other in (("low", "high"), ("high", "low")):
        rows = rows.groupBy(end, "toxic").agg(F.min(F.struct("text", other)).alias("r")) \
            .select("toxic", end, "r.*")
    return rows.select("text", "toxic")


def _terms(rows: DataFrame) -> tuple[list[tuple[int, bytes]], np.ndarray]:
    """Telling terms, best first, and the lexicon of each (-1: none); at most TERMS.

    Lexicons are of about equal size, from the most precise terms to the least.
    """
    best: list[tuple[int, bytes, float, int]] = []
    z, n = 1.64, F.col("toxic") + F.col("clean")  # Wilson's lower bound, one-sided 95 %
    p = F.col("toxic") / n
    share = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    for kind in KINDS:
        chosen = [(k, t) for k, t, share_, _ in best if share_ >= PRECISE]
        found = rows.mapInArrow(_weigher(kind, chosen), "term binary, toxic long, clean long") \
            .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
            .filter(F.col("toxic") >= SUPPORT).withColumn("share", share) \
            .filter(F.col("share") >= TELLING) \
            .orderBy(F.desc(F.col("toxic") * F.col("share")), "term").limit(TERMS // len(KINDS))
        best += [(kind, bytes(r["term"]), r["share"], r["toxic"]) for r in found.collect()]
    best.sort(key=lambda r: (-r[2] * r[3], r[0], r[1]))
    share = np.array([r[2] for r in best])
    rank = np.argsort(np.argsort(-share, kind="stable"))
    chosen = max(int((share >= PRECISE).sum()), 1)
    return [r[:2] for r in best], \
        np.where(share >= PRECISE, rank * LEXICONS // chosen, -1)


# ---- voters and the label model ------------------------------------------------------------

@dataclass
class Voters:
    """Up to 63 voters; the votes of a text are the bits of one number."""

    terms: list[tuple[int, bytes]]
    lexicon: np.ndarray
    insults: list[tuple[int, bytes]] = field(
        default_factory=lambda: [(0, w.encode()) for w in INSULTS])

    @property
    def count(self) -> int:
        return min(ALONE, len(self.terms)) + LEXICONS + len(PATTERNS) + 2

    def masks(self, column: pa.Array, present: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Bits: the best terms one by one, lexicons of precise terms, insults, patterns; the
        last voter speaks for clean where no term does."""
        row, term = present
        out = np.zeros(len(column), np.int64)
        alone = min(ALONE, len(self.terms))
        single = term < alone
        np.bitwise_or.at(out, row[single], np.left_shift(np.int64(1), term[single]))
        member = self.lexicon[term] if len(term) else np.zeros(0, np.int64)
        listed = member >= 0
        np.bitwise_or.at(out, row[listed], np.left_shift(np.int64(1), alone + member[listed]))
        rude, _ = _present(column, self.insults)
        out[rude] |= np.int64(1) << np.int64(alone + LEXICONS)
        out[out == 0] = np.int64(1) << np.int64(self.count - 1)
        data, offsets = text_bytes(column)
        raw = data.tobytes()
        for i, pattern in enumerate(PATTERNS):
            bit = np.int64(1) << np.int64(alone + LEXICONS + 1 + i)
            at = np.array([m.start() for m in re.finditer(pattern, raw)], np.int64)
            out[np.unique(np.searchsorted(offsets, at, side="right") - 1)] |= bit
        return out


@dataclass
class LabelModel:
    """Class share, how often each voter fires in either class, and how voters fire together.

    A voter that does not fire abstains.
    """

    share: float
    toxic: np.ndarray
    clean: np.ndarray
    together: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability that a text with these votes (0 or 1 per voter) is toxic."""
        alike = np.maximum(votes @ self.together, 1)  # of those that fire, how many say the same
        odds = votes * np.log(self.toxic / self.clean) / alike
        z = np.log(self.share / (1 - self.share)) + odds.sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _bits(masks: np.ndarray, count: int) -> np.ndarray:
    return ((masks[:, None] >> np.arange(count)) & 1).astype(float)


def _moments(votes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum of weights, first and second moments, as one row."""
    return np.concatenate([[weight.sum()], weight @ votes, (votes.T @ (votes * weight[:, None])).ravel()])


def _expect(model: LabelModel, count: int):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + count + count * count))
        for batch in batches:
            votes = _bits(batch.column("mask").to_numpy(), count)
            rows = batch.column("rows").to_numpy().astype(float)
            p = model.posterior(votes)
            sums += np.stack([_moments(votes, rows * p), _moments(votes, rows * (1 - p))])
        yield pa.RecordBatch.from_arrays([pa.array([r.tolist() for r in sums])], names=["sums"]).add_column(
            0, pa.field("toxic", pa.int32()), pa.array([1, 0], pa.int32()))
    return expect


def _maximise(toxic: np.ndarray, clean: np.ndarray, count: int) -> LabelModel:
    rates, spreads = [], []
    for sums in (toxic, clean):
        n = sums[0] + 2
        mean = (sums[1:1 + count] + 0.1) / n
        cov = sums[1 + count:].reshape(count, count) / n - np.outer(mean, mean)
        dev = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
        rates.append(np.clip(mean, 1e-5, 1 - 1e-5))
        spreads.append(np.clip(cov / np.outer(dev, dev), 0, 1))
    together = np.maximum(*spreads)
    np.fill_diagonal(together, 1)
    share = (toxic[0] + 1) / (toxic[0] + clean[0] + 2)
    return LabelModel(float(np.clip(share, 1e-4, 0.5)), *rates, together)


def label_model(votes: DataFrame, seen: list[np.ndarray], count: int) -> LabelModel:
    """Fitted to (mask, rows) of all documents. seen: moments of labelled toxic and clean rows."""
    model = _maximise(*seen, count)
    for _ in range(TURNS):
        sums = votes.mapInArrow(_expect(model, count), "toxic int, sums array<double>") \
            .select("toxic", F.posexplode("sums")).groupBy("toxic", "pos").agg(F.sum("col").alias("v")).collect()
        found = np.zeros((2, 1 + count + count * count))
        for r in sums:
            found[r["toxic"], r["pos"]] = r["v"]
        # Labelled rows stay in with their labels, so that the classes keep their meaning.
        model = _maximise(found[1] + seen[0], found[0] + seen[1], count)
    return model


# ---- classifier ----------------------------------------------------------------------------

@dataclass
class Classifier:
    terms: list[tuple[int, bytes]]
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        row, term = _present(column, self.terms)
        z = self.bias + np.bincount(row, self.weights[term], len(column)) if len(row) \
            else np.full(len(column), self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _train(row: np.ndarray, term: np.ndarray, labels: np.ndarray, terms: list,
           ridge: float = 0.05, turns: int = 600) -> Classifier:
    """Logistic regression on soft labels, both classes weighing the same, by gradient steps
    scaled per weight."""
    n, width = len(labels), len(terms)
    if n == 0:
        return Classifier(terms, np.zeros(width), float(np.log(BASE_RATE / (1 - BASE_RATE))))
    pull = labels * n / (2 * max(labels.sum(), 1)), (1 - labels) * n / (2 * max((1 - labels).sum(), 1))
    w = np.zeros(width + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for turn in range(1, turns + 1):
        z = w[-1] + (np.bincount(row, w[term], n) if len(row) else 0.0)
        score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        error = pull[1] * score - pull[0] * (1 - score)
        grad = np.append(np.bincount(term, error[row], width) + ridge * w[:-1] if len(row)
                         else ridge * w[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        w -= 0.1 * (m / (1 - 0.9 ** turn)) / (np.sqrt(v / (1 - 0.99 ** turn)) + 1e-8) \
            * min(1.0, 2 * (1 - turn / (turns + 1)))
    return Classifier(terms, w[:-1], float(w[-1]))


def _reader(voters: Voters):
    schema = pa.schema([("mask", pa.int64()), ("toxic", pa.int64()), ("terms", pa.list_(pa.int32()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            present = _present(block.column("text"), voters.terms)
            ends = np.searchsorted(present[0], np.arange(block.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(present[1], pa.int32()))
            masks = pa.array(voters.masks(block.column("text"), present))
            yield pa.RecordBatch.from_arrays([masks, block.column("toxic").cast(pa.int64()), lists],
                                             schema=schema)
    return read


def _voting(voters: Voters):
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            present = _present(block.column("text"), voters.terms)
            masks, rows = np.unique(voters.masks(block.column("text"), present), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(masks), pa.array(rows)], names=["mask", "rows"])
    return vote


def train(docs: DataFrame, labels: DataFrame, held_out: Column) -> Classifier:
    """docs: doc_id, text; labels: doc_id, toxic; held_out: condition on _id, an id not to learn from."""
    rows = staged(training_rows(docs, labels, held_out))
    voters = Voters(*_terms(rows))
    votes = staged(docs.select(F.col("text").cast("string")).mapInArrow(_voting(voters), "mask long, rows long")
                   .groupBy("mask").agg(F.sum("rows").alias("rows")))
    fit = rows.mapInArrow(_reader(voters), "mask long, toxic long, terms array<int>").toArrow()  # FIT_ROWS
    bits = _bits(fit.column("mask").to_numpy(), voters.count)
    toxic = fit.column("toxic").to_numpy() > 0
    seen = [_moments(bits, toxic.astype(float)), _moments(bits, (~toxic).astype(float))]
    if not toxic.any():  # what a lexicon and patterns are taken to be worth
        told = np.eye(voters.count) * 5
        seen[0] += np.concatenate([[10], np.full(voters.count, 5), told.ravel()])
        seen[1] += np.concatenate([[10 / BASE_RATE], np.full(voters.count, 1), told.ravel() / 5])
    model = label_model(votes, seen, voters.count)
    lists = fit.column("terms").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(bits)), sizes)
    term = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return _train(row, term, model.posterior(bits), voters.terms)


def _scorer(model: Classifier):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(model.scores(block.column("text")))],
                names=["doc_id", "score"])
    return score


def scores(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, score) for every row."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")) \
        .mapInArrow(_scorer(model), "doc_id long, score double")


def clean(docs: DataFrame, model: Classifier, limit: float = 0.5) -> DataFrame:
    """The rows, all columns, whose texts score below the limit."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield block.filter(pa.array(model.scores(block.column("text")) < limit))
    return docs.mapInArrow(keep, docs.schema)


def remainder(key: Column, parts: int) -> Column:
    """crc32 of an id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts
