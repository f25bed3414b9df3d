"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions. Each decision, named by the bits before it in its
byte, has a tree of contexts: the DEPTH bytes before. A node of the tree holds how
often a 0 and a 1 followed it in the training texts, its Krichevsky-Trofimov
estimate, and the weighted probability that mixes this estimate with that of its
children. The probability of a bit mixes the estimates of all depths by the
posterior weights of the nodes on its path; a path that leaves the tree goes on
with one half. The bytes before a text count as zeros.

The tree is fitted by DataFrame aggregations, one per depth: counts of byte runs,
sums over children, and back down the mixtures. A text's score is the sum over its
byte runs; so is the base score over its words. Values of the most frequent runs
and words, at most HEAD each, are sent to every task; texts give out the rest of
their runs and words as rows, which are joined with the rest of the tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import Sent, fold, written
from gridcast.llm.rolling import SOLID, Hasher, pieces, words
from gridcast.llm.tokens import text_bytes

DEPTH = 4  # bytes of context; up to 7 work, since a run and its byte are one number of 64 bits, at more disk (README)
HEAD = 1 << 20
GRAM, WORD = 0, 1
_FLUSH = 1 << 21
_SLICE = 1 << 20
_HALF = math.log(0.5)


def byte_runs(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte the DEPTH bytes before it in its text, zeros before its begin, and itself, in one number."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    x = data.astype(np.uint64)
    total = x.copy()
    for k in range(1, min(DEPTH, len(x) - 1) + 1):
        total[k:] |= np.where(place[k:] >= k, x[:-k], 0).astype(np.uint64) << np.uint64(8 * k)
    return total


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else counts


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


class _Tally:
    """Sums by key that are given out when they grow large."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray, weight: int) -> None:
        found, counts = _unique(keys)
        self.parts.append((found, counts * weight))
        self.size += len(found)

    def rows(self, least: int = 0) -> Iterator[pa.RecordBatch]:
        if self.size <= least:
            return
        keys, counts = _merge(self.parts)
        self.parts, self.size = [(keys, counts)], len(keys)
        if least and self.size <= least // 2:
            return
        self.parts, self.size = [], 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), self.kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(counts)], ["kind", "key", "n"]
        )


def gather(docs: DataFrame) -> DataFrame:
    """(kind, key, n) of all byte runs of `docs(text, train)` and all words of its training texts: training counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, tallies = Hasher(lower=True), (_Tally(GRAM), _Tally(WORD))
        for batch in batches:
            for train in (True, False):
                part = batch.filter(batch.column(1) if train else pc.invert(batch.column(1)))
                data, offsets = text_bytes(part.column(0))
                for a, b in pieces(offsets, _SLICE):
                    own, bounds = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                    tallies[0].add(byte_runs(own, bounds), int(train))
                    if train:
                        tallies[1].add(words(own, bounds, SOLID, hasher)[0], 1)
                    for tally in tallies:
                        yield from tally.rows(_FLUSH)
        for tally in tallies:
            yield from tally.rows()

    return docs.select("text", "train").mapInArrow(count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: Stirling's series seven steps up."""
    z, below = x + 7, x
    for i in range(1, 7):
        below = below * (x + i)
    series = 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def _parent(c: str, depth: int) -> Column:
    return F.col(c).bitwiseAND(F.lit((1 << 8 * depth) - 1)).cast("long")


def fit_tree(grams: DataFrame) -> list[DataFrame]:
    """Per depth from 0: (context, node, p, reach): the mixture of the estimates down to this depth, and the
    weight that is left for deeper ones, for each seen node of `grams(key, n)`."""
    n0, n1 = F.col("n0"), F.col("n1")
    estimate = (_log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1.0) - math.log(math.pi)).alias("own")
    level = grams.where("n > 0").select(
        F.shiftright("key", 8).alias("context"), F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("byte"), "n",
        F.explode(F.sequence(F.lit(0), F.lit(7))).alias("level"))
    node = F.expr("cast(shiftleft(1, level) | shiftright(byte, 8 - level) as int)").alias("node")
    bit = F.expr("shiftright(byte, 7 - level) & 1").alias("bit")
    counted = level.select("context", node, bit, "n").groupBy("context", "node").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
    tree = [written(counted.select("context", "node", "n0", "n1", estimate).select("*", F.col("own").alias("weighted"), F.lit(1.0).alias("stop")), "tree")]
    for depth in range(DEPTH - 1, -1, -1):
        summed = tree[0].groupBy(_parent("context", depth).alias("context"), "node").agg(
            F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("weighted").alias("below"))
        gap = F.col("below") - F.col("own")
        tree.insert(0, written(summed.select("context", "node", "n0", "n1", "below", estimate).select(
            "context", "node", "n0", "n1", "own",
            (F.greatest("below", "own") + F.log1p(F.exp(-F.abs(gap))) + _HALF).alias("weighted"), (1 / (1 + F.exp(gap))).alias("stop")), "tree"))
    kt = (n1 + 0.5) / (n0 + n1 + 1.0)
    down = [tree[0].select("context", "node", (F.col("stop") * kt).alias("p"), (1 - F.col("stop")).alias("reach"))]
    for depth in range(1, DEPTH + 1):
        above = down[-1].select(F.col("context").alias("up"), "node", F.col("p").alias("p0"), F.col("reach").alias("r0"))
        mine = tree[depth].withColumn("up", _parent("context", depth - 1)).join(above, ["up", "node"])
        down.append(written(mine.select("context", "node", (F.col("p0") + F.col("r0") * F.col("stop") * kt).alias("p"),
                                        (F.col("r0") * (1 - F.col("stop"))).alias("reach")), "mixed"))
    return down


def gram_scores(grams: DataFrame, down: list[DataFrame]) -> DataFrame:
    """(key, n, value) for `grams(key, n)`: log10 of the probability of the last byte after those before it.

    Seen runs find their nodes at full depth. Of the others, each bit takes the
    mixture of the deepest node on its path and one half for what is left.
    """
    def bits(rows: DataFrame) -> DataFrame:
        return rows.select(
            "key", "n", F.shiftright("key", 8).alias("context"), F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("byte"),
            F.explode(F.sequence(F.lit(0), F.lit(7))).alias("level")
        ).select("key", "n", "context", F.expr("cast(shiftleft(1, level) | shiftright(byte, 8 - level) as int)").alias("node"),
                 F.expr("shiftright(byte, 7 - level) & 1").alias("bit"))

    def summed(rows: DataFrame) -> DataFrame:
        chance = F.when(F.col("bit") == 1, F.col("p")).otherwise(1 - F.col("p"))
        return rows.groupBy("key", "n").agg(F.sum(F.log10(chance)).alias("value"))

    seen = bits(grams.where("n > 0")).join(down[DEPTH].select("context", "node", "p"), ["context", "node"])
    fresh = bits(grams.where("n = 0")).select("*", F.lit(0.5).alias("p"))
    for depth, nodes in enumerate(down):
        at = nodes.select(F.col("context").alias("up"), "node", (F.col("p") + F.col("reach") / 2).alias("deeper"))
        fresh = fresh.withColumn("up", _parent("context", depth)).join(at, ["up", "node"], "left").withColumn(
            "p", F.coalesce("deeper", "p")).drop("up", "deeper")
    return summed(seen).unionByName(summed(fresh))


class Lookup:
    """Values by 64-bit key: one probe for nearly all, a binary search for keys that lost their slot."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 22):
        self.keys, self.values, self.shift = keys.astype(np.uint64), values, np.uint64(64 - bits)
        slot = self._slot(self.keys)
        self.slots = np.full(1 << bits, -1, np.int32)
        self.slots[slot] = np.arange(len(keys))
        lost = np.flatnonzero(self.slots[slot] != np.arange(len(keys)))
        self.lost = lost[np.argsort(self.keys[lost])]
        self.lost_keys = self.keys[self.lost]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where unknown), and whether each key is known."""
        if not len(self.keys):
            return np.zeros(len(keys)), np.zeros(len(keys), bool)
        at = self.slots[self._slot(keys)]
        known = (at >= 0) & (self.keys[at] == keys)
        out = np.where(known, self.values[at], 0.0)
        rest = np.flatnonzero(~known)
        if len(self.lost) and len(rest):
            place = np.minimum(np.searchsorted(self.lost_keys, keys[rest]), len(self.lost) - 1)
            same = self.lost_keys[place] == keys[rest]
            out[rest[same]], known[rest[same]] = self.values[self.lost[place[same]]], True
        return out, known


def _head(scores: DataFrame, head: int) -> tuple[Lookup, DataFrame]:
    """The most frequent rows of `scores(key, n, value)`, at most `head`, and the others.

    The cut is a power of two of the counts, found from the sizes of their octaves.
    """
    octave = F.when(F.col("n") > 0, F.floor(F.log2("n"))).otherwise(F.lit(-1)).cast("int")
    sizes = sorted(((r["o"], r["count"]) for r in scores.groupBy(octave.alias("o")).count().collect()), reverse=True)
    taken, cut = 0, None
    for o, count in sizes:
        if taken + count > head:
            break
        taken, cut = taken + count, o
    first = scores.where(octave >= cut) if cut is not None else scores.limit(0)
    got = first.select("key", "n", "value").toArrow()
    order = np.argsort(got.column("n").to_numpy(), kind="stable")  # the most frequent key of a slot keeps it
    lookup = Lookup(got.column("key").to_numpy()[order], got.column("value").to_numpy()[order])
    return lookup, scores.where(octave < cut).select("key", "value") if cut is not None else scores.select("key", "value")


def _score(docs: DataFrame, grams: Lookup, known_words: Lookup) -> DataFrame:
    """Per row of `docs(doc_id, text, train)` the sums over what the look-ups know, and the keys they do not."""
    shared = Sent(docs.sparkSession, (grams, known_words))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(lower=True)
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in pieces(offsets, _SLICE):
                own, bounds = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
                n, sums, rest = b - a, [], []
                hashes, upto = words(own, bounds, SOLID, hasher)
                for keys, edges, lookup in ((byte_runs(own, bounds), bounds, shared.value[0]), (hashes, upto, shared.value[1])):
                    values, found = lookup.find(keys)
                    of = np.repeat(np.arange(n), np.diff(edges))
                    lost = np.bincount(of[~found], minlength=n)
                    sums.append((np.bincount(of, values, n), np.diff(edges) - lost))
                    rest.append(pa.ListArray.from_arrays(
                        pa.array(np.append(0, np.cumsum(lost)), pa.int32()), pa.array(keys[~found].astype(np.int64))))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, n), batch.column(2).slice(a, n), pa.array(np.diff(upto)), pa.array(sums[1][1]),
                    pa.array(sums[1][0]), pa.array(sums[0][0]), pa.array(np.diff(bounds)), rest[0], rest[1],
                ], ["doc_id", "train", "n_words", "n_known", "base", "score", "n_bytes", "grams", "words"])

    return docs.mapInArrow(
        score, "doc_id long, train boolean, n_words long, n_known long, base double, score double, n_bytes long, grams array<long>, words array<long>")


def score_texts(docs: DataFrame, head: int = HEAD) -> DataFrame:
    """One row per row of `docs(doc_id, text, train)`: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte.

    The model and the counts are those of the rows where train is true (null counts
    as false). A null or empty text has score 0 and one token, its end. Words are
    told apart by 64-bit hashes. Repeated rows each count and are each scored.
    Other columns are ignored; an empty table gives no rows, and without training
    rows every bit has probability one half.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("train", F.lit(False)).alias("train"))
    gathered = written(gather(rows), "gathered")
    grams = gathered.where(f"kind = {GRAM}").select("key", "n")
    ends = rows.where("train").count()
    distinct, total = gathered.where(f"kind = {WORD}").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    train_tokens, vocabulary = total + ends, distinct + (ends > 0)
    below = float(train_tokens + (vocabulary + 1))
    log_share = lambda c: F.log10((c + 1) / F.lit(below))
    word_scores = gathered.where(f"kind = {WORD}").select("key", "n", log_share(F.col("n")).alias("value"))
    gram_values = written(gram_scores(grams, fit_tree(grams)), "gram-scores")
    (gram_head, gram_tail), (word_head, word_tail) = _head(gram_values, head), _head(word_scores, head)
    scored = written(_score(rows, gram_head, word_head).withColumn("row", F.monotonically_increasing_id()), "scored")

    more_grams = scored.select("row", F.explode("grams").alias("key")).join(gram_tail, "key").groupBy("row").agg(F.sum("value").alias("more"))
    more_words = (
        scored.select("row", F.explode("words").alias("key")).join(word_tail, "key", "left").groupBy("row")
        .agg(F.sum(F.coalesce("value", F.lit(-math.log10(below)))).alias("more_base"), F.count("value").alias("more_known"))
    )
    end = math.log10((ends + 1) / below)
    zero = F.lit(0.0)
    whole = scored.drop("grams", "words").join(more_grams, "row", "left").join(more_words, "row", "left")
    return whole.select(
        "doc_id", (~F.col("train")).alias("held_out"), (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_known") + F.coalesce("more_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", zero) + end).alias("base_score"),
        (F.col("score") + F.coalesce("more", zero)).alias("score"),
        F.when(F.col("n_bytes") > 0, -(F.col("score") + F.coalesce("more", zero)) * math.log2(10) / F.col("n_bytes")).alias("bits_per_byte"),
    )


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of `docs(doc_id, text)`; fold 2 of 7 is held out."""
    return score_texts(docs.select("doc_id", "text", (fold(F.col("doc_id"), 7) != 2).alias("train")))
