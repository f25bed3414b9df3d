"""Benchmark decontamination by spaced-seed hashing.

A mask says which words of a window count; the others may be anything, so a
substituted word spoils only the masks that look at it. Seeds of the test items
are looked up for every window of every document; a hit gives a document, an item
and the shift between them. Along that shift the words are compared one by one. A
document is contaminated by an item if some stretch in which at most a fifth of the
words differ has at least LEAST_WORDS words, or all the words of a shorter item.

No such stretch is missed. One of 26 words or more has a half of at least 13 words in
which at most a fifth differ, so there is one of 13 to 25 words; MASKS have a window
without a differing word in each of those, wherever the differing words are. Shorter
items have masks for each place of their differing words.

The items are taken in blocks of a bounded number of words. The seeds of a block
go to every task; the documents are read once per block and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import Sent, written
from gridcast.llm.rolling import ALNUM, Hasher, mix, numbers, pieces, words
from gridcast.llm.tokens import text_bytes

# fixed values: masks of weight 6 that together find every stretch of 13 to 25 words
MASKS = ("1101111", "11010001011", "1110001000101")
LEAST_WORDS = 13
PENALTY = 4  # a differing word costs as much as four equal ones: one in five at most
BLOCK_WORDS = 1 << 20
_BITS = 22


def seeds(hashes: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The seed of each window of a run of word hashes."""
    n = max(0, len(hashes) - len(mask) + 1)
    total = np.zeros(n, np.uint64)
    factors = numbers(len(mask), 1000 + number) | np.uint64(1)
    for i, used in enumerate(mask):
        if used == "1":
            total += hashes[i:i + n] * factors[i]
    return mix(total)


def short_masks(n: int) -> list[str]:
    """Masks for an item of n < LEAST_WORDS words: one of them leaves out any n // 5 differing words."""
    parts = np.array_split(np.arange(n), n if n < 10 else 4)
    out = []
    for left_out in combinations(range(len(parts)), n // (PENALTY + 1)):
        free = {i for k in left_out for i in parts[k].tolist()}
        out.append("".join("0" if i in free else "1" for i in range(n)))
    return out


def best_stretch(same: np.ndarray, least: int) -> tuple[int, int] | None:
    """Begin and end of the run of at least `least` words with the most equal words, then the first, in
    which the sum of 1 for equal and -PENALTY for differing words is not negative; None if there is none."""
    equal = np.append(0, np.cumsum(same))
    place = np.arange(len(equal))
    upto = equal - PENALTY * (place - equal)
    # the earliest begin for each end: the first sum that is not above the one there
    begins = np.searchsorted(-np.minimum.accumulate(upto), -upto)
    ends = place[place - begins >= least]
    if not len(ends):
        return None
    begins = begins[ends]
    k = np.lexsort((ends, begins, equal[begins] - equal[ends]))[0]
    begin, end = int(begins[k]), int(ends[k])
    while end - begin > least and not same[begin]:
        begin += 1
    return begin, end


class Seeds:
    """The seeds of a block of items, sorted, behind a bitmap that turns most windows away."""

    def __init__(self, items: list[tuple[int, bytes]], shortest: int = 1):
        hasher = Hasher(lower=True)
        self.items, self.words = [], []
        for item_id, text in items:
            hashes, _ = words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM, hasher)
            if len(hashes) >= shortest:
                self.items.append(item_id)
                self.words.append(hashes)
        lengths = sorted({len(w) for w in self.words if len(w) < LEAST_WORDS})
        # a shorter item counts as a whole only, so its masks have its length
        self.masks = [*MASKS, *(m for n in lengths for m in short_masks(n))]
        self.tables = []
        for number, mask in enumerate(self.masks):
            short = number >= len(MASKS)
            found = [(seeds(w, mask, number), i) for i, w in enumerate(self.words)
                     if (len(w) == len(mask) if short else len(w) >= LEAST_WORDS)]
            keys = np.concatenate([s for s, _ in found]) if found else np.zeros(0, np.uint64)
            item = np.concatenate([np.full(len(s), i) for s, i in found]) if found else np.zeros(0, int)
            place = np.concatenate([np.arange(len(s)) for s, _ in found]) if found else np.zeros(0, int)
            order = np.argsort(keys, kind="stable")
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[keys >> np.uint64(64 - _BITS)] = True
            self.tables.append((keys[order], item[order], place[order], bitmap))

    def hits(self, hashes: np.ndarray, upto: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, number of an item, shift of its first word) of all seeds shared with a run of texts.

        `upto` has the number of words before each text; a window across two texts is none.
        """
        found = set()
        for number, (mask, (keys, item, place, bitmap)) in enumerate(zip(self.masks, self.tables)):
            mine = seeds(hashes, mask, number)
            at = np.flatnonzero(bitmap[mine >> np.uint64(64 - _BITS)])
            low, high = np.searchsorted(keys, mine[at]), np.searchsorted(keys, mine[at], "right")
            text = np.searchsorted(upto, at, "right") - 1
            real = (high > low) & (at + len(mask) <= upto[text + 1])
            for p, d, a, b in zip(at[real].tolist(), text[real].tolist(), low[real].tolist(), high[real].tolist()):
                found.update((d, int(item[k]), p - int(place[k]) - int(upto[d])) for k in range(a, b))
        return found

    def overlaps(self, hashes: np.ndarray, upto: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int, int]]:
        """For each (text, item) that is contaminated: equal words, words, first word there, first word of the item."""
        best = {}
        for d, i, shift in self.hits(hashes, upto):
            item, own = self.words[i], hashes[upto[d]:upto[d + 1]]
            first, last = max(0, -shift), min(len(item), len(own) - shift)
            same = item[first:last] == own[first + shift:last + shift]
            if stretch := best_stretch(same, min(LEAST_WORDS, len(item))):
                begin, end = stretch
                row = (int(same[begin:end].sum()), end - begin, first + begin + shift, first + begin)
                best[d, i] = max(best.get((d, i), row), row, key=lambda r: (r[0], -r[2]))
        return best


def _blocks(items: DataFrame, shortest: int) -> Iterator[Seeds]:
    """Blocks of about BLOCK_WORDS words, each brought to the driver alone."""
    sized = written(
        items.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
        .withColumn("n", F.size(F.split("text", r"\s+"))), "benchmark",
    )
    total = sized.agg(F.sum("n")).first()[0] or 0
    count = int(total // BLOCK_WORDS) + 1
    for k in range(count):
        part = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k).select("item_id", "text").toArrow()
        block = Seeds(sorted((i, t.encode()) for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())), shortest)
        if block.items:
            yield block


def find_overlaps(docs: DataFrame, items: DataFrame, shortest: int = 1) -> DataFrame:
    """One row per contaminated row of `docs(doc_id, text)` and item of `items(item_id, text)`: doc_id,
    item_id, n_equal, n_words, doc_word, item_word (where the stretch begins).

    Words are runs of letters, digits and bytes outside ASCII, A-Z lowered. Of
    several stretches of a pair the one of most equal words is given, then the
    first. Items of fewer than five words match as a whole and exactly; `shortest` leaves out items of
    fewer words than that, by default none. Null or empty texts match nothing, items of null id, null
    text or no word are left out. Rows that repeat are each reported. Other
    columns are ignored; an empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, n_equal long, n_words long, doc_word long, item_word long"
    parts = [spark.createDataFrame([], schema)]
    for block in _blocks(items, shortest):
        shared = Sent(spark, block)

        def scan(batches: Iterator[pa.RecordBatch], shared: Sent = shared) -> Iterator[pa.RecordBatch]:
            known, hasher = shared.value, Hasher(lower=True)
            names = [f.split()[0] for f in schema.split(", ")]
            for batch in batches:
                data, offsets = text_bytes(batch.column(1))
                rows = []
                for a, b in pieces(offsets):
                    bounds = offsets[a:b + 1] - offsets[a]
                    hashes, upto = words(data[offsets[a]:offsets[b]], bounds, ALNUM, hasher)
                    rows += [(batch.column(0)[a + d].as_py(), known.items[i], *row)
                             for (d, i), row in known.overlaps(hashes, upto).items()]
                columns = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        parts.append(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, schema))
    return reduce(DataFrame.unionByName, parts)
