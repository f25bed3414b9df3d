"""Exact substring dedup by distributed prefix doubling over sampled positions.

Suffix arrays by prefix doubling rank all positions by short prefixes, pair each rank
with the one at an offset, and rank anew until a position is unique or the threshold
is passed. Here the same is done for the positions that decide: every LENGTH-byte
window names the smallest hashed string of a size inside it, its anchor, and equal
windows name equal anchors at equal places. So

1. anchors of SHORT bytes are ranked, paired with the rank of the whole stretch
   of windows that name them. Spark sorts the pairs. A stretch that occurs earlier is
   repeated as a whole; an anchor of one stretch alone is unique and drops out;
2. windows of what is left, stretches that share an anchor but differ somewhere, name
   anchors of LONG bytes, which are ranked in the same way. Most windows over a byte that
   differs have an anchor of their own and drop out;
3. the single windows of what is left then are ranked by their anchor and the LENGTH - LONG
   bytes around it, which step 2 kept; all but the first of a rank are repeated.

Ranks are 64-bit names of byte strings. Tasks leave out what is repeated within
themselves before they shuffle, so a string that is everywhere costs one row per task.
Each step is written, and its shuffle files go before the next one begins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import row_key, written
from gridcast.llm.rolling import CHUNK_BYTES, Hasher, mix, pieces
from gridcast.llm.tokens import text_bytes
from gridcast.operators.groups import join_small_groups

LENGTH, SHORT, LONG = 100, 32, 84
_EDGE = LENGTH - LONG
_FLUSH = 1 << 20
_PLACE_BITS = 22  # of a place in a slice


def slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(first text, bytes, offsets, place of the first byte in its text): runs of texts, and long
    texts in parts that overlap so that each window lies in one part."""
    for a, b in pieces(offsets):
        begin, size = offsets[a], offsets[b] - offsets[a]
        if size <= CHUNK_BYTES:
            yield a, data[begin:begin + size], offsets[a:b + 1] - begin, 0
        else:
            for s in range(0, size, CHUNK_BYTES):
                part = data[begin + s:begin + min(size, s + CHUNK_BYTES + LENGTH - 1)]
                yield a, part, np.array([0, len(part)]), s


def window_anchors(names: np.ndarray, span: int) -> np.ndarray:
    """For each window of `span` names the place of its smallest one, the first of equals."""
    shift = np.uint64(_PLACE_BITS)
    low = names >> shift << shift | np.arange(len(names), dtype=np.uint64)
    reach = 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = span - reach
    low = np.minimum(low[:len(low) - rest], low[rest:]) if rest else low
    return (low & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)


def anchor_rows(data: np.ndarray, offsets: np.ndarray, hasher: Hasher, size: int) -> tuple[np.ndarray, ...]:
    """Per anchor of `size` bytes: text, first and last window, place of the anchor, its name, name of its stretch."""
    if len(data) < LENGTH:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    sums = hasher.prefix(data)
    place = np.arange(len(data) - size + 1)
    names = hasher.between(sums, place, place + size)
    anchor = window_anchors(names, LENGTH - size + 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    window = np.flatnonzero(text[:len(anchor)] == text[LENGTH - 1:])
    anchor = anchor[window]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(window) else np.zeros(0, np.int64)
    low, anchor = window[first], anchor[first]
    high = window[np.append(first[1:], len(window)) - 1] if len(first) else low
    form = ((anchor - low) * LENGTH + (high - low)).astype(np.uint64)
    stretch = mix(hasher.between(sums, low, high + LENGTH) + form)
    start = offsets[text[low]]
    return text[low], low - start, high - start, anchor - start, names[anchor], stretch


def around(data: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Per stretch of an anchor of LONG bytes the bytes of its windows before and after the anchor, zeros to the full width."""
    step = np.arange(2 * _EDGE, dtype=np.int32)
    at = low.astype(np.int32)[:, None] + step
    at += (step >= (anchor - low)[:, None]) * np.int32(LONG)
    np.minimum(at, len(data) - 1, out=at)
    return data[at] * (step < (_EDGE + high - low)[:, None])


def window_names(short: np.ndarray, lead: np.ndarray, edges: np.ndarray, skip: np.ndarray) -> np.ndarray:
    """Names of windows `skip` places after the first of their stretch: of the anchor, its place in the window and the bytes around it."""
    own = np.take_along_axis(edges, skip[:, None] + np.arange(_EDGE), 1).view(np.uint64)
    name = mix(short + (lead - skip).astype(np.uint64))
    for i in range(own.shape[1]):
        name = mix(name ^ own[:, i])
    return name


def _merged(key: np.ndarray, part: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows of a text joined where their bytes touch or overlap: key, part, first and last window."""
    if not len(key):
        return key, part, low, high
    order = np.lexsort((low, part, key))
    key, part, low, high = key[order], part[order], low[order], high[order]
    # number the texts, so that one running maximum serves all of them
    base = np.cumsum(np.append(0, (key[1:] != key[:-1]) | (part[1:] != part[:-1]))) << 40
    reach = np.maximum.accumulate(base + high + LENGTH)
    fresh = np.append(True, base[1:] + low[1:] > reach[:-1])
    first = np.flatnonzero(fresh)
    return key[first], part[first], low[first], np.maximum.reduceat(high, first)


class _Kept:
    """Rows (short, full, key, part, low, high, more) of a task, without those whose full name it has seen at an earlier place.

    A place is the id and where the window starts; at one place there may be texts of several rows, of which none is earlier.
    With `alone` there is one name, which goes out as the short one. What is `more` goes out with a row.
    """

    def __init__(self, alone: bool, most: int = _FLUSH):
        self.alone, self.most, self.parts, self.size = alone, most, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.size += len(columns[0])
        if self.size >= self.most:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        short, full, key, part, low, high, *more = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.size = [], 0
        order = np.lexsort((part, low, key, full))
        short, full, key, part, low, high = (c[order] for c in (short, full, key, part, low, high))
        named = np.append(True, full[1:] != full[:-1])
        begin = np.flatnonzero(named)[np.cumsum(named) - 1]  # the first row of the same name
        again = (key != key[begin]) | (low != low[begin])
        # rows that are equal in all are one text, stored several times
        fresh = ~again & (named | np.append(True, part[1:] != part[:-1]))
        if self.alone:
            full = np.zeros(len(full), np.uint64)
        later = _merged(key[again], part[again], low[again], high[again])
        yield _batch(False, short[fresh], full[fresh], key[fresh], part[fresh], low[fresh], high[fresh], *(c[order[fresh]] for c in more))
        # repeated stretches only pass the shuffle: any name will do that spreads them
        yield _batch(True, mix(later[0].astype(np.uint64) ^ mix(later[2].astype(np.uint64))), np.zeros(len(later[0]), np.uint64), *later,
                     *(np.zeros((len(later[0]), *c.shape[1:]), c.dtype) for c in more))


_ROW = "again boolean, short long, full long, key long, part long, low long, more long"  # more: windows after the first
_MORE = ["lead", "edges"]  # of anchors of LONG bytes: their place after the first window's, the bytes around them
_LONG_ROW = _ROW + ", lead long, edges binary"


def _batch(again: bool, short, full, key, part, low, high, lead=None, edges=None) -> pa.RecordBatch:
    columns = [
        pa.array(np.full(len(key), again)), pa.array(short.astype(np.int64)), pa.array(full.astype(np.int64)),
        pa.array(key.astype(np.int64)), pa.array(part.astype(np.int64)), pa.array(low.astype(np.int64)), pa.array((high - low).astype(np.int64)),
    ]
    names = [f.split()[0] for f in _ROW.split(", ")]
    if edges is None:
        return pa.RecordBatch.from_arrays(columns, names)
    wide = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * _EDGE), len(key), [None, pa.py_buffer(np.ascontiguousarray(edges))])
    return pa.RecordBatch.from_arrays([*columns, pa.array(lead), wide.cast(pa.binary())], [*names, *_MORE])


def _anchors(rows: DataFrame) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, kept = Hasher(lower=False), _Kept(alone=False)
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            keys, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, piece, bounds, skipped in slices(data, offsets):
                text, low, high, _, short, full = anchor_rows(piece, bounds, hasher, SHORT)
                yield from kept.add(short, full, keys[first + text], parts[first + text], low + skipped, high + skipped)
        yield from kept.rows()

    return rows.mapInArrow(find, _ROW)


def joined_ranges(of: np.ndarray, low: np.ndarray, high: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Sorted ranges of windows of texts, those joined that follow each other, in parts of at most `most` windows."""
    if not len(of):
        return of, low, high
    first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (low[1:] != high[:-1] + 1)))
    of, low, high = of[first], low[first], high[np.append(first[1:], len(of)) - 1]
    count = (high - low) // most + 1
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    of, low, high = np.repeat(of, count), np.repeat(low, count) + nth * most, np.repeat(high, count)
    return of, low, np.minimum(high, low + most - 1)


def _long_anchors(ranged: DataFrame) -> DataFrame:
    """The same rows for the windows of `ranged(key, part, text, ranges)` by anchors of LONG bytes, with the bytes around them."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, kept = Hasher(lower=False), _Kept(alone=False, most=_FLUSH // 4)
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            keys, parts, lists = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            of = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            of, begin, end = joined_ranges(of, *(lists.flatten().field(i).to_numpy() for i in range(2)), CHUNK_BYTES)
            ends = np.append(0, np.cumsum(end - begin + LENGTH))
            for a, b in pieces(ends):
                bounds = ends[a:b + 1] - ends[a]
                piece = data[np.arange(bounds[-1]) + np.repeat(offsets[of[a:b]] + begin[a:b] - bounds[:-1], np.diff(bounds))]
                nth, low, high, anchor, short, full = anchor_rows(piece, bounds, hasher, LONG)
                edges, nth, start = around(piece, low + bounds[nth], high + bounds[nth], anchor + bounds[nth]), nth + a, begin[a + nth]
                yield from kept.add(short, full, keys[of[nth]], parts[of[nth]], low + start, high + start, anchor - low, edges)
        yield from kept.rows()

    return ranged.mapInArrow(find, _LONG_ROW)


def _windows(stretches: DataFrame) -> DataFrame:
    """The same rows for the single windows of `stretches(short, key, part, low, high, lead, edges)`; short and full are one name."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = _Kept(alone=True)
        for batch in batches:
            short, key, part, low, high, lead = (batch.column(i).to_numpy() for i in range(6))
            edges = np.frombuffer(b"".join(batch.column(6).to_pylist()), np.uint8).reshape(-1, 2 * _EDGE)
            count = high - low + 1
            row = np.repeat(np.arange(len(low)), count)
            skip = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            name, place = window_names(short[row].astype(np.uint64), lead[row], edges[row], skip), low[row] + skip
            yield from kept.add(name, name, key[row], part[row], place, place)
        yield from kept.rows()

    return stretches.mapInArrow(find, _ROW)


def _ranked(rows: DataFrame, *kept: str) -> DataFrame:
    """Sort by name and place: (again, open, key, part, low, high), again for what occurs at an earlier place, open for
    what is at the first place of its full name while its short name has other full names too, with the columns `kept`."""
    same = Window.partitionBy("again", "short").orderBy("full", "key", "low")
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # sorted as the window above
    named = Window.partitionBy("again", "short", "full").orderBy("key", "low").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(
        (F.col("again") | (F.first("key").over(named) != F.col("key")) | (F.first("low").over(named) != F.col("low"))).alias("again"),
        (F.first("full").over(whole) != F.last("full").over(whole)).alias("open"), "key", "part", "low",
        (F.col("low") + F.col("more")).alias("high"), *kept,
    ).where("again or open")


def _listed(rows: DataFrame, name: str) -> DataFrame:
    """The ranges of each text in one array; a text has fewer than its bytes."""
    return rows.groupBy("key", "part").agg(F.sort_array(F.collect_set(F.struct("low", "high"))).alias(name))


def repeated_runs(rows: DataFrame) -> DataFrame:
    """(key, part, low, high) for `rows(key, part, text)`: runs of first bytes of windows that occur at an earlier (key, place)."""
    first = written(_ranked(_anchors(rows)), "anchors")
    ranges = _listed(first.where("open and not again"), "ranges")
    second = written(_ranked(_long_anchors(rows.join(ranges, ["key", "part"]).select("key", "part", "text", "ranges")), "short", *_MORE), "stretches")
    stretches = second.where("open and not again").select("short", "key", "part", "low", "high", *_MORE)
    third = written(_ranked(_windows(stretches)).where("again"), "windows")
    return reduce(DataFrame.unionByName, (step.where("again").select("key", "part", "low", "high") for step in (first, second, third)))


def _parted(rows: DataFrame) -> DataFrame:
    """`rows(key, text)` with `part`: 0, or a name of the text where rows of one key differ in their texts."""
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    several = written(
        rows.select("key", hashed.alias("h")).groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a != b").select("key"), "several")
    if several.isEmpty():
        return rows.withColumn("part", F.lit(0).cast("long"))
    marked = join_small_groups(rows, several.withColumn("_several", F.lit(True)), ["key"], how="left")
    return marked.withColumn("part", F.when(F.col("_several"), hashed).otherwise(F.lit(0)).cast("long")).drop("_several")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed if a LENGTH-byte string over it also starts earlier: in a row of
    smaller doc_id, or earlier in a row of the same one; removed or not, all strings count. A
    null text has no bytes, and a text of fewer than LENGTH bytes keeps all. Of rows
    that repeat an id, with equal or other texts, none is earlier than the others: only where a string
    starts decides among them, so equal rows keep what is new in them, each. Rows without an id come after all
    others, in an order set by their texts, and behave alike. Other columns are ignored; an empty
    table gives no rows.
    """
    rows = _parted(docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text"))
    runs = _listed(repeated_runs(rows.select("key", "part", "text")), "runs")
    marked = rows.join(runs, ["key", "part"], "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "runs")
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            lists = batch.column(2)
            edge = lists.offsets.to_numpy()
            low, high = (lists.values.field(i).to_numpy() for i in range(2))
            out = []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                own = slice(edge[i], edge[i + 1]) if lists[i].is_valid else slice(0, 0)
                none = np.zeros(len(low[own]), np.int64)
                *_, begin, end = _merged(none, none, low[own], high[own])
                kept, at, removed = hashlib.sha256(), a, 0
                for s, e in zip(begin.tolist(), end.tolist()):
                    kept.update(data[at:a + s])
                    at, removed = a + e + LENGTH, removed + e + LENGTH - s
                kept.update(data[at:b])
                out.append((b - a, removed, len(begin), kept.hexdigest()))
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], names)

    return marked.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
