"""Fill-in-the-middle transformation: texts cut at two random unit borders and rearranged.

A unit is a run of white space with the solid run after it, or white space at the
end of the text: `[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+`. Only ASCII
white space separates, so units end on the same bytes as on code points.

A batch of texts is one run of bytes, viewed as words of eight. Arithmetic on whole
words (SWAR) raises the high bit of each byte that ends a unit; bitwise_count per word
and a running sum give the number of units up to each word. The unit at which a text
is cut is found by a binary search of that sum, and its byte by a select inside the word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from gridcast.llm.common import fresh
from gridcast.llm.rolling import pieces
from gridcast.llm.tokens import text_bytes

# fixed values: the marks of the parts, the seed and the shares in percent
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 42, 50, 80

_ONES = np.uint64(0x0101010101010101)
_HIGH = _ONES << np.uint64(7)


def words_of(data: np.ndarray) -> np.ndarray:
    """The bytes as words of eight, first byte lowest; padded with zeros and one more word."""
    padded = np.zeros((len(data) // 8 + 2) * 8, np.uint8)
    padded[:len(data)] = data
    return padded.view("<u8")


def _at_least(low: np.ndarray, value: int) -> np.ndarray:
    # `low` has no high bits, so no byte of the sum carries into the next one
    return (low + _ONES * np.uint64(128 - value)) & _HIGH


def unit_ends(words: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words whose high bits mark the last byte of each unit; `offsets` bound the texts."""
    low = words & ~_HIGH
    blank = (_at_least(low, 9) & ~_at_least(low, 14)) | (_at_least(low, 32) & ~_at_least(low, 33))
    blank &= ~words
    after = blank >> np.uint64(8)
    after[:-1] |= blank[1:] << np.uint64(56)
    ends = ~blank & after & _HIGH
    last = offsets[1:][np.diff(offsets) > 0] - 1  # a text ends a unit wherever it ends
    np.bitwise_or.at(ends, last >> 3, np.uint64(128) << ((last & 7) << 3).astype(np.uint64))
    return ends


def char_starts(words: np.ndarray) -> np.ndarray:
    """Words whose high bits mark all bytes but the later ones of a code point."""
    return (~words | (words << np.uint64(1))) & _HIGH


class Marks:
    """Rank and select over marked bytes."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.cumsum(np.bitwise_count(marks), dtype=np.int64)

    def before(self, at: np.ndarray) -> np.ndarray:
        """The number of marks before each byte."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        inside = self.marks[word] & ((np.uint64(1) << bits) - np.uint64(1))
        return np.where(word > 0, self.upto[word - 1], 0) + np.bitwise_count(inside)

    def place(self, k: np.ndarray) -> np.ndarray:
        """The byte of the k-th mark, from 1."""
        word = np.searchsorted(self.upto, k)
        rank = (k - np.where(word > 0, self.upto[word - 1], 0)).astype(np.uint64)
        sums = (self.marks[word] >> np.uint64(7)) * _ONES  # byte j: the marks in bytes 0 to j
        reached = ((sums | _HIGH) - rank * _ONES) & _HIGH
        return word * 8 + 8 - np.bitwise_count(reached)


def cut_texts(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each text the number of units, the bytes of its two cuts, and the code points before each cut and in all."""
    words = words_of(data)
    ends, chars = Marks(unit_ends(words, offsets)), Marks(char_starts(words))
    first = ends.before(offsets[:-1])
    n = ends.before(offsets[1:]) - first
    cuts = np.sort(draws % (n + 1), axis=0)
    at = [offsets[:-1].copy() for _ in cuts]
    for place, cut in zip(at, cuts):
        place[cut > 0] = ends.place((first + cut)[cut > 0]) + 1
    points = [chars.before(x) for x in (offsets[:-1], *at)]
    return n, at[0], at[1], points[1] - points[0], points[2] - points[1]


def _draw(doc_id: Column, seed: int, which: int) -> Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 8 * which - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
    names: tuple[str, str, str, str, str] = ("fim_text", "form", "n", "prefix_chars", "middle_chars"),
) -> DataFrame:
    """`docs` with its transformed text, its form, its number of units, and the code points of
    prefix and middle, under `names`; a name that `docs` has already replaces that column.

    The draws are made from `seed` and doc_id alone, so reruns agree and rows that repeat an
    id draw alike; a null id draws as the empty text. A null text is the empty text. The form
    is 'plain' (text as it is, no cut, chars null) for an empty text, one that
    contains a mark, and all but `fim_percent` of the others; else 'spm' for `spm_percent`, or 'psm'.
    Every row comes back, whatever its other columns; an empty table gives an empty table.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    plain = (text == "") | marked | (_draw(F.col("doc_id"), seed, 3) % 100 >= fim_percent)
    form = F.when(plain, "plain").when(_draw(F.col("doc_id"), seed, 4) % 100 < spm_percent, "spm").otherwise("psm")
    kept = [c for c in docs.columns if c.lower() not in {name.lower() for name in names}]
    own = [x.alias(fresh(docs, name)) for x, name in (
        (text, "_text"), (form, "_form"), (_draw(F.col("doc_id"), seed, 1), "_h1"), (_draw(F.col("doc_id"), seed, 2), "_h2"))]
    sent = docs.select(*kept, *own)
    schema = StructType([*sent.schema.fields[:len(kept)]])
    for name, kind in zip(names, (StringType(), StringType(), LongType(), LongType(), LongType())):
        schema.add(name, kind)
    marks = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()

    def rearrange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in pieces(text_bytes(batch.column(len(kept)))[1]):
                part = batch.slice(a, b - a)
                data, offsets = text_bytes(part.column(len(kept)))
                forms = part.column(len(kept) + 1).to_pylist()
                draws = np.stack([part.column(len(kept) + i).to_numpy() for i in (2, 3)])
                n, one, two, before, between = cut_texts(data, offsets, draws)
                whole, out = data.tobytes(), []
                for i, kind in enumerate(forms):
                    start, end = int(offsets[i]), int(offsets[i + 1])
                    cut, again = int(one[i]), int(two[i])
                    prefix, middle, suffix = whole[start:cut], whole[cut:again], whole[again:end]
                    if kind == "psm":
                        out.append(b"".join((marks[0], prefix, marks[1], suffix, marks[2], middle)))
                    elif kind == "spm":
                        out.append(b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle)))
                    else:
                        out.append(whole[start:end])
                plain_rows = np.array([f == "plain" for f in forms], bool)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:len(kept)], pa.array(out, pa.binary()).cast(pa.string()), part.column(len(kept) + 1), pa.array(n, pa.int64()),
                    pa.array(before, pa.int64(), mask=plain_rows), pa.array(between, pa.int64(), mask=plain_rows),
                ], names=[*schema.names])

    return sent.mapInArrow(rearrange, schema)


def restored(text: Column, form: Column) -> Column:
    """The text before the transformation, from the transformed text and its form alone.

    A mark begins with its only '<', so the first place where a mark is read is the mark itself.
    """
    ends = lambda mark: F.locate(mark, text)  # noqa: E731  the place of a mark, from 1
    part = lambda begin, end: F.substring(text, begin + F.lit(3), end - begin - F.lit(3))
    after = F.length(text) + 1
    p, s, m = ends(PREFIX), ends(SUFFIX), ends(MIDDLE)
    psm = F.concat(part(p, s), part(m, after), part(s, m))
    spm = F.concat(part(p, m), part(m, after), part(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the hashes of the transformed and of the restored text."""
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    return fill_in_middle(docs.select("doc_id", "text")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", hashed(F.col("fim_text")).alias("output_sha256"),
        hashed(restored(F.col("fim_text"), F.col("form"))).alias("restored_sha256"))


def oracle() -> str:
    """DuckDB SQL of `digests`, by lists of regular-expression matches."""
    draw = lambda k: f"('0x' || substr(h, {8 * k - 7}, 8))::bigint"
    return f"""
with units as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as u,
    sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), drawn as (
  select *, cast(len(u) as bigint) as n, {draw(1)} % (len(u) + 1) as a, {draw(2)} % (len(u) + 1) as b,
    case when t = '' or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}') or {draw(3)} % 100 >= {FIM_PERCENT} then 'plain'
      when {draw(4)} % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form from units
), cut as (
  select *, array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m,
    array_to_string(u[greatest(a, b) + 1:], '') as s from drawn
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'psm' then '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m when 'spm' then '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m else t end) as output_sha256,
  sha256(t) as restored_sha256 from cut"""
