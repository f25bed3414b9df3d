"""License scans by a positional rare-token index [DataFrame functions only].

Each template is a license notice with a mandatory key phrase inside it. The
index holds, for the two highest-IDF words of a key phrase, their offset in the
template; IDF is counted over all documents. A text is looked up by those words
alone: each hit gives the place where the template would start, the two sets of
starts are intersected, the key phrase is verified word for word, and the score
is the IDF share of the template's words found at their relative positions.

All of this happens inside the row, so matching needs no shuffle; the only one
counts the documents of each licence word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    label: str
    notice: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.notice.split()

    @property
    def key_words(self) -> list[str]:
        return self.key.split()

    @property
    def key_at(self) -> int:
        n = len(self.key_words)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key_words)


# fixed values: the phrases and labels of the contract, then notices of public licences with their key phrases
TEMPLATES = (
    Template("cc-by", "cc by", "cc by", True),
    Template("gpl", "general public license", "general public license", True),
    Template("reserved", "all rights reserved", "all rights reserved", True),
    Template("agpl-3.0", "gnu affero general public license version 3", "affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("bsl-1.0", "distributed under the boost software license version 1 0", "boost software license"),
    Template("cc-by-4.0", "this work is licensed under cc by 4 0", "cc by 4 0"),
    Template("cc-by-nc", "this work is licensed under cc by nc", "cc by nc"),
    Template("cc-by-sa", "this work is licensed under cc by sa", "cc by sa"),
    Template("cc-by-text", "licensed under a creative commons attribution license", "creative commons attribution"),
    Template("cc0-1.0", "cc0 1 0 universal public domain dedication", "cc0 1 0"),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", "eclipse public license"),
    Template("gpl-2.0", "gnu general public license version 2", "general public license version 2"),
    Template("gpl-3.0", "gnu general public license version 3", "general public license version 3"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose", "and or distribute this software"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted free of charge"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
LEAST_SCORE = 0.5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START_BITS = 40  # a candidate is one long: template number, then its start
_AHEAD = 1 << 16  # added to a start: a template may begin before the text


def license_words(text: Column) -> Column:
    """The words of a text: A-Z lowered, cut at ASCII characters that are no letter or digit."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def document_frequencies(docs: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of rows, and of rows with each licence word. The result is bounded by the templates."""
    vocabulary = sorted({word for t in TEMPLATES for word in t.words})
    literal = F.array(*map(F.lit, vocabulary))
    found = docs.select(F.array_intersect(license_words(F.col("text")), literal).alias("found"))
    counted = (
        found.select(F.explode(F.array_append("found", F.lit(""))).alias("word"))  # the empty word counts rows
        .groupBy("word").count()
    )
    counts = {row["word"]: row["count"] for row in counted.collect()}
    return counts.pop("", 0), counts


def inverse_frequencies(docs: DataFrame) -> dict[str, float]:
    total, counts = document_frequencies(docs)
    words = {word for t in TEMPLATES for word in t.words}
    return {word: math.log((1 + total) / (1 + counts.get(word, 0))) + 1 for word in words}


def _rare(t: Template, idf: dict[str, float]) -> list[tuple[str, int]]:
    """The two highest-IDF words of the key phrase with their offsets in the template."""
    ranked = sorted(set(t.key_words), key=lambda word: (-idf[word], word))[:2]
    return [(word, t.key_at + t.key_words.index(word)) for word in ranked]


def _long_array(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def _map(pairs: list[tuple]) -> Column:
    return F.create_map(*[item for key, value in pairs for item in (F.lit(key), value)])


def _starts(hits: Column, postings: dict[str, list[tuple[int, int]]]) -> Column:
    """Candidates `template << 40 | start + _AHEAD` of all hits."""
    index = _map([(word, F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(at).alias("at")) for t, at in found]))
                  for word, found in sorted(postings.items())])
    each = F.transform(hits, lambda hit: F.transform(
        F.coalesce(F.try_element_at(index, hit["word"]), F.array().cast("array<struct<t:bigint,at:int>>")),
        lambda p: F.shiftleft(p["t"], _START_BITS) + hit["pos"] - p["at"] + F.lit(_AHEAD)))
    return F.flatten(each)


def scan_licenses(docs: DataFrame, idf: dict[str, float] | None = None) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, n_matches (places of all labels).

    A null text counts as empty: no words, no labels, score 0, null places. Text
    outside ASCII belongs to words. Overlapping and repeated places all count. A notice may begin
    before the text, if its key phrase is in the text; it is then measured by the words that have a place in it.
    Other columns of `docs` are ignored; an empty table gives no rows. `idf`
    defaults to the frequencies over `docs`.
    """
    idf = inverse_frequencies(docs.select("text")) if idf is None else idf
    first, second = {}, {}
    for number, t in enumerate(TEMPLATES):
        for postings, (word, at) in zip((first, second), _rare(t, idf)):
            postings.setdefault(word, []).append((number, at))
    rare = sorted({*first, *second})
    mask = (1 << _START_BITS) - 1

    words = docs.select("doc_id", license_words(F.col("text")).alias("w"))
    hits = F.array_compact(F.transform("w", lambda word, i: F.when(
        word.isin(*rare), F.struct(i.cast("long").alias("pos"), word.alias("word")))))
    looked_up = words.withColumn("hits", F.when(
        F.arrays_overlap("w", F.array(*map(F.lit, rare))), hits
    ).otherwise(F.array().cast("array<struct<pos:bigint,word:string>>")))
    met = looked_up.withColumn("met", F.array_intersect(_starts(F.col("hits"), first), _starts(F.col("hits"), second)))

    keys = _map([(n, F.array(*map(F.lit, t.key_words))) for n, t in enumerate(TEMPLATES)])
    key_at = _long_array([t.key_at for t in TEMPLATES])
    key_size = _long_array([len(t.key_words) for t in TEMPLATES])
    parts = _map([(n, F.array(*[
        F.struct(F.lit(i).alias("at"), F.lit(word).alias("word"), F.lit(idf[word]).alias("idf")) for i, word in enumerate(t.words)
    ])) for n, t in enumerate(TEMPLATES)])
    totals = F.array(*[F.lit(float(sum(idf[word] for word in t.words))) for t in TEMPLATES])

    def number(c: Column) -> Column:
        return F.shiftright(c, _START_BITS).cast("int")

    def start(c: Column) -> Column:
        return c.bitwiseAND(F.lit(mask)) - F.lit(_AHEAD)

    def verified(c: Column) -> Column:
        at = (start(c) + F.get(key_at, number(c)) + 1).cast("int")
        inside = F.slice(F.col("w"), F.greatest(at, F.lit(1)), F.get(key_size, number(c)).cast("int")) == F.element_at(keys, number(c))
        return (at >= 1) & inside  # the key phrase itself stands in the text

    def score(c: Column) -> Column:
        found = F.aggregate(F.element_at(parts, number(c)), F.lit(0.0), lambda total, p: total + F.when(
            F.get(F.col("w"), (start(c) + p["at"]).cast("int")).eqNullSafe(p["word"]), p["idf"]).otherwise(F.lit(0.0)))
        inside = F.aggregate(F.element_at(parts, number(c)), F.lit(0.0), lambda total, p: total + F.when(
            start(c) + p["at"] >= 0, p["idf"]).otherwise(F.lit(0.0)))
        return F.least(F.lit(1.0), found / F.when(start(c) >= 0, F.get(totals, number(c))).otherwise(inside))

    base = [n for n, t in enumerate(TEMPLATES) if t.base]
    labels = F.array(*[F.lit(t.label) for t in TEMPLATES])
    matched = met.withColumn("sure", F.filter("met", verified)).select(
        "doc_id", F.size("w").cast("long").alias("n_words"),
        F.filter(F.transform("sure", lambda c: F.struct(number(c).alias("t"), start(c).alias("at"), score(c).alias("score"))),
                 lambda m: m["score"] >= LEAST_SCORE).alias("m"),
    )
    bases = matched.withColumn("b", F.filter("m", lambda m: m["t"].isin(*base)))

    def joined(column: str) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda m: F.get(labels, m["t"])))), ",")

    return bases.select(
        "doc_id", "n_words", F.size("b").cast("long").alias("n_base"),
        F.array_min("b.at").alias("first_word"), F.array_max("b.at").alias("last_word"),
        joined("b").alias("base_labels"), joined("m").alias("labels"),
        F.coalesce(F.array_max("m.score"), F.lit(0.0)).alias("score"),
        F.size("m").cast("long").alias("n_matches"),
    )


def oracle() -> str:
    """The same rows from key phrases alone: every place of a key phrase, scored by its template."""
    quote = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ", ".join(
        f"('{t.label}', {t.base}, {quote(t.words)}, {quote(t.key_words)}, {t.key_at})" for t in TEMPLATES
    )
    return rf"""
with texts as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), templates(label, base, words, key, key_at) as (values {rows}),
vocabulary as (select distinct unnest(words) as word from templates),
spread as (select r, unnest(w) as word, unnest(range(len(w))) as i from texts),
counts as (select word, count(distinct r) as n from spread semi join vocabulary using (word) group by 1),
idf as (select word, ln((1 + (select count(*) from texts)) / (1.0::double + coalesce(n, 0))) + 1 as idf from vocabulary left join counts using (word)),
places as (
  select s.r, t.label, t.base, t.words, s.i - t.key_at as start, x.w
  from spread s join templates t on s.word = t.key[1] join texts x using (r)
  where x.w[s.i + 1:s.i + len(t.key)] = t.key
), parts as (
  select r, label, base, start, word, start + j >= 0 as inside, start + j >= 0 and w[greatest(start + j, 0) + 1] = word as same
  from (select r, label, base, start, w, unnest(words) as word, unnest(range(len(words))) as j from places)
), scored as (
  select r, label, base, start, least(1.0, sum(case when same then idf else 0 end) / sum(case when inside then idf end)) as score
  from parts join idf using (word) group by 1, 2, 3, 4
), found as (
  select r, count(*) filter (base) as n_base, min(start) filter (base) as first_word, max(start) filter (base) as last_word,
         string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) as labels,
         max(score) as score, count(*) as n_matches
  from scored where score >= {LEAST_SCORE} group by 1
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, cast(first_word as bigint) as first_word,
       cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
       round(coalesce(score, 0.0::double), 6) as score, cast(coalesce(n_matches, 0) as bigint) as n_matches
from texts left join found using (r)
"""
