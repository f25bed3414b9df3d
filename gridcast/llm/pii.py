"""Personal data by rules, and by contexts that the rules' finds teach [DataFrame functions only].

What the base rules find are seeds. The words around a seed are its lexical patterns:
the two words before it, and the word before with the word after. Things that look
like an identifier but miss the rules (`LOOSE`) are unseen instances, and share
patterns with seeds. Patterns and instances form a graph that is scored in rounds:
the score of a pattern is the mean of its instances' scores, where a seed counts 1, and
that of an unseen instance the best of its patterns' scores. Patterns without
enough trusted support score 0. Instances that end with a high score are
identifiers too, wherever they occur. Scores are whole millionths, so reruns agree.

A document is scanned in its row. Only places found, with a few words beside them, leave it;
edges are made distinct and patterns are counted before anything is joined, so that a context
that is everywhere is one row for each distinct instance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import written
from gridcast.operators.groups import join_small_groups

KINDS = ("email", "ip", "card", "phone")
# The rules of the base, written so that Java's matcher needs one pass: a run of characters is entered at its
# start or where the last match ended (\G), and is not given back (++).
_LOCAL = r"[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"[^\s<>\"'(),;:@]"
# What may be an identifier if its context says so: addresses without a dotted domain or beyond ASCII, IPv6 and
# dashed addresses, card numbers with other separators or a wrong check digit, phone numbers without a plus.
LOOSE = {
    "email": rf"(?:\G|(?<!{_PART})){_PART}++@{_PART}++",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])|(?<![0-9-])[0-9]{1,3}(?:-[0-9]{1,3}){3}(?![0-9-])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]?[0-9]{4}){2,3}(?![0-9])|(?<![0-9])[0-9]{4}[\x20._/-]?[0-9]{6}[\x20._/-]?[0-9]{5}(?![0-9])",
    "phone": r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20./-]?[0-9]{3,4}(?![0-9])",
}
# what a text must contain before a rule is worth trying
_NEEDS = {"email": "@", "phone": "+"}
BEFORE, AFTER = 64, 32  # code points beside a place in which its words are looked for
ROUNDS, SUPPORT, CONFIDENCE = 3, 3, 0.8
_ONE = 1_000_000


def _places(text: Column, kind: str, base: bool) -> tuple[Column, Column]:
    """The texts between the matches of a rule, and the matches."""
    rule = BASE[kind] if base else LOOSE[kind]
    worth = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS and (base or kind == "email") else F.lit(True)
    return F.when(worth, F.split(text, rule, -1)), F.when(worth, F.regexp_extract_all(text, F.lit(rule), F.lit(0)))


def _marks(number: int, base: bool, between: Column, hits: Column) -> Column:
    """(kind, base, k, gap, value, before, after) for each match, in order."""
    count = F.size(hits)
    before = F.transform(F.slice(between, 1, count), lambda p: F.struct(
        F.length(p).alias("gap"), F.substring(p, -BEFORE, BEFORE).alias("before")))
    after = F.transform(F.slice(between, 2, count), lambda p: F.substring(p, 1, AFTER))
    joined = F.zip_with(F.zip_with(before, hits, lambda b, h: F.struct(b["gap"].alias("gap"), b["before"].alias("before"), h.alias("value"))), after,
                        lambda b, a: F.struct(b["gap"].alias("gap"), b["value"].alias("value"), b["before"].alias("before"), a.alias("after")))
    return F.transform(joined, lambda m, k: F.struct(
        F.lit(number).alias("kind"), F.lit(base).alias("base"), k.alias("k"), m["gap"].alias("gap"), m["value"].alias("value"),
        m["before"].alias("before"), m["after"].alias("after")))


def valid(kind: Column, value: Column) -> Column:
    """Whether a match of a base rule stands: parts at most 255, 13 to 19 digits passing Luhn, 9 to 15 digits."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.length(digits)
    small = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})(?:\.|$)){4}$"
    return (F.when(kind == 1, value.rlike(small)).when(kind == 2, count.between(13, 19) & F.call_function("luhn_check", digits))
            .when(kind == 3, count.between(9, 15)).otherwise(F.lit(True)))


def _contexts(before: Column, after: Column) -> Column:
    """The lexical patterns of a place; none where no word stands before it."""
    words = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: w != "")
    left = F.slice(F.concat(F.array(F.lit("^"), F.lit("^")), words(before)), -2, 2)
    right = F.concat(words(after), F.array(F.lit("$")))
    patterns = F.array(F.concat(F.lit("l:"), left[0], F.lit(" "), left[1]), F.concat(F.lit("f:"), left[1], F.lit("_"), right[0]))
    return F.when(left[1] != "^", patterns).otherwise(F.array().cast("array<string>"))


def places(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows (row, doc_id) of `docs(doc_id, text)`, and all places found in them:
    (row, kind, base, start, end, value, patterns), loose ones only where they overlap no find of the base."""
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    scans = [(number, kind, base) for base in (True, False) for number, kind in enumerate(KINDS)]
    split = {}
    for number, kind, base in scans:
        split[f"between_{number}_{base}"], split[f"hits_{number}_{base}"] = _places(F.col("text"), kind, base)
    cut = read.select("row", "doc_id", *[c.alias(name) for name, c in split.items()])
    lists = [_marks(n, b, F.col(f"between_{n}_{b}"), F.col(f"hits_{n}_{b}")) for n, _, b in scans]
    empty = F.slice(lists[2], 1, 0)
    found = written(cut.select("row", "doc_id", F.flatten(F.array(*[F.coalesce(x, empty) for x in lists])).alias("marks")), "places")

    # all windows below are over the places of one row
    marks = found.where(F.size("marks") > 0).select("row", F.inline("marks")).repartition("row")
    upto = Window.partitionBy("row", "kind", "base").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    placed = marks.withColumn("end", F.sum(F.col("gap").cast("long") + F.length("value")).over(upto)).withColumn(
        "start", F.col("end") - F.length("value")).where(~F.col("base") | valid(F.col("kind"), F.col("value")))
    earlier = Window.partitionBy("row").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy(F.desc("start"), "base").rowsBetween(Window.unboundedPreceding, -1)
    clear = (F.coalesce(F.max(F.when(F.col("base"), F.col("end"))).over(earlier), F.lit(0)) <= F.col("start")) & F.coalesce(
        F.min(F.when(F.col("base"), F.col("start"))).over(later) >= F.col("end"), F.lit(True))
    kept = placed.withColumn("clear", clear).where(F.col("base") | F.col("clear"))
    return found.select("row", "doc_id"), written(kept.select(
        "row", "kind", "base", "start", "end", F.lower("value").alias("value"), _contexts(F.col("before"), F.col("after")).alias("patterns")), "marks")


def trusted(marks: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """(kind, value, score) of the unseen instances whose score reaches `confidence`, in millionths."""
    edges = marks.select("kind", "base", "value", F.explode("patterns").alias("pattern"))
    unseen = written(edges.where("not base").select("kind", "pattern", "value").distinct(), "unseen")
    seeds = edges.where("base").join(unseen.select("kind", "pattern").distinct(), ["kind", "pattern"], "left_semi")
    counted = written(
        unseen.groupBy("kind", "pattern").agg(F.count("*").alias("unseen"))
        .join(seeds.groupBy("kind", "pattern").agg(F.count_distinct("value").alias("seeds")), ["kind", "pattern"], "left")
        .select("kind", "pattern", "unseen", F.coalesce("seeds", F.lit(0)).alias("seeds")), "patterns")
    scores = unseen.select("kind", "value").distinct().withColumn("score", F.lit(0).cast("long"))
    for _ in range(rounds):
        sums = join_small_groups(unseen, scores, ["kind", "value"]).groupBy("kind", "pattern").agg(F.sum("score").alias("found"))
        weight = F.col("seeds") * _ONE + F.col("found")
        patterns = counted.join(sums, ["kind", "pattern"]).select("kind", "pattern", F.when(
            weight >= support * _ONE, F.floor(weight / (F.col("seeds") + F.col("unseen")))).otherwise(0).cast("long").alias("pattern_score"))
        scores = join_small_groups(unseen, patterns, ["kind", "pattern"]).groupBy("kind", "value").agg(F.max("pattern_score").alias("score"))
    return scores.where(F.col("score") >= round(confidence * _ONE))


def find_pii(docs: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per row of `docs(doc_id, text)`: doc_id and `spans`, an array of (kind, start, end, base, value) by kind, then start.

    Places count code points from 0, ends are exclusive. The matches of a base rule are leftmost and do not overlap
    each other; those that fail its test are dropped and not tried again. `base` is false for an identifier
    found by its context; such a one overlaps no find of the base. Values are in lower case. A null or empty text has no
    spans. Rows that repeat an id or a text are rows of their own, and a value counts once for a pattern
    however often it occurs. Other columns are ignored; an empty table gives an empty table.
    """
    rows, marks = places(docs)
    accepted = trusted(marks, rounds, support, confidence)
    loose = join_small_groups(marks.where("not base"), accepted.select("kind", "value"), ["kind", "value"])
    spans = marks.where("base").unionByName(loose, allowMissingColumns=True).groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("kind", "start", "end", "base", "value"))).alias("spans"))
    named = F.transform("spans", lambda s: F.struct(
        F.array(*map(F.lit, KINDS))[s["kind"]].alias("kind"), *[s[c].alias(c) for c in ("start", "end", "base", "value")]))
    none = F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,base:boolean,value:string>>)")
    return rows.join(spans, "row", "left").select("doc_id", F.coalesce(named, none).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of base finds by kind, the hash of the base spans, and all spans as text."""
    found = find_pii(docs)
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    counts = [number(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
