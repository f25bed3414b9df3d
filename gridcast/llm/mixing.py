"""Mix sources to target weights by Efraimidis-Spirakis sampling [DataFrame functions only].

Every source has a word budget. Whole passes over a source come first; what is
left of the budget takes documents in the order of the exponential key
-ln(u) / w, where u is a hash of the document's id (and of its text, where the id is
null or stands for several texts) and w its quality weight:
the documents of the smallest keys are a weighted sample without replacement.

Prefix sums are cut in two levels. The keys of a source fall into `bins` bins by
their distribution function; sums of whole bins give each bin its start, and only
inside a bin are rows ordered. A source that holds a third of all rows is thus
spread over thousands of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import fresh, row_key, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix-1:"
BINS = 4096
# weight of a document of known quality 1 or 0, and of one of unknown quality
GOOD, POOR, UNKNOWN = 2.0, 0.5, 1.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source, source_size, target, for `sizes(source, size)`.

    Sources by code point, null last, weigh 5, 2, 1, repeating. The level at which
    sources stop at MOST_EPOCHS times their size is found by one running sum over
    the sources in order of that cap per weight. The window holds one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    ranked = totals.withColumn("weight", weight.cast("long")).withColumn("cap", MOST_EPOCHS * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.select(
        "source", "source_size", "weight", "cap", F.row_number().over(by_cap).alias("place"),
        ((F.lit(SHARE) * F.sum("source_size").over(everywhere) - F.coalesce(F.sum("cap").over(below), F.lit(0)))
         / F.sum("weight").over(onward)).alias("level"),
    )
    # the level of the first source that stays below its cap is that of all after it; those before it stop at their caps
    held = F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct("place", "level"))).over(everywhere)
    return levels.withColumn("held", held).select(
        "source", "source_size",
        F.when(F.col("held").isNull() | (F.col("place") < F.col("held.place")), F.col("cap").cast("double"))
        .otherwise(F.col("held.level") * F.col("weight")).alias("target"),
    )


def mix(docs: DataFrame, quality: DataFrame | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of `docs(doc_id, text, source)`: doc_id, source, size, source_size,
    target (words, of the source), epochs (times the document is taken, 0 to 2), taken (words).

    quality: rows (doc_id, quality); repeated ids count by their mean, ids that
    are null or unknown weigh UNKNOWN. A null or empty text has size 0 and takes
    nothing. Rows without an id, and rows of one id with different texts, have a key
    of their text; rows of equal key follow one another by a hash of the text, so only
    rows of equal texts are in any order, which gives the same rows. Other columns of `docs` are ignored. An
    empty table gives no rows. The whole-document epochs end at the document
    whose middle passes the budget, so each source is within one document of it.
    """
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), tie.alias("_tie"), *also)
    several = sized.where("doc_id is not null").groupBy("doc_id").agg(F.min("_tie").alias("_a"), F.max("_tie").alias("_b"))
    sized = sized.join(several.where("_a != _b").select("doc_id", F.lit(True).alias("_several")), "doc_id", "left")
    if quality is None:
        weight = F.lit(UNKNOWN)
    else:
        known = quality.where("doc_id is not null").groupBy("doc_id").agg(F.avg("quality").alias("_q"))
        sized = sized.join(known, "doc_id", "left")
        weight = F.coalesce(F.lit(POOR) + F.lit(GOOD - POOR) * F.col("_q"), F.lit(UNKNOWN))
    by_text = F.when(F.col("doc_id").isNull() | F.col("_several"), F.concat(F.lit(":"), F.col("_tie").cast("string"))).otherwise("")
    digits = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), by_text).cast("binary"))
    uniform = (F.conv(F.substring(digits, 1, 13), 16, 10).cast("double") + 1) / F.lit(float(2**52 + 1))
    rows = written(
        sized.select("doc_id", "source", "size", "_tie", *also, (-F.log(uniform) / weight).alias("key"))
        .withColumn("bin", F.floor(F.lit(BINS) * (1 - F.exp(-F.col("key"))))),
        "mix-sizes",
    )
    part = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    rows = rows.withColumn("part", part)
    targets = source_targets(rows).withColumn("part", part).drop("source")
    bins = rows.groupBy("part", "bin").agg(F.sum("size").alias("bin_size"))
    starts = bins.select(
        "part", "bin",
        (F.sum("bin_size").over(Window.partitionBy("part").orderBy("bin")) - F.col("bin_size")).alias("start"),
    )
    inside = Window.partitionBy("part", "bin").orderBy("key", "doc_id", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("within", F.sum("size").over(inside))
        .join(starts, ["part", "bin"]).join(targets, "part")
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
    )
    middle = F.col("start") + F.col("within") - F.col("size") / 2
    extra = (F.col("size") > 0) & (middle <= F.col("target") - F.col("whole") * F.col("source_size"))
    return placed.withColumn(
        "epochs", F.when(F.col("size") == 0, 0).otherwise(F.col("whole") + extra.cast("int")).cast("int")
    ).select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("size") * F.col("epochs")).cast("long").alias("taken"), *also,
    )


def take(docs: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it; its columns stay as they are.

    Equal rows are taken together as often as all of them.
    """
    # both numbers together name a row
    key, other = fresh(docs, "_key"), fresh(docs, "_row")
    keyed = docs.withColumns({key: row_key(F.col("doc_id"), F.col("text")), other: F.xxhash64(*docs.columns)})
    narrow = keyed.select("doc_id", "text", "source", F.col(key).alias("_k"), F.col(other).alias("_r"))
    copies = written(
        mix(narrow, quality, also=("_k", "_r")).groupBy(F.col("_k").alias(key), F.col("_r").alias(other))
        .agg(F.sum("epochs").cast("int").alias("_copies"), F.count("*").alias("_rows")).where("_copies > 0"), "copies"
    )
    counts = fresh(docs, "_copies")
    copies = copies.withColumnRenamed("_copies", counts)
    times = F.explode(F.sequence(F.lit(1), F.col(counts))).alias(fresh(docs, "_time"))
    taken = keyed.join(copies.where("_rows = 1").drop("_rows"), [key, other])
    repeated = copies.where("_rows > 1").drop("_rows")
    if not repeated.isEmpty():
        taken = taken.unionByName(keyed.join(repeated, [key, other]).dropDuplicates([key, other]))
    return taken.select(*docs.columns, times).select(*docs.columns)


ORACLE = """
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
         coalesce(0.5 + 1.5 * q, 1.0) as w
  from documents left join (select doc_id, avg(quality) as q from labels where doc_id is not null group by 1) using (doc_id)
), keyed as (
  select *, -ln((cast('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint) + 1)
                / 4503599627370497.0::double) / w as key
  from sized
), totals as (
  select source, cast(sum(size) as bigint) as source_size,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from keyed group by source
), levels as (
  select *, 2 * source_size as cap, row_number() over (order by 2.0::double * source_size / weight, source nulls last) as place,
         (1.5::double * cast(sum(source_size) over () as bigint)
          - coalesce(cast(sum(2 * source_size) over (order by 2.0::double * source_size / weight, source nulls last
              rows between unbounded preceding and 1 preceding) as bigint), 0))
         / cast(sum(weight) over (order by 2.0::double * source_size / weight, source nulls last
              rows between current row and unbounded following) as bigint) as level
  from totals
), held as (
  select place, level from levels where cap > level * weight order by place limit 1
), targets as (
  select source, source_size,
         case when h.place is null or l.place < h.place then cap::double else h.level * weight end as target
  from levels l left join held h on true
), placed as (
  select k.*, t.source_size, t.target,
         case when t.source_size > 0 then floor(t.target / t.source_size) else 0 end as whole,
         sum(size) over (partition by k.source order by key, doc_id rows unbounded preceding) as upto
  from keyed k join targets t on k.source is not distinct from t.source
), picked as (
  select *, case when size = 0 then 0
                 else whole + (case when upto - size / 2.0::double <= target - whole * source_size then 1 else 0 end) end as epochs
  from placed
)
select doc_id, source, size, source_size, target, cast(epochs as integer) as epochs, cast(size * epochs as bigint) as taken
from picked
"""
