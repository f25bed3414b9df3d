"""As-of joins: the latest right row known at or before each left row."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.groups import FEW_GROUPS, join_small_groups
from gridcast.operators.ranks import running_counts
from gridcast.session import settle


@dataclass(frozen=True)
class Feed:
    """Right side of an as-of join. `at` is its time column, unique per join key."""

    name: str
    df: DataFrame
    at: str


def asof_latest(
    left: DataFrame,
    feeds: list[Feed],
    on: list[str],
    left_at: Column,
    span: str | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Add one struct column per feed holding its latest row with `at <= left_at`.

    All sides are stacked and carried forward in one ordered pass per key, so
    several feeds on the same key share one shuffle and the work is linear in
    the rows. With `span` (a date_trunc unit) each key is further cut into time
    spans and the newest row of every span is handed to the next one that has
    rows, so a hot key is spread over as many tasks as it has spans.

    With `hot_rows` the cuts are chosen from the rows: a key with more rows than that, of all
    sides, is cut into spans of about `hot_rows` by the counts of its times, and a span
    that stays larger because many left rows share one time is dealt over several tasks. The
    sides are then read twice; settle them when they are costly to produce. Left rows with a null
    key or time find nothing and stay out of the pass.
    """
    if hot_rows is not None:
        return _asof_hot(left, feeds, on, left_at, hot_rows)
    fields = {"_left": [c for c in left.columns if c not in on]}
    types = {"_left": _struct_type(left, fields["_left"])}
    for feed in feeds:
        fields[feed.name] = [c for c in feed.df.columns if c not in on]
        types[feed.name] = _struct_type(feed.df, fields[feed.name])

    def stacked(df, name, side):
        parts = [
            f"struct({', '.join(f'`{c}`' for c in fields[name])}) as {name}" if name == own
            else f"cast(null as {types[own]}) as {own}"
            for own in types
        ]
        return df.selectExpr(*on, "_at", f"{side} as _side", *parts)

    rows = stacked(left.withColumn("_at", left_at), "_left", len(feeds))
    for side, feed in enumerate(feeds):
        known = feed.df.withColumn("_at", F.col(feed.at)).where(
            " and ".join(f"{c} is not null" for c in [*on, "_at"])
        )
        rows = rows.unionByName(stacked(known, feed.name, side))

    partition = list(on)
    if span is not None:
        partition.append("_span")
        rows = rows.withColumn("_span", F.date_trunc(span, "_at"))
        rows = rows.unionByName(_carried_over(rows, on, feeds))

    so_far = (
        Window.partitionBy(*partition).orderBy("_at", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.select(*on, "_left", *[F.last(f.name, ignorenulls=True).over(so_far).alias(f.name) for f in feeds])
        .where("_left is not null")
        .selectExpr(*[c if c in on else f"_left.`{c}` as `{c}`" for c in left.columns], *[f.name for f in feeds])
    )


def _asof_hot(left: DataFrame, feeds: list[Feed], on: list[str], left_at: Column, hot_rows: int) -> DataFrame:
    at = "_asof_at"
    placed = left.withColumn(at, left_at.cast("timestamp"))
    usable = " and ".join(f"{c} is not null" for c in [*on, at])
    known, lost = placed.where(usable), placed.where(f"not ({usable})")
    sides = {feed.name: feed.df.withColumn(at, F.col(feed.at).cast("timestamp")).where(usable) for feed in feeds}
    times = reduce(DataFrame.unionByName, [df.select(*on, F.unix_micros(at).alias("_micros")) for df in (known, *sides.values())])
    hot = times.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).drop("_n")
    counts = running_counts(join_small_groups(times, hot, on), "_micros", on)
    cut = counts.groupBy(*on, F.floor((F.col("rows_upto") - F.col("rows")) / hot_rows).alias("_part")).agg(
        F.min("_micros").alias("from"), F.ceil(F.sum("rows") / hot_rows).cast("int").alias("deals"))
    # one row per hot key: as many cuts as it has times `hot_rows`
    cuts = settle(cut.groupBy(*on).agg(F.array_sort(F.collect_list(F.struct("from", "deals"))).alias("_cuts")))
    few = cuts.count() <= FEW_GROUPS

    def spanned(df: DataFrame) -> DataFrame:
        """Rows with the number of cuts at or before their time, by halving, and the number of tasks of that span."""
        middle = "cast((s.low + s.high) / 2 as int)"
        halve = (f"if(s.low >= s.high, s, if(get(_cuts, {middle}).from <= unix_micros({at}),"
                 f" named_struct('low', {middle} + 1, 'high', s.high), named_struct('low', s.low, 'high', {middle})))")
        search = f"aggregate(sequence(0, cast(ceil(log2(size(_cuts) + 1)) as int)), named_struct('low', 0, 'high', size(_cuts)), (s, i) -> {halve}).low"
        joined = df.join(F.broadcast(cuts) if few else cuts, on, "left")
        return joined.withColumn("_span", F.expr(f"if(_cuts is null, 0, {search})")).withColumn(
            "_deals", F.expr("coalesce(get(_cuts, _span - 1).deals, 1)")).drop("_cuts")

    own_columns = {name: [c for c in df.columns if c not in on and c != at] for name, df in {"_left": known, **sides}.items()}
    types = {name: _struct_type(df, own_columns[name]) for name, df in {"_left": known, **sides}.items()}

    def stacked(df: DataFrame, name: str, side: int) -> DataFrame:
        parts = [f"struct({', '.join(f'`{c}`' for c in own_columns[name])}) as {name}" if name == own else f"cast(null as {types[own]}) as {own}" for own in types]
        return df.selectExpr(*on, f"{at} as _at", f"{side} as _side", "_span", "_deals", *parts)

    asked = stacked(spanned(known), "_left", len(feeds))
    offered = reduce(DataFrame.unionByName, [stacked(spanned(df), name, i) for i, (name, df) in enumerate(sides.items())])
    spread = asked.groupBy(*on, "_span", "_deals").agg(F.min("_at").alias("_at")).where("_span > 0")
    carried = _carried_over(offered.drop("_deals").unionByName(spread.selectExpr(
        *on, "_at", "-1 as _side", "_span", *[f"cast(null as {kind}) as {name}" for name, kind in types.items()])), on, feeds)
    starts = carried.join(spread.select(*on, "_span", "_deals"), [*on, "_span"], "left").withColumn("_deals", F.coalesce("_deals", F.lit(1)))
    # what is known is given to each task of a span; a row that asks goes to one, by its content, so that a retry deals alike
    everywhere = offered.unionByName(starts.withColumn("_at", F.lit("0001-01-01").cast("timestamp"))).withColumn(
        "_deal", F.explode(F.sequence(F.lit(0), F.col("_deals") - 1)))
    dealt = asked.withColumn("_deal", F.pmod(F.xxhash64("_left"), F.col("_deals")).cast("int"))
    so_far = Window.partitionBy(*on, "_span", "_deal").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        everywhere.unionByName(dealt)
        .select(*on, "_left", *[F.last(f.name, ignorenulls=True).over(so_far).alias(f.name) for f in feeds])
        .where("_left is not null")
        .selectExpr(*[c if c in on else f"_left.`{c}` as `{c}`" for c in left.columns], *[f.name for f in feeds])
    )
    return found.unionByName(lost.selectExpr(*[f"`{c}`" for c in left.columns], *[f"cast(null as {types[f.name]}) as {f.name}" for f in feeds]))


def _struct_type(df: DataFrame, columns: list[str]) -> str:
    types = dict(df.dtypes)
    return f"struct<{', '.join(f'`{c}`: {types[c]}' for c in columns)}>"


def _carried_over(rows: DataFrame, on: list[str], feeds: list[Feed]) -> DataFrame:
    """Per key and span, the newest feed rows of the spans before, placed at the span's start."""
    newest = rows.groupBy(*on, "_span").agg(
        *[F.max(F.when(F.col(f.name).isNotNull(), F.struct("_at", f.name))).alias(f.name) for f in feeds]
    )
    before = Window.partitionBy(*on).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select(
        *on, "_span", *[F.last(f.name, ignorenulls=True).over(before)[f.name].alias(f.name) for f in feeds]
    )
    any_known = reduce(or_, [F.col(f.name).isNotNull() for f in feeds])
    left_type = dict(rows.dtypes)["_left"]
    return carried.where(any_known).select(
        *on, F.col("_span").alias("_at"), F.lit(-1).alias("_side"),
        F.lit(None).cast(left_type).alias("_left"), *[f.name for f in feeds], "_span",
    )
