"""Ordered work on long time series without pulling a series into one task.

A window ordered by time over a whole series would run in a single task. These
operators number the rows span by span, then cut the numbered series into
buckets of fixed size that overlap by as many rows as a lag or frame reaches
back, so every window partition is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.functions.dates import hours

SPAN_UNIT = "month"
BUCKET_ROWS = 10_000


def row_index(
    df: DataFrame, ts: str, keys: list[str] = (), name: str = "row_index", span_unit: str = SPAN_UNIT
) -> DataFrame:
    """Add the 0-based position of each row in time order, per `keys`.

    `ts` must be unique per key. A span is one calendar month unless a series
    finer than hourly asks for a shorter unit, so the window partitions stay
    small however long or hot a series is; only the counts per span meet in one
    place.
    """
    keys = list(keys)
    by = ", ".join([*keys, "_span"])
    earlier = f"over ({f'partition by {chr(44).join(keys)} ' if keys else ''}order by _span rows between unbounded preceding and 1 preceding)"
    spanned = df.withColumn("_span", F.date_trunc(span_unit, ts))
    starts = spanned.groupBy(*keys, "_span").agg(F.expr("count(*) as _rows")).selectExpr(
        *keys, "_span", f"coalesce(sum(_rows) {earlier}, 0) as _start"
    )
    place = f"_start + row_number() over (partition by {by} order by {ts}) - 1 as {name}"
    return spanned.join(starts, [*keys, "_span"]).selectExpr(*df.columns, place)


def _two_sum(a: str, b: str) -> str:
    """What the rounding of a + b leaves out, exactly."""
    grown = f"(({a} + {b}) - {a})"
    return f"(({a} - (({a} + {b}) - {grown})) + ({b} - {grown}))"


def _frame_sums(df: DataFrame, column: str, frames: set[int], over: str) -> DataFrame:
    """Add `_sum_{column}_{rows}`, the rounded sum of the last `rows` values, for each of `frames`.

    A sum of 2k rows is that of k rows plus the one that ends k rows earlier, and
    a frame is put together from such sums by its binary digits: 168 rows take
    nine lags instead of 168 reads. A sum is a pair of doubles, its rounded
    total and what rounding left out, so nothing is lost to the order of the
    additions, nothing is ever subtracted, and a frame's sum depends on its
    rows alone. Nulls and NaN add nothing; an infinite total stays as it is.
    """
    def high(rows): return f"_high_{column}_{rows}"
    def low(rows): return f"_low_{column}_{rows}"

    def plus(df, own, other, back, name):
        """The pair `own` plus the pair `other` of `back` rows before, as pair `name`."""
        far = df.selectExpr("*", *[f"lag({part(other)}, {back}, 0D) over {over}) as _far{part('')}" for part in (high, low)])
        far_high, far_low = f"_far{high('')}", f"_far{low('')}"
        return far.selectExpr(
            "*", f"{high(own)} + {far_high} as {high(name)}",
            f"{low(own)} + {far_low} + {_two_sum(high(own), far_high)} as {low(name)}",
        ).drop(far_high, far_low)

    kept = df.columns
    summed = df.selectExpr("*", f"coalesce(nanvl(cast({column} as double), null), 0D) as {high(1)}", f"0D as {low(1)}")
    for level in range(max(frames).bit_length() - 1):
        summed = plus(summed, 2**level, 2**level, 2**level, 2 ** (level + 1))
    for rows in sorted(frames):
        digits = [2**d for d in reversed(range(rows.bit_length())) if rows >> d & 1]
        reached = digits[0]
        for digit in digits[1:]:
            name = reached + digit
            if high(name) not in summed.columns:
                summed = plus(summed, reached, digit, reached, name)
            reached = name
    infinite = "double('Infinity')"
    return summed.selectExpr(*kept, *[
        f"if(abs({high(rows)}) < {infinite}, {high(rows)} + {low(rows)}, {high(rows)}) as _sum_{column}_{rows}"
        for rows in sorted(frames)])


def lags_and_means(
    df: DataFrame,
    ts: str,
    lags: dict[str, tuple[str, int]],
    means: dict[str, tuple[str, int]],
    keys: list[str] = (),
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add row lags and trailing means, `name -> (column, rows)`.

    A mean covers the current row and the `rows - 1` before it, skips nulls and
    uses what there is at the start. Of decimals and whole numbers it is the
    difference of two exact running sums, so a frame of 168 rows costs no more
    than one of 24. Differences of doubles would lose digits, so doubles are
    summed by `_frame_sums`; NaN is skipped like null.
    """
    keys = list(keys)
    reach = max(rows for _, rows in [*lags.values(), *means.values()])
    if bucket_rows <= reach:
        raise ValueError("bucket_rows must exceed the longest lag or frame")

    own = f"_index div {bucket_rows}"
    is_tail = f"_index % {bucket_rows} >= {bucket_rows - reach}"
    bucketed = row_index(df, ts, keys, "_index").selectExpr(
        "*", f"{own} as _own", f"explode(if({is_tail}, array({own}, {own} + 1), array({own}))) as _bucket"
    )
    over = f"(partition by {', '.join([*keys, '_bucket'])} order by _index"
    running = f"over {over} rows between unbounded preceding and current row)"
    types = dict(df.dtypes)

    sums, doubles = [], {}
    whole = {"tinyint", "smallint", "int", "bigint"}
    for column, rows in means.values():
        if "decimal" not in types[column] and types[column] not in whole:
            doubles.setdefault(column, set()).add(rows)
    for source in dict.fromkeys(column for column, _ in means.values()):
        if source in doubles:
            sums.append(f"count(nanvl(cast({source} as double), null)) {running} as _n_{source}")
            continue
        exact = source if "decimal" in types[source] else f"cast({source} as decimal(20,0))"
        sums += [f"coalesce(sum({exact}) {running}, 0) as _sum_{source}", f"count({exact}) {running} as _n_{source}"]
    summed = bucketed.selectExpr("*", *sums)
    for column, frames in doubles.items():
        summed = _frame_sums(summed, column, frames, over)

    added = [f"lag({column}, {rows}) over {over}) as {name}" for name, (column, rows) in lags.items()]
    for name, (column, rows) in means.items():
        total = f"(_sum_{column} - coalesce(lag(_sum_{column}, {rows}) over {over}), 0))"
        if column in doubles:
            total = f"_sum_{column}_{rows}"
        count = f"(_n_{column} - coalesce(lag(_n_{column}, {rows}) over {over}), 0))"
        added.append(f"case when {count} > 0 then cast({total} as double) / {count} end as {name}")
    return (
        summed.selectExpr("*", *added)
        .where("_bucket = _own")
        .select(*df.columns, *lags, *means)
    )


def shifted_lookup(
    df: DataFrame,
    ts: str,
    own: list[str],
    lookups: dict[str, tuple[str, int]],
    keys: list[str] = (),
) -> DataFrame:
    """For each row, values of the same series `n` hours before, `name -> (column, n)`.

    Every row is sent once to each later time that asks for it and the pieces
    meet in one grouping, so any number of lookups costs one shuffle and the
    series is read once. `ts` must be unique per key; fixed-width types keep
    the grouping a hash aggregation. Times with no row of their own are dropped.
    """
    keys = list(keys)
    shifts = sorted({0, *[n for _, n in lookups.values()]})
    sources = sorted({column for column, _ in lookups.values()} | set(own))
    pieces = (
        df.select(*keys, F.col(ts).alias("_from"), *sources, F.explode(F.array(*[F.lit(n) for n in shifts])).alias("_shift"))
        .withColumn(ts, F.col("_from") + hours(F.col("_shift")))
    )
    at = "max(case when _shift = {1} then {0} end) as `{2}`"
    return (
        pieces.groupBy(*keys, ts)
        .agg(
            F.max(F.col("_shift") == 0).alias("_present"),
            *[F.expr(at.format(column, 0, column)) for column in own],
            *[F.expr(at.format(column, shift, name)) for name, (column, shift) in lookups.items()],
        )
        .where("_present")
        .drop("_present")
    )
