"""Exact ranks and quantiles of values, spread over many tasks.

Equal values are counted first (map-side), so a value shared by a third of all
rows is one row afterwards. Values hang in a tree of spans: coarse spans of
LEADING_DIGITS digits, inside each of them at most 10,000 fine spans of FINE_DIGITS
digits, and in those the values. Prefix sums are taken level by level: of the
coarse spans of a key, of the fine spans inside a coarse one, of the values inside a
fine one, so that no task adds up more than one such level however many rows there
are. The spans are a pure function of the value, so a recomputed stage always
cuts at the same points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.operators.groups import join_small_groups
from gridcast.operators.series import row_index

LEADING_DIGITS = 4
FINE_DIGITS = 8


def value_span(value: str, leading_digits: int = LEADING_DIGITS) -> Column:
    """Non-decreasing whole number from a value: its sign, decimal exponent and leading digits.

    The number counts in steps of FINE_DIGITS digits, so spans of fewer digits and
    of more can stand side by side. Logarithm and power are those of the strict
    library, so every machine computes the same. Never null: a nullable join key
    would add a filter to one of the two branches that count the values and Spark
    could not share their shuffle.
    """
    size = F.least(F.abs(F.col(value).cast("double")), F.lit(1.7e308))
    exponent = F.greatest(F.floor(F.log10(size)), F.lit(-300))
    kept = F.floor(size / F.pow(F.lit(10.0), exponent) * F.lit(10.0 ** (leading_digits - 1)))
    code = (exponent + 301) * F.lit(10 ** (FINE_DIGITS + 1)) + kept * F.lit(10 ** (FINE_DIGITS - leading_digits))
    signed = F.when(F.col(value) < 0, -code).otherwise(code)
    return F.when(size > 0, F.coalesce(signed, F.lit(0))).otherwise(F.lit(0)).cast("bigint")


def _known(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Key and value columns of the rows with no null among them."""
    return df.where(" and ".join(f"{c} is not null" for c in [*keys, value])).select(*keys, value)


def _offsets(counts: DataFrame, group: list[str], span: str, rows: str, prefix: str) -> DataFrame:
    """Per `group` and span: `_rows`, the rows of lower spans of the group as `prefix`, and `_all` of its rows.

    A group is a key, which has a few thousand coarse spans per decimal magnitude, or a coarse
    span, which has at most 10,000 fine ones: the windows are small whatever the number of rows.
    """
    per_group = f"partition by {', '.join(group)}" if group else ""
    return counts.groupBy(*group, span).agg(F.expr(f"{rows} as _rows")).selectExpr(
        *group, span, "_rows",
        f"coalesce(sum(_rows) over ({per_group} order by {span} rows between unbounded preceding and 1 preceding), 0) as {prefix}",
        f"sum(_rows) over ({per_group}) as _all",
    )


def _upto(value: str, spans: list[str]) -> Column:
    """The rows of the values up to this one inside its fine span."""
    return F.sum("rows").over(Window.partitionBy(*spans).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))


def running_counts(df: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """Distinct `value`s per `keys` with `rows`, `rows_upto` (<= value) and `rows_total`.

    Rows with a null key or value are left out.
    """
    keys = list(keys)
    counts = _known(df, value, keys).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"_coarse": value_span(value), "_fine": value_span(value, FINE_DIGITS)})
    spans = [*keys, "_coarse", "_fine"]
    coarse = _offsets(counts, keys, "_coarse", "sum(rows)", "_below").withColumnRenamed("_all", "rows_total").drop("_rows")
    fine = _offsets(counts, spans[:-1], "_fine", "sum(rows)", "_before").drop("_rows", "_all")
    offsets = fine.join(coarse, spans[:-1]).selectExpr(*spans, "_below + _before as _before", "rows_total")
    return counts.join(offsets, spans).select(
        *keys, value, "rows", (F.col("_before") + _upto(value, spans)).alias("rows_upto"), "rows_total")


def values_at(df: DataFrame, value: str, positions: dict[str, str], keys: list[str] = ()) -> DataFrame:
    """Per `keys` the values at 0-based positions in ascending order, and `rows_total`.

    `positions` maps a column name to SQL over `rows_total`. The first pass counts rows per
    coarse span (combined before the shuffle) and finds those that hold a wanted position, at most one
    per key and position; the second counts the values of these alone, and goes on into the fine spans. `df`
    is read twice, so settle it when it is costly to produce; its rows are not shuffled.
    """
    keys = list(keys)
    known = _known(df, value, keys).withColumn("_coarse", value_span(value))
    wanted = lambda before: " or ".join(f"({before} <= {at} and {at} < {before} + _rows)" for at in positions.values())
    coarse = _offsets(known, keys, "_coarse", "count(*)", "_below").withColumnRenamed("_all", "rows_total").where(wanted("_below")).drop("_rows")
    kept = [*keys, "_coarse", "_below", "rows_total"]
    counts = join_small_groups(known, coarse, [*keys, "_coarse"]).groupBy(*kept, value).agg(
        F.count(F.lit(1)).alias("rows")).withColumn("_fine", value_span(value, FINE_DIGITS))
    fine = _offsets(counts, kept, "_fine", "sum(rows)", "_before").where(wanted("(_below + _before)")).drop("_rows", "_all")
    inside = counts.join(fine, [*kept, "_fine"]).withColumn("_upto", F.col("_below") + F.col("_before") + _upto(value, [*kept, "_fine"]))
    found = "max(case when _upto > {at} and _upto - rows <= {at} then {value} end) as {name}"
    return inside.groupBy(*keys).agg(
        F.expr("max(rows_total) as rows_total"),
        *[F.expr(found.format(at=at, value=value, name=name)) for name, at in positions.items()],
    )


def exact_quantile(df: DataFrame, value: str, share: float, keys: list[str] = (), name: str = "quantile") -> DataFrame:
    """Linear-interpolated quantile of `value` per `keys`, as numpy and pandas define it."""
    at = f"((rows_total - 1) * {float(share)!r}D)"
    ends = values_at(df, value, {"_low": f"floor{at}", "_high": f"ceil{at}"}, keys)
    low, high = "cast(_low as double)", "cast(_high as double)"
    return ends.selectExpr(*keys, f"{low} + ({high} - {low}) * ({at} - floor{at}) as {name}")


def top_share(df: DataFrame, value: str, at_least: float, ts: str) -> DataFrame:
    """Rows whose cumulative distribution of `value` is >= `at_least`, ranked from the top.

    Adds `cume_dist` and `rank`, the row number by `value` then `ts`, both
    descending; `ts` must be unique. The rank is the number of rows with a
    greater value plus the place among equals, and equals are numbered span by
    span in time, so even a value that a third of all rows share is spread out.
    """
    kept = running_counts(df, value).selectExpr(
        value, "rows_upto / rows_total as cume_dist", "rows_total - rows_upto + rows as _down_to"
    ).where(F.col("cume_dist") >= at_least)
    placed = row_index(df.join(kept, value), ts, [value], "_earlier_equals")
    return placed.selectExpr(*df.columns, "cume_dist", "_down_to - _earlier_equals as rank")
