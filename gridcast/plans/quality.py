"""Data-quality checks. Each returns the violating rows: none means it passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.contracts import HORIZONS


def rule_violations(tables: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """One row per declared rule with its violations: name -> (table, not null, unique).

    Each table is read once. A row gives (rule, value) for every unique column and
    (rule, null) where a value is missing; these are counted inside the tasks
    first, so all rules of all tables share one shuffle, no row is expanded per
    distinct count, and a frequent value is one row per task. Nulls do not
    violate `unique`; 0.0 equals -0.0 and NaN equals NaN.
    """
    rules, found = [], None
    for name, (df, not_null, unique) in tables.items():
        types, entries = dict(df.dtypes), []
        for column in not_null:
            entries.append(F.when(F.col(column).isNull(), F.struct(F.lit(len(rules)).alias("_rule"), F.lit(None).cast("string").alias("_value"))))
            rules.append((name, column, "not_null"))
        for column in unique:
            entries.append(F.when(F.col(column).isNotNull(), F.struct(F.lit(len(rules)).alias("_rule"), _as_text(column, types[column]).alias("_value"))))
            rules.append((name, column, "unique"))
        if entries:
            one = df.select(F.explode(F.array_compact(F.array(*entries))).alias("_e")).select("_e.*")
            found = one if found is None else found.unionByName(one)
    if found is None:
        raise ValueError("no rules")
    values = found.groupBy("_rule", "_value").agg(F.count(F.lit(1)).alias("_rows"))
    beyond = {"not_null": F.col("_rows"), "unique": F.col("_rows") - 1}
    counted = values.agg(*[
        F.coalesce(F.sum(F.when(F.col("_rule") == i, beyond[rule])), F.lit(0)).alias(f"_{i}") for i, (_, _, rule) in enumerate(rules)])
    entries = ", ".join(
        f"struct('{name}' as table_name, '{column}' as column_name, '{rule}' as rule, _{i} as violations)"
        for i, (name, column, rule) in enumerate(rules))
    return counted.selectExpr(f"inline(array({entries}))")


def _as_text(column: str, kind: str) -> Column:
    """Text that differs exactly where the values do."""
    if kind in ("float", "double"):
        return F.when(F.col(column) == 0, "0").otherwise(F.col(column).cast("string"))
    if kind == "binary":
        return F.hex(column)
    if kind.startswith(("array", "struct")):
        return F.to_json(F.struct(column), {"ignoreNullFields": "false"})
    return F.col(column).cast("string")


def null_and_duplicate_counts(name: str, df: DataFrame, not_null: list[str], unique: list[str] = ()) -> DataFrame:
    """One row per declared rule of one table with its violations."""
    return rule_violations({name: (df, list(not_null), list(unique))})


def future_leakage(training: DataFrame) -> DataFrame:
    return training.where("feature_max_source_timestamp_utc > feature_as_of_timestamp_utc")


_SNAPSHOTS = ["weather_forecast", "generation_availability", "intertie_schedule"]


def issued_after_as_of(training: DataFrame) -> DataFrame:
    return training.where(" or ".join(f"{s}_issue_utc > feature_as_of_timestamp_utc" for s in _SNAPSHOTS))


def target_mismatch(training: DataFrame) -> DataFrame:
    return training.where(" or ".join(f"{s}_target_utc <> target_timestamp_utc" for s in _SNAPSHOTS))


def repeated_grain(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(issue, target) pairs that occur more than once: name -> (table, issue, target)."""
    found = None
    for name, (df, issue, target) in tables.items():
        one = (
            df.groupBy(F.col(issue).alias("issue_utc"), F.col(target).alias("target_utc"))
            .agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")
            .select(F.lit(name).alias("model_name"), "issue_utc", "target_utc", "row_count")
        )
        found = one if found is None else found.unionByName(one)
    return found


def absent_horizons(training: DataFrame, expected: list[int] = HORIZONS) -> DataFrame:
    wanted = training.sparkSession.createDataFrame([(h,) for h in expected], "horizon_hours int")
    return wanted.join(training.select("horizon_hours").distinct(), "horizon_hours", "left_anti")


def wrong_holiday_flags(calendar: DataFrame, expected: DataFrame) -> DataFrame:
    """Calendar rows of the expected dates whose flags differ, nulls compared as values."""
    flags = [c for c in expected.columns if c != "local_date"]
    wanted = expected.select("local_date", *[F.col(c).alias(f"_{c}") for c in flags])
    differs = " or ".join(f"not ({c} <=> _{c})" for c in flags)
    return calendar.join(wanted, "local_date").where(differs).select("local_date", *flags)
