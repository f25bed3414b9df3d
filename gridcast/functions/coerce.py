"""Column expressions that turn untrusted text into typed values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: accepted timestamp spellings, tried in this order, all read as UTC
TIMESTAMP_PATTERNS = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "yyyy/M/d H:mm:ss", "yyyy/M/d H:mm",
                      "M/d/yyyy h:mm:ss a", "M/d/yyyy h:mm a", "yyyy-M-d h:mm:ss a", "yyyy-M-d h:mm a",
                      "d-MMM-yyyy H:mm:ss", "d-MMM-yyyy H:mm", "d-MMM-yyyy", "d MMM yyyy H:mm:ss", "d MMM yyyy H:mm", "d MMM yyyy", "d MMMM yyyy H:mm:ss", "d MMMM yyyy H:mm", "d MMMM yyyy",
                      "MMM d, yyyy H:mm:ss", "MMM d, yyyy H:mm", "MMM d, yyyy", "MMMM d, yyyy H:mm:ss", "MMMM d, yyyy H:mm", "MMMM d, yyyy"]
# fixed value: text that is a number; type suffixes such as 1f or 2d are not
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity|nan))$"
# fixed values: text meaning "yes"
TRUE_WORDS = ["1", "true", "t", "yes", "y"]
TRUE_WORDS_REPORTS = TRUE_WORDS + ["on"]


def to_number(column: str) -> Column:
    """Number from text with optional thousands commas; anything else is null."""
    text = F.replace(F.trim(F.col(column).cast("string")), F.lit(","), F.lit(""))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_utc_timestamp(column: str) -> Column:
    """UTC instant from text in any of the accepted spellings; anything else is null."""
    text = F.trim(F.col(column).cast("string"))
    tries = [text.try_cast("timestamp")]
    tries += [F.try_to_timestamp(text, F.lit(pattern)) for pattern in TIMESTAMP_PATTERNS]
    return F.coalesce(*tries)


def default_text(column: str, default: str) -> str:
    """SQL text: trimmed text, keeping its case; blank or null becomes `default`."""
    return f"coalesce(nullif(trim(cast({column} as string)), ''), '{default}')"


def key_text(column: str, default: str) -> str:
    """SQL text: lower-case trimmed key; blank or null becomes `default`."""
    return f"lower({default_text(column, default)})"


def optional_number(df: DataFrame, column: str) -> Column:
    return to_number(column) if column in df.columns else F.lit(None).cast("double")


def optional_text(df: DataFrame, column: str, default: str) -> Column:
    return F.expr(default_text(column, default)) if column in df.columns else F.lit(default)


def truthy(column: str | Column, words=TRUE_WORDS) -> Column:
    """Boolean from text or boolean; null and unknown words are false."""
    source = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.lower(F.trim(source.cast("string"))).isin(*words), F.lit(False))


def finite(column: str | Column) -> Column:
    """True for numbers that are neither null, NaN nor infinite."""
    value = (F.col(column) if isinstance(column, str) else column).cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))
    return F.coalesce(usable, F.lit(False))


def finite_or_null(column: str | Column) -> Column:
    value = (F.col(column) if isinstance(column, str) else column).try_cast("double")
    return F.when(finite(value), value)
