"""Many CSV files with a header each, read in one plan, with the rows that were refused."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.operators.groups import join_small_groups
from gridcast.session import settle


def _parsed(line: str | Column, width: int) -> Column:
    return F.from_csv(line, ", ".join(f"c{i} string" for i in range(width)))


def _fields(parsed: str, width: int) -> Column:
    return F.array(*[F.col(f"{parsed}.c{i}") for i in range(width)])


def read_csv_parts(spark: SparkSession, paths: str | list[str], columns: list[str], label: str) -> DataFrame:
    """file, line and the named columns as text, of every row of one or many CSV files.

    Each file is read by its own header, wherever in it the columns stand. Headers
    are found by tasks, in a first pass that keeps one line per file; the second
    pass looks up the places of a file's columns. Both are one scan of all files,
    so the plan is the same for one file and for any number of them.

    Blank lines, and lines that repeat their file's header, are not rows. A file
    without lines has no rows; a column that a short row lacks is null; of columns
    named alike the first counts. Lines end at line breaks, also inside quotes.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError(f"no {label} paths were given")
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line")
    ).where("trim(line) <> ''")
    # Tasks read a block from its start on, so the least id in a file's first block with lines is its first line.
    headers = settle(
        lines.withColumn("_at", F.struct("_block", F.monotonically_increasing_id()))
        .groupBy("file").agg(F.min_by("line", "_at").alias("header"))
    )
    width = headers.agg(F.max(F.length(F.regexp_replace("header", "[^,]", "")))).first()[0]
    width = 1 if width is None else width + 1
    places = {name: f"_place_{i}" for i, name in enumerate(columns)}
    placed = (
        headers.withColumn("_parsed", _parsed(F.regexp_replace("header", "^\ufeff", ""), width))
        .withColumn("_names", _fields("_parsed", width))
        .select("file", "header", *[(F.array_position("_names", F.lit(name)) - 1).alias(place) for name, place in places.items()])
    )
    unfit = placed.where(" or ".join(f"{place} < 0" for place in places.values())).first()
    if unfit is not None:
        absent = sorted(name for name, place in places.items() if unfit[place] < 0)
        raise ValueError(f"{label} data is missing required columns: {', '.join(absent)} in {unfit['file']}")
    found = join_small_groups(lines.drop("_block"), placed, ["file"]).where("line <> header")
    fields = _fields("_parsed", width)
    return found.withColumn("_parsed", _parsed("line", width)).select(
        "file", "line", *[F.get(fields, F.col(place).cast("int")).alias(name) for name, place in places.items()]
    )


def refused_rows(parts: DataFrame, readers: dict[str, Callable[[str], Column]]) -> DataFrame:
    """Rows that one of `readers` (column -> its parser) turns into null: file, line, reason.

    The reason names every such column, in the order of `readers`, with "no" where
    the text is absent or blank and "unreadable" where it isn't.
    """
    reasons = []
    for name, read in readers.items():
        blank = F.coalesce(F.trim(F.col(name)), F.lit("")) == ""
        reasons.append(F.when(blank, f"no {name}").when(read(name).isNull(), f"unreadable {name}"))
    return parts.withColumn("reason", F.concat_ws(", ", *reasons)).where("reason <> ''").select("file", "line", "reason")
