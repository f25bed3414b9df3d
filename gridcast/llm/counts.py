"""Token counts as delta-maintained rollups with idempotent batch commits.

A change is a signed row: +1 with a document's count when it enters, -1 with its
old count when it leaves, both when its count is revised. Changes are summed by
source, language and tokenizer version before they are stored, so a commit is as
small as the number of groups, and totals are sums over commits in any order. A
batch id commits once: a folder with the writer's success mark is final, one
without it is a failed attempt and is overwritten.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm.common import arrow_batches
from gridcast.llm.tokens import PieceEncoder, text_bytes

GROUP = ["source", "lang", "version"]
ROW = "sign int, source string, lang string, version string, n_docs long, n_tokens long"
BATCH_ROWS = 512
WORDS, BPE = "words", "byte_bpe_50k"


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Signed changes of `counts(source, lang, version, n_tokens)`; a null count is 0."""
    return counts.select(F.lit(sign).alias("sign"), *GROUP, F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Changes that replace the counts of `before` by those of `after`: the old ones leave, the new ones enter."""
    return signed(before, -1).unionByName(signed(after, 1))


def spaced_words(texts: pa.Array) -> np.ndarray:
    """The number of runs of bytes other than ASCII white space in each text."""
    data, offsets = text_bytes(texts)
    if not len(data):
        return np.zeros(len(texts), np.int64)
    solid = ~((data == 32) | (data >= 9) & (data <= 13))
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    filled = offsets[:-1] < offsets[1:]
    first = offsets[:-1][filled]
    begins[first] = solid[first]  # a text begins anew
    upto = np.append(0, np.cumsum(begins))
    return upto[offsets[1:]] - upto[offsets[:-1]]


def token_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(source, lang, version, n_tokens) of every row of `docs(text, source, lang)`, for both versions.

    A null or empty text has no tokens.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer)
        for batch in batches:
            texts = batch.column(2)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([batch.column(0)] * 2), pa.concat_arrays([batch.column(1)] * 2),
                pa.array([BPE] * n + [WORDS] * n),
                pa.array(np.concatenate([encoder.encode(texts)[1], spaced_words(texts)])),
            ], ["source", "lang", "version", "n_tokens"])

    return docs.select(F.col("source").cast("string"), F.col("lang").cast("string"), "text").mapInArrow(
        count, "source string, lang string, version string, n_tokens long"
    )


class TokenRollup:
    """Rollups kept in the folder `path`, which all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._at = jvm.org.apache.hadoop.fs.Path
        self._files = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, batch: str) -> str:
        return f"{self.path}/batch-{quote(batch, safe='')}"

    def committed(self, batch: str) -> bool:
        return self._files.exists(self._at(f"{self._folder(batch)}/_SUCCESS"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Store the sums of signed `changes`; False if the batch was committed before.

        Rows of sign null count as 0. Nulls of a group column form a group.
        """
        if self.committed(batch):
            return False
        (
            changes.groupBy(*GROUP)
            .agg(F.sum("sign").cast("long").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).cast("long").alias("n_tokens"))
            .coalesce(1).write.mode("overwrite").parquet(self._folder(batch))
        )
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, n_docs, n_tokens) over all committed batches; groups that ended are left out."""
        found = []
        if self._files.exists(self._at(self.path)):
            found = [str(s.getPath()) for s in self._files.listStatus(self._at(self.path))
                     if self._files.exists(self._at(f"{s.getPath()}/_SUCCESS"))]
        schema = "source string, lang string, version string, n_docs long, n_tokens long"
        stored = self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)
        return (
            stored.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs != 0 or n_tokens != 0")
        )


def roll_up(docs: DataFrame, tokenizer: str, path: str) -> DataFrame:
    """Totals of `docs(text, source, lang)` by source, lang and tokenizer version, kept in `path`.

    First every document enters with an estimate of a quarter of its bytes as its
    BPE count, as a loader would write it; then the exact counts of both versions
    replace the estimates; last, documents without text leave. Each step is one
    batch, and committing it again changes nothing. Repeated rows each count.
    """
    rollup = TokenRollup(docs.sparkSession, path)
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    columns = [F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang")]
    guess = docs.select(*columns, F.lit(BPE).alias("version"), F.floor(size / 4).alias("n_tokens"))
    exact = token_counts(docs, tokenizer)
    empty = docs.where(size == 0).select(*columns, F.explode(F.array(F.lit(BPE), F.lit(WORDS))).alias("version"), F.lit(0).alias("n_tokens"))
    steps = [("load", lambda: signed(guess, 1)), ("exact", lambda: revised(guess, exact)), ("empty", lambda: signed(empty, -1)),
             ("load", lambda: signed(guess, 1))]  # the last is a replay, as after a lost answer
    for batch, changes in steps:
        with arrow_batches(docs.sparkSession, BATCH_ROWS):
            rollup.commit(batch, changes())
    return rollup.totals()
