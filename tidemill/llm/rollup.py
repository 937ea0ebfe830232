"""Token counts kept up to date by signed deltas."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import bpe, kernels
from tidemill.session import new_folder, stage

KEYS = ["source", "lang", "tokenizer"]
SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def counted(docs: DataFrame, tokenizer: str = bpe.VOCABULARY) -> DataFrame:
    """``doc_id, source, lang, tokenizer, n_tokens, text_hash`` of every row; a null text has no token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.blocks(batches):
            _, bounds = bpe.encode(batch.column("text"), tokenizer)
            columns = [batch.column(c) for c in ("doc_id", "source", "lang", "text_hash")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(bounds))], ["doc_id", "source", "lang", "text_hash", "n_tokens"])

    own = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang")]
    rows = docs.select(*own, F.col("text").cast("string").alias("text"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    kinds = "doc_id bigint, source string, lang string, text_hash string, n_tokens bigint"
    return rows.mapInArrow(run, kinds).withColumn("tokenizer", F.lit(tokenizer))


def deltas(changes: DataFrame) -> DataFrame:
    """Signed sums by key of changes ``old, new``: structs of the keys and ``n_tokens``, either may be null.

    An insert has no ``old``, a delete no ``new``; a revised count has both, also if its source, language or
    tokenizer changed. A hot source is one row for each task before the shuffle.
    """
    signed = F.explode(
        F.array(
            F.struct(F.lit(1).cast("bigint").alias("sign"), F.col("new").alias("row")),
            F.struct(F.lit(-1).cast("bigint").alias("sign"), F.col("old").alias("row")),
        )
    ).alias("x")
    rows = changes.select(signed).where("x.row is not null")
    keys = [F.col(f"x.row.{k}").alias(k) for k in KEYS]
    tokens = F.coalesce(F.col("x.row.n_tokens"), F.lit(0)) * F.col("x.sign")
    return rows.groupBy(*keys).agg(F.sum("x.sign").alias("n_docs"), F.sum(tokens).alias("n_tokens"))


class Rollup:
    """Totals by source, language and tokenizer version, as the sum of committed batches below a folder.

    A batch's deltas are one file folder named by the hash of its id. It is written under another name and
    renamed when whole, so a lost job leaves nothing that is read, and a batch id that is there already is
    not added again. Ids must be chosen by the sender and be the same on a retry.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._path = lambda *parts: spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))
        self._files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def _name(self, batch_id: str) -> str:
        return "batch-" + hashlib.sha256(batch_id.encode()).hexdigest()[:32]

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of changes; False if the id is committed already."""
        name = self._name(batch_id)
        if self._files.exists(self._path("batches", name)):
            return False
        written = f"unfinished/{name}"
        deltas(changes).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{written}")
        self._files.mkdirs(self._path("batches"))
        return bool(self._files.rename(self._path(written), self._path("batches", name)))

    def totals(self) -> DataFrame:
        """Sums over all committed batches; keys that are back at nothing are left out."""
        rows = self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true")
        if not self._files.exists(self._path("batches")):
            return self.spark.createDataFrame([], SCHEMA)
        sums = rows.parquet(f"{self.folder}/batches").groupBy(*KEYS).agg(
            F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
        )
        return sums.where("n_docs <> 0 or n_tokens <> 0")


def _row() -> Column:
    return F.struct(*KEYS, "n_tokens")


def document_totals(docs: DataFrame, tokenizer: str = bpe.VOCABULARY) -> DataFrame:
    """Totals of a corpus after three commits: all rows inserted, a second version of their counts, copies deleted.

    1. Every row is inserted with its number of words, tokenizer ``words``.
    2. Every count is revised: the same row moves from ``words`` to ``tokenizer``; sent twice, added once.
    3. Rows whose text stands before in the corpus (at a smaller id, or as an equal row) are deleted.

    Returns ``source, lang, tokenizer, n_docs, n_tokens``. Null sources and languages are keys of their own.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
    old = docs.select(F.struct(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.lit("words").alias("tokenizer"), words.alias("n_tokens")).alias("old"))
    none = F.lit(None).cast("struct<source:string,lang:string,tokenizer:string,n_tokens:bigint>")
    counts = stage(counted(docs, tokenizer), "counts")
    spark = docs.sparkSession
    rollup = Rollup(spark, new_folder(spark, "rollup"))
    rollup.commit("insert", old.select(none.alias("old"), F.col("old").alias("new")))
    revised = old.select("old", none.alias("new")).union(counts.select(none.alias("old"), _row().alias("new")))
    rollup.commit("revise", revised)
    rollup.commit("revise", revised)
    rollup.commit("delete", _repeats(counts).select(F.col("row").alias("old"), none.alias("new")))
    return rollup.totals()


def _repeats(counts: DataFrame) -> DataFrame:
    """Rows that are not the first with their text: each group's minimum is joined back, no group is sorted.

    Of equal rows the stored order decides.
    """
    rows = counts.select("text_hash", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), F.monotonically_increasing_id().alias("r"), _row().alias("row"))
    rows = stage(rows, "rows")
    first = rows.groupBy("text_hash").agg(F.min(F.struct("d", "r")).alias("first"), F.count("*").alias("n")).where("n > 1")
    return rows.join(first.select("text_hash", "first"), "text_hash").where("d <> first.d or r <> first.r")
