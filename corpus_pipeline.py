"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import debruijn, minhash, mixing, ordinal, packing
from tidemill.session import scratch, stage

# Hashing, token ids and the fitted classifier have no counterpart in SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier selects; it is fitted on the rated ones among them.

    Null and empty texts are graded like any other; ratings with a null flag or id are not fitted on. Without ratings the grade is the
    same for all documents.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal.train(docs, ordinal.graded(labels))
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])  # whatever they are called
    rows = ordinal.grade_documents(docs.select("text", others.alias("row")), model).where("selected")
    return rows.select(*["text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8.

    Documents without words stay, and so do those without an id whose group has no id; of rows with equal id and text one stays.
    """
    return minhash.one_of_each(docs, words=5, percent=80)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans of 35 words or more that repeat in the corpus, with ``n_chars`` of what is left.

    All documents stay, also where nothing is left; a null text stays null and so does its ``n_chars``.
    """
    rows = debruijn.cleaned(docs)
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Documents without words are taken no time; a null source is a source of its own.
    """
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("row"))
    return mixing.repeated(mixing.mix(rows)).select("row.*")


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens; repeated rows are packed each, null ids stay null."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("mixture", mixture),
    ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each returns is written, and read as the next one's input.

    What a stage has stored on its way is deleted when its result is written. Columns beyond those of documents pass through
    whatever they are called; an empty table gives an empty result.
    """
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        with scratch(spark):
            rows = stage(apply(spark, rows, sf_dir), name, keep=True)
    return STAGES[-1][1](spark, rows, sf_dir)
