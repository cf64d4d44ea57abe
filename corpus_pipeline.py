"""A training corpus from raw documents: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), docs being what the stage before it kept, and returns a DataFrame that is
written and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm.decontam import drop_leaks
from foliant.llm.lines import drop_lines
from foliant.llm.neardup import drop_near_duplicates
from foliant.llm.packing import pack
from foliant.llm.queries import tokenizer_path
from foliant.llm.toxicity import drop_toxic
from foliant.staging import folder_of, release


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, boilerplate lines of their source removed. n_chars follows the text."""
    from pyspark.sql import functions as F

    out = drop_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity of 0.8 or more."""
    return drop_near_duplicates(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed into sequences of 4096 tokens."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", packing),
]

#: The classifier and the packing plan can't be put into SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again; what a stage has read is removed then."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = folder_of(spark, "corpus-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # without paths, release would remove every staged table
            release(*before)
        before = [path]
    return docs
