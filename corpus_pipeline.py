"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on all that the stage before it kept, written as Parquet in between.
The packing stage has no SQL form, so that the whole is tested against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stageline.llm.common import step_folder
from stageline.llm.decontaminate import drop_contaminated
from stageline.llm.exact_dedup import drop_repeats
from stageline.llm.ngram_join import keep_one_of_each_class
from stageline.llm.packing import pack_documents
from stageline.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text that is equal without white space."""
    return drop_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return keep_one_of_each_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a sequence."""
    return pack_documents(docs)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("decontaminate", decontaminate), ("pack", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = step_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
