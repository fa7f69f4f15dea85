"""A training corpus from documents: language, exact copies, near copies, repeated passages, packing.

Every stage but the last takes and returns the columns of `documents`; the last returns the pieces of
packed sequences. Documents only go where a stage says so: without a known language, as a copy of
another, or as a near copy. Repeated passages shorten texts; a text left empty is kept as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import exact_dedup, language, packing, simhash, substring_dedup
from tidewatch.llm.frames import stored
from tidewatch.session import configure


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without a letter, or of no language by far, go."""
    configure(spark)
    return language.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the document with the smallest id."""
    configure(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their fingerprints the document with the smallest id."""
    configure(spark)
    return simhash.drop_near_copies(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words that earlier windows of 20 words repeat; n_chars follows."""
    configure(spark)
    return substring_dedup.without_repeated_passages(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    configure(spark)
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", drop_repeated_passages),
    ("packing", pack),
]

#: A fitted classifier and a linear program have no SQL; tests hold the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
