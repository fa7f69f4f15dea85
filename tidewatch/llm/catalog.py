"""The registered queries of the text operators, each over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.catalog.base import Query
from tidewatch.llm import collocations, exact_dedup, html, language, lexicon, line_dedup, packing, periods, quality, records, regions, simhash, substring_dedup
from tidewatch.session import configure


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def over(name: str, operator) -> Query:
    return Query(lambda spark, folder: operator(read(spark, folder, name)))


def entries() -> dict[str, Query]:
    return {
        "op1_quality_rules": over("documents", quality.judge),
        "op2_bpe": over("documents", lexicon.round_trip),
        "op3_language_id": over("documents", language.identify),
        "op4_simhash_near_dedup": over("documents", simhash.near_groups),
        "op5_line_dedup": Query(over("documents", line_dedup.line_digest).run, line_dedup.ORACLE),
        "op6_token_records": over("documents", records.record_digest),
        "op7_exact_dedup": Query(over("documents", exact_dedup.exact_groups).run, exact_dedup.ORACLE),
        "op8_packing": over("documents", packing.pack),
        "op9_html_extraction": over("pages", html.extract),
        "op10_substring_dedup": Query(over("documents", substring_dedup.passage_digest).run, substring_dedup.ORACLE),
        "op11_collocations": Query(over("documents", collocations.collocations).run, collocations.ORACLE),
        "op12_periodic_runs": over("documents", periods.run_digest),
        "op13_jaccard_join": over("documents", regions.jaccard_classes),
    }
