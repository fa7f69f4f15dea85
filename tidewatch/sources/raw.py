"""Raw records from files: batch and stream, with broken lines kept aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.sources.schemas import CORRUPT, hook_schema


def read_raw(spark: SparkSession, path: str, hook: str, file_format: str = "json") -> DataFrame:
    """Raw records of a hook. JSON lines that do not parse stay, in `_corrupt_record`."""
    schema = hook_schema(hook)
    if file_format == "parquet":
        return spark.read.schema(schema).parquet(path)
    return (
        spark.read.schema(f"{schema}, {CORRUPT} STRING")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_raw_stream(spark: SparkSession, path: str, hook: str, file_format: str = "json",
                    max_files: int = 1000) -> DataFrame:
    """The same records as a stream; `max_files` per trigger bounds a batch after an outage."""
    schema = hook_schema(hook)
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    if file_format == "parquet":
        return reader.schema(schema).parquet(path)
    return (
        reader.schema(f"{schema}, {CORRUPT} STRING")
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def parse_raw(lines: DataFrame, hook: str, text: str = "value") -> DataFrame:
    """Raw records out of a text column, for sources that deliver lines rather than files."""
    schema = hook_schema(hook)
    parsed = F.from_json(
        F.col(text), f"{schema}, {CORRUPT} STRING",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return lines.select(parsed.alias("_record")).select("_record.*")


def intact(records: DataFrame) -> DataFrame:
    """Records that parsed."""
    return records.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def json_line(df: DataFrame) -> Column:
    """A row of raw columns as the JSON line `read_raw` reads."""
    return F.to_json(F.struct(*df.columns))
