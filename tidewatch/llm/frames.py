"""Helpers the text operators share: row keys, white space, and tables kept in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ensure_checkpoint_dir

#: The white space that separates words: space, and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only `id` and `text`, so that other columns, whatever their names, take no part."""
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def one_space(text: Column) -> Column:
    """Each run of white space as one space; a single space is matched by nothing and costs nothing."""
    return F.regexp_replace(text, f"{SPACE}{{2,}}|[\\x09-\\x0D]", " ")


def hashable(df: DataFrame) -> list[str]:
    """Columns that Spark can hash: all but those that hold maps or variants."""
    return [f"`{f.name}`" for f in df.schema.fields
            if not any(kind in f.dataType.simpleString() for kind in ("map<", "variant"))]


def scratch(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder; it can be deleted once the job has ended."""
    return f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame, block: int | None = None) -> DataFrame:
    """The rows written once to the shared folder and read from there, so that lost executors and
    second readers cost no second computation. Use it for narrow rows, or with `block`, the bytes that a task
    holds while it writes or reads them."""
    folder = scratch(df.sparkSession)
    writer = df.write if block is None else df.write.option("parquet.block.size", block)
    writer.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def small_batches(spark: SparkSession, most: int = 4 << 20, rows: int | None = None) -> Iterator[None]:
    """Batches of at most so many bytes go to Python for what runs inside: rows that are long texts or arrays
    otherwise come ten thousand at a time, whatever their length. With `rows` files are read so many rows at a time."""
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": most, "spark.sql.parquet.columnarReaderBatchSize": rows}
    wanted = {name: value for name, value in wanted.items() if value is not None}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def name_key(column: Column) -> Column:
    """Text that is equal for equal ids and for null ids, which plain equality never is."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def pick(docs: DataFrame, chosen: DataFrame, id_col: str, mark: Column) -> DataFrame:
    """The rows of `docs` whose id and mark, a hash of the text, are in `chosen` (id, mark), one for each.

    Of rows that share both, the one with the smallest hash over its columns stays.
    """
    rows = docs.select(
        F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), name_key(F.col(f"`{id_col}`")).alias("key"),
        mark.alias("mark"), F.xxhash64(*hashable(docs)).alias("rank"))
    kept = rows.join(chosen.select(name_key(F.col("id")).alias("key"), "mark"), ["key", "mark"])
    kept = kept.groupBy("key", "mark").agg(F.min_by("row", "rank").alias("row"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
