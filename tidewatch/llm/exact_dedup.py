"""Exact deduplication in DataFrame functions: group by a 128-bit hash, compare bytes, keep the smallest id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.frames import one_space, pick, texts

#: Copies of one row are dealt out in runs of so many, so that no array grows with the input.
RUN = 1_000_000


def content_hash(text: Column) -> Column:
    """128 bits of the text."""
    return F.unhex(F.md5(text))


def _hashed(docs: DataFrame, id_col: str, text_col: str, digest=content_hash) -> DataFrame:
    body = one_space(F.coalesce(F.col("text"), F.lit("")))
    return (texts(docs, id_col, text_col).select("id", body.alias("body"))
            .withColumn("hash", digest(F.col("body"))).withColumn("sha", F.unhex(F.sha2("body", 256))))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=content_hash) -> DataFrame:
    """One row per input row: which row of its group of equal texts stays.

    Texts are equal when identical after each run of white space became one space. Rows are first
    grouped by `digest`; inside a group the texts themselves are compared, as grouping keys, so a
    collision splits the group. Each task combines its own copies before anything is shuffled, and
    texts are shuffled once, one per group and task. Rows find their group by hash and SHA-256, which
    are narrow; a large group is split by the adaptive skew join.

    Columns: doc_id, keep_id (smallest id of the group), group_size, kept, text_sha256.
    A null text counts as empty. A null id never wins against an id; in a group of null ids alone
    keep_id is null and one row is kept. Of repeated rows (same id, equal text) one is kept and all
    count. Other columns are ignored; no rows give no rows.
    """
    rows = _hashed(docs, id_col, text_col, digest)
    groups = rows.groupBy("hash", "body").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = groups.select("hash", F.unhex(F.sha2("body", 256)).alias("sha"), "keep_id", "group_size")
    copies = rows.groupBy("id", "hash", "sha").agg(F.count("*").alias("copies"))
    found = copies.join(groups, ["hash", "sha"])
    # One row per group of repeated rows so far: give each back, the first as the one that stays.
    runs = found.select("*", F.explode(F.expr(f"sequence(0L, (copies - 1) div {RUN})")).alias("run"))
    each = runs.select("*", F.explode(F.expr(f"sequence(run * {RUN}, least(copies, (run + 1) * {RUN}) - 1)")).alias("copy"))
    return each.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that `exact_groups` keeps, with all their columns and their own white space.

    Of repeated rows (same id, equal text) that differ in other columns or in white space, the one
    with the smallest hash over its columns stays.
    """
    body = one_space(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    keepers = exact_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("mark"))
    return pick(docs, keepers, id_col, F.unhex(F.sha2(body, 256)))


ORACLE = """
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT *, min(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM g
"""
