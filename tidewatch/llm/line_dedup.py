"""Removal of repeated lines by windows of three consecutive lines, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.frames import texts


def repeated_windows(lines: DataFrame, size: int) -> DataFrame:
    """Later occurrences (id, mark, at) of windows of `size` lines, by (id, mark, at); null ids last.

    Windows are counted by two 64-bit hashes with partial aggregation, so a window that is
    everywhere is one row per task. The join back to its occurrences is split by the adaptive skew
    join. A window without a word is no window.
    """
    window = ", ".join(f"lines[i + {k}]" for k in range(size))
    worded = " OR ".join(f"lines[i + {k}] rlike '[^\\\\x20\\\\x09-\\\\x0D]'" for k in range(size))
    places = lines.where(F.size("lines") >= size).select("id", "mark", F.explode(F.expr(
        f"filter(transform(sequence(0, size(lines) - {size}), i -> named_struct('at', i, 'a', xxhash64({window}), "
        f"'b', xxhash64(7, {window}), 'worded', {worded})), w -> w.worded)")).alias("w"))
    places = places.select("id", "mark", "w.at", "w.a", "w.b")
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "mark", "at")
    first = (places.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("a", "b", "first"))
    return places.join(first, ["a", "b"]).where(place > F.col("first")).select("id", "mark", "at")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """One row per input row: its text without the lines that an earlier window of lines repeats.

    Lines are split at `\\n` and compared as they are. A window is `size` consecutive lines of one
    document with at least one word. A line goes if it is covered by a window that also starts
    earlier: in a document with a smaller id, or earlier in the same one.

    Columns: doc_id, n_lines, n_removed, text (kept lines joined by `\\n`).
    A null or empty text has no lines and gives an empty text; one of fewer than `size` lines stays.
    Null ids come last. Rows of one id with equal text are one document given more than once and all
    get its result; with different texts they are ordered by a hash of the text. Other columns are
    ignored; no rows give no rows.
    """
    lines = texts(docs, id_col, text_col).select(
        "id", F.xxhash64("text").alias("mark"),
        F.when(F.length("text") > 0, F.split("text", "\n", -1)).otherwise(F.array().cast("array<string>")).alias("lines"))
    gone = repeated_windows(lines, size).groupBy("id", "mark").agg(F.collect_set("at").alias("starts"))
    gone = gone.select(F.col("id").alias("gone_id"), F.col("mark").alias("gone_mark"), "starts")
    found = lines.join(gone, F.col("mark").eqNullSafe(F.col("gone_mark")) & F.col("id").eqNullSafe(F.col("gone_id")), "left")
    # Positions are taken away as sets, which takes time in proportion to the lines.
    covered = F.expr(f"flatten(transform(starts, s -> sequence(s, s + {size - 1})))")
    every = F.expr("CASE WHEN size(lines) > 0 THEN sequence(0, size(lines) - 1) ELSE array() END")
    found = found.withColumn("kept", F.when(F.col("starts").isNull(), every).otherwise(F.array_except(every, covered)))
    text = F.when(F.col("starts").isNull(), F.array_join("lines", "\n")).otherwise(
        F.array_join(F.expr("transform(kept, i -> lines[i])"), "\n"))
    return found.select(F.col("id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
                        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"), text.alias("text"))


def line_digest(docs: DataFrame) -> DataFrame:
    """The result with a digest of the text: doc_id, n_lines, n_removed, kept_sha256."""
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (
  SELECT doc_id, CASE WHEN text <> '' THEN string_split(text, chr(10)) ELSE []::VARCHAR[] END AS a FROM documents
), w AS (
  SELECT doc_id, i, a[i] || chr(10) || a[i + 1] || chr(10) || a[i + 2] AS win
  FROM (SELECT doc_id, a, unnest(range(1, len(a) - 1)) AS i FROM l)
), r AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n
  FROM w WHERE regexp_matches(win, '[^\\x20\\x09-\\x0D]')
), c AS (
  SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1
), s AS (
  SELECT doc_id, i, a[i] AS line FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM l)
), k AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM s ANTI JOIN c USING (doc_id, i)
  GROUP BY doc_id
)
SELECT l.doc_id, CAST(len(a) AS BIGINT) AS n_lines, CAST(len(a) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM l LEFT JOIN k ON l.doc_id = k.doc_id
"""
