"""Removal of repeated passages: hashes of every window of words, counted over the whole corpus."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Multiplier of the rolling hash, and of the mixing that follows it: odd 64-bit numbers.
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Hashes of words kept by a task, to hash a frequent word once.
WORDS = 200_000
#: Documents in a block, on average, and blocks at most: their borders are one list on the driver, so
#: blocks of more than 50,000 * 2,000 documents grow. A task holds one block.
BLOCK, BLOCKS = 2_000, 50_000
#: Windows in one part of the hash space, about; a task holds one part.
PART = 2_000_000


class WordHashes:
    """64-bit hashes of words, remembered for the most recent ones."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hash of each window: a polynomial in BASE over the hashes of its words, modulo 2**64."""
    if len(words) < size:
        return words[:0]
    out = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        out *= BASE
        out += words[k: len(words) - size + 1 + k]
    out ^= out >> np.uint64(32)
    out *= MIX
    out ^= out >> np.uint64(29)
    return out


class Block:
    """The documents of one block in their order, with the hash of every window."""

    def __init__(self, table: pa.Table, size: int):
        table = self.table = table.sort_by([("id", "ascending"), ("mark", "ascending")])  # nulls last
        self.words = [(t.as_py() or "").encode().split() for t in table.column("text")]
        hashes = WordHashes()
        windows = [window_hashes(hashes(w), size) for w in self.words]
        self.counts = np.array([len(w) for w in windows], np.int64)
        whole = np.concatenate([*windows, np.empty(0, np.uint64)])
        self.order = np.argsort(whole, kind="stable")
        ranked = whole[self.order]
        #: For each window in the order of hashes: whether its hash is new, and its place among distinct ones.
        self.new = np.concatenate(([True], ranked[1:] != ranked[:-1]))[: len(ranked)]
        self.distinct = ranked[self.new]

    def parts(self, n: int) -> np.ndarray:
        """Where each of n equal parts of the hash space begins and ends among the distinct hashes."""
        borders = np.array([(k << 64) // n for k in range(1, n)], np.uint64)
        return np.concatenate(([0], np.searchsorted(self.distinct, borders), [len(self.distinct)]))

    def repeated(self, seen: np.ndarray) -> list[np.ndarray]:
        """For each document which of its windows start earlier too. seen: distinct hashes of earlier blocks."""
        later = ~self.new | seen[np.cumsum(self.new) - 1]
        flags = np.empty(len(later), bool)
        flags[self.order] = later
        return np.split(flags, np.cumsum(self.counts)[:-1]) if len(self.counts) else []


def planes(hashes: np.ndarray) -> bytes:
    """Sorted numbers, byte plane by byte plane: their equal leading bytes then compress away."""
    return hashes.view(np.uint8).reshape(-1, 8).T.tobytes()


def of_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).reshape(-1)


def covered(starts: np.ndarray, words: int, size: int) -> np.ndarray:
    """Words covered by the windows that start at the flagged places, overlapping intervals merged."""
    steps = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return np.cumsum(steps[:-1]) > 0


def in_blocks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Rows (block, id, mark, text, doc), and the number of parts for their windows.

    Blocks follow each other as (id, mark) does, mark being a hash of the text. Their borders are
    quantiles of the ids over all rows; an id with more rows than a block has is split by mark. Rows
    without an id follow all others, split by mark. `doc` holds the columns other than the text.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rest = [f"`{c}`" for c in docs.columns if c != text_col]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"), F.struct(*rest).alias("doc"))
    named, every, size = rows.select(F.count("id"), F.count("*"), F.sum(F.octet_length("text"))).first()
    n, nameless = (min(BLOCKS, max(1, -(-rows_ // BLOCK))) for rows_ in (named, every - named))
    cuts = np.empty(0, np.int64)
    if n > 1:
        steps = ", ".join(repr(k / n) for k in range(1, n))
        cuts = np.array(rows.select(F.expr(f"percentile_approx(id, array({steps}), {min(20 * n, 200_000)})")).first()[0], np.int64)

    @F.pandas_udf("int")
    def block(id_: pd.Series, mark: pd.Series) -> pd.Series:
        share = (mark.to_numpy(np.float64) + 2.0**63) / 2.0**64
        none = id_.isna().to_numpy()
        ids = id_.astype("Int64").fillna(0).to_numpy(np.int64)
        low, high = np.searchsorted(cuts, ids), np.searchsorted(cuts, ids, "right")
        low, width = np.where(none, len(cuts) + 1, low), np.where(none, nameless, np.maximum(high - low, 1))
        return pd.Series(low + np.minimum(np.floor(share * width), width - 1).astype(np.int64))

    return rows.select(block("id", "mark").alias("block"), "*"), max(1, -(-(size or 0) // (6 * PART)))


def earlier(rows: DataFrame, parts: int, size: int) -> DataFrame:
    """For each block and part of the hash space, a bit for each distinct hash: an earlier block has it.

    A block sends each of its distinct hashes once, so a passage that is everywhere is one number per
    block. They travel as sorted arrays, one for each part.
    """

    def sent(table: pa.Table) -> pa.Table:
        block, number = Block(table, size), table.column("block")[0].as_py()
        borders = block.parts(parts)
        found = [(k, block.distinct[a:b]) for k, (a, b) in enumerate(zip(borders[:-1], borders[1:], strict=True)) if b > a]
        return pa.table({"part": pa.array([k for k, _ in found], pa.int32()), "block": pa.array([number] * len(found), pa.int32()),
                         "hashes": pa.array([planes(h) for _, h in found], pa.binary())})

    def met(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        hashes = [of_planes(h.as_py()) for h in table.column("hashes")]
        whole = np.concatenate(hashes)
        order = np.argsort(whole, kind="stable")
        ranked = whole[order]
        seen = np.empty(len(whole), bool)
        seen[order] = np.concatenate(([False], ranked[1:] == ranked[:-1]))
        bits = [np.packbits(b).tobytes() for b in np.split(seen, np.cumsum([len(h) for h in hashes])[:-1])]
        return pa.table({"block": table.column("block"), "part": table.column("part"), "bits": pa.array(bits, pa.binary())})

    hashes = rows.groupBy("block").applyInArrow(sent, "part int, block int, hashes binary")
    return hashes.groupBy("part").applyInArrow(met, "block int, part int, bits binary")


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 20, whole: bool = False) -> DataFrame:
    """One row per input row: its text without the words that an earlier window of words repeats.

    Words are runs without space or control white space, compared as they are. A window is `size`
    consecutive words of one document. A word goes if it is covered by a window whose words also
    start earlier: in a document with a smaller id, or earlier in the same one. Windows are judged on
    the input. Windows are equal if their 64-bit hashes are: with n windows the chance that any two
    others meet is below n * n / 2**65.

    Columns: doc (the other columns), text (kept words joined by one space; with `whole`, a text that
    loses nothing stays as it is), n_words, n_removed, spans (start and stop of each longest interval
    of removed words).
    Ids are whole numbers; null ids come last, ordered by a hash of the text, as rows of one id are.
    Of repeated rows one comes first and keeps its words. A null text has no words; a text of fewer
    than `size` words stays. No rows give no rows.
    """
    rows, parts = in_blocks(docs, id_col, text_col)
    schema = T.StructType([rows.schema["doc"], T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])))])

    def kept(table: pa.Table, bits: pa.Table) -> pa.Table:
        block = Block(table, size)
        borders = block.parts(parts)
        seen = np.zeros(len(block.distinct), bool)
        for part, packed in zip(bits.column("part").to_pylist(), bits.column("bits").to_pylist(), strict=True):
            a, b = borders[part], borders[part + 1]
            seen[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a)
        texts, removed, spans = [], [], []
        old = block.table.column("text")
        for k, (words, starts) in enumerate(zip(block.words, block.repeated(seen), strict=True)):
            if not starts.any():
                texts.append(old[k].as_py() if whole else b" ".join(words).decode())
                removed.append(0)
                spans.append([])
                continue
            gone = covered(starts, len(words), size)
            edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
            texts.append(b" ".join([words[i] for i in np.flatnonzero(~gone)]).decode())
            removed.append(int(gone.sum()))
            spans.append([{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)])
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table({"doc": block.table.column("doc"), "text": pa.array(texts, pa.string()), "n_words": pa.array([len(w) for w in block.words], pa.int64()),
                         "n_removed": pa.array(removed, pa.int64()), "spans": pa.array(spans, span)})

    return rows.groupBy("block").cogroup(earlier(rows, parts, size).groupBy("block")).applyInArrow(kept, schema)


def passage_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each row."""
    kept = drop_repeated_passages(docs.select("doc_id", "text"))
    return kept.select("doc.doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def without_repeated_passages(docs: DataFrame) -> DataFrame:
    """The rows with shortened texts; n_chars, where there is one, counts what is left."""
    kept = drop_repeated_passages(docs, whole=True)
    counted = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None
    of = {"text": F.col("text"), "n_chars": counted}
    return kept.select(*[of.get(c, F.col("doc").getField(c)).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


ORACLE = """
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS a FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(a[i:i + 19], ' ') AS win FROM (SELECT doc_id, a, unnest(range(1, len(a) - 18)) AS i FROM t)
), r AS (
  SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1
), c AS (
  SELECT DISTINCT doc_id, i + k AS i FROM r, (SELECT unnest(range(0, 20)) AS k)
), k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS body, count(*) AS n
  FROM (SELECT doc_id, i, a[i] AS word FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM t)) ANTI JOIN c USING (doc_id, i)
  GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(a) AS BIGINT) AS n_words, CAST(len(a) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM t LEFT JOIN k ON t.doc_id = k.doc_id
"""
