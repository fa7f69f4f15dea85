"""Packing of token sequences: cutting stock by column generation over the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.frames import stored, texts
from tidewatch.llm.wordbpe import END, encoder

#: Tokens of a sequence, and of a length class: the program has one row for each class.
ROOM, UNIT = 4096, 16
#: Pieces of at most SHORT tokens are joined, in order, into bundles of less than BUNDLE + SHORT: rounding a bundle costs
#: less than a hundredth, rounding each piece could cost fifteen places of sixteen.
SHORT, BUNDLE = 64, 960
#: Pieces of one class that are ranked in one task.
RANKED = 100_000
#: Tolerance of numbers; how far from the fewest sequences the relaxed program may stop; steps between fresh inverses.
CLOSE, GAP, FRESH = 1e-9, 5e-4, 64


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Each row's ids and its end id, cut at whole multiples of a sequence: id, mark, start, length, crc, tokens."""
    rows = texts(docs, id_col, text_col).select("id", F.xxhash64("text").alias("mark"), "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary), np.array([END], "<u4").tobytes()
        for batch in batches:
            row, start, length, crc, tokens = [], [], [], [], []
            for k, text in enumerate(batch.column("text")):
                ids = encode.text(text.as_py()) + end
                n = len(ids) // 4
                for at in range(0, n, ROOM):
                    part = ids[4 * at:4 * (at + ROOM)]
                    row.append(k)
                    start.append(at)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    tokens.append(n)
            named = batch.select(["id", "mark"]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*named.columns, *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens))],
                                             ["id", "mark", "start", "length", "crc", "tokens"])

    return rows.mapInArrow(cut, f"id {rows.schema['id'].dataType.simpleString()}, mark long, start long, length long, crc long, tokens long")


def dearest(prices: np.ndarray, sizes: np.ndarray, room: int) -> np.ndarray:
    """How often each size is in the pattern of greatest price that fits the room: dynamic programming."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for space in range(1, room + 1):
        best[space] = best[space - 1]
        fits = int(np.searchsorted(sizes, space, "right"))
        if fits:
            values = best[space - sizes[:fits]] + prices[:fits]
            top = int(values.argmax())
            if values[top] > best[space] + CLOSE:
                best[space], last[space] = values[top], top
    pattern, space = np.zeros(len(sizes)), room
    while space > 0:
        if last[space] < 0:
            space -= 1
        else:
            pattern[last[space]] += 1
            space -= sizes[last[space]]
    return pattern


def relaxed(sizes: np.ndarray, demand: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and how often each is used, in fractions, so that the fewest sequences meet the demand.

    Revised simplex: a basis of as many patterns as there are sizes, prices from its inverse, and the
    dearest pattern at these prices enters until none is worth more than 1 + GAP sequences: then no
    set of patterns needs less than 1 / (1 + GAP) of the sequences.
    """
    basis = np.diag((room // sizes).astype(float))
    goal = demand * (1 + 1e-7 * np.arange(1, len(sizes) + 1) / len(sizes))  # keeps steps from being empty
    inverse = np.linalg.inv(basis)
    for step in range(1, 40 * len(sizes) + 1):
        if step % FRESH == 0:
            inverse = np.linalg.inv(basis)
        pattern = dearest(inverse.sum(axis=0), sizes, room)
        if pattern @ inverse.sum(axis=0) <= 1 + GAP:
            break
        used, change = inverse @ goal, inverse @ pattern
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(change > CLOSE, used / change, np.inf)
        out = int(ratio.argmin())
        basis[:, out] = pattern
        row = inverse[out] / change[out]
        inverse -= np.outer(change, row)
        inverse[out] = row
    return basis, np.maximum(np.linalg.solve(basis, demand.astype(float)), 0)


def cutting_stock(counts: dict[int, int], room: int) -> list[tuple[list[int], int]]:
    """Patterns (sizes, largest first) and how many sequences each is used for; every item is placed once.

    The relaxed amounts are rounded down; the few items that leaves, fewer than patterns times sizes
    in a pattern, are placed first-fit, largest first.
    """
    if not counts:
        return []
    sizes = np.array(sorted(counts))
    demand = np.array([counts[s] for s in sizes.tolist()])
    patterns, amounts = relaxed(sizes, demand, room)
    left, plan = demand.copy(), []
    for pattern, amount in zip(patterns.T.astype(int), np.floor(amounts + 1e-6).astype(int), strict=True):
        on = pattern > 0
        times = int(min(amount, (left[on] // pattern[on]).min()))
        if times > 0:
            left -= times * pattern
            plan.append((np.repeat(sizes, pattern)[::-1].tolist(), times))
    bins: list[list[int]] = []
    spaces = np.empty(0, int)
    for size in np.repeat(sizes, left)[::-1].tolist():
        fits = np.flatnonzero(spaces >= size)
        if len(fits):
            bins[fits[0]].append(size)
            spaces[fits[0]] -= size
        else:
            bins.append([size])
            spaces = np.append(spaces, room - size)
    return plan + [(b, 1) for b in bins]


def slots(plan: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each size the stretches of ranks that a place in a pattern takes: first rank, first sequence, place."""
    found: dict[int, list] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for sizes, times in plan:
        for spot, size in enumerate(sizes):
            found.setdefault(size, []).append((taken.get(size, 0), sequence, spot))
            taken[size] = taken.get(size, 0) + times
        sequence += times
    return {size: np.array(rows, np.int64) for size, rows in found.items()}


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per piece of a document: which sequence of at most 4096 tokens holds it, and where.

    Pieces of at most SHORT tokens are joined into bundles first, by running sums within shares of them,
    and a bundle is packed like one piece. Lengths fall into classes of UNIT tokens. The driver sees one
    count for each class, at most 256, and solves for patterns of classes. Pieces are ranked within their
    class, in parallel by shares of a class, and a piece's rank gives its sequence. A sequence gathers at
    most 256 bundles and pieces, and no more pieces than tokens.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.
    A null text is empty: one token, the end id. Null ids, repeated rows and rows of one id are rows
    of their own. Other columns are ignored; no rows give no rows.
    """
    rows = stored(pieces(docs, id_col, text_col, vocabulary))
    counts = rows.groupBy((F.col("length") <= SHORT).alias("short")).count().collect()
    parts = max(1, -(-max((r["count"] for r in counts if r["short"]), default=0) // RANKED))
    # A share's short pieces in order: the bundle is told by the tokens before a piece, its place in it by those before in the bundle.
    line = Window.partitionBy("part").orderBy("id", "mark", "start").rowsBetween(Window.unboundedPreceding, -1)
    short = (rows.where(f"length <= {SHORT}").withColumn("part", F.pmod(F.xxhash64("id", "mark", "start"), F.lit(parts)))
             .withColumn("before", F.coalesce(F.sum("length").over(line), F.lit(0))).withColumn("bundle", F.expr(f"before div {BUNDLE}")))
    short = stored(short.withColumn("within", F.col("before") - F.min("before").over(Window.partitionBy("part", "bundle"))).drop("before"))
    # An item is a bundle or one longer piece.
    bundles = short.groupBy("part", "bundle").agg(F.sum("length").alias("filled"))
    longer = rows.where(f"length > {SHORT}").withColumn("filled", F.col("length")).withColumn("part", F.lit(None).cast("long")).withColumn("bundle", F.lit(None).cast("long"))
    size = F.expr(f"(filled + {UNIT - 1}) div {UNIT}")
    items = bundles.unionByName(longer, allowMissingColumns=True).withColumn("size", size)
    counts = {r["size"]: r["count"] for r in items.groupBy("size").count().collect()}
    where = slots(cutting_stock(counts, ROOM // UNIT))

    shares = max(1, -(-max(counts.values(), default=0) // RANKED))
    order = ("part", "bundle", "id", "mark", "start")
    dealt = items.withColumn("share", F.pmod(F.xxhash64(*order), F.lit(shares)))
    rank = F.row_number().over(Window.partitionBy("size", "share").orderBy(*order))
    base = dealt.groupBy("size", "share").count().select("size", "share", (
        F.sum("count").over(Window.partitionBy("size").orderBy("share")) - F.col("count")).alias("base"))
    ranked = dealt.withColumn("rank", rank).join(base, ["size", "share"]).withColumn("rank", F.col("rank") - 1 + F.col("base"))

    @F.pandas_udf("sequence long, spot long")
    def placed(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sizes, ranks, out = size.to_numpy(), rank.to_numpy(), np.zeros((len(size), 2), np.int64)
        for s in np.unique(sizes):
            mine, table = sizes == s, where[int(s)]
            at = np.searchsorted(table[:, 0], ranks[mine], "right") - 1
            out[mine, 0] = table[at, 1] + ranks[mine] - table[at, 0]
            out[mine, 1] = table[at, 2]
        return pd.DataFrame(out, columns=["sequence", "spot"])

    found = ranked.withColumn("p", placed("size", "rank")).select("*", "p.sequence", "p.spot")
    offset = F.sum("filled").over(Window.partitionBy("sequence").orderBy("spot")) - F.col("filled")
    put = found.withColumn("offset", offset)
    of_bundles = put.where("bundle IS NOT NULL").select("part", "bundle", "sequence", F.col("offset").alias("at"))
    joined = short.join(of_bundles, ["part", "bundle"]).withColumn("offset", F.col("at") + F.col("within"))
    whole = joined.drop("at", "within").unionByName(put.where("bundle IS NULL"), allowMissingColumns=True)
    return whole.select(F.col("id").alias("doc_id"), "start", "length", F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
                        F.col("sequence").alias("sequence_id"), "offset")
