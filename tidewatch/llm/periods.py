"""Periodic runs of words: an enhanced suffix array tested for branching tandems, no tree nodes.

The word sequences of a batch of texts stand one after another in one array; a word of one text equals no
word of another, so no common prefix crosses texts. Ranks by the first 1, 2, 4, ... words give the suffix
array, its inverse, the common prefixes (LCP) of neighbours, and left extensions, all in whole-array steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import let
from tidewatch.llm.frames import SPACE, texts

#: Words whose suffixes are sorted at once, and suffixes tested at once: bounds of a task's memory. A longer
#: text is sorted alone.
WORDS = 1 << 19
CHECKS = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def rank_levels(codes: np.ndarray) -> list[np.ndarray]:
    """Rank of each suffix by its first 2^k words, k = 0, 1, ..., until all ranks differ.

    A rank is the place of the first suffix of its group, so a group is as wide as its ranks leave free.
    Only suffixes whose group has others are sorted again. The last code must be unlike all others.
    """
    order = np.argsort(codes, kind="stable")
    fresh = np.concatenate(([True], codes[order][1:] != codes[order][:-1]))
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    levels, active = [rank.astype(np.int32)], order
    while True:
        starts = np.flatnonzero(np.concatenate(([True], rank[active][1:] != rank[active][:-1])))
        sizes = np.diff(np.append(starts, len(active)))
        active = active[np.repeat(sizes > 1, sizes)]
        if len(active) == 0:
            return levels
        step = 1 << (len(levels) - 1)
        key = (rank[active] << 32) | rank[np.minimum(active + step, len(codes) - 1)]
        inner = np.argsort(key, kind="stable")
        active, key = active[inner], key[inner]
        group = np.concatenate(([True], key[1:] != key[:-1]))
        whole = np.concatenate(([True], (key >> 32)[1:] != (key >> 32)[:-1]))
        at = np.flatnonzero(group)
        mine, first = at[np.cumsum(group) - 1], np.flatnonzero(whole)[np.cumsum(whole) - 1]
        rank[active] = rank[active] + mine - first
        levels.append(rank.astype(np.int32))


def common_prefixes(levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Words that each suffix in sorted order shares with the one before; 0 for the first."""
    found = np.zeros(len(order), np.int64)
    alive, nested = np.arange(1, len(order)), []
    for rank in levels:
        alive = alive[rank[order[alive]] == rank[order[alive - 1]]]
        nested.append(alive)
    for k in range(len(levels) - 1, -1, -1):
        pairs = nested[k]
        if len(pairs):
            a, b = order[pairs] + found[pairs], order[pairs - 1] + found[pairs]
            found[pairs] += (levels[k][a] == levels[k][b]).astype(np.int64) << k
    return found


def _interval_ends(lcp: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each border b between neighbours its LCP interval as a node of a binary tree of borders.

    left: the last border before b with a smaller LCP; right: the first one after it with none larger. Of
    equal borders the last is the topmost, so an interval with many children is a chain of binary nodes.
    Minima over 2^j borders are kept for as many j as the longest stretch of shared first words needs.
    """
    zero = np.flatnonzero(lcp == 0)
    widest = int(np.diff(np.append(zero, len(lcp))).max())
    least = [lcp]
    while (1 << len(least)) <= widest:
        half = 1 << (len(least) - 1)
        last = least[-1]
        least.append(np.minimum(last, np.concatenate((last[half:], np.zeros(min(half, len(last)), last.dtype)))))
    own = lcp[nodes]
    right, left = nodes + 1, nodes - 1
    for j in range(len(least) - 1, -1, -1):
        at = np.minimum(right, len(lcp) - 1)
        right = np.where((right < len(lcp)) & (least[j][at] > own), right + (1 << j), right)
        start = left - (1 << j) + 1
        left = np.where((start >= 0) & (least[j][np.maximum(start, 0)] >= own), start - 1, left)
    return left, np.minimum(right, len(lcp))


def branching_squares(order: np.ndarray, place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares whose next word breaks the period.

    For each LCP interval of depth d, each suffix i of its smaller child is tested: if i + d (or i - d) lies
    in the other child, its first d words are followed by the same d words and a differing word. Smaller
    children together hold n log n suffixes at most.
    """
    nodes = np.flatnonzero(lcp > 0)
    if len(nodes) == 0:
        return nodes, nodes
    left, right = _interval_ends(lcp, nodes)
    left = np.maximum(left, 0)  # the suffix at a border belongs to its right side
    small_left = nodes - left <= right - nodes
    lo, hi = np.where(small_left, left, nodes), np.where(small_left, nodes, right)
    other_lo, other_hi = np.where(small_left, nodes, left), np.where(small_left, right, nodes)
    starts, periods = [], []
    total = np.cumsum(hi - lo)
    cuts = np.unique(np.append(np.searchsorted(total, np.arange(CHECKS, total[-1], CHECKS), "right"), len(nodes)))
    for a, b in zip(np.concatenate(([0], cuts[:-1])).tolist(), cuts.tolist(), strict=True):
        size = hi[a:b] - lo[a:b]
        which = np.repeat(np.arange(a, b), size)
        at = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + lo[which]
        suffix, depth = order[at], lcp[nodes[which]]
        for step in (depth, -depth):
            partner = suffix + step
            inside = (partner >= 0) & (partner < len(order))
            met = place[np.where(inside, partner, 0)]
            hit = inside & (met >= other_lo[which]) & (met < other_hi[which])
            starts.append(np.minimum(suffix, partner)[hit])
            periods.append(depth[hit])
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(codes: np.ndarray, least: int, powers: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the runs of at least `least` words and `powers` periods, by start and period.

    Each run ends with one branching square of its period; the square is rotated to the left, by halving
    steps over the ranks, as far as the period holds. Squares of a multiple of the period rotate over the
    same words and merge into the run of the smallest period.
    """
    levels = rank_levels(codes)
    place = levels[-1].astype(np.int64)
    order = np.empty(len(codes), np.int64)
    order[place] = np.arange(len(codes))
    start, period = branching_squares(order, place, common_prefixes(levels, order))
    end = start + 2 * period
    for k in range(len(levels) - 1, -1, -1):
        back = start - (1 << k)
        on = back >= 0
        at = np.where(on, back, 0)
        on &= levels[k][at] == levels[k][at + period]
        start = np.where(on, back, start)
    length = end - start
    long_enough = length >= np.maximum(least, powers * period)
    start, length, period = start[long_enough], length[long_enough], period[long_enough]
    by = np.lexsort((period, length, start))
    start, length, period = start[by], length[by], period[by]
    first = np.concatenate(([True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])))[: len(start)]
    start, length, period = start[first], length[first], period[first]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those of a run after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def _batch_runs(lists: list[list[bytes]], least: int, powers: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words; one array for all of them."""
    sizes = np.array([len(words) for words in lists], np.int64)
    ends = np.cumsum(sizes + 1)
    begins = ends - sizes - 1
    codes = np.empty(int(ends[-1]), np.int64)
    base = 0
    for words, begin in zip(lists, begins.tolist(), strict=True):
        ids: dict[bytes, int] = {}
        number = count(base).__next__
        for word in set(words):
            ids[word] = number()
        codes[begin:begin + len(words)] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        base += len(ids) + 1
        codes[begin + len(words)] = base - 1  # an end that equals nothing
    start, length, period = find_runs(codes, least, powers)
    owner = np.searchsorted(begins, start, "right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    for own, s, n, p in zip(owner.tolist(), (start - begins[owner]).tolist(), length.tolist(), period.tolist(), strict=True):
        out[own].append((s, n, p))
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, powers: int = 4) -> DataFrame:
    """One row per input row: id, n_words, runs (start, length, period by start, then period), collapsed.

    Words are separated by space and control white space. A run is a stretch of consecutive words with
    smallest period q, of at least `least` words and `powers` times q, that no neighbouring word extends
    with period q. `collapsed` is the text without the words that a run holds after its first q, joined by
    one space. A null text has no words, no runs and an empty collapsed text, as an empty one. Repeated rows
    each give a row; a null id stays null; other columns are ignored; no rows give no rows. A task holds
    WORDS words at a time, or one text.
    """
    rows = texts(docs, id_col, text_col)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, lists, held = 0, [], 0
            for value in batch.column("text"):
                text = value.as_py()
                words = text.encode().split() if text else []
                if lists and held + len(words) > WORDS:
                    yield out(batch, at, lists)
                    at, lists, held = at + len(lists), [], 0
                lists.append(words)
                held += len(words) + 1
            if lists:
                yield out(batch, at, lists)

    def out(batch: pa.RecordBatch, at: int, lists: list[list[bytes]]) -> pa.RecordBatch:
        runs = _batch_runs(lists, least, powers)
        kept = [_collapsed(words, own).decode() for words, own in zip(lists, runs, strict=True)]
        shape = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        named = [[dict(zip(("start", "length", "period"), run, strict=True)) for run in own] for own in runs]
        return pa.RecordBatch.from_arrays(
            [batch.column("id").slice(at, len(lists)), pa.array(map(len, lists), pa.int64()), pa.array(named, shape), pa.array(kept, pa.string())],
            ["id", "n_words", "runs", "collapsed"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(of, f"id {kind}, n_words long, runs {RUNS}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The text of the query's task: of every tenth document, by a checksum of its id, the words from a
    place on repeat with a period; both come from the checksum. Without an id or a word nothing changes."""
    mark = F.crc32(doc_id.cast("string").cast("binary"))
    step = F.floor(mark / 10)

    def repeated(words: Column) -> Column:
        size = F.size(words)
        shape = F.struct((step % F.greatest(size, F.lit(1))).alias("first"), size.alias("size"))
        return let(shape, lambda s: let(
            F.lit(1) + F.floor((s["size"] - s["first"]) / (F.lit(3) + step % 8)),
            lambda period: F.array_join(F.transform(words, lambda w, i: F.when(i < s["first"], w).otherwise(
                F.get(words, (s["first"] + (i - s["first"]) % period).cast("int")))), " ")))

    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    return F.when(mark.isNull() | (mark % 10 != 0) | text.isNull(), text).otherwise(let(words, repeated))


def run_digest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_runs, the longest run (ties: smallest start, then period; nulls
    without a run) with 1000 times its exponent, and hashes of all runs and of the collapsed text."""
    found = periodic_runs(docs.select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]), F.lit("\n")))
    shown = found.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), best.alias("b"), lines.alias("lines"), "collapsed")
    return shown.select(
        "doc_id", "n_runs", (-F.col("b.s")).alias("start"), F.col("b.n").alias("length"), (-F.col("b.p")).alias("period"),
        F.floor(F.col("b.n") * 1000 / -F.col("b.p")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", "lines"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
