"""Greedy chains: "a group starts, and the next starts at the first row that no longer fits".

Every start depends on the one before, which looks sequential per key. Within a slice, though, the
jump from each row is a binary search, and a slice is fully described by where a chain entering it
would leave it: a jump function, kept as rows of (row entered, limits it leaves with). A chain that
meets no row to enter passes through with the limits it came with, which needs no row. Two such
functions compose into that of both slices together, by an as-of join of the exits of the first with
the entries of the second. So neighbours are composed pairwise until the functions of a key are few
rows, those are followed, and what enters each slice is handed down the same tree again.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.plans.keys import join_on
from tidewatch.plans.ordered import HOT_ROWS, SLICE, arrange, written

START = "_start"
OPENS = "_opens"
SPAN = "_span"
LIMITS = ("_meter_limit", "_fill_limit")
FIRST, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _jumps(meters, fills, sizes, step, room):
    """Index of the first row that a group started at each row cannot take, and its fill limit."""
    limits = fills - sizes + room
    by_meter = np.searchsorted(meters, meters + step, side="left")
    by_fill = np.searchsorted(fills, limits, side="right")
    return np.maximum(np.arange(len(meters)) + 1, np.minimum(by_meter, by_fill)), limits


def _follow(jump, at):
    starts = []
    while at < len(jump):
        starts.append(at)
        at = jump[at]
    return np.array(starts, dtype=np.int64)


def _entry(meters, fills, meter_limit, fill_limit):
    """First row at or over the meter limit, or over the fill limit."""
    by_meter = np.searchsorted(meters, meter_limit, side="left")
    by_fill = np.searchsorted(fills, fill_limit, side="right")
    return int(min(by_meter, by_fill))


def mark_chain(df: DataFrame, group: Sequence[str], order: Sequence[str], meter: str, step: int,
               filled: str | None = None, size: str | None = None, room: int = 0,
               sliced: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add `_start`, the meter of the row that opened this row's group in the greedy chain, and
    `_opens`, whether it is that row.

    A group opened at row s takes rows while meter < meter[s] + step and, if `filled` (the running
    total of `size`) is given, while the sizes taken sum to at most `room`. The meter must differ
    between any two groups of one chain, which it does: it never shrinks and a step is positive.
    """
    group, order = list(group), list(order)
    out_schema = T.StructType([
        *df.schema.fields, T.StructField(START, T.LongType()), T.StructField(OPENS, T.BooleanType()),
    ])
    names = [field.name for field in out_schema.fields]

    def arrays(table: pa.Table):
        table = table.sort_by([(name, "ascending") for name in order])
        meters = table[meter].to_numpy().astype(np.int64)
        if filled is None:
            fills = sizes = np.zeros(len(meters), dtype=np.int64)
        else:
            fills = table[filled].to_numpy().astype(np.int64)
            sizes = table[size].to_numpy().astype(np.int64)
        return table, meters, fills, sizes

    def marked(table, meters, fills, sizes, first: int, opened: int) -> pa.Table:
        jump, _ = _jumps(meters, fills, sizes, step, room)
        starts = _follow(jump, first)
        which = np.searchsorted(starts, np.arange(len(meters)), side="right")
        values = np.concatenate(([opened], meters[starts]))[which]
        opens = np.zeros(len(meters), dtype=bool)
        opens[starts] = True
        table = table.append_column(START, pa.array(values, type=pa.int64()))
        return table.append_column(OPENS, pa.array(opens)).select(names)

    if not sliced:
        def whole(table: pa.Table) -> pa.Table:
            return marked(*arrays(table), 0, 0)

        return df.groupBy(*group).applyInArrow(whole, out_schema)

    keys = [df.schema[name] for name in group]
    piece_schema = T.StructType([
        *keys, T.StructField(SPAN, T.IntegerType()),
        *[T.StructField(name, T.LongType()) for name in PIECE],
    ])

    def summarise(table: pa.Table) -> pa.Table:
        """Rows a chain can enter this slice at, and the limits it leaves with from each."""
        table, meters, fills, sizes = arrays(table)
        jump, limits = _jumps(meters, fills, sizes, step, room)
        count = len(meters)
        last = np.where(jump < count, np.minimum(jump, count - 1), np.arange(count))
        while True:
            further = last[last]
            if np.array_equal(further, last):
                break
            last = further
        entries = min(count, int(np.searchsorted(meters, meters[0] + step, side="left")) + 1)
        exits = last[:entries]
        # Neighbouring entries that leave alike count as one, reached up to its last row.
        picked = np.flatnonzero(np.append(exits[1:] != exits[:-1], True))
        out = table.select([*group, SLICE]).take(pa.array(np.zeros(len(picked), dtype=np.int64)))
        lows = np.concatenate(([FIRST], meters[picked][:-1]))
        bound = np.full(len(picked), meters[0] + step)
        for name, values in zip(PIECE, (lows, meters[picked], fills[picked],
                                        meters[exits[picked]] + step, limits[exits[picked]], bound)):
            out = out.append_column(name, pa.array(values, type=pa.int64()))
        return out.rename_columns([*group, SPAN, *PIECE])

    pieces = df.groupBy(*group, SLICE).applyInArrow(summarise, piece_schema)
    entries = slice_entries(pieces, group, filled is not None, hot_rows or HOT_ROWS)
    entries = entries.withColumnRenamed(SPAN, SLICE)

    def enter(table: pa.Table) -> pa.Table:
        table, meters, fills, sizes = arrays(table)
        meter_limit = table["_meter_limit"][0].as_py()
        first = _entry(meters, fills, meter_limit, table["_fill_limit"][0].as_py())
        opened = meter_limit - step if first > 0 else 0
        return marked(table, meters, fills, sizes, first, opened)

    return join_on(df, entries, [*group, SLICE]).groupBy(*group, SLICE).applyInArrow(enter, out_schema)


#: A row of a jump function: whoever comes with a meter limit above `_low` and up to `_meter` (or a
#: fill limit under `_fill`) enters here and leaves with the two limits; none comes with more than `_bound`.
PIECE = ("_low", "_meter", "_fill", "_meter_exit", "_fill_exit", "_bound")


def slice_entries(pieces: DataFrame, group: Sequence[str], filled: bool, most: int) -> DataFrame:
    """The limits with which each key's chain enters each slice (`_span` of `pieces`).

    Functions are composed pairwise until no key has more than `most` rows of them. A function holds as
    many rows as one step of the chain spans, so this ends also where a slice is shorter than a step.
    """
    levels = [written(pieces)]
    while _largest(levels[-1], group) > most:
        levels.append(written(_composed(levels[-1], group, filled, most)))
    keys = [pieces.schema[name] for name in group]
    entries = levels[-1].groupBy(*group).applyInArrow(
        _followed(list(group)), T.StructType([*keys, T.StructField(SPAN, T.IntegerType()),
                                              *[T.StructField(name, T.LongType()) for name in LIMITS]]))
    for level in reversed(levels[:-1]):
        entries = written(_handed_down(entries, level, group))
    return entries


def _largest(pieces: DataFrame, group: Sequence[str]) -> int:
    """Rows of the key with most, among keys that still have several functions."""
    counted = pieces.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.max(SPAN).alias("last"), F.min(SPAN).alias("first"))
    return counted.filter("last > first").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def _composed(pieces: DataFrame, group: Sequence[str], filled: bool, hot_rows: int) -> DataFrame:
    """The functions of pairs of neighbouring spans."""
    names = [*group, SPAN]
    halves = pieces.withColumns({SPAN: F.floor(F.col(SPAN) / 2).cast("int"), "_second": F.col(SPAN) % 2 == 1})
    first, second = halves.filter(~F.col("_second")), halves.filter("_second")
    before = first.groupBy(*names).agg(F.max("_meter").alias("_ends"), F.first("_bound").alias("_reach"))
    # A piece of the second half is entered from outside only while the first half may be passed.
    second = join_on(second, before, names, "left").withColumns({
        "_low": F.when(F.col("_low") == FIRST, F.coalesce("_ends", "_low")).otherwise(F.col("_low")),
        "_bound": F.coalesce("_reach", "_bound")})
    reached = second.filter(F.col("_low") < F.col("_bound")).select(*names, *PIECE)
    onward = _applied(first.select(*names, *PIECE), second.select(*names, *PIECE), names, filled, hot_rows)
    return onward.unionByName(reached)


def _applied(first: DataFrame, second: DataFrame, names: Sequence[str], filled: bool, hot_rows: int) -> DataFrame:
    """The pieces of `first` with their exits led on through `second`."""
    entry = F.struct("_meter", F.struct("_meter_exit", "_fill_exit").alias("exits"))
    probes = first.select(*names, F.struct(*PIECE).alias("_piece"))

    def met(probes: DataFrame, limit: str, at: str, probe_side: int, name: str) -> DataFrame:
        """Adds `name`, the first row of `second` that the limit reaches; the order is from the far end."""
        stacked = probes.withColumns({"_pos": -F.col(f"_piece.{limit}"), "_side": F.lit(probe_side)}).unionByName(
            second.select(*names, (-F.col(at)).alias("_pos"), F.lit(1 - probe_side).alias("_side"),
                          entry.alias("_entry")), allowMissingColumns=True)
        rows = arrange(stacked, names, ["_pos", "_side"], hot_rows).last_known(F.col("_entry"), name)
        return rows.df.filter(F.col("_piece").isNotNull()).drop("_pos", "_side", "_entry", SLICE)

    probes = met(probes, "_meter_exit", "_meter", 1, "_by_meter")
    found = F.col("_by_meter")
    if filled:
        probes = met(probes, "_fill_exit", "_fill", 0, "_by_fill")
        found = F.least("_by_meter", "_by_fill")  # the earlier row; a NULL counts as none
    led = {name: F.coalesce(found["exits"][name], F.col(f"_piece.{name}"))
           for name in ("_meter_exit", "_fill_exit")}
    return probes.select(*names, *[led.get(name, F.col(f"_piece.{name}")).alias(name) for name in PIECE])


def _followed(group: list[str]):
    """Follow one chain through its spans: the limits it enters each with."""

    def thread(table: pa.Table) -> pa.Table:
        table = table.sort_by([(SPAN, "ascending"), ("_meter", "ascending")])
        spans = table[SPAN].to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], spans[1:] != spans[:-1])))
        meters, fills, meter_exits, fill_exits = (table[name].to_numpy() for name in PIECE[1:5])
        meter_limit, fill_limit, limits = FIRST, LAST, []
        for a, b in zip(starts, np.append(starts[1:], len(spans))):
            limits.append((meter_limit, fill_limit))
            at = _entry(meters[a:b], fills[a:b], meter_limit, fill_limit)
            if at < b - a:
                meter_limit, fill_limit = int(meter_exits[a + at]), int(fill_exits[a + at])
        out = table.select([*group, SPAN]).take(pa.array(starts))
        for name, values in zip(LIMITS, zip(*limits)):
            out = out.append_column(name, pa.array(values, type=pa.int64()))
        return out

    return thread


def _handed_down(entries: DataFrame, pieces: DataFrame, group: Sequence[str]) -> DataFrame:
    """What enters the spans below, from what enters the pairs they make."""
    names = [*group, SPAN]
    below = pieces.select(*names).distinct().withColumnRenamed(SPAN, "_own").withColumn(
        SPAN, F.floor(F.col("_own") / 2).cast("int"))
    given = join_on(below, entries, names)
    halves = join_on(pieces.filter(F.col(SPAN) % 2 == 0).withColumn(SPAN, F.floor(F.col(SPAN) / 2).cast("int")), entries, names)
    taken = halves.filter((F.col("_meter") >= F.col("_meter_limit")) | (F.col("_fill") > F.col("_fill_limit")))
    left = taken.groupBy(*names).agg(F.min_by(F.struct("_meter_exit", "_fill_exit"), "_meter").alias("_left"))
    joined = join_on(given, left, names, "left")
    second = F.col("_own") % 2 == 1
    return joined.select(*group, F.col("_own").alias(SPAN), *[
        F.when(second, F.coalesce(F.col("_left")[exit_], F.col(limit))).otherwise(F.col(limit)).alias(limit)
        for limit, exit_ in zip(LIMITS, ("_meter_exit", "_fill_exit"))])
