"""Folding and the ceiling chained in one streaming query, with the results of the batch operators.

Both steps let rows wait until the watermark has passed them and then take them in order, so rows may
arrive out of order within its delay. Folding hands on `admit_at` as the event time of what it emits, and
the ceiling waits by that. State holds the rows of the watermark's delay, one open run per key, and one
window per player, for groups of keys (`held`). A group's rows of one step are arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidewatch import fixed
from tidewatch.functions.records import SUMMED
from tidewatch.operators.canonical import CANONICAL
from tidewatch.operators.shaping import MICROS, report_columns, report_reason, totals_into_data, with_fold_columns
from tidewatch.streaming.held import GROUPS, Held, fold, group_of, key_text, numbers

TEXT_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class _InOrder(StatefulProcessor):
    """Rows that wait for the watermark; `taken` gets those of a group that it has passed."""

    WAITING: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Held(handle, "waiting", self.WAITING)
        self.names = list(self.waiting.kinds)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        least = None
        for frame in rows:
            if len(frame):
                self.waiting.append(frame[[f"x_{name}" for name in self.names]].set_axis(self.names, axis=1))
                first = int(frame["x_at"].min())
                least = first if least is None else min(least, first)
        if least is not None:
            self._wake(least, timerValues)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = self.waiting.get()
        ready = numbers(rows["at"]) <= passed
        rest = rows[~ready]
        if ready.any():
            self.waiting.put(rest)
        out, due = self.taken(rows[ready], passed)
        pending = [int(rest["at"].min())] if len(rest) else []
        if due is not None or pending:
            self._wake(min([*pending, *([due] if due is not None else [])]), timerValues)
        if len(out):
            yield out

    def _wake(self, at: int, timerValues) -> None:
        """Be called once the watermark has reached a moment; rounded up, as timers count milliseconds.

        A timer that the watermark has reached already, such as the one being handled, will not call again.
        """
        due = -(-at // 1000)
        ahead = [timer for timer in self.handle.listTimers() if timer > timerValues.getCurrentWatermarkInMs()]
        if not ahead or due < min(ahead):
            self.handle.registerTimer(due)

    def taken(self, rows: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, int | None]:
        """What leaves, and when the group must be woken next."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class _Fold(_InOrder):
    """One open run per key."""

    def __init__(self, sums: list[str], gap: int, hold: int):
        self.sums, self.gap, self.hold = sums, gap, hold
        self.values = [f"v{i}" for i in range(len(sums))]
        self.WAITING = ", ".join(["key string", "at bigint", "seq bigint", "occurred bigint", "row string", *[f"{v} string" for v in self.values]])

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        fields = ["key string", "row string", "repeats bigint", "opened bigint", "last bigint", "since bigint", "until bigint"]
        self.runs = Held(handle, "runs", ", ".join([*fields, *[f"{v} string" for v in self.values]]))

    def taken(self, rows: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, int | None]:
        runs = self.runs.get()
        firsts, totals, still = fold(runs, rows, self.values, self.gap, self.hold, passed)
        self.runs.put(still)
        nothing = dict.fromkeys(["repeats", "_from", "_until", *[f"_sum_{name}" for name in self.sums]])
        out = [pd.DataFrame({"_row": firsts["row"], "is_rollup": False, "admit_at": pd.to_datetime(firsts["opened"], unit="us"), **nothing}, dtype=None),
               pd.DataFrame({"_row": totals["row"], "is_rollup": True, "admit_at": pd.to_datetime(totals["ends"], unit="us"),
                             "repeats": totals["repeats"], "_from": totals["since"], "_until": totals["until"],
                             **{f"_sum_{name}": totals[v] for name, v in zip(self.sums, self.values)}})]
        return _stacked(out), int(still["ends"].min()) if len(still) else None


def _stacked(frames: list[pd.DataFrame]) -> pd.DataFrame:
    """One frame of those that have rows; a column that only some fill stays one of objects."""
    frames = [frame.astype({name: object for name in frame.columns if name != "admit_at"}) for frame in frames if len(frame)]
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame()


class _Ceiling(_InOrder):
    """One window per player: how many passed, how many did not, and the first of those."""

    WAITING = "key string, at bigint, turn bigint, seq bigint, row string"

    def __init__(self, limit: int, width: int, origin: int):
        self.limit, self.width, self.origin = limit, width, origin

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.windows = Held(handle, "windows", "key string, bucket bigint, used bigint, dropped bigint, row string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """Rows without a player pass."""
        players = []
        for frame in rows:
            free = frame["x_key"].isna()
            if free.any():
                yield self._out(frame["x_row"][free])
            players.append(frame[~free])
        yield from super().handleInputRows(key, iter(players), timerValues)

    def _out(self, rows, start=None, dropped=None) -> pd.DataFrame:
        return pd.DataFrame({"_row": rows, "_start": start, "dropped": dropped}).astype(object)

    def taken(self, rows: pd.DataFrame, passed: int) -> tuple[pd.DataFrame, int | None]:
        windows = self.windows.get()
        bucket = (numbers(rows["at"]) - self.origin) // self.width
        rows = rows.assign(bucket=bucket).sort_values(["key", "bucket", "at", "turn", "seq"], kind="stable", ignore_index=True)
        known = rows[["key", "bucket"]].merge(windows[["key", "bucket", "used"]], on=["key", "bucket"], how="left")["used"]
        place = rows.groupby(["key", "bucket"], sort=False).cumcount().to_numpy() + known.fillna(0).to_numpy(dtype=np.int64)
        over = place >= self.limit
        offered = rows.assign(used=~over, dropped=over).groupby(["key", "bucket"], as_index=False, sort=False)[["used", "dropped"]].sum()
        least = rows[over].drop_duplicates(["key", "bucket"])[["key", "bucket", "row"]]
        fresh = offered.merge(least, on=["key", "bucket"], how="left")
        both = pd.concat([windows, fresh.astype({"used": "Int64", "dropped": "Int64", "bucket": "Int64"})], ignore_index=True)
        merged = both.groupby(["key", "bucket"], as_index=False, sort=False).agg({"used": "sum", "dropped": "sum", "row": "first"})
        ends = (numbers(merged["bucket"]) + 1) * self.width + self.origin
        ended = ends <= passed
        self.windows.put(merged[~ended])
        told = merged[ended & (numbers(merged["dropped"]) > 0)]
        out = [self._out(rows["row"][~over]),
               self._out(told["row"], numbers(told["bucket"]) * self.width + self.origin, told["dropped"])]
        return _stacked(out), int(ends[~ended].min()) if not ended.all() else None


def _fold(events: DataFrame, keys: list[str], gap: float, hold: float, sums: list[str], delay: str, groups: int) -> DataFrame:
    """Folded rows of a stream with `admit_at` as their event time; events must have a time."""
    schema, columns = events.schema, events.columns
    narrow = events.withWatermark("received_at", delay).select(
        group_of(keys, groups).alias("_group"), key_text(keys).alias("x_key"), "received_at", F.unix_micros("received_at").alias("x_at"),
        F.coalesce(F.col("arrival_seq").cast("bigint"), F.lit(-(2**62))).alias("x_seq"),
        F.unix_micros("occurred_at").alias("x_occurred"), F.to_json(F.struct(*columns), TEXT_TIME).alias("x_row"),
        *[F.col(name).cast("string").alias(f"x_v{i}") for i, name in enumerate(sums)])
    folded = narrow.groupBy("_group").transformWithStateInPandas(
        statefulProcessor=_Fold(sums, round(gap * MICROS), round(hold * MICROS)), outputMode="Append", timeMode="EventTime",
        eventTimeColumnName="admit_at", outputStructType=T.StructType([
            T.StructField("_row", T.StringType()), T.StructField("is_rollup", T.BooleanType()), T.StructField("admit_at", T.TimestampType()),
            T.StructField("repeats", T.LongType()), T.StructField("_from", T.LongType()), T.StructField("_until", T.LongType()),
            *[T.StructField(f"_sum_{name}", T.StringType()) for name in sums]]))
    rows = folded.withColumn("_r", F.from_json("_row", schema, TEXT_TIME))
    rolled = F.col("is_rollup")

    def value(name: str) -> Column:
        own = F.col(f"_r.`{name}`")
        if name in sums:
            return F.when(rolled, F.col(f"_sum_{name}").cast(schema[name].dataType)).otherwise(own)
        if name == "event_id":
            return F.when(rolled, F.substring(F.sha2(F.concat_ws("|", own, F.lit("repeats")), 256), 1, 32)).otherwise(own)
        if name == "transaction_id":
            return F.when(~rolled, own)
        if name == "occurred_at":
            return F.when(rolled, F.timestamp_micros("_from")).otherwise(own)
        return own

    return rows.select(*[value(name).alias(name) for name in columns], "repeats",
                       F.timestamp_micros("_until").alias("repeated_until"), "is_rollup", "admit_at")


def shape_stream(events: DataFrame, gap: float = fixed.GAP_SECONDS, max_hold: float = fixed.HOLD_SECONDS,
                 limit: int = fixed.PLAYER_LIMIT, window: float = fixed.LIMIT_SECONDS, delay: str = "1 minute",
                 groups: int = GROUPS) -> DataFrame:
    """Canonical events of a stream, folded, capped and with the reports of what the cap dropped, as one
    stream of canonical columns: `deliverable(*shape_events(events))` below the watermark.

    Events without a time pass as they are; those without a player are folded and pass the ceiling. The
    limits must be positive. A run's first row, too, leaves once the watermark has passed it. Keys and players
    are dealt to `groups` groups, each with one entry of the state.
    """
    timed = events.filter(F.col("received_at").isNotNull())
    folded = totals_into_data(_fold(with_fold_columns(timed), ["server_id", "fold_key"], gap, max_hold, list(SUMMED), delay, groups))
    rows = folded.select(*CANONICAL, "is_rollup", "admit_at")
    schema = T.StructType([rows.schema[name] for name in CANONICAL])
    source = F.col("actor.source")
    # Rows without a player are dealt by what they are; nothing is kept for them.
    dealt = F.when(source.isNotNull(), F.xxhash64("server_id", source)).otherwise(F.xxhash64("event_id", "arrival_seq"))
    offered = rows.select(
        F.pmod(dealt, F.lit(groups)).cast("int").alias("_group"),
        F.when(source.isNotNull(), F.to_json(F.struct("server_id", source.cast("string").alias("player")))).alias("x_key"), "admit_at",
        F.unix_micros("admit_at").alias("x_at"), (~F.col("is_rollup")).cast("bigint").alias("x_turn"),
        F.coalesce(F.col("arrival_seq").cast("bigint"), F.lit(-(2**62))).alias("x_seq"),
        F.to_json(F.struct(*CANONICAL), TEXT_TIME).alias("x_row"))
    capped = offered.groupBy("_group").transformWithStateInPandas(
        statefulProcessor=_Ceiling(limit, round(window * MICROS), 0), outputMode="Append", timeMode="EventTime",
        outputStructType=T.StructType([
            T.StructField("_row", T.StringType()), T.StructField("_start", T.LongType()), T.StructField("dropped", T.LongType())]))
    parsed = capped.withColumns({"_r": F.from_json("_row", schema, TEXT_TIME), "window_start": F.timestamp_micros("_start")})
    shown = parsed.withColumns({
        "server_id": F.col("_r.server_id"), "source": F.col("_r.actor.source"), "actor": F.col("_r.actor"), "category": F.lit("security"),
        "action": F.lit("rate_limit_triggered"), "severity": F.lit("warning"), "reason": report_reason(F.col("dropped"), limit)})
    reported = report_columns(window)
    out = shown.select(*[
        F.when(F.col("dropped").isNull(), F.col(f"_r.`{name}`")).otherwise(reported[name].cast(schema[name].dataType)).alias(name)
        for name in CANONICAL])
    return out.unionByName(events.filter(F.col("received_at").isNull()).select(*CANONICAL))
