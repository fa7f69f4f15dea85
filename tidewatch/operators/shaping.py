"""Traffic shaping: folding repeats, the per-player ceiling, its report, and volume."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.records import SUMMED, event_id, fold_key, json_object
from tidewatch.functions.text import lua_number, number_json, text_json, utc_text
from tidewatch.operators.canonical import CANONICAL, SELF
from tidewatch.operators.identity import PARTY
from tidewatch.plans.chains import OPENS, START, mark_chain
from tidewatch.plans.keys import join_on
from tidewatch.plans.ordered import HOT_ROWS, arrange, written

MICROS = 1_000_000
FOLD_COLUMNS = ("repeats", "repeated_until", "is_rollup", "admit_at")


class Watch:
    """What goes into folding and what comes out, counted while the folded rows are written.

    Pass it to `coalesce_repeats`, write the result, then ask `totals` or `check`. Nothing is read a second
    time. After tasks were lost and run again the counts may be too high; `conservation_check` is the
    judge then.
    """

    def __init__(self, sums: Sequence[str] = SUMMED):
        self.sums, self._parts, self._after = list(sums), [], None

    def _metrics(self, events: Column) -> list[Column]:
        return [F.coalesce(F.sum(events), F.lit(0)).alias("events"),
                *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in self.sums]]

    def offered(self, rows: DataFrame) -> DataFrame:
        """Every row must pass exactly one such place on its way into folding."""
        self._parts.append(Observation())
        return rows.observe(self._parts[-1], *self._metrics(F.lit(1).cast("bigint")))

    def kept(self, rows: DataFrame) -> DataFrame:
        self._after = Observation()
        events = F.when(F.col("is_rollup"), F.col("repeats")).otherwise(F.lit(1).cast("bigint"))
        return rows.observe(self._after, *self._metrics(events))

    def totals(self) -> dict[str, tuple]:
        """Metric to (before, after); waits for the write to end."""
        before, after = [part.get for part in self._parts], self._after.get
        return {name: (sum(part[name] for part in before), after[name]) for name in ("events", *self.sums)}

    def check(self) -> dict[str, tuple]:
        """The totals, or an error that names those which folding changed."""
        totals = self.totals()
        changed = {name: pair for name, pair in totals.items() if pair[0] != pair[1]}
        if changed:
            raise ValueError(f"folding changed totals: {changed}")
        return totals


def coalesce_repeats(df: DataFrame, keys: Sequence[str], gap: float = fixed.GAP_SECONDS,
                     max_hold: float = fixed.HOLD_SECONDS, sums: Sequence[str] = SUMMED,
                     at: str = "received_at", seq: str = "arrival_seq",
                     occurred_at: str = "occurred_at", flush_at: str | None = None,
                     hot_rows: int | None = HOT_ROWS, watch: Watch | None = None) -> DataFrame:
    """Fold repeats of a key: the first row of a run passes, the rest become one total.

    A run is over `gap` seconds after its last row or `max_hold` after its first, whichever comes
    first. The total carries the first row's columns with `sums` added up over the repeats alone,
    a new event id and no transaction id. New columns: `repeats`, `repeated_until`, `is_rollup`
    and `admit_at`, the moment the row reaches whatever is next. Rows are read in (at, seq) order.
    NULL keys fold like others. A row without an arrival time passes as it is, with no `admit_at`.
    `watch` counts what goes in and comes out.
    """
    columns = df.columns
    offered = watch.offered if watch else lambda rows: rows
    kept = watch.kept if watch else lambda rows: rows
    if gap <= 0:
        return kept(offered(df).withColumns({
            "repeats": F.lit(None).cast("bigint"),
            "repeated_until": F.lit(None).cast(df.schema[occurred_at].dataType),
            "is_rollup": F.lit(False), "admit_at": F.col(at),
        }))

    gap_us, hold_us = round(gap * MICROS), round(max_hold * MICROS)
    timed = df.withColumn("_t", F.unix_micros(F.col(at)))
    timeless = offered(timed.filter(F.col("_t").isNull()).select(*columns))
    timed = timed.filter(F.col("_t").isNotNull())
    rows = arrange(timed, keys, ["_t", seq], hot_rows).previous(F.col("_t"), "_before")
    fresh = F.col("_before").isNull() | (F.col("_t") - F.col("_before") >= gap_us)
    rows = rows.last_known(F.when(fresh, F.col("_t")), "_island")

    # Until max_hold after the quiet before it, a row belongs to the island's first run. Only rows
    # beyond that need the chain of holds, in which each start depends on the one before.
    within = F.col("_t") - F.col("_island") < hold_us
    near = offered(rows.df.filter(within)).withColumns({START: F.col("_island"), OPENS: fresh})
    # Observed behind the chain, which may read its rows more than once.
    far = mark_chain(rows.df.filter(~within), [*keys, "_island"], ["_t", seq], meter="_t",
                     step=hold_us, sliced=rows.sliced, hot_rows=hot_rows)

    def repeat(value: Column) -> Column:
        return F.when(~F.col(OPENS), value)

    order = repeat(F.struct("_t", seq))
    runs = near.unionByName(offered(far)).groupBy(*keys, START).agg(
        F.first(F.when(F.col(OPENS), F.struct(*columns)), ignorenulls=True).alias("_row"),
        F.count(repeat(F.lit(1))).alias("_repeats"),
        F.max("_t").alias("_last"),
        *[F.sum(repeat(F.col(name))).alias(f"_sum_{name}") for name in sums],
        F.min_by(repeat(F.col(occurred_at)), order).alias("_from"),
        F.max_by(repeat(F.col(occurred_at)), order).alias("_until"),
    )
    closes = F.least(F.col("_last") + gap_us, F.col(START) + hold_us)
    if flush_at is not None:
        closes = F.least(closes, F.unix_micros(F.lit(flush_at).cast("timestamp")))

    def own(name: str) -> Column:
        value = F.col(f"_row.{name}")
        return value.cast(runs.schema[f"_sum_{name}"].dataType) if name in sums else value

    def folded(name: str) -> Column:
        if name in sums:
            return F.col(f"_sum_{name}")
        if name == "event_id":
            text = F.concat_ws("|", F.col("_row.event_id"), F.lit("repeats"))
            return F.substring(F.sha2(text, 256), 1, 32)
        if name == "transaction_id":
            return F.lit(None).cast(df.schema[name].dataType)
        return F.col("_from") if name == occurred_at else own(name)

    moment = df.schema[occurred_at].dataType
    first = F.struct(
        *[own(name).alias(name) for name in columns],
        F.lit(None).cast("bigint").alias("repeats"),
        F.lit(None).cast(moment).alias("repeated_until"),
        F.lit(False).alias("is_rollup"),
        F.col(f"_row.{at}").cast("timestamp").alias("admit_at"),
    )
    rollup = F.struct(
        *[folded(name).alias(name) for name in columns],
        F.col("_repeats").alias("repeats"),
        F.col("_until").alias("repeated_until"),
        F.lit(True).alias("is_rollup"),
        F.timestamp_micros(closes).alias("admit_at"),
    )
    rows_out = F.when(F.col("_repeats") > 0, F.array(first, rollup)).otherwise(F.array(first))
    folded_rows = runs.select(F.inline(rows_out))
    kinds = {field.name: field.dataType for field in folded_rows.schema.fields}
    passed = {
        "repeats": F.lit(None), "repeated_until": F.lit(None), "is_rollup": F.lit(False), "admit_at": F.lit(None),
    }
    return kept(folded_rows.unionByName(timeless.select(
        *[passed.get(name, F.col(name)).cast(kind).alias(name) for name, kind in kinds.items()]
    )))


def _ceiling(df: DataFrame, window: float, origin: float, source: str, order: Sequence[Column]) -> DataFrame:
    """Rows of players numbered within (server, player, window)."""
    width, start = round(window * MICROS), round(origin * MICROS)
    bucket = F.floor((F.unix_micros("admit_at") - start) / width)
    named = df.withColumns({"_who": F.col(source).cast("string"), "_bucket": bucket})
    placed = Window.partitionBy("server_id", "_who", "_bucket").orderBy(*order)
    return named.withColumn("_place", F.row_number().over(placed))


def _admission(df: DataFrame) -> DataFrame:
    """Rows that did not come from folding get the columns the ceiling reads."""
    missing = {
        "admit_at": F.col("received_at"), "is_rollup": F.lit(False),
    }
    return df.withColumns({k: v for k, v in missing.items() if k not in df.columns})


def admission_order() -> list[Column]:
    """Order in which rows reach the ceiling: a total closing at a moment goes before new rows."""
    return [F.col("admit_at"), F.col("is_rollup").desc(), F.col("arrival_seq")]


def rate_limit(df: DataFrame, limit: int = fixed.PLAYER_LIMIT,
               window: float = fixed.LIMIT_SECONDS, origin: float = 0.0,
               source: str = "actor.source") -> DataFrame:
    """The first `limit` rows of each player and window; rows without a player, or without a time, pass.

    Spark turns "row_number <= limit" into a per-task cut before the shuffle, so a flooding player
    costs `limit` rows per map task however many rows it sent.
    """
    if limit <= 0:
        return df
    added = [name for name in ("admit_at", "is_rollup") if name not in df.columns]
    rows = _admission(df)
    limited = F.col(source).isNotNull() & F.col("admit_at").isNotNull()
    placed = _ceiling(rows.filter(limited), window, origin, source, admission_order())
    kept = placed.filter(F.col("_place") <= limit).drop("_who", "_bucket", "_place")
    # A filter that also let the others pass would keep Spark from cutting players before the shuffle.
    return kept.unionByName(rows.filter(~limited)).drop(*added)


def rate_limit_report(df: DataFrame, limit: int = fixed.PLAYER_LIMIT,
                      window: float = fixed.LIMIT_SECONDS, origin: float = 0.0,
                      source: str = "actor.source", actor: str = "actor") -> DataFrame:
    """One row per player and window over the ceiling: how many were dropped and who sent them.

    Rows without a time are in no window and never dropped, so they are not reported either.
    """
    rows = _admission(df)
    width, start = round(window * MICROS), round(origin * MICROS)
    bucket = F.floor((F.unix_micros("admit_at") - start) / width)
    players = rows.filter(F.col(source).isNotNull() & F.col("admit_at").isNotNull()).select(
        "server_id", F.col(source).alias("source"), bucket.alias("bucket"), "admit_at",
        "is_rollup", "arrival_seq", F.col(actor).alias("actor"),
    )
    over = players.groupBy("server_id", "source", "bucket").agg(
        F.count(F.lit(1)).alias("offered")
    ).filter(F.lit(limit > 0) & (F.col("offered") > limit))
    placed = Window.partitionBy("server_id", "source", "bucket").orderBy(*admission_order())
    # The first row dropped is the one after the last kept, again cut before the shuffle.
    first_dropped = (
        players.withColumn("_place", F.row_number().over(placed))
        .filter(F.col("_place") == max(limit, 0) + 1)
        .select("server_id", "source", "bucket", "actor")
    )
    dropped = F.col("offered") - limit
    return join_on(over, first_dropped, ["server_id", "source", "bucket"]).select(
        "server_id", "source",
        F.timestamp_micros(F.col("bucket") * width + start).alias("window_start"),
        F.lit("security").alias("category"),
        F.lit("rate_limit_triggered").alias("action"),
        F.lit("warning").alias("severity"),
        "actor",
        dropped.alias("dropped"),
        report_reason(dropped, limit).alias("reason"),
    )


def report_reason(dropped: Column, limit: int) -> Column:
    return F.format_string(fixed.LIMIT_REASON, F.lit(limit) + dropped, F.lit(limit))


def report_events(report: DataFrame, window: float = fixed.LIMIT_SECONDS) -> DataFrame:
    """The reports of a ceiling over canonical events as canonical events themselves.

    A report arrives when its window ends. It has no place in the order of arrival; its id comes
    from server, player and window, so that a replay reports under the same id.
    """
    columns = report_columns(window)
    return report.select(*[columns[name].alias(name) for name in CANONICAL])


def report_columns(window: float) -> dict[str, Column]:
    """The canonical columns of a report by name, out of the columns of `rate_limit_report`."""
    ends = F.timestamp_micros(F.unix_micros("window_start") + round(window * MICROS))
    whose = F.concat_ws("|", F.col("source").cast("string"), F.unix_micros("window_start").cast("string"))
    made = {
        "received_at": ends, "occurred_at": F.date_trunc("second", ends),
        "event_id": event_id(F.lit(None).cast("string"), F.col("server_id"), whose, F.col("action")),
        "context": json_object(resource=text_json(F.lit(SELF))),
        "data": json_object(reason=text_json(F.col("reason")), dropped=F.col("dropped").cast("string")),
        "arrival_seq": F.lit(None).cast("bigint"), "target": F.lit(None).cast(PARTY),
    }
    given = ("server_id", "category", "action", "severity", "actor")
    return {name: F.col(name) if name in given else made.get(name, F.lit(None).cast("string")) for name in CANONICAL}


def deliverable(admitted: DataFrame, report: DataFrame, window: float = fixed.LIMIT_SECONDS) -> DataFrame:
    """What leaves shaping: the admitted events and the reports, in the canonical columns."""
    return admitted.select(*CANONICAL).unionByName(report_events(report, window))


def volume_label(channel: Column, category: Column, action: Column) -> Column:
    return F.concat(F.coalesce(channel, category, F.lit("?")), F.lit(" "), action)


def top_volume(df: DataFrame, k: int = 15, since: str | None = None, until: str | None = None,
               at: str = "received_at") -> DataFrame:
    """The busiest event types among admitted rows, with their rate per minute."""
    if since is not None:
        df = df.filter(F.col(at) >= F.lit(since).cast("timestamp"))
    if until is not None:
        df = df.filter(F.col(at) <= F.lit(until).cast("timestamp"))
    label = volume_label(F.col("channel"), F.col("category"), F.col("action"))
    first = F.lit(since).cast("timestamp") if since else F.min("_from")
    last = F.lit(until).cast("timestamp") if until else F.max("_to")
    counted = df.groupBy(label.alias("label")).agg(
        F.count(F.lit(1)).alias("events"), F.min(at).alias("_from"), F.max(at).alias("_to")
    )
    # One row, whatever the input: the span the counters cover.
    span = counted.agg(
        F.greatest(F.lit(1), F.unix_timestamp(last) - F.unix_timestamp(first)).alias("seconds")
    )
    busiest = counted.select("label", "events").orderBy(F.col("events").desc(), "label").limit(k)
    return busiest.crossJoin(F.broadcast(span)).select(
        "label", "events", "seconds",
        F.round(F.col("events") * 60 / F.col("seconds"), 6).alias("per_minute"),
    )


def shaping_status(shaped: DataFrame, report: DataFrame) -> DataFrame:
    """Totals: repeats folded away and rows over the ceiling; `shaped` is the folded frame."""
    folded = shaped.agg(F.coalesce(F.sum("repeats"), F.lit(0)).alias("folded"))
    limited = report.agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("limited"))
    # Two one-row frames.
    return folded.crossJoin(limited)


def conservation_check(before: DataFrame, after: DataFrame, keys: Sequence[str],
                       sums: Sequence[str] = SUMMED) -> DataFrame:
    """Keys whose events or sums changed by folding; empty when nothing was lost or invented."""
    def totals(df: DataFrame, suffix: str, events: Column) -> DataFrame:
        return df.groupBy(*keys).agg(
            F.sum(events).alias(f"events_{suffix}"),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(f"{name}_{suffix}") for name in sums],
        )

    one = F.lit(1).cast("bigint")
    offered = totals(before, "before", one)
    kept = totals(after, "after", F.when(F.col("is_rollup"), F.col("repeats")).otherwise(one))
    changed = reduce(
        Column.__or__,
        [~F.col(f"{name}_before").eqNullSafe(F.col(f"{name}_after")) for name in ("events", *sums)],
    )
    return join_on(offered, kept, list(keys), "full").filter(changed)


def with_fold_columns(events: DataFrame) -> DataFrame:
    """Canonical events with their fold key and the numbers folding adds up."""
    return events.withColumns({
        "fold_key": fold_key(F.col("context"), F.col("data")),
        **{name: lua_number(json_number(F.element_at("data", name))) for name in SUMMED},
    })


def json_number(value: Column) -> Column:
    """Text of a JSON number, or of a string holding one."""
    return F.trim(F.translate(value, '"', " "))


def fold_events(events: DataFrame, gap: float = fixed.GAP_SECONDS,
                max_hold: float = fixed.HOLD_SECONDS, flush_at: str | None = None,
                hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """`coalesce_repeats` over canonical events; totals and repeats go back into `data`."""
    folded = coalesce_repeats(
        with_fold_columns(events), ["server_id", "fold_key"], gap, max_hold, flush_at=flush_at,
        hot_rows=hot_rows,
    )
    return totals_into_data(folded)


def totals_into_data(folded: DataFrame) -> DataFrame:
    """Folded canonical events with the totals and repeats in `data`."""
    template = F.map_filter(F.col("data"), lambda key, _: ~key.isin(*SUMMED, "repeats", "repeatedUntil"))
    totals = {name: F.when(F.col(name).isNotNull(), number_json(F.col(name))) for name in SUMMED}
    rolled = F.map_concat(
        F.coalesce(template, F.create_map().cast("map<string,string>")),
        json_object(**totals, repeats=F.col("repeats").cast("string"),
                    repeatedUntil=text_json(utc_text(F.col("repeated_until")))),
    )
    return folded.withColumns({
        "data": F.when(F.col("is_rollup"), rolled).otherwise(F.col("data")),
        # Folding adds up balances like payments; such a total is no amount of money.
        "total_is_additive": ~F.coalesce(F.col("action") == "balance_set", F.lit(False)),
    })


def shape_events(events: DataFrame, gap: float = fixed.GAP_SECONDS,
                 max_hold: float = fixed.HOLD_SECONDS, limit: int = fixed.PLAYER_LIMIT,
                 window: float = fixed.LIMIT_SECONDS, flush_at: str | None = None,
                 hot_rows: int | None = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Fold, then cap each player: (rows admitted, reports of what the cap dropped).

    The events are written to the shared folder once, as folding reads them several times, and so are the
    folded rows, which the ceiling and the report read.
    """
    folded = written(fold_events(written(events), gap, max_hold, flush_at, hot_rows))
    return rate_limit(folded, limit, window), rate_limit_report(folded, limit, window)
