"""As-of join: each probe meets the latest states of its key, in one sort and no range join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.plans.ordered import HOT_ROWS, arrange


@dataclass(frozen=True)
class State:
    """Rows that set `name` to the struct `value` from `at` on, for one key."""

    df: DataFrame
    keys: Sequence[str]
    at: str
    value: Column
    name: str
    seq: str | None = None


def spread_nulls(key: Column, seq: Column, marker: str = "none:") -> Column:
    """The key as text; NULL keys match nothing and are spread instead of meeting in one group."""
    stray = F.concat(F.lit(marker), F.pmod(F.xxhash64(seq), F.lit(65536)).cast("string"))
    return F.coalesce(F.concat(F.lit("key:"), key.cast("string")), stray)


def as_of(probes: DataFrame, keys: Sequence[str], at: str, seq: str, states: Sequence[State],
          hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Probes with, per state, the value of its last row of the same key at or before the probe.

    Both sides are stacked, sorted by (key, time, side, seq), and the last values carried forward;
    a state and a probe at the same instant meet. A reset is a state row whose struct is set but
    whose fields are NULL.
    """
    columns = probes.columns
    tags = [f"_k{i}" for i in range(len(keys))]
    stacked = probes.select(
        *[spread_nulls(F.col(key), F.col(seq)).alias(tag) for key, tag in zip(keys, tags)],
        F.col(at).cast("timestamp").alias("_at"),
        F.lit(1).alias("_side"),
        F.col(seq).cast("bigint").alias("_seq"),
        F.struct(*columns).alias("_probe"),
    )
    for state in states:
        known = state.df.dropna(subset=list(state.keys))
        stacked = stacked.unionByName(
            known.select(
                *[F.concat(F.lit("key:"), F.col(key).cast("string")).alias(tag)
                  for key, tag in zip(state.keys, tags)],
                F.col(state.at).cast("timestamp").alias("_at"),
                F.lit(0).alias("_side"),
                (F.col(state.seq) if state.seq else F.lit(0)).cast("bigint").alias("_seq"),
                state.value.alias(f"_of_{state.name}"),
            ),
            allowMissingColumns=True,
        )
    rows = arrange(stacked, tags, ["_at", "_side", "_seq"], hot_rows)
    for state in states:
        rows = rows.last_known(F.col(f"_of_{state.name}"), f"_is_{state.name}")
    return rows.df.filter(F.col("_side") == 1).select(
        "_probe.*", *[F.col(f"_is_{state.name}").alias(state.name) for state in states]
    )
