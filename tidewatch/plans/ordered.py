"""Ordered scans over keyed rows that hold up when one key has a third of all rows.

Window functions put each key in one task. That is right for ordinary keys and wrong for a hot
one, so `arrange` finds the hot keys first (a count with map-side combine), range-partitions only
their rows on (key, order) and cuts each sorted range into slices. Windows then run per (key, slice), and
what crosses a slice border is carried over by a small table with one row per key and slice. Ranges are
tasks, so there are no more of them than the cluster and the rows ask for, however short the slices are.
Without hot keys nothing of this is in the plan: one slice, plain windows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from tidewatch.plans.keys import join_on
from tidewatch.session import ensure_checkpoint_dir

SLICE = "_slice"
HOT_ROWS = 5_000_000
# Input under this many bytes per hot row needs no count: all of it fits one task.
SMALL_ROW_BYTES = 16
# Rows of a range, sorted by one task, once every core has some.
RANGE_ROWS = 2_500_000
# A row's number by `monotonically_increasing_id`: the partition above this bit, the place in it below.
PLACE_BITS = 33


@dataclass(frozen=True)
class Ordered:
    """Rows with a slice column; within (keys, slice) they are to be read in `order`."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    sliced: bool

    def replace(self, df: DataFrame) -> Ordered:
        return Ordered(df, self.keys, self.order, self.sliced)

    def with_column(self, name: str, value: Column) -> Ordered:
        return self.replace(self.df.withColumn(name, value))

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, SLICE).orderBy(*self.order)

    @property
    def _upto(self) -> WindowSpec:
        return self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def previous(self, value: Column, name: str) -> Ordered:
        """`value` of the row before."""
        local = self.df.withColumn(name, F.lag(value).over(self.window))
        if not self.sliced:
            return self.replace(local)
        last = F.max_by(F.struct(value.alias("v")), F.struct(*self.order))
        return self._patched_edge(name, local, last, F.lag, descending=False)

    def following(self, value: Column, name: str) -> Ordered:
        """`value` of the row after."""
        local = self.df.withColumn(name, F.lead(value).over(self.window))
        if not self.sliced:
            return self.replace(local)
        first = F.min_by(F.struct(value.alias("v")), F.struct(*self.order))
        return self._patched_edge(name, local, first, F.lead, descending=True)

    def last_known(self, value: Column, name: str) -> Ordered:
        """The latest non-NULL `value` up to and including this row."""
        local = self.df.withColumn(name, F.last(value, ignorenulls=True).over(self._upto))
        if not self.sliced:
            return self.replace(local)
        latest = F.max_by(
            F.when(value.isNotNull(), value), F.when(value.isNotNull(), F.struct(*self.order))
        )
        earlier = Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = self._summary(latest.alias("v")).withColumn(
            "_carried", F.last("v", ignorenulls=True).over(earlier)
        )
        joined = self._with_carried(local, carried)
        return self.replace(
            joined.withColumn(name, F.coalesce(name, "_carried")).drop("_carried")
        )

    def running_sum(self, value: Column, name: str) -> Ordered:
        """Sum of `value` up to and including this row."""
        local = self.df.withColumn(name, F.sum(value).over(self._upto))
        if not self.sliced:
            return self.replace(local)
        earlier = Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(
            Window.unboundedPreceding, -1
        )
        carried = self._summary(F.sum(value).alias("v")).withColumn(
            "_carried", F.sum("v").over(earlier)
        )
        joined = self._with_carried(local, carried)
        total = F.when(F.col("_carried").isNull(), F.col(name)).otherwise(
            F.col("_carried") + F.coalesce(F.col(name), F.lit(0))
        )
        return self.replace(joined.withColumn(name, total).drop("_carried"))

    def _summary(self, value: Column) -> DataFrame:
        """One row per hot key and slice, a small part of the rows."""
        return self.df.filter(F.col(SLICE) > 0).groupBy(*self.keys, SLICE).agg(value)

    def _with_carried(self, local: DataFrame, carried: DataFrame) -> DataFrame:
        # No hint: Spark broadcasts it if it proves small, and splits a skewed join if not.
        return join_on(local, carried.drop("v"), [*self.keys, SLICE], "left")

    def _patched_edge(self, name, local, edge, shift, descending) -> Ordered:
        across = Window.partitionBy(*self.keys).orderBy(SLICE)
        carried = self._summary(edge.alias("v")).withColumn("_carried", shift("v").over(across))
        order = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        at_edge = F.row_number().over(Window.partitionBy(*self.keys, SLICE).orderBy(*order)) == 1
        joined = self._with_carried(local.withColumn("_edge", at_edge), carried)
        patched = F.when(
            F.col("_edge") & F.col("_carried").isNotNull(), F.col("_carried")["v"]
        ).otherwise(F.col(name))
        return self.replace(joined.withColumn(name, patched).drop("_edge", "_carried"))


def written(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder: a lost executor then costs no second computation."""
    folder = f"{ensure_checkpoint_dir(df.sparkSession)}/ordered-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _surely_small(df: DataFrame, hot_rows: int) -> bool:
    """Whether Spark's own size estimate leaves no room for a key that one task could not hold.

    The estimate errs upward for joins. It only decides if keys are counted, never a result.
    """
    try:
        estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:  # no classic session behind the frame
        return False
    return int(str(estimate)) < hot_rows * SMALL_ROW_BYTES


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `hot_rows` rows and how many: one row in `hot_rows` at most."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.filter(F.col("_rows") > hot_rows)


def _ranges(spark: SparkSession, rows: int, slices: int) -> int:
    """Tasks that sort the hot rows: enough for the cluster and for the rows, and no more than slices."""
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return min(slices, max(tasks, -(-rows // RANGE_ROWS)))


def arrange(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            hot_rows: int | None = HOT_ROWS, counted: DataFrame | None = None) -> Ordered:
    """Prepare `df` for ordered scans by `keys`; order columns must not be NULL, keys may be.

    `hot_rows=None` promises that no key is hot and saves the count. `counted` is a frame that is
    cheaper than `df` and has nearly the same keys; a hot key it misses costs time, not rows.
    """
    keys, order = tuple(keys), tuple(order)
    total = 0
    if hot_rows is not None and not _surely_small(df, hot_rows):
        found = written(hot_keys(df if counted is None else counted, keys, hot_rows))
        total = found.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    if not total:
        return Ordered(df.withColumn(SLICE, F.lit(0)), keys, order, False)

    names = found.select(*keys)
    slices = max(2, -(-2 * total // hot_rows))
    # The slice is part of the data from here on: both passes over it must see the same borders,
    # also after an executor is lost, so the sorted ranges are written to the shared folder once.
    ranged = written(
        join_on(df, names, keys, "left_semi")
        .repartitionByRange(_ranges(df.sparkSession, total, slices), *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(SLICE, F.monotonically_increasing_id())
    )
    place = F.col(SLICE).bitwiseAND((1 << PLACE_BITS) - 1)
    cut = F.floor(place / max(1, -(-total // slices)))
    # Numbered alike in every range, so that they ascend; a range shorter than the longest leaves a gap.
    most = ranged.agg(F.max(cut)).first()[0] + 1
    hot = ranged.withColumn(SLICE, (F.shiftright(SLICE, PLACE_BITS) * most + cut + 1).cast("int"))
    cold = join_on(df, names, keys, "left_anti").withColumn(SLICE, F.lit(0))
    return Ordered(reduce(DataFrame.unionByName, [cold, hot]), keys, order, True)
