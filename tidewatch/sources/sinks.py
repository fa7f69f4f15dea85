"""Sinks: canonical events once each, and refused rows with their reason.

A canonical table is a folder of commits. Each commit has a folder of data files, an index of the ids in
them, and one row in the manifest; the manifest is written last, as one file that appears whole or not at
all, so what a killed write leaves behind is read by nobody. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.delivery import dedup_events
from tidewatch.plans.keys import join_on

ID = ("server_id", "event_id")
MANIFEST = "commit STRING, folder STRING, replaces ARRAY<STRING>, committed_at TIMESTAMP"
INDEX = "fingerprint BIGINT, file STRING"
#: Up to so many ids of a batch are handed to Parquet as values, which skips pages of the index by their
#: statistics and Bloom filters; more ids are joined with it.
LOOKED_UP = 1000


def _present(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table at the path; None only if nothing is there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _manifest(spark: SparkSession, path: str) -> tuple[set[str], dict[str, str]]:
    """All commits ever made, and the folders of those that are live, oldest first."""
    table = _present(spark, f"{path}/commits", MANIFEST)
    rows = [] if table is None else sorted(table.collect(), key=lambda row: row.committed_at)
    gone = {name for row in rows for name in row.replaces}
    return {row.commit for row in rows}, {row.commit: row.folder for row in rows if row.commit not in gone}


def _fingerprint():
    return F.xxhash64(*ID)


def read_canonical(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The events of all live commits; None before the first."""
    _, live = _manifest(spark, path)
    if not live:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*[f"{path}/data/{folder}" for folder in live.values()])


def may_hold(ids: DataFrame, path: str) -> list[str]:
    """Data files, as folder/name, whose index has the fingerprint of one of the ids (server_id, event_id)."""
    spark = ids.sparkSession
    _, live = _manifest(spark, path)
    if not live:
        return []
    index = spark.read.schema(INDEX).parquet(*[f"{path}/ids/{commit}" for commit in live])
    wanted = ids.filter(F.col("event_id").isNotNull()).select(_fingerprint().alias("fingerprint"))
    # Not made distinct: a batch has few copies by now, and the join below has no use for it.
    few = [row[0] for row in wanted.limit(LOOKED_UP + 1).collect()]
    if len(few) <= LOOKED_UP:
        hits = index.filter(F.col("fingerprint").isin(few))
    else:
        hits = index.join(wanted, "fingerprint", "left_semi")
    return sorted(row.file for row in hits.select("file").distinct().collect())


def _commit(spark: SparkSession, path: str, commit: str, folder: str, replaces: list[str]) -> None:
    """Index the data of a commit, then make both visible."""
    data = spark.read.parquet(f"{path}/data/{folder}")
    ids = data.filter(F.col("event_id").isNotNull()).select(
        _fingerprint().alias("fingerprint"), F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name")).alias("file"))
    # Sorted by fingerprint as a whole: few pages of few files hold a given one.
    files = max(1, len(data.inputFiles()) // 8)
    (ids.repartitionByRange(files, "fingerprint").sortWithinPartitions("fingerprint")
     .write.mode("overwrite").option("parquet.bloom.filter.enabled#fingerprint", "true").parquet(f"{path}/ids/{commit}"))
    row = spark.range(1).select(F.lit(commit).alias("commit"), F.lit(folder).alias("folder"),
                                F.array(*map(F.lit, replaces)).cast("array<string>").alias("replaces"),
                                F.current_timestamp().alias("committed_at"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def write_canonical(events: DataFrame, path: str, mode: str = "append", commit: str | None = None) -> None:
    """Add events to the table at `path`, once per (server_id, event_id) whenever either copy arrives.

    The batch is written once, without its own copies. The index then names the data files that may hold
    one of its ids; of those alone the ids are read and compared, and only if some are stored already is
    the batch written again without them. A `commit` name that was committed before is done and skipped.
    Events without an id are no copies and are all kept. `overwrite` replaces all earlier commits.
    Within a file rows go by category and time, so filters on these skip row groups.
    """
    spark = events.sparkSession
    ever, live = _manifest(spark, path)
    commit = commit or uuid.uuid4().hex
    if commit in ever:
        return
    order = [c for c in ("category", "received_at") if c in events.columns]
    folder = commit

    def put(rows: DataFrame) -> None:
        rows.sortWithinPartitions(*order).write.mode("overwrite").parquet(f"{path}/data/{folder}")

    put(dedup_events(events))
    hits = []
    if mode == "append":
        batch = spark.read.schema(events.schema).parquet(f"{path}/data/{folder}")
        hits = may_hold(batch.select(*ID), path)
    if hits:
        held = spark.read.schema(events.schema).parquet(*[f"{path}/data/{file}" for file in hits]).select(*ID)
        named = F.col("event_id").isNotNull()
        folder = f"{commit}-once"
        put(join_on(batch.filter(named), held, ID, "left_anti").unionByName(batch.filter(~named)))
    _commit(spark, path, commit, folder, list(live) if mode == "overwrite" else [])


def compact(spark: SparkSession, path: str, files: int) -> None:
    """Put all live commits into one of about `files` data files; readers see either the old ones or the new."""
    _, live = _manifest(spark, path)
    if len(live) < 2:
        return
    commit = uuid.uuid4().hex
    events = read_canonical(spark, path)
    order = [c for c in ("category", "received_at") if c in events.columns]
    events.repartitionByRange(files, *(order or ["event_id"])).sortWithinPartitions(*order).write.parquet(f"{path}/data/{commit}")
    _commit(spark, path, commit, commit, list(live))


def stream_canonical(events: DataFrame, path: str, checkpoint: str, watermark: str = "1 minute"):
    """Streaming form: duplicates within the watermark go in state, later replays by the table.

    A batch that is run again after a failure has the same commit name, so it is stored once, events
    without an id included. These pass the watermark's duplicates as they are.
    """
    timed = events.withWatermark("received_at", watermark)
    # Rows without an id get a key of their own place; they are told apart by all they hold.
    alike = F.when(F.col("event_id").isNull(), F.sha2(F.to_json(F.struct(*[F.col(c) for c in events.columns])), 256))
    unique = timed.withColumn("_own", alike).dropDuplicatesWithinWatermark([*ID, "_own"]).drop("_own")
    name = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex
    return (
        unique.writeStream.foreachBatch(lambda batch, number: write_canonical(batch, path, commit=f"{name}-{number}"))
        .option("checkpointLocation", checkpoint)
    )


def write_quarantine(rows: DataFrame, path: str, reason: str = "reason") -> None:
    """Write accepted and refused rows in one pass, into one table with a folder for each reason."""
    marked = rows.withColumn("refused_for", F.coalesce(F.col(reason), F.lit(ACCEPTED)))
    marked.write.mode("append").partitionBy("refused_for").parquet(path)


ACCEPTED = "accepted"


def accepted(spark: SparkSession, path: str, reason: str = "reason") -> DataFrame:
    """Rows without a reason; the folders of the others are not opened."""
    return spark.read.parquet(path).filter(F.col("refused_for") == ACCEPTED).drop("refused_for", reason)


def refused(spark: SparkSession, path: str) -> DataFrame:
    """Rows with their reason."""
    return spark.read.parquet(path).filter(F.col("refused_for") != ACCEPTED).drop("refused_for")
