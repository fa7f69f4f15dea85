"""Spool snapshots: what servers had not delivered when they stopped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import fixed
from tidewatch.functions.text import let, lua_number
from tidewatch.sources import spools

FILE = "data STRING, sha256 STRING"
#: `data` is one JSON string and may fill the largest spool; by default Spark reads strings of 20,000,000 characters.
FILE_OPTIONS = {"maxStringLen": str(2**31 - 1)}
_EVENTS = "array<struct<part:string,payload:string,bytes:string>>"


def _whole(value: Column, least: int) -> Column:
    """A JSON number without fraction, from `least` to 2^53-1."""
    number = F.when(value.rlike("^[-0-9]"), lua_number(value))
    return F.coalesce(
        (number >= least) & (number <= fixed.MAX_EXACT_INTEGER) & (number == F.floor(number)),
        F.lit(False),
    )


def _members(value: Column) -> Column:
    """Members of an object variant; NULL if it is none."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def _elements(value: Column, path: str = "$") -> Column:
    """Elements of an array variant; NULL if it is none."""
    return F.try_variant_get(value, path, "array<variant>")


def _text(members: Column, name: str) -> Column:
    """JSON text of a member; NULL if it is absent or JSON null."""
    value = F.element_at(members, name)
    return F.when(~F.is_variant_null(value), F.to_json(value))


def _event(part: str, payload: Column, size: Column) -> Column:
    return F.struct(F.lit(part).alias("part"), payload.alias("payload"), size.alias("bytes"))


def _queued(value: Column) -> Column:
    """Queued items as events, whose payload and bytes are JSON text."""
    return F.transform(_elements(value), lambda item: _event("queued", *[
        F.to_json(F.try_variant_get(item, f"$.{name}", "variant")) for name in ("payload", "bytes")]))


def _flown(body: Column) -> Column:
    """Events in the body of a flight; NULL if it is not the text of an object that holds them."""
    return F.transform(
        _elements(F.try_parse_json(F.when(F.schema_of_variant(body) == "STRING", F.try_variant_get(body, "$", "string"))),
                  "$.events"),
        lambda event: _event("flight", F.to_json(event), F.lit(None).cast("string")))


def parse_snapshots(files: DataFrame, content: str = "value") -> DataFrame:
    """Add `reason` (NULL when the snapshot may be replayed) and its events, in the flight and queued.

    `files` has one row per file with its whole content, whose data is parsed once into a variant. The result is
    generated from an array of one: a filter on a projected reason would be pushed below the projection and parse anew.
    """
    parsed = let(F.from_json(F.col(content), FILE, FILE_OPTIONS), lambda entry: let(
        F.try_parse_json(entry["data"]), lambda data: let(
            _members(data), lambda top: let(
                _members(F.element_at(top, "flight")), lambda flight: let(
                    _queued(F.element_at(top, "queued")), lambda items: let(
                        _flown(F.element_at(flight, "body")), lambda events: F.struct(
                            _reason(entry, data, top, items, flight, events).alias("reason"),
                            items.alias("items"), events.alias("flight_events"),
                        )))))))
    rows = files.select("*", F.explode(F.array(parsed)).alias("_snapshot"))
    return rows.select(
        *files.columns, F.col("_snapshot.reason").alias("reason"),
        F.col("_snapshot.items").alias("_items"), F.col("_snapshot.flight_events").alias("_flight_events"),
    )


def _reason(entry: Column, data: Column, top: Column, items: Column, flight: Column, events: Column) -> Column:
    """Why a snapshot may not be replayed; NULL when it may."""
    # Lambdas are interpreted: nearly every size is told by one pattern.
    item_ok = F.forall(items, lambda item: F.coalesce(
        (item["payload"].startswith("{") | item["payload"].startswith("["))
        & (item["bytes"].rlike(r"^[1-9][0-9]{0,14}\z") | _whole(item["bytes"], 1)), F.lit(False)))
    dropped = F.coalesce(_text(top, "dropped"), F.lit("0"))
    count = _text(flight, "count")
    flight_ok = F.coalesce(_whole(count, 1) & (F.size(events) == lua_number(count)), F.lit(False))
    queue_ok = items.isNotNull() | (_text(top, "queued") == "{}")
    flying = F.element_at(top, "flight")
    return (
        F.when(entry["data"].isNull() | entry["sha256"].isNull(), "unreadable")
        .when(F.sha2(entry["data"], 256) != entry["sha256"], "checksum")
        .when(top.isNull() & _elements(data).isNull(), "not_json")
        .when(~F.coalesce(_text(top, "v") == "1", F.lit(False)), "version")
        .when(~F.coalesce(queue_ok, F.lit(False)), "queue")
        .when(~F.coalesce(item_ok, F.lit(True)), "item")
        .when(~_whole(dropped, 0), "dropped")
        .when(flying.isNotNull() & ~F.is_variant_null(flying) & ~flight_ok, "flight")
    )


def _replay() -> Column:
    """Events of a parsed file in replay order: the flight first, then the queue."""
    none = F.array().cast(_EVENTS)
    return F.concat(F.coalesce("_flight_events", none), F.coalesce("_items", none))


def _event_columns() -> list[Column]:
    """The columns of one event `_event`, made here in compiled code. Numbers are texts without an ending `.0`, which
    those with an exponent have until their text is parsed again.
    """
    payload = F.col("_event.payload")
    plain = F.when(payload.contains(".0"), F.to_json(F.try_parse_json(payload))).otherwise(payload)
    return [F.col("_event.part"), plain.alias("payload"),
            lua_number(F.col("_event.bytes")).cast("bigint").alias("event_bytes")]


def recovered_events(parsed: DataFrame, name: str = "path") -> DataFrame:
    """Events of valid snapshots in replay order: the flight first, then the queue."""
    good = parsed.filter(F.col("reason").isNull())
    return good.select(name, F.posexplode(_replay()).alias("position", "_event")).select(
        name, "position", *_event_columns(), F.lit(True).alias("recovered"))


def snapshot_rows(files: DataFrame) -> DataFrame:
    """Rows of the `spool` format, a table or a stream, as (path, reason, position, part, payload, event_bytes,
    recovered, content): the events of good files in replay order, and each bad file whole, with its reason.
    """
    parsed = parse_snapshots(files, "content").withColumnRenamed("reason", "_rule")
    # What the reader found comes first; a file it could not take whole has no content to judge.
    parsed = parsed.withColumn("reason", F.coalesce("found", "_rule"))
    good = F.col("reason").isNull()
    bad = F.array(F.lit(None)).cast(_EVENTS)
    # A good file's content is dropped before its events would each carry it.
    rows = parsed.withColumn("content", F.when(~good, F.col("content"))).select("path", "reason", "content", "first", F.posexplode(
        F.when(good, _replay()).otherwise(bad)).alias("position", "_event"))
    return rows.select(
        "path", "reason", F.when(good, F.col("first") + F.col("position")).alias("position"), *_event_columns(),
        good.alias("recovered"), "content")


def read_snapshots(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(events to replay, quarantined files with their reason). A bad file is kept whole, one of more than
    MAX_SPOOL_BYTES where it is, without content here."""
    rows = snapshot_rows(_files(spark.read, spark, path))
    events = rows.filter("recovered").drop("reason", "content")
    return events, rows.filter("NOT recovered").select("path", "reason", "content")


def read_snapshots_stream(spark: SparkSession, path: str, settle_seconds: float = 1) -> DataFrame:
    """Files as they appear, or are written again, in the columns of `snapshot_rows`."""
    reader = spark.readStream.option("settleSeconds", settle_seconds)
    return snapshot_rows(_files(reader, spark, path))


def _files(reader, spark: SparkSession, path: str) -> DataFrame:
    spools.register(spark)
    reader = reader.option("tasks", spark.sparkContext.defaultParallelism)
    return reader.format(spools.FORMAT).load(path).withColumnRenamed("reason", "found")
