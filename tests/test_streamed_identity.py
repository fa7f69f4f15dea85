"""Sessions and characters joined to streams equal the batch as-of on the same rows."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewatch.catalog.streams import drain
from tidewatch.operators import identity
from tidewatch.streaming import attach_identity_stream

START = datetime(2024, 1, 1)
EVENTS = "server_id string, source int, received_at timestamp, arrival_seq long, action string"
CONNECTIONS = "server_id string, source int, event string, received_at timestamp, arrival_seq long, name string, identifiers array<string>"
CHARACTERS = "server_id string, source int, valid_from timestamp, seq long, identifier string, name string, job string, `group` string"


def at(seconds):
    return START + timedelta(seconds=seconds)


def tables(seed=2):
    rnd = random.Random(seed)
    who = lambda: ("s%d" % rnd.randrange(2), rnd.randrange(1, 4))
    connections = [(*who(), rnd.choice(["joining", "joining", "dropped"]), at(rnd.randrange(600)), i, f"n{i}", [f"license:{i}"]) for i in range(60)]
    characters = [(*who(), at(rnd.randrange(600)), i, f"char{i}" if i % 4 else None, f"c{i}", "job", "user") for i in range(60)]
    events = [(*who(), at(rnd.randrange(600)), i, "a") for i in range(200)]
    events += [("s0", None, at(5), 900, "a"), (None, 1, at(5), 901, "a"), ("s0", 1, None, 902, "a"), ("s9", 9, at(7), 903, "a")]
    closing = [(s, n, t, 1000 + i, "disconnect") for i, (s, n, e, t, _, _, _) in enumerate(connections) if e == "dropped"]
    end = [("s7", 7, at(5000), 9999, "end")]
    return events + closing + end, connections + [("s7", 7, "joining", at(5000), 999, "z", [])], characters + [("s7", 7, at(5000), 999, "z", "z", "z", "z")]


def streamed(spark, folder, rows, schema, when):
    """Four files of about consecutive times, each out of order and reaching 20 seconds into the next."""
    place = lambda r: (r[when] or START) + timedelta(seconds=random.Random(str(r)).randrange(20))
    rows = sorted(rows, key=place)
    step = -(-len(rows) // 4)
    for i in range(4):
        part = f"{folder}/part{i}"
        spark.createDataFrame(rows[i * step:(i + 1) * step], schema).coalesce(1).write.parquet(part)
        for name in os.listdir(part):
            if name.endswith(".parquet"):
                os.rename(f"{part}/{name}", f"{folder}/{i}.parquet")
                os.utime(f"{folder}/{i}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")


def test_stream_equals_batch(spark, tmp_path):
    """Rows are up to 20 seconds out of order; the watermark passes files while later ones are read."""
    events, connections, characters = tables()
    streams = []
    for name, rows, schema, when in (("e", events, EVENTS, 2), ("c", connections, CONNECTIONS, 3), ("h", characters, CHARACTERS, 2)):
        (tmp_path / name).mkdir()
        streams.append(streamed(spark, str(tmp_path / name), rows, schema, when))
    closes = F.col("action") == "disconnect"
    got = drain(attach_identity_stream(*streams, closing=closes, delay="1 minute"))
    sessions = identity.session_intervals(spark.createDataFrame(connections, CONNECTIONS))
    batch = spark.createDataFrame(events, EVENTS)
    batch = identity.attach_session(batch, sessions, closing=closes)
    batch = identity.attach_character(batch, spark.createDataFrame(characters, CHARACTERS))
    shown = ["server_id", "source", "received_at", "arrival_seq", "session.name", "session.identifiers", "session.joined_at",
             "character.identifier", "character.job"]
    want = batch.filter("action <> 'end'").select(*shown)
    # Late by more than the watermark is nothing here, and the last event still waits.
    assert sorted(map(str, got.select(*shown).collect())) == sorted(map(str, want.collect()))
    assert got.filter("session IS NOT NULL").count() > 30 and got.filter("character IS NOT NULL").count() > 30
