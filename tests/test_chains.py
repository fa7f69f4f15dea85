"""Greedy chains of hot keys whose slices are shorter than one step of the chain."""

import random

import pytest
from pyspark.sql import functions as F

from tidewatch.plans import chains
from tidewatch.plans.ordered import SLICE, arrange


def walked(rows, step, room):
    """rows: (t, size) in order; the meter of the row that opened each row's group, and whether it is that row."""
    out, opened, filled = [], None, 0
    for t, size in rows:
        fits = opened is not None and t < opened + step and (room is None or filled + size <= room)
        if not fits:
            opened, filled = t, 0
        filled += size
        out.append((opened, not fits))
    return out


@pytest.mark.parametrize("room", [None, 350])
def test_slices_shorter_than_a_step(spark, monkeypatch, room):
    """One key has 240 rows in about 20 slices, a step spans 50 of them; another key is small, one is NULL."""
    monkeypatch.setattr("tidewatch.plans.ordered._surely_small", lambda *_: False)
    rnd = random.Random(5)
    rows = {}
    for key, n in (("hot", 240), ("cold", 25), (None, 40)):
        t = 0
        rows[key] = []
        for _ in range(n):
            t += rnd.randrange(1, 4) if room else rnd.randrange(0, 3)
            rows[key].append((t, rnd.randrange(1, 20)))
    data = [(key, t, i, size) for key, own in rows.items() for i, (t, size) in enumerate(own)]
    df = spark.createDataFrame(data, "k string, t long, i long, size long").repartition(3)
    arranged = arrange(df, ["k"], ["t", "i"], hot_rows=30)
    assert arranged.sliced
    seen = []
    compose = chains._composed
    monkeypatch.setattr(chains, "_composed", lambda *args: seen.append(1) or compose(*args))
    extra = {}
    if room:
        arranged = arranged.running_sum(arranged.df["size"], "filled")
        extra = {"filled": "filled", "size": "size", "room": room}
    got = chains.mark_chain(arranged.df, ["k"], ["t", "i"], meter="t", step=100, sliced=True, hot_rows=30, **extra)
    found = {(r.k, r.i): (r[chains.START], r[chains.OPENS]) for r in got.collect()}
    want = {(key, i): mark for key, own in rows.items() for i, mark in enumerate(walked(own, 100, room))}
    assert found == want and len(seen) > 1
    # Followed at once, without composing, as for slices longer than a step.
    plain = chains.mark_chain(arranged.df, ["k"], ["t", "i"], meter="t", step=100, sliced=True, hot_rows=10**6, **extra)
    assert {(r.k, r.i): (r[chains.START], r[chains.OPENS]) for r in plain.collect()} == want


def test_no_group_holds_more_rows_than_a_slice(spark, monkeypatch):
    """Composed functions stay as narrow as one step of the chain, and the last ones are followed in bounds."""
    monkeypatch.setattr("tidewatch.plans.ordered._surely_small", lambda *_: False)
    df = spark.range(500).selectExpr("'k' AS k", "id AS t")
    rows = arrange(df, ["k"], ["t"], hot_rows=60)
    sizes = []
    keep = chains.written
    monkeypatch.setattr(chains, "written", lambda frame: sizes.append(keep(frame)) or sizes[-1])
    chains.mark_chain(rows.df, ["k"], ["t"], meter="t", step=25, sliced=True, hot_rows=60).count()
    levels = [frame for frame in sizes if "_low" in frame.columns]
    assert max(frame.groupBy("_span").count().agg({"count": "max"}).first()[0] for frame in levels) <= 60
    assert levels[-1].count() <= 60


def test_short_slices_ask_for_no_more_tasks_than_the_cluster_has(spark, monkeypatch):
    monkeypatch.setattr("tidewatch.plans.ordered._surely_small", lambda *_: False)
    rows = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE 'k' || id % 3 END AS k", "id DIV 2 AS t", "id AS seq")
    placed = arrange(rows, ["k"], ["t", "seq"], hot_rows=10)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    files = [name for name in placed.df.filter(f"{SLICE} > 0").inputFiles() if "/ordered-" in name]
    by_folder = {}
    for name in files:
        by_folder.setdefault(name.rsplit("/", 1)[0], []).append(name)
    assert max(map(len, by_folder.values())) <= tasks
    slices = placed.df.groupBy("k", SLICE).agg(F.count("seq").alias("n"), F.min("seq").alias("low"), F.max("seq").alias("high")).collect()
    assert max(row.n for row in slices) <= 10 and sum(row.n for row in slices) == 6000 and len(slices) >= 600
    for key in {row.k for row in slices}:
        own = sorted((row[SLICE], row.low, row.high) for row in slices if row.k == key)
        assert all(a[2] < b[1] for a, b in zip(own, own[1:]))
    counted = placed.running_sum(F.lit(1), "n").df.groupBy("k").agg(F.max("n").alias("n"))
    assert sorted(row.n for row in counted.collect()) == [2000, 2000, 2000]
