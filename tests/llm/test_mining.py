"""Collocations, periodic runs and the Jaccard join against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import catalog, collocations, periods, regions

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], SCHEMA).repartition(parts)


def clashing(df):
    """Columns with names the operators use inside."""
    names = ("id", "words", "word", "h", "a", "n", "l", "r", "score", "cell", "key", "grams", "label", "home", "runs", "mark", "k", "t")
    return df.select("*", *[F.lit("x").alias(name) for name in names])


# ---- collocations ----

def prose(seed, rows=80):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["The", "the", "of", "and"]) if rnd.random() < 0.4 else f"w{int(rnd.paretovariate(1.2))}"
    out = []
    for i in range(rows):
        text = ""
        for _ in range(rnd.randrange(60)):
            text += rnd.choice(["New York City hall", "in spite of", "ab cd ef gh ij kl", word(), word(), word(), "é"])
            text += rnd.choice([" ", " ", " ", "\t", ", ", ".\n", "\x0b", "  ", ":"])
        out.append((i, text, rnd.choice(["en", "en", "fr", None, "und"])))
    return out + [(900, None, "en"), (901, "", "en"), (902, None, None), (903, "...", "xx"), out[3], (None, out[4][1], "en")]


@pytest.mark.parametrize("seed,top,least,step", [(1, 2000, 3, 16), (2, 6, 3, 3)])
def test_collocations(spark, monkeypatch, seed, top, least, step):
    """Also where the frontier is opened in many steps and settles before all words are."""
    monkeypatch.setattr(collocations, "STEP", step)
    monkeypatch.setattr(collocations, "CHUNK", 300)
    rows = prose(seed)
    got = collocations.collocations(clashing(frame(spark, rows)), top=top, least=least)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain.phrases([(lang, t) for _, t, lang in rows], top, least))


def test_a_settled_language_is_not_opened_further(spark, monkeypatch):
    """Rare words score far above what phrases of the frequent ones can reach."""
    monkeypatch.setattr(collocations, "STEP", 2)
    opened, keep = [], collocations._opened
    monkeypatch.setattr(collocations, "_opened", lambda coded, band, *rest: opened.append(band.count()) or keep(coded, band, *rest))
    rows = [(i, " ".join(["a b"] * 200) + f". x{i % 5} y{i % 5}.", "en") for i in range(20)]
    got = collocations.collocations(frame(spark, rows), top=3, least=4)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain.phrases([(lang, t) for _, t, lang in rows], 3, 4))
    assert len(opened) == 1 and opened[0] == 10


def test_words_decide_where_hashes_collide():
    codes = np.array([5, 6, 0, 7, 8, 0, 5, 6, 0], np.uint64)
    at, starts = collocations._groups(codes, np.array([0, 3, 6]), np.array([1, 1, 1], np.uint64), 2)
    assert sorted(np.diff(np.append(starts, 3)).tolist()) == [1, 2]


def test_no_collocations(spark):
    got = collocations.collocations(frame(spark, [], 1))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0
    assert collocations.collocations(frame(spark, [(1, "a b a b", "en")], 1)).count() == 0


# ---- periodic runs ----

def periodic(seed):
    rnd = random.Random(seed)
    out = []
    for i in range(150):
        own = [str(rnd.randrange(rnd.choice([1, 2, 3, 9]))) for _ in range(rnd.randrange(70))]
        if rnd.random() < 0.4 and len(own) > 4:
            a = rnd.randrange(len(own))
            p = 1 + (len(own) - a) // rnd.randrange(2, 9)
            own = [own[k] if k < a else own[a + (k - a) % p] for k in range(len(own))]
        out.append((i, rnd.choice([" ", "\n", "\t "]).join(own), "en"))
    long = " ".join(f"w{k * k % 977}" for k in range(4000)) + " again and" * 3000
    return out + [(900, None, "en"), (901, "", "en"), (902, " \n", "en"), (903, long, "en"), out[2], out[2], (None, "a a a a a a a", "en")]


@pytest.mark.parametrize("bound", [1 << 19, 100])
def test_runs(spark, monkeypatch, bound):
    monkeypatch.setattr(periods, "WORDS", bound)
    monkeypatch.setattr(periods, "CHECKS", 500)
    rows = [(i, t, lang) for i, t, lang in periodic(4) if i != 903]
    got = periods.periodic_runs(clashing(frame(spark, rows)).drop("id"))
    found = sorted(((r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=repr)
    want = []
    for i, t, _ in rows:
        own = plain.words(t)
        runs = plain.runs(own)
        want.append((i, len(own), runs, plain.collapsed(own, runs)))
    assert found == sorted(want, key=repr)


def test_a_long_periodic_text(spark):
    row = periods.periodic_runs(frame(spark, [r for r in periodic(4) if r[0] == 903], 1)).first()
    assert row.n_words == 10_000 and (4000, 6000, 2) in [tuple(r) for r in row.runs]
    assert row.collapsed.endswith(" again and") and not row.collapsed.endswith("and again and")


def test_run_query(spark):
    """With the repeats that the query plants by a checksum of the id."""
    rows = [(i, " ".join(f"v{(i * k) % 31}" for k in range(i % 90)), "en") for i in range(300)] + [(None, "a a a a a a", "en"), (5000, None, "en")]
    got = {r.doc_id: r for r in periods.run_digest(frame(spark, rows)).collect()}
    for i, t, _ in rows:
        own = plain.words(t)
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and own:
            a = h // 10 % len(own)
            p = 1 + (len(own) - a) // (3 + h // 10 % 8)
            own = [own[k] if k < a else own[a + (k - a) % p] for k in range(len(own))]
        runs = plain.runs(own)
        start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert tuple(got[i]) == (
            i, len(runs), start, length, period, None if start is None else 1000 * length // period,
            hashlib.sha256(text.encode()).hexdigest(), plain.sha(plain.collapsed(own, runs)))
    assert sum(bool(r.n_runs) for r in got.values()) > 20
    assert periods.run_digest(frame(spark, [], 1)).count() == 0


# ---- Jaccard join ----

def near_copies(seed, rows=260):
    """Groups of near copies at all distances, one of them large; texts of all sizes; shared passages."""
    rnd = random.Random(seed)
    fresh = lambda n: [f"w{rnd.randrange(300)}" for _ in range(n)]
    bases = [fresh(rnd.choice([3, 5, 11, 12, 40, 150])) for _ in range(12)]
    passage, out = fresh(30), []
    for i in range(rows):
        own = list(bases[0] if rnd.random() < 0.4 else rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            own[rnd.randrange(len(own))] = rnd.choice(["x", "y", f"w{rnd.randrange(99)}"])
        if rnd.random() < 0.15:
            own = fresh(rnd.randrange(40)) + passage + fresh(rnd.randrange(40))
        out.append((i, rnd.choice([" ", "\n"]).join(own), "en"))
    bases[0] = fresh(80)
    return out + [(1000, None, "en"), (1001, "", "en"), (1002, "a", "en"), (1003, "A", "en"), (1004, "a b", "en"), (1005, "a \t b", "en"),
                  out[7], (7, "the same id again", "en"), (None, out[8][1], "en"), (None, None, "en")]


@pytest.mark.parametrize("seed,cell", [(1, 512), (2, 24), (3, 8)])
def test_jaccard_classes(spark, seed, cell):
    """In one task each, and with regions split by pivots and into tiles."""
    rows = near_copies(seed)
    got = regions.jaccard_classes(clashing(frame(spark, rows)), cell=cell)
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=repr)
    assert found == sorted(plain.jaccard([(i, t) for i, t, _ in rows]), key=repr)


def test_histograms_rule_out_no_link():
    rnd = random.Random(5)
    for _ in range(60):
        size = rnd.choice([10, 30, 200, 3000])
        own = {rnd.randrange(2**64) for _ in range(size)}
        other = set(rnd.sample(sorted(own), len(own) - rnd.randrange(0, max(1, size // 15)))) | {rnd.randrange(2**64) for _ in range(rnd.randrange(0, max(1, size // 15)))}
        linked = 100 * len(own & other) >= 90 * len(own | other)
        arrays = [np.array(sorted(x), np.uint64) for x in (own, other)]
        met = regions._may_link(np.array([len(x) for x in arrays]), [regions.histogram(x) for x in arrays], 90)
        assert not linked or met.all()
    arrays = [np.array(sorted(rnd.randrange(2**64) for _ in range(500)), np.uint64) for _ in range(20)]
    assert not regions._may_link(np.full(20, 500), [regions.histogram(x) for x in arrays], 90).any()


def test_voronoi_cells_keep_every_link(spark):
    """A region far larger than a cell, of copies at all distances from one another."""
    rnd = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        base = base if i % 10 else [*base[:50], *[f"c{rnd.randrange(10**6)}" for _ in range(10)]]
        own = list(base)
        own[rnd.randrange(60)] = "z"
        rows.append((i, " ".join(own), "en"))
    got = regions.jaccard_classes(frame(spark, rows), percent=80, cell=16)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain.jaccard([(i, t) for i, t, _ in rows], 80))


def test_no_documents(spark):
    assert regions.jaccard_classes(frame(spark, [], 1)).count() == 0
    assert [tuple(r) for r in regions.jaccard_classes(frame(spark, [(3, None, "en")], 1)).collect()] == [(3, 0, 3)]


def test_queries_are_registered():
    entries = catalog.entries()
    assert {"op11_collocations", "op12_periodic_runs", "op13_jaccard_join"} <= set(entries)
    assert entries["op11_collocations"].sql
