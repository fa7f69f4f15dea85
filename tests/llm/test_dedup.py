"""Exact, near, line and passage deduplication against plain versions."""

import random

import plain
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import exact_dedup, line_dedup, simhash, stars, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * i % 977}" for i in range(5000))


def corpus(seed=1, rows=120):
    """Texts with exact and near copies, shared passages, repeats, odd white space, nulls and repeated rows."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["The", "the", "of", "und", "é", "a" * 9]) if rnd.random() < 0.3 else f"w{rnd.randrange(400)}"
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(rows):
        kind, own = rnd.random(), " ".join(word() for _ in range(rnd.randrange(1, 120)))
        if kind < 0.2 and texts:
            own = rnd.choice(texts)
        elif kind < 0.4 and texts:
            own = (rnd.choice(texts) or "").replace(" ", rnd.choice(["\n", "  ", "\t"]))
        elif kind < 0.6:
            own = f"{own} {passage[rnd.randrange(80):]} {own}"
        elif kind < 0.7:
            own = "\n".join(rnd.choice(["one line", "two line", "three line", ""]) for _ in range(rnd.randrange(12)))
        texts.append(own)
    texts += [None, "", " \n ", "x", LONG, LONG]
    found = [(i, t) for i, t in enumerate(texts)]
    return found + [(5, found[5][1]), (5, "another text of the same id"), (None, found[7][1]), (None, None), (None, "no id")]


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, "en", "s", 0 if t is None else len(t)) for i, t in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda c: F.unhex(F.lpad(F.hex(F.length(c) % 3), 2, "0"))])
def test_exact_groups(rows, docs, digest):
    """Also with a hash that collides all the time."""
    got = exact_dedup.exact_groups(docs, digest=digest)
    assert collected(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(plain.exact(rows), key=repr)


def test_drop_copies_keeps_rows_whole(spark, rows, docs):
    got = exact_dedup.drop_copies(docs.withColumn("key", F.lit("k")).withColumn("mark", F.lit(1)).withColumn("tags", F.create_map(F.lit("a"), F.lit(1))))
    assert got.columns == [*docs.columns, "key", "mark", "tags"]
    kept = collected(got, "doc_id", "text")
    want = [(i, s) for i, _, _, k, s in plain.exact(rows) if k]
    assert sorted((i, plain.sha(plain.SPACE.sub(" ", t or ""))) for i, t in kept if i is not None) == sorted(w for w in want if w[0] is not None)
    assert len(kept) == len(want) and set(kept) <= set(rows)


def test_no_python_on_native_paths(docs):
    for df in (exact_dedup.exact_groups(docs), exact_dedup.drop_copies(docs), line_dedup.drop_repeated_lines(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_lines(spark):
    rows = [r for r in corpus(2) if r[0] is not None]
    rows = list({i: t for i, t in rows}.items())
    got = line_dedup.drop_repeated_lines(frame(spark, rows))
    lists = [t.split("\n") if t else [] for _, t in rows]
    seen, want = set(), []
    for (id_, _), own in zip(rows, lists, strict=True):
        gone = set()
        for i in range(len(own) - 2):
            window = tuple(own[i:i + 3])
            if not any(plain.words(x) for x in window):
                continue
            gone |= set(range(i, i + 3)) if window in seen else set()
            seen.add(window)
        want.append((id_, len(own), len(gone), "\n".join(x for i, x in enumerate(own) if i not in gone)))
    assert any(w[2] for w in want)
    assert collected(got, "doc_id", "n_lines", "n_removed", "text") == sorted(want, key=repr)


def test_lines_of_odd_rows(spark, docs):
    got = {(r["doc_id"], r["text"]): r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert got[(None, "no id")]["n_removed"] == 0
    assert got[(None, "")]["n_lines"] == 0


@pytest.mark.parametrize("trie", [simhash.TRIE, 16, 3])
def test_trie_links(spark, trie):
    """Dense clusters, whole and split into pieces of the trie."""
    rnd, values = random.Random(trie), set()
    for _ in range(30):
        x = rnd.getrandbits(64)
        for _ in range(rnd.choice([1, 3, 40])):
            values.add(x)
            for _ in range(rnd.choice([1, 2, 3])):
                x ^= 1 << rnd.randrange(64)
    values = sorted(values)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    found = stars.components(simhash.links(spark.createDataFrame([(signed(v),) for v in values], "fp long"), 2, trie))
    root = {r["node"]: r["root"] for r in found.collect()}
    groups, want = {}, {}
    for v, first in zip(values, plain.linked(values), strict=True):
        groups.setdefault(root.get(signed(v), signed(v)), set()).add(v)
        want.setdefault(first, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_near_groups(rows, docs):
    got = simhash.near_groups(docs)
    prints = [plain.fingerprint(t) for _, t in rows]
    tops = plain.linked(prints)
    least = {top: min((i for (i, _), t in zip(rows, tops, strict=True) if t == top and i is not None), default=None) for top in set(tops)}
    want = [(i, f"{p:016x}", least[top]) for (i, _), p, top in zip(rows, prints, tops, strict=True)]
    assert collected(got, "doc_id", "fingerprint", "component_id") == sorted(want, key=repr)
    kept = collected(simhash.drop_near_copies(docs), "doc_id", "text")
    assert len(kept) == len(set(tops)) and {i for i, _ in kept} == set(least.values())


def test_path_of_links(spark):
    """A long chain of links is one component."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500)], "u long, v long")
    assert {r["root"] for r in stars.components(edges).collect()} == {0}


def test_passages(rows, docs):
    marks = {(i, t): m for i, t, m in docs.select("doc_id", "text", F.xxhash64("text")).collect()}
    order = sorted(rows, key=lambda r: (plain.rank(r), marks[r]))
    got = substring_dedup.drop_repeated_passages(docs)
    want = plain.passages(order)
    assert any(w[2] for w in want)
    assert collected(got.select("doc.*", "*"), "doc_id", "n_words", "n_removed", "text") == sorted(want, key=repr)
    for r in got.collect():
        assert sum(s["stop"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_passages_of_many_blocks(spark, rows, docs, monkeypatch):
    """Small blocks and parts, of ids that are all over, give the same."""
    monkeypatch.setattr(substring_dedup, "BLOCK", 7)
    monkeypatch.setattr(substring_dedup, "PART", 500)
    few = substring_dedup.drop_repeated_passages(docs).select("doc.*", "*")
    monkeypatch.undo()
    whole = substring_dedup.drop_repeated_passages(docs).select("doc.*", "*")
    assert collected(few, "doc_id", "n_removed", "text") == collected(whole, "doc_id", "n_removed", "text")


def test_texts_that_lose_nothing_stay(spark, docs):
    got = substring_dedup.without_repeated_passages(docs.withColumn("spans", F.lit(1)))
    assert got.columns == [*docs.columns, "spans"] and got.schema["n_chars"].dataType.typeName() == "long"
    assert (None, None) in {(r["doc_id"], r["text"]) for r in got.collect()}


def test_no_rows(spark):
    none = frame(spark, [])
    for operator in (exact_dedup.exact_groups, exact_dedup.drop_copies, line_dedup.drop_repeated_lines, simhash.near_groups,
                     simhash.drop_near_copies, substring_dedup.drop_repeated_passages, substring_dedup.without_repeated_passages):
        assert operator(none).collect() == []
