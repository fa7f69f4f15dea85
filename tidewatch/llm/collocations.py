"""Collocations per language by best-first growth of phrases with admissible bounds.

A phrase grows to the right from its first word. Cutting it after that word gives l = f(first word) and r at
least the phrase's own count, so no phrase that starts with w scores above 1000 * n / f(w): rare first words
have the highest bounds and are opened first, in steps. After each step the phrases found so far are scored
exactly; a language is settled once its 2000th surviving score is above the bound of every word not opened.

Words are 64-bit hashes from the first pass on (no two words of a language share one: checked, and salted
anew if so). Counts are first taken per hash of a phrase, which can only be too high, to choose what is then
counted word by word. What tasks are sent is a filter of fixed size, whatever the vocabulary.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.frames import small_batches, stored

#: Words of a phrase at most, its least count, phrases reported for each language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: First words are opened in steps: up to this many times the count of the step before.
STEP = 16
#: Bits of a filter (2 MB), words of one row of the coded texts, distinct words a task keeps before it starts anew.
FILTER_BITS, CHUNK, DISTINCT = 24, 1 << 13, 1 << 17
#: Words that are worked on at once, about; rows of coded texts (64 KB) read at once, and bytes of a block of them on disk.
AT_ONCE, ROWS, BLOCK = 1 << 17, 128, 16 << 20
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_BREAKS, b"\xff" * len(_BREAKS))
_STOP = b"\xff"
_KEY = ["lang", "words"]


def pieces_of(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words in order, with a mark, a byte that no text holds, where a piece ends."""
    return text.encode().lower().translate(_TABLE).replace(_STOP, b" \xff ").split()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, word, f) over all documents; a null language is `und`."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            lists = [(lang, [w for w in own if w != _STOP]) for lang, own in counts.items()]
            return pa.RecordBatch.from_arrays([
                pa.array([lang for lang, own in lists for _ in own], pa.string()),
                pa.array([w.decode() for _, own in lists for w in own], pa.string()),
                pa.array([counts[lang][w] for lang, own in lists for w in own], pa.int64())], ["lang", "word", "c"])

        for batch in batches:
            for lang, value in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                text = value.as_py()
                if text:
                    counts.setdefault(lang, Counter()).update(pieces_of(text))
                    if sum(map(len, counts.values())) > DISTINCT:
                        yield out()
                        counts.clear()
        yield out()

    return rows.mapInArrow(of, "lang string, word string, c long").groupBy("lang", "word").agg(F.sum("c").alias("f"))


def _coded_words(counts: DataFrame) -> tuple[DataFrame, str]:
    """(lang, h, word, f) and the salt with which no two words of a language share the hash h, nor any is 0."""
    salt = ""
    while True:
        words = counts.withColumn("h", F.xxhash64(F.concat("word", F.lit(salt))))
        shared = words.groupBy("lang", "h").agg(F.count("*").alias("words")).where("words > 1 OR h = 0")
        if shared.isEmpty():
            return words, salt
        salt += "\xff"


# ---- hashes of phrases and filters of them ----

def _mixed(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its front and the hash of its last word."""
    both = (hashes ^ (words * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return both ^ (both >> np.uint64(29))


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 7))


def _bits(hashes: DataFrame) -> np.ndarray:
    """The filter of the hashes `h`, put together by an aggregation; at most 2^18 rows reach the driver."""
    place = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - FILTER_BITS}) & 63 AS int))")
    found = hashes.select(F.shiftrightunsigned(place, 6).alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    return table.view(np.uint64)


def _in(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (table[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


def _sent(spark: SparkSession, tables: list[np.ndarray]):
    """The filters as a broadcast; compressed, as most of their bits are 0 while phrases are few."""
    return spark.sparkContext.broadcast([zlib.compress(table.tobytes(), 1) for table in tables])


def _received(shared) -> list[np.ndarray]:
    return [np.frombuffer(zlib.decompress(table), np.uint64) for table in shared.value]


def _phrase_hashes(phrases: DataFrame) -> DataFrame:
    """(m, h): length and hash of each phrase (lang, words)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, sizes = [], []
            for lang, words in zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist(), strict=True):
                h = np.array([_lang_hash(lang)])
                for word in words:
                    h = _mixed(h, np.array([word], np.int64).view(np.uint64))
                own.append(int(h[0]))
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(np.array(own, np.uint64).view(np.int64))], ["m", "h"])

    return phrases.select(*_KEY).mapInArrow(of, "m int, h long")


# ---- passes over the coded texts ----

def coded_texts(docs: DataFrame, known: np.ndarray, salt: str, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, codes): stretches of two and more frequent words as hashes, 0 between stretches."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    shared, tail = _sent(docs.sparkSession, [known]), salt.encode()

    def stretches(codes: np.ndarray) -> np.ndarray:
        full = codes != 0
        beside = np.concatenate(([False], full[:-1])) | np.concatenate((full[1:], [False]))
        kept = np.where(full & beside, codes, np.uint64(0))
        return kept[(kept != 0) | (np.concatenate(([0], kept[:-1])) != 0)]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _received(shared)[0]
        codes: dict[str, dict[bytes, int]] = {}
        held: dict[str, list[bytes]] = {}

        def out(lang: str) -> Iterator[pa.RecordBatch]:
            words = held.pop(lang)
            own = codes.setdefault(lang, {_STOP: 0})
            fresh = list(set(words) - own.keys())
            hashes = np.fromiter((xxhash.xxh64_intdigest(word + tail, 42) for word in fresh), np.uint64, len(fresh))
            frequent = _in(table, _mixed(np.full(len(fresh), _lang_hash(lang)), hashes))
            own.update(zip(fresh, np.where(frequent, hashes, np.uint64(0)).tolist(), strict=True))
            found = stretches(np.fromiter(map(own.__getitem__, words), np.uint64, len(words)))
            if sum(map(len, codes.values())) > DISTINCT:
                codes.clear()
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([np.append(found, np.uint64(0)).tobytes()], pa.binary())], ["lang", "codes"])

        for batch in batches:
            for lang, value in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                words = held.setdefault(lang, [])
                words += pieces_of(value.as_py() or "")
                words.append(_STOP)
                if len(words) > CHUNK or len(held) > 256:
                    yield from out(lang)
        for lang in list(held):
            yield from out(lang)

    return rows.mapInArrow(of, "lang string, codes binary")


def _codes_in(batch: pa.RecordBatch, at_once: int = AT_ONCE) -> Iterator[tuple[str, np.ndarray]]:
    """The coded texts of a batch, those of one language one after another, in arrays of no more than about
    `at_once` words, so that what a pass holds does not grow with the phrases that it keeps; each row ends with 0."""
    langs = batch.column("lang").to_pylist()
    arrays = [np.frombuffer(value.as_buffer(), np.uint64) for value in batch.column("codes")]
    for lang in dict.fromkeys(langs):
        held, length = [], 0
        for own in (own for own, other in zip(arrays, langs, strict=True) if other == lang):
            if held and length + len(own) > at_once:
                yield lang, np.concatenate(held)
                held, length = [], 0
            held.append(own)
            length += len(own)
        yield lang, np.concatenate(held)


def _grown(lang: str, codes: np.ndarray, filters: list[np.ndarray], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For m = 1, 2, ... the places and hashes of phrases of m words whose fronts all pass their filters."""
    at = np.flatnonzero(codes)
    hashes = _mixed(np.full(len(at), _lang_hash(lang)), codes[at])
    for m in range(1, longest + 1):
        yield m, at, hashes
        if m > len(filters) or m == longest:
            return
        on = _in(filters[m - 1], hashes)
        at, hashes = at[on], hashes[on]
        more = codes[np.minimum(at + m, len(codes) - 1)]  # a row of codes ends with 0
        on = more != 0
        at, hashes = at[on], _mixed(hashes[on], more[on])


def _hash_counts(coded: DataFrame, filters: list[np.ndarray], m: int) -> DataFrame:
    """(h, c): how many places have each hash of m words, where the fronts pass the filters."""
    shared = _sent(coded.sparkSession, filters)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = _received(shared)
        for batch in batches:
            for lang, codes in _codes_in(batch):
                *_, (size, _, hashes) = _grown(lang, codes, filters, m)
                if size == m:
                    h, c = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

    return coded.mapInArrow(of, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def _groups(codes: np.ndarray, at: np.ndarray, hashes: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted so that equal phrases are together, and where each begins; words decide, not hashes."""
    order = np.argsort(hashes, kind="stable")
    at = at[order]
    fresh = np.concatenate(([True], hashes[order][1:] != hashes[order][:-1]))
    words = [codes[at + k] for k in range(m)]
    differs = np.zeros(len(at), bool)
    for word in words:
        differs[1:] |= word[1:] != word[:-1]
    if (differs & ~fresh).any():  # two phrases of one hash
        order = np.lexsort(words)
        at = at[order]
        fresh = np.concatenate(([True], np.any([codes[at + k][1:] != codes[at + k][:-1] for k in range(m)], axis=0)))
    return at, np.flatnonzero(fresh)


def _exact_counts(coded: DataFrame, fronts: list[np.ndarray] | None, wanted: dict[int, np.ndarray]) -> DataFrame:
    """(lang, words, a, before, after): exact counts of the phrases of m words that pass wanted[m].

    before (after) is the word that stands before (after) every one of them, null if they differ or if one
    is not preceded (followed) by a frequent word of its piece. With `fronts` a phrase's fronts must pass.
    """
    lengths, leading = sorted(wanted), len(fronts or [])
    shared = _sent(coded.sparkSession, [*(fronts or []), *(wanted[m] for m in lengths)])
    everything = np.full(1 << (FILTER_BITS - 6), ~np.uint64(0))
    longest = max(wanted, default=1)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _received(shared)
        filters, wanted = tables[:leading] or [everything] * longest, dict(zip(lengths, tables[leading:], strict=True))
        for batch in batches:
            for lang, codes in _codes_in(batch):
                padded = np.concatenate((np.zeros(1, np.uint64), codes, np.zeros(1, np.uint64)))
                for m, at, hashes in _grown(lang, codes, filters, longest):
                    if m not in wanted:
                        continue
                    on = _in(wanted[m], hashes)
                    if not on.any():
                        continue
                    at, starts = _groups(codes, at[on], hashes[on], m)
                    first = at[starts]
                    words = np.stack([codes[first + k] for k in range(m)], axis=1).view(np.int64)
                    sides = []
                    for beside in (padded[at], padded[at + m + 1]):
                        low, high = np.minimum.reduceat(beside, starts), np.maximum.reduceat(beside, starts)
                        sides.append(np.where(low == high, low, np.uint64(0)).view(np.int64))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(first) * m + 1, m, dtype=np.int32)), pa.array(words.ravel()))
                    counts = np.diff(np.append(starts, len(at)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(first), pa.string()), lists, *(pa.array(x) for x in (counts.astype(np.int64), *sides))],
                        ["lang", "words", "c", "before", "after"])

    rows = coded.mapInArrow(of, "lang string, words array<long>, c long, before long, after long")
    same = lambda side: F.when((F.min(side) == F.max(side)) & (F.min(side) != 0), F.min(side))
    return rows.groupBy(*_KEY).agg(F.sum("c").alias("a"), same("before").alias("before"), same("after").alias("after"))


# ---- scores ----

def _suffixes(phrases: DataFrame) -> DataFrame:
    """The parts of two and more words that cuts of the phrases leave on the right."""
    cut = phrases.select("lang", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    return cut.select("lang", F.expr("slice(words, k + 1, size(words) - k)").alias("words")).where("size(words) > 1").distinct()


def scored(phrases: DataFrame, counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """Phrases (lang, words, a, ...) with l, r, n and score of their lowest-scoring cut, ties to the shortest front.

    `counts` has f of every part, single words among them, `sizes` n of each language. Products are decimals.
    """
    cuts = phrases.select(*phrases.columns, F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"_left": F.expr("slice(words, 1, k)"), "_right": F.expr("slice(words, k + 1, size(words) - k)")})
    for side, name in (("_left", "l"), ("_right", "r")):
        part = counts.select(F.col("lang").alias("_lang"), F.col("words").alias("_part"), F.col("a").alias(name))
        cuts = cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).drop("_lang", "_part")
    cuts = cuts.join(sizes, "lang")
    score = F.expr("cast(1000 * cast(a AS decimal(19,0)) AS decimal(23,0)) * cast(n AS decimal(15,0)) "
                   "div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    cut = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    found = cuts.groupBy(*phrases.columns, "n").agg(cut)
    return found.select(*phrases.columns, "n", "cut.score", "cut.l", "cut.r")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP, least: int = LEAST,
                 longest: int = LONGEST) -> DataFrame:
    """The `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split at `[.,;:!?]` and line ends into pieces, these at spaces and tabs into
    words. A phrase has 2 to `longest` words of a piece and occurs a >= `least` times, overlaps included; n is
    the number of words of its language. Its score is floor(1000 * a * n / (l * r)) of the cut where that is
    lowest (ties: the shortest front), l and r being the counts of the parts. Phrases that a longer one of at
    most `longest` words contains at each of their occurrences are left out. Ranks go by score and a
    descending, then by phrase (bytes). A null text has no words; a null language is `und`; repeated rows all
    count; other columns are ignored; no rows, or no phrase frequent enough, give no rows.
    """
    with small_batches(docs.sparkSession, rows=ROWS):
        words, salt = _coded_words(stored(word_counts(docs, lang_col, text_col)))
        sizes = stored(words.groupBy("lang").agg(F.sum("f").alias("n")))
        words = stored(words.where(F.col("f") >= least).select("lang", "h", "word", "f"))
        singles = words.select("lang", F.array("h").alias("words"), F.col("f").alias("a"))
        coded = stored(coded_texts(docs, _bits(_phrase_hashes(singles)), salt, lang_col, text_col), BLOCK)
        open_langs, found, extra = sizes, [], []
        low, high = 0, least * STEP
        while True:
            band = words.join(open_langs.select("lang"), "lang", "left_semi").where(F.col("f").between(low + 1, high))
            phrases = _opened(coded.join(open_langs.select("lang"), "lang", "left_semi"), band, least, longest)
            if phrases is not None:
                found.append(phrases)
                known = reduce(DataFrame.union, [x.select(*_KEY, "a") for x in [*found, *extra]])
                missing = stored(_suffixes(phrases).join(known, _KEY, "left_anti"))
                extra += _counted(coded, missing)
            state = _settle(found, extra, singles, sizes, open_langs, words, high, top, longest)
            if state is not None:
                open_langs = state
            if state is None or open_langs.isEmpty():
                break
            low, high = high, high * STEP
        return _ranked(found, extra, singles, sizes, words, top, longest)


def _opened(coded: DataFrame, band: DataFrame, least: int, longest: int) -> DataFrame | None:
    """Frequent phrases that start with a word of the band, grown word by word; None if there are none."""
    fronts = [_bits(_phrase_hashes(band.select("lang", F.array("h").alias("words"))))]
    wanted: dict[int, np.ndarray] = {}
    for m in range(2, longest + 1):
        if not fronts[-1].any():
            break
        wanted[m] = _bits(_hash_counts(coded, fronts, m).where(F.col("c") >= least))
        fronts.append(wanted[m])
    if not any(table.any() for table in wanted.values()):
        return None
    counts = _exact_counts(coded, fronts, wanted).where(F.col("a") >= least)
    own = band.select("lang", F.col("h").alias("first"))
    return stored(counts.withColumn("first", F.col("words")[0]).join(own, ["lang", "first"], "left_semi").drop("first"))


def _counted(coded: DataFrame, phrases: DataFrame) -> list[DataFrame]:
    """Exact counts of given phrases, as a list of no or one table."""
    if phrases.isEmpty():
        return []
    hashes = stored(_phrase_hashes(phrases))
    lengths = [row["m"] for row in hashes.select("m").distinct().collect()]
    wanted = {m: _bits(hashes.where(F.col("m") == m)) for m in lengths}
    counts = _exact_counts(coded, None, wanted)
    return [stored(counts.join(phrases, _KEY, "left_semi"))]


def _survivors(found: list[DataFrame], extra: list[DataFrame], singles: DataFrame, sizes: DataFrame, longest: int) -> DataFrame:
    """Scored phrases but those that a longer one contains wherever they occur."""
    phrases = reduce(DataFrame.union, found)
    counts = reduce(DataFrame.union, [x.select(*_KEY, "a") for x in [*found, *extra]]).distinct().union(singles)
    free = phrases.where((F.size("words") == longest) | (F.col("before").isNull() & F.col("after").isNull()))
    return scored(free.select(*_KEY, "a"), counts, sizes)


def _bound(n: Column, f: Column) -> Column:
    return F.floor(n * 1000 / f)


def _settle(found, extra, singles, sizes, open_langs, words, high, top, longest) -> DataFrame | None:
    """The languages whose next words may still start a phrase among the first; None if no words are left."""
    ahead = words.where(F.col("f") > high).groupBy("lang").agg(F.min("f").alias("next")).join(open_langs, "lang")
    ahead = stored(ahead.select("lang", "n", F.expr("1000 * n div next").alias("bound")))
    if ahead.isEmpty():
        return None
    if not found:
        return ahead.select("lang", "n")
    above = _survivors(found, extra, singles, sizes, longest).join(ahead.select("lang", "bound"), "lang").where("score > bound")
    done = above.groupBy("lang").agg(F.count("*").alias("above")).where(F.col("above") >= top)
    return stored(ahead.join(done, "lang", "left_anti").select("lang", "n"))


def _ranked(found, extra, singles, sizes, words, top, longest) -> DataFrame:
    if not found:
        shape = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
        return sizes.sparkSession.createDataFrame([], shape).select(
            "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = _survivors(found, extra, singles, sizes, longest).withColumn("near", F.rank().over(best)).where(F.col("near") <= top)
    each = near.select("*", F.posexplode("words").alias("at", "h")).join(words.select("lang", "h", "word"), ["lang", "h"])
    named = each.groupBy("lang", "words", "a", "l", "r", "n", "score").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("own"))
    named = named.withColumn("phrase", F.array_join("own.word", " "))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.withColumn("rank", F.row_number().over(place).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')) AS piece FROM t
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p
), s AS (
  SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w
), g AS MATERIALIZED (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, count(*) AS f
  FROM s, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE i + m - 1 <= len(ws) GROUP BY ALL
), sizes AS (
  SELECT lang, sum(f) AS n FROM g WHERE m = 1 GROUP BY lang
), c AS MATERIALIZED (
  SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE m > 1 AND f >= 100
), inner_parts AS (
  SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS phrase, max(a) AS longer
  FROM c, (SELECT unnest([1, 2, 3, 4]) AS i), (SELECT unnest([2, 3, 4]) AS k) WHERE k < m AND i + k - 1 <= m GROUP BY ALL
), parts AS MATERIALIZED (
  SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS lp, array_to_string(ws[k + 1:m], ' ') AS rp
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c)
), cuts AS (
  SELECT parts.lang, parts.phrase, a, k, l.f AS l, r.f AS r, n,
         CAST(1000 AS HUGEINT) * a * n // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM parts JOIN g AS l ON l.lang = parts.lang AND l.phrase = lp
  JOIN g AS r ON r.lang = parts.lang AND r.phrase = rp
  JOIN sizes ON sizes.lang = parts.lang
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inner_parts AS i ON i.lang = lowest.lang AND i.phrase = lowest.phrase
  WHERE longer IS NULL OR longer < a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""
