"""Quality rules with thresholds that adapt to each language and source, from mergeable quantile sketches."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.frames import stored

#: Words in a window whose repetition within a text counts.
WINDOW = 8
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_again")
#: Ratio of the borders of a sketch's bucket; quantiles are right to half of what it is above 1.
GAMMA = 1.02
#: A threshold lies this many times the middle half's width beyond it; documents that a group's own
#: sketch needs, fewer take that of the language or, failing that, of all documents.
REACH, ENOUGH = 4.0, 50
#: What is measured: the share, the least width that counts for it, and whether low values are odd too.
RULES = {
    "word_length": ("word_chars / nullif(n_words, 0)", 0.6, True),
    "symbols": ("n_symbols / nullif(n_words, 0)", 0.025, False),
    "dup_lines": ("n_dup_lines / nullif(n_lines, 0)", 0.3, False),
    "repeats": ("n_repeat_words / nullif(n_words, 0)", 0.2, False),
    "again": ("n_again / nullif(n_words, 0)", 0.05, False),
}
#: Rules that nearly all texts have a 0 for, so that the middle half tells nothing, and the highest value a
#: judged text can have. Their threshold lies beyond the TAIL quantile by as much as that is from the
#: median, but at most NEARER of the way to the highest value, so that it can be broken.
TAILED = {"dup_lines": 1.0, "repeats": 0.3}
TAIL, NEARER, ENOUGH_TAIL = 0.98, 0.9, 100


def repeat_words(codes: np.ndarray, size: int = WINDOW) -> int:
    """Words that lie in windows of `size` words found twice or more among them, the first ones included."""
    n = len(codes) - size + 1
    if n < 2:
        return 0
    hashes = np.zeros(n, np.uint64)
    for k in range(size):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + n]
    ranked = np.sort(hashes)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(twice):
        return 0
    places = np.flatnonzero(np.isin(hashes, twice))
    # Only windows whose hashes meet are compared word by word.
    rows = np.stack([codes[places + k] for k in range(size)], axis=1)
    _, which, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    starts = places[counts[which.reshape(-1)] > 1]
    covered = np.zeros(len(codes), bool)
    for k in range(size):
        covered[starts + k] = True
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The FEATURES of one text; null has no words and no lines."""
    text = text or ""
    words = text.encode().split()
    numbers: dict[bytes, int] = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64)
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return (len(words), len(text) - sum(map(text.count, " \t\n\v\f\r")), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(codes) if len(numbers) < len(words) else 0, len(lines),
            int((codes[1:] == codes[:-1]).sum()))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """id, lang, source and the FEATURES of each row's whole text."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"),
                       F.col(f"`{source_col}`").cast("string").alias("source"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([measure(t.as_py()) for t in batch.column("text")], np.int64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.select(["id", "lang", "source"]).columns, *map(pa.array, table.T.copy())],
                                             ["id", "lang", "source", *FEATURES])

    kinds = ", ".join(f"{f} long" for f in FEATURES)
    return rows.mapInArrow(of, f"id {rows.schema['id'].dataType.simpleString()}, lang string, source string, {kinds}")


def sketch(measured: DataFrame) -> DataFrame:
    """Quantile sketches: lang, source, rule, bucket, n. Sketches merge by adding counts.

    A bucket holds the values between two powers of GAMMA, so there are a few hundred in each sketch
    however many documents it covers; each task adds up its own first.
    """
    values = F.array(*[F.struct(F.lit(rule).alias("rule"), F.expr(value).alias("value")) for rule, (value, _, _) in RULES.items()])
    long = measured.select("lang", "source", F.explode(values).alias("v")).select("lang", "source", "v.*").where("value IS NOT NULL")
    bucket = F.when(F.col("value") > 1e-6, F.ceil(F.log("value") / math.log(GAMMA))).otherwise(F.lit(-10_000))
    return long.groupBy("lang", "source", "rule", bucket.cast("int").alias("bucket")).agg(F.count("*").alias("n"))


def fences(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """For each group of the keys and each rule: documents, lowest and highest value that is not odd."""
    merged = sketches.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    run = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
    value = lambda b: F.when(b > -10_000, F.pow(F.lit(GAMMA), b) * (2 / (1 + GAMMA))).otherwise(0.0)
    at = lambda share: value(F.min(F.when(F.col("upto") >= share * F.col("all"), F.col("bucket"))))
    middle = run.groupBy(*keys, "rule").agg(F.max("all").alias("documents"), at(0.25).alias("low"), at(0.75).alias("high"),
                                               at(0.5).alias("median"), at(TAIL).alias("tail"))
    least, sided, top = F.lit(None), F.lit(False), F.lit(None)
    for rule, (_, width, both) in RULES.items():
        least, sided = F.when(F.col("rule") == rule, width).otherwise(least), F.when(F.col("rule") == rule, both).otherwise(sided)
    for rule, highest in TAILED.items():
        top = F.when(F.col("rule") == rule, highest).otherwise(top)
    reach = F.greatest(F.col("high") - F.col("low"), least) * REACH
    beyond = F.least(F.greatest(F.col("tail") - F.col("median"), least), (top - F.col("tail")) * NEARER)
    return middle.select(*keys, "rule", "documents", F.when(sided, F.col("low") - reach).alias("least"), F.when(top.isNotNull(), F.col("tail") + beyond).otherwise(F.col("high") + reach).alias("most"))


def thresholds(measured: DataFrame) -> DataFrame:
    """One row for each (lang, source): `<rule>_least` and `<rule>_most` of every rule."""
    own = sketch(measured)
    by_group, by_lang, by_all = fences(own, ["lang", "source"]), fences(own, ["lang"]), fences(own, [])
    wide = (by_group.alias("g")
            .join(by_lang.alias("l"), F.col("g.lang").eqNullSafe(F.col("l.lang")) & (F.col("g.rule") == F.col("l.rule")))
            .join(by_all.alias("a"), F.col("g.rule") == F.col("a.rule")))

    enough = F.when(F.col("g.rule").isin(*TAILED), ENOUGH_TAIL).otherwise(ENOUGH)

    def best(side: str) -> Column:
        return (F.when(F.col("g.documents") >= enough, F.col(f"g.{side}")).when(F.col("l.documents") >= enough, F.col(f"l.{side}"))
                .otherwise(F.col(f"a.{side}")))

    chosen = wide.select("g.lang", "g.source", "g.rule", best("least").alias("least"), best("most").alias("most"))
    return chosen.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("rule") == rule, F.col(side))).alias(f"{rule}_{side}") for rule in RULES for side in ("least", "most")])


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per input row: its measures, whether it fails the base rules, whether it is kept.

    A text fails the base with fewer than 20 words, or with more than 30 % of them in repeated windows.
    The others make the sketches of their language and source, and a text goes if a measure is odd
    there: beyond the middle half of the values by more than REACH times its width, a least width being
    set for each rule; for TAILED rules, beyond the TAIL quantile. Nothing goes for being the worst of a clean source.

    Columns: doc_id, the FEATURES, base_failed, kept, odd (the rules it broke).
    A null text has no words and fails the base. Null languages and sources are groups like others.
    Null ids and repeated rows are rows like others; other columns are ignored; no rows give no rows.
    """
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    rows = stored(features(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", failed))
    limits = thresholds(rows.where(~F.col("base_failed"))).withColumnRenamed("lang", "its_lang").withColumnRenamed("source", "its_source")
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("its_lang")) & F.col("source").eqNullSafe(F.col("its_source")), "left")
    odd = [F.when((F.expr(value) < F.col(f"{rule}_least")) | (F.expr(value) > F.col(f"{rule}_most")), F.lit(rule)) for rule, (value, _, _) in RULES.items()]
    broken = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*odd)))
    return joined.select(F.col("id").alias("doc_id"), *FEATURES, "base_failed", (~F.col("base_failed") & (F.size(broken) == 0)).alias("kept"), broken.alias("odd"))
