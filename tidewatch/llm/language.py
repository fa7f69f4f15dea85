"""Language identification: ridge regression over n-gram presence kernels with Nyström landmarks."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.frames import stored

#: Labelled rows of each language that the classifier is fitted on, and how many of them are landmarks.
SAMPLE, LANDMARKS = 400, 64
#: Shares of a language that its rows are chosen in first.
SHARES = 16
#: Penalty of the regression, and how fast a difference of its outputs turns into certainty.
PENALTY, CERTAINTY = 1e-3, 4.0
#: Letters told apart, by frequency in the sample; the others share one number, and all else is a gap.
LETTERS = 62
#: Numbers of one symbol, and where the codes of pairs and triples begin.
BASE = LETTERS + 2
PAIRS, TRIPLES, GRAMS = BASE, BASE + BASE**2, BASE + BASE**2 + BASE**3
#: Texts scored by one matrix product.
BATCH = 256
UNKNOWN = "und"


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")


def symbols(letters: str) -> np.ndarray:
    """The number of every character: a letter's place from 1 on, the last number for other letters, 0 for all else."""
    table = np.fromiter((chr(p).isalpha() for p in range(0x110000)), np.uint8, 0x110000) * np.uint8(BASE - 1)
    for number, letter in enumerate(letters, 1):
        table[ord(letter)] = number
    return table


def grams(text: str, table: np.ndarray) -> np.ndarray:
    """Codes of all runs of one, two and three symbols, repeats included; a run of gaps is one."""
    codes = table[points(text)].astype(np.int32)
    codes = codes[(codes > 0) | (np.concatenate(([1], codes[:-1])) > 0)]
    pairs = codes[:-1] * BASE + codes[1:]
    return np.concatenate((codes, pairs + PAIRS, pairs[:-1] * BASE + codes[2:] + TRIPLES))


@dataclass(frozen=True)
class Model:
    """A fitted classifier: languages, letters, codes that occur in a landmark, and their weights."""

    languages: list[str]
    letters: str
    codes: np.ndarray
    weights: np.ndarray

    def scorer(self):
        """A function from texts to (language, certainty) of each."""
        table = symbols(self.letters)
        held = np.zeros(GRAMS, bool)

        def score(texts: list[str | None]) -> list[tuple[str, float]]:
            found: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
            for at in range(0, len(texts), BATCH):
                rows, present, size = [], np.zeros((BATCH, len(self.codes)), np.float32), np.ones(BATCH)
                for k, text in enumerate(texts[at:at + BATCH]):
                    own = grams(text, table) if text else np.empty(0, np.int32)
                    held[own] = True
                    if held[1:BASE].any() and self.languages:  # it has a letter
                        present[len(rows)] = held[self.codes]
                        size[len(rows)] = np.count_nonzero(held)
                        rows.append(at + k)
                    held[own] = False
                if not rows:
                    continue
                outputs = (present[:len(rows)] @ self.weights) / np.sqrt(size[:len(rows), None])
                shares = np.exp(CERTAINTY * (outputs - outputs.max(axis=1, keepdims=True)))
                shares /= shares.sum(axis=1, keepdims=True)
                for row, best, share in zip(rows, shares.argmax(axis=1), shares.max(axis=1), strict=True):
                    found[row] = (self.languages[best], float(share))
            return found

        return score


def held_out(id_: Column) -> Column:
    """Whether a row takes no part in learning by its id; a row without an id is not held out."""
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """lang and text of at most SAMPLE labelled rows of each language, chosen by a hash of the id."""
    id_, lang = F.col(f"`{id_col}`"), F.col(f"`{lang_col}`").cast("string")
    named = docs.where(id_.isNotNull() & lang.isNotNull() & F.col(f"`{text_col}`").isNotNull() & ~held_out(id_))
    # First within shares of a language, so that one with most of the rows is not one task's work.
    narrow = named.select(id_.alias("id"), lang.alias("lang")).distinct().withColumn("share", F.pmod(F.hash("id"), F.lit(SHARES)))
    least = F.xxhash64("id"), F.col("id")
    chosen = narrow.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*least))).where(F.col("place") <= SAMPLE)
    chosen = chosen.select("id", "lang", F.row_number().over(Window.partitionBy("lang").orderBy(*least)).alias("place")).where(F.col("place") <= SAMPLE)
    # Written first, its size is known before the texts move: Spark sends it to them if it is small.
    chosen = stored(chosen)
    rows = named.select(id_.alias("id"), lang.alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.join(chosen, ["id", "lang"]).groupBy("lang", "place").agg(F.min("text").alias("text"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A classifier from a bounded sample of labelled rows: SAMPLE of each language, whole texts.

    The kernel of two texts is the number of runs of one, two and three symbols present in both, over
    the root of the product of their own numbers. LANDMARKS texts of each language span the functions
    considered, and for each language one of them is fitted to 1 on its texts and -1 on the others.
    The sample's codes are taken from its texts on the executors.
    """
    sample = stored(sampled(docs, id_col, text_col, lang_col))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column("text"):
                counts.update(text.as_py().lower())
        kept = {c: n for c, n in counts.items() if c.isalpha()}
        yield pa.RecordBatch.from_arrays([pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64())], ["letter", "n"])

    top = sample.select("text").mapInArrow(counted, "letter string, n long").groupBy("letter").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "letter").limit(LETTERS)
    letters = "".join(r["letter"] for r in top.collect())

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = symbols(letters)
        for batch in batches:
            codes = [np.unique(grams(t.as_py(), table)).astype("<i4").tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), pa.array(codes, pa.binary())], ["lang", "place", "codes"])

    rows = sorted(sample.mapInArrow(coded, "lang string, place int, codes binary").collect(), key=lambda r: (r["lang"], r["place"]))
    sets = [np.frombuffer(r["codes"], "<i4") for r in rows]
    rows, sets = [r for r, s in zip(rows, sets, strict=True) if len(s)], [s for s in sets if len(s)]
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return Model([], letters, np.empty(0, np.int32), np.empty((0, 0), np.float32))

    marks = [k for lang in languages for k in [i for i, r in enumerate(rows) if r["lang"] == lang][:LANDMARKS]]
    codes = np.unique(np.concatenate([sets[k] for k in marks]))
    present = np.zeros((len(rows), len(codes)), np.float32)
    for k, own in enumerate(sets):
        present[k, np.searchsorted(codes, own[np.isin(own, codes)])] = 1
    present /= np.sqrt([len(s) for s in sets])[:, None]
    kernel = (present @ present[marks].T).astype(float)
    goal = np.where([[r["lang"] == lang for lang in languages] for r in rows], 1.0, -1.0)
    # Every language weighs the same, however many rows it has.
    share = np.array([1 / sum(r["lang"] == s["lang"] for s in rows) for r in rows])[:, None]
    system = kernel.T @ (kernel * share) + PENALTY * kernel[marks] + 1e-9 * np.eye(len(marks))
    dual = np.linalg.solve(system, kernel.T @ (goal * share))
    # A text's kernels with the landmarks, times the dual weights, is one product with these.
    return Model(languages, letters, codes.astype(np.int32), (present[marks].T @ dual).astype(np.float32))


def predicted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows as struct `doc`, with lang_pred and score."""
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("doc"))
    schema = T.StructType([rows.schema["doc"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for batch in batches:
            found = score(batch.column("doc").field(text_col).cast(pa.string()).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array([p for p, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                                             ["doc", "lang_pred", "score"])

    return rows.mapInArrow(of, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred (a learned language) and score (0 to 1).

    A null text, or one without a letter, is `und` with score 0, as every text is if nothing could be
    learned. With one language learned every other text is of it. Predictions see the text alone. A
    null id is not held out and not learned from. Repeated rows are rows like others; other columns
    are ignored; no rows give no rows.
    """
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = predicted(narrow, fit(docs, id_col, text_col, lang_col))
    return found.select(F.col("doc.id").alias("doc_id"), held_out(F.col("doc.id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows, with their own columns, whose language is known with a score of at least `least`."""
    found = predicted(docs, fit(docs, text_col=text_col), text_col)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("doc.*")
