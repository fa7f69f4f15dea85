"""Encoding and decoding with a word lexicon kept as a minimal acyclic transducer.

The corpus' frequent word parts are compiled, with their token ids, into an automaton whose states are
shared between words of equal endings. An arc carries how many words of its state come before it; their
sum along a word is the word's number, which finds its ids. The automaton is one file, sent to every
executor and memory-mapped there. A part that is not in it is merged by the vocabulary's merge rules.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import math
import mmap
import os
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewatch.llm.frames import stored, texts
from tidewatch.llm.wordbpe import PARTS, VISIBLE, VOCABULARY, Recent, plain

#: Word parts compiled into the automaton, and the longest of them; others are merged, with the same ids.
FREQUENT, LONGEST = 50_000, 64
#: Distinct parts a task counts before it passes the counts on.
COUNTED = 200_000


class Merges:
    """The vocabulary of a tokenizers file and its merge rules, applied exactly."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        pairs = (p if isinstance(p, list) else p.split(" ") for p in model["merges"])
        self.ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}

    def __call__(self, part: str) -> list[int]:
        """Ids of a part, in visible characters: of all adjacent pairs the one of least rank merges, leftmost first."""
        symbols = [*part[:-1], part[-1] + self.end]
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        rank = self.ranks.get
        heap = [(r, k) for k, pair in enumerate(zip(symbols, symbols[1:], strict=False)) if (r := rank(pair)) is not None]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            n = after[k]
            if symbols[k] is None or n >= len(symbols) or rank((symbols[k], symbols[n])) != r:
                continue
            symbols[k], symbols[n] = symbols[k] + symbols[n], None
            after[k] = after[n]
            if after[k] < len(symbols):
                before[after[k]] = k
                if (r := rank((symbols[k], symbols[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k))
            if before[k] >= 0 and (r := rank((symbols[before[k]], symbols[k]))) is not None:
                heapq.heappush(heap, (r, before[k]))
        return [self.ids[s] for s in symbols if s is not None]


def compiled(words: dict[bytes, list[int]]) -> bytes:
    """The file of a lexicon: words to ids, as a minimal acyclic automaton with numbered words.

    Words are added in order; once a word parts from the last one, the states that only the last one
    led through are final and are exchanged for an equal state met before, if there is one.
    """
    known: dict[tuple, int] = {}
    states: list[tuple[bool, list]] = []
    path: list[list] = [[False, []]]  # for each letter of the last word so far: ends a word, arcs

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            ends, arcs = path.pop()
            key = (ends, *map(tuple, arcs))
            if key not in known:
                known[key] = len(states)
                states.append((ends, arcs))
            path[-1][1][-1][1] = known[key]

    last = b""
    for word in sorted(words):
        shared = next((k for k, (a, b) in enumerate(zip(word, last, strict=False)) if a != b), min(len(word), len(last)))
        settle(shared)
        for letter in word[shared:]:
            path[-1][1].append([letter, None])
            path.append([False, []])
        path[-1][0] = True
        last = word
    settle(0)
    states.append(tuple(path[0]))

    below = [0] * len(states)  # words that end in or after a state; arcs lead to earlier states
    first, labels, targets, skips, ends = [0], bytearray(), [], [], []
    for k, (final, arcs) in enumerate(states):
        count = int(final)
        for letter, target in arcs:
            labels.append(letter)
            targets.append(target)
            skips.append(count)
            count += below[target]
        below[k] = count
        first.append(len(labels))
        ends.append(final)
    lists = [words[w] for w in sorted(words)]
    offsets = np.cumsum([0, *map(len, lists)])
    parts = [np.array(x, "<u4") for x in (first, targets, skips, ends, offsets, [i for ids in lists for i in ids])]
    head = np.array([len(x) for x in parts] + [len(labels)], "<u4")
    return b"".join([head.tobytes(), *(x.tobytes() for x in parts), bytes(labels)])


class Lexicon:
    """A compiled lexicon over mapped memory; nothing of it is copied when it is opened."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        whole = memoryview(self.data)
        head = whole[:28].cast("I").tolist()
        at, views = 28, []
        for n in head[:6]:
            views.append(whole[at:at + 4 * n].cast("I"))
            at += 4 * n
        self.first, self.targets, self.skips, self.ends, self.offsets, self.ids = views
        self.labels, self.root = at, len(self.ends) - 1

    def __call__(self, word: bytes) -> bytes | None:
        """Ids of a word as 32-bit integers, or None if the lexicon lacks it."""
        state, number = self.root, 0
        find, first, targets, skips, labels = self.data.find, self.first, self.targets, self.skips, self.labels
        for letter in word:
            arc = find(letter.to_bytes(), labels + first[state], labels + first[state + 1]) - labels
            if arc < 0:
                return None
            number += skips[arc]
            state = targets[arc]
        if not self.ends[state]:
            return None
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tobytes()


class Parts:
    """A text as word parts and special tokens, the latter as ids."""

    def __init__(self, library: Tokenizer):
        self.library = library
        self.special = {t.content: k for k, t in library.get_added_tokens_decoder().items()}

    def __call__(self, text: str) -> list[str | int]:
        low = plain(text)
        if low is not None:
            return [p if p.isascii() else p.encode().decode("latin-1").translate(VISIBLE) for p in PARTS.findall(low)]
        found: list[str | int] = []
        while text:
            at, token = min(((k, t) for t in self.special if (k := text.find(t)) >= 0), default=(len(text), ""))
            normal = self.library.normalizer.normalize_str(text[:at]) if at else ""
            found += [part for part, _ in self.library.pre_tokenizer.pre_tokenize_str(normal) if part] if normal else []
            found += [self.special[token]] if token else []
            text = text[at + len(token):]
        return found


class Codec:
    """Encodes and decodes with a lexicon and, for what it lacks, the merge rules."""

    def __init__(self, lexicon: str | None, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Tokenizer.from_file(vocabulary)
        self.parts, self.merges = Parts(library), Merges(vocabulary)
        self.lexicon = Lexicon(lexicon) if lexicon else None
        self.seen = Recent(self.part)
        names = {i: t for t, i in self.merges.ids.items()} | {i: t.content for i, t in library.get_added_tokens_decoder().items()}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]

    def part(self, part: str | int) -> bytes:
        if isinstance(part, int):
            return np.array([part], "<u4").tobytes()
        ids = self.lexicon(part.encode()) if self.lexicon else None
        return np.array(self.merges(part), "<u4").tobytes() if ids is None else ids

    def encode(self, text: str | None) -> bytes:
        return b"".join(map(self.seen.__getitem__, self.parts(text or "")))

    def decode(self, ids: bytes) -> str:
        """The tokens joined by a space, as the library decodes a vocabulary without a decoder."""
        return " ".join(map(self.names.__getitem__, memoryview(ids).cast("I")))


@functools.lru_cache(maxsize=2)
def codec(lexicon: str | None, vocabulary: str) -> Codec:
    """One codec for each worker process; the lexicon is the name of a file sent with the application."""
    return Codec(SparkFiles.get(lexicon) if lexicon else None, vocabulary)


def frequent(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None, most: int = FREQUENT) -> list[str]:
    """At most `most` word parts: all that are at least as frequent, over all whole texts, as a border.

    The border is found from how many parts have counts between powers of 1.1, a few hundred numbers;
    so no more than `most` parts reach the driver.
    """
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, counts = codec(None, path).parts, Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["part", "n"])
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    counts.update(p for p in parts(text.as_py()) if isinstance(p, str) and len(p) <= LONGEST)
                    if len(counts) > COUNTED:
                        yield out()
                        counts.clear()
        yield out()

    found = docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(counted, "part string, n long")
    words = stored(found.groupBy("part").agg(F.sum("n").alias("n")).withColumn("level", F.floor(F.log("n") / math.log(1.1)).cast("int")))
    border, total = None, 0
    for row in sorted(words.groupBy("level").count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        border = row["level"]
    return [] if border is None else [r["part"] for r in words.where(F.col("level") >= border).select("part").collect()]


def publish(spark: SparkSession, words: list[str], vocabulary: str | None = None) -> str:
    """Compiles the words and sends the file to all executors; returns its name there."""
    merges = Merges(vocabulary or public_tokenizers.path(VOCABULARY))
    name = f"lexicon-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(prefix="tidewatch-"), name)
    with open(path, "wb") as file:
        file.write(compiled({w.encode(): merges(w) for w in words}))
    spark.sparkContext.addFile(path)
    return name


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, most: int = FREQUENT) -> DataFrame:
    """id and ids (binary, little-endian 32-bit) of every row's whole text, without end or special ids added.

    Ids are those of the tokenizers library with add_special_tokens=False, truncation and padding
    unused; the strings of special tokens in a text become these tokens. A null text is empty. The
    lexicon only makes it faster: with any word list, an empty one too, the ids are the same. Null ids
    and repeated rows are rows like others; other columns are ignored; no rows give no rows.
    """
    lexicon = publish(docs.sparkSession, frequent(docs, text_col, vocabulary, most), vocabulary)
    path, rows = vocabulary or public_tokenizers.path(VOCABULARY), texts(docs, id_col, text_col)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(lexicon, path).encode
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([of(t.as_py()) for t in batch.column("text")], pa.binary())], ["id", "ids"])

    return rows.mapInArrow(encoded, f"id {rows.schema['id'].dataType.simpleString()}, ids binary")


def decode(rows: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """id and text of rows (id, ids), special tokens included; null ids are an empty text."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = codec(None, path).decode
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([of(t.as_py() or b"") for t in batch.column("ids")], pa.string())], ["id", "text"])

    return rows.select("id", "ids").mapInArrow(decoded, f"id {rows.schema['id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row, the ids decoded where they were made."""
    lexicon = publish(docs.sparkSession, frequent(docs))
    path, rows = public_tokenizers.path(VOCABULARY), texts(docs, "doc_id", "text")

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(lexicon, path)
        for batch in batches:
            ids = [own.encode(t.as_py()) for t in batch.column("text")]
            sha = lambda data: hashlib.sha256(data).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array([sha(i) for i in ids]),
                 pa.array([sha(own.decode(i).encode()) for i in ids])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(both, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
