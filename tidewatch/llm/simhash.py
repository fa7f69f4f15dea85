"""Near-duplicate groups: 64-bit SimHash fingerprints, linked by a self-join of binary tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.frames import pick, stored, texts
from tidewatch.llm.stars import components

BITS = 64
#: Shingles whose bits are counted at once, and node pairs expanded at once: bounds of a task's memory.
CHUNK = 1 << 16
PAIRS = 1 << 20
#: Fingerprints in one trie; a larger group of equal leading bits is split by its next bits.
TRIE = 1 << 15
#: A fingerprint in one of its tries.
PIECES = pa.schema([("turn", pa.int32()), ("lead", pa.int64()), ("piece", pa.int64()), ("value", pa.int64()), ("guest", pa.bool_())])


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; repeats count."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1], ends[size - 1:]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], seed) for s, e in spans], "<u8")
        counts += np.add.reduce(np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(starts))
    return int(sum(1 << int(b) for b in set_bits))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id, mark (a hash of the text) and fp (the fingerprint as a signed long) of each row."""
    rows = texts(docs, id_col, text_col).select("id", F.xxhash64("text").alias("mark"), "text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = (t.as_py() for t in batch.column("text"))
            fps = np.fromiter((fingerprint(t.encode(), shingle) if t else 0 for t in whole), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), pa.array(fps.view(np.int64))], ["id", "mark", "fp"])

    return rows.mapInArrow(of, f"id {rows.schema['id'].dataType.simpleString()}, mark long, fp long")


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
    """Where the second child of each node [lo, hi) of the sorted values begins."""
    one = np.uint64(1) << np.uint64(bit)
    border = ((values[lo] >> np.uint64(bit)) | np.uint64(1)) << np.uint64(bit)
    whole = (values[lo] & one) != 0  # all values of the node lie in its second child
    return np.where(whole, lo, np.clip(np.searchsorted(values, border), lo, hi))


def trie_pairs(left: np.ndarray, right: np.ndarray | None, roots: tuple, bit: int, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of values that differ in at most `limit` bits, for the pairs of nodes in `roots`.

    A sorted array is a binary trie: a node is a stretch of it. Pairs of nodes (one of `left`, one of
    `right`, or both of `left`) go down a bit at a time; a step to different children adds a differing
    bit, and a pair beyond the limit is dropped with all below it. `roots` holds lo and hi of either
    node and the bits that differ so far; `bit` is the next bit. Open pairs are kept in pieces of at
    most PAIRS, so a dense trie takes time but no memory.
    """
    other = left if right is None else right
    stack = [(bit, roots)]
    while stack:
        bit, pairs = stack.pop()
        if len(pairs[0]) > PAIRS:
            stack += [(bit, tuple(x[at:at + PAIRS] for x in pairs)) for at in range(0, len(pairs[0]), PAIRS)]
            continue
        a, b, c, d, diff = pairs
        leaf = (b - a == 1) & (d - c == 1)
        if leaf.any():
            i, j = a[leaf], c[leaf]
            near = np.bitwise_count(left[i] ^ other[j]) <= limit
            yield i[near], j[near]
            a, b, c, d, diff = (x[~leaf] for x in pairs)
        if not len(a):
            continue
        m, n = _split(left, a, b, bit), _split(other, c, d, bit)
        below = []
        for p, q, r, s, step in ((a, m, c, n, 0), (m, b, n, d, 0), (a, m, n, d, 1), (m, b, c, n, 1)):
            keep = (p < q) & (r < s) & (diff + step <= limit)
            if right is None:  # of a node with itself one half, and no pair of a value with itself
                keep &= (p < r) | ((p == r) & (q - p > 1))
            below.append(tuple(x[keep] for x in (p, q, r, s, diff + step)))
        stack.append((bit - 1, tuple(np.concatenate(x) for x in zip(*below, strict=True))))


class Links:
    """Union of the nodes 0..n-1 by pairs, in arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (up := self.root[self.root]).tobytes() != self.root.tobytes():
                self.root = up


def _stars(members: np.ndarray, guests: np.ndarray, lead: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star for each group of linked values: (value, smallest value of its group here)."""
    members = np.unique(members)
    if len(members) == 0:
        return members, members
    low = BITS - lead
    heads = members >> np.uint64(low)
    lo = np.flatnonzero(np.concatenate(([True], heads[1:] != heads[:-1])))
    hi = np.append(lo[1:], len(members))
    several = hi - lo > 1
    links, zero = Links(len(members) + len(guests)), np.zeros(len(lo), np.int64)
    for i, j in trie_pairs(members, None, tuple(x[several] for x in (lo, hi, lo, hi, zero)), low - 1, limit):
        links.add(i, j)
    guests = np.unique(guests)
    if len(guests):
        first, last = np.searchsorted(guests >> np.uint64(low), heads[lo]), np.searchsorted(guests >> np.uint64(low), heads[lo], "right")
        met = first < last
        for i, j in trie_pairs(members, guests, tuple(x[met] for x in (lo, hi, first, last, zero)), low - 1, limit):
            links.add(i, j + len(members))
    every = np.concatenate((members, guests))
    root = links.root[: len(every)]
    tied = root != np.arange(len(every))
    return every[tied], every[root[tied]]


def links(fps: DataFrame, limit: int = 2, trie: int = TRIE) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints `fp` linked at `limit` or fewer differing bits.

    Of limit + 1 parts of a fingerprint at least one is equal in both of a linked pair. So each
    fingerprint goes into limit + 1 tries, turned so that one part leads, and is joined with those of
    equal leading part only; below it the join counts differing bits. A group with more than `trie`
    fingerprints is split by its next bits: each fingerprint is a member of its own piece, and a guest
    of every later piece whose bits differ from its own in `limit` places or fewer.

    A task returns one edge per linked fingerprint, not all pairs.
    """
    parts = limit + 1
    width = BITS // parts

    def turned(k: int) -> Column:
        by = k * width
        return F.col("fp") if by == 0 else F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", BITS - by))

    rows = fps.select(F.explode(F.array(*[F.struct(F.lit(k).alias("turn"), turned(k).alias("value")) for k in range(parts)])).alias("r")).select("r.*")
    rows = rows.withColumn("lead", F.shiftrightunsigned("value", BITS - width))
    large = (rows.groupBy("turn", "lead").count().where(F.col("count") > trie)
             .select("turn", "lead", F.least(F.ceil(F.log2(F.col("count") / trie)), F.lit(BITS - width - 1).cast("long")).cast("int").alias("deep")))
    rows = rows.join(large, ["turn", "lead"], "left").select("turn", "value", "lead", F.coalesce("deep", F.lit(0)).alias("deep"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turn, value, lead, deep = (batch.column(n).to_numpy() for n in ("turn", "value", "lead", "deep"))
            bits = value.view(np.uint64)
            out = [(turn, lead, np.zeros(len(turn), np.int64), value, np.zeros(len(turn), bool))]
            for e in np.unique(deep[deep > 0]):
                mine = deep == e
                piece = (bits[mine] >> np.uint64(BITS - width - int(e))) & np.uint64((1 << int(e)) - 1)
                out[0][2][mine] = piece.view(np.int64)
                for mask in _masks(int(e), limit):
                    guest = piece ^ np.uint64(mask)
                    on = guest > piece
                    out.append((turn[mine][on], lead[mine][on], guest[on].view(np.int64), value[mine][on], np.ones(on.sum(), bool)))
            for turn, lead, piece, value, guest in out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (turn, lead, piece, value, guest)], ["turn", "lead", "piece", "value", "guest"])

    pieces = rows.mapInArrow(dealt, "turn int, lead long, piece long, value long, guest boolean").repartition("turn", "lead", "piece")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), PIECES)
        turn, value, guest, piece = (table.column(n).to_numpy() for n in ("turn", "value", "guest", "piece"))
        bits = value.view(np.uint64)
        for k in np.unique(turn):
            here = turn == k
            plain = here & (piece == 0) & ~guest
            jobs = [(bits[plain], bits[:0])] if plain.any() else []
            jobs += [(bits[here & (piece == p) & ~guest], bits[here & (piece == p) & guest]) for p in np.unique(piece[here & (piece != 0)])]
            for members, guests in jobs:
                u, v = _stars(members, guests, width, limit)
                back = np.uint64(int(k) * width)
                if k:
                    u, v = ((x >> back) | (x << (np.uint64(BITS) - back)) for x in (u, v))
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (u, v)], ["u", "v"])

    return pieces.mapInArrow(joined, "u long, v long")


def _masks(bits: int, limit: int) -> list[int]:
    """Numbers of up to `limit` set bits out of `bits`, none not among them."""
    found = {0}
    for _ in range(limit):
        found |= {m | 1 << b for m in found for b in range(bits)}
    return sorted(found - {0})


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2, trie: int = TRIE) -> DataFrame:
    """id, mark, fp of each row and root, one fingerprint that stands for its class."""
    rows = stored(fingerprints(docs, id_col, text_col))
    roots = components(links(rows.select("fp").distinct(), limit, trie))
    return rows.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("id", "mark", "fp", F.coalesce("root", "fp").alias("root"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2, trie: int = TRIE) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable).

    A-Z are lower-cased; words are runs without space or control white space; shingles are three
    words joined by a space, all words if there are fewer. A text without a word, or null, has the
    fingerprint zero and is linked like any other. Fingerprints link at `limit` or fewer differing
    bits. component_id is null if no row of the component has an id. Repeated rows and rows of one id
    with different texts are rows of their own. Other columns are ignored; no rows give no rows.
    """
    rows = classes(docs, id_col, text_col, limit, trie)
    least = rows.groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.join(least, "root").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 2) -> DataFrame:
    """The rows, with all columns, that stand for their component: the one of the smallest id.

    Null ids come last; of one id with several texts the one with the smallest hash stays, and of
    repeated rows one.
    """
    place = F.struct(F.col("id").isNull().alias("nameless"), "id", "mark")
    chosen = classes(docs, id_col, text_col, limit).groupBy("root").agg(F.min(place).alias("p")).select("p.id", "p.mark")
    return pick(docs, chosen, id_col, F.xxhash64(F.col(f"`{text_col}`").cast("string")))
