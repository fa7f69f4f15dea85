"""Similarity join of word-shingle sets in the Jaccard metric: pivots, Voronoi regions, windows, recursion.

The Jaccard distance d (one minus similarity) is a metric, so documents within r of each other differ by at
most r in their distance to any pivot. Two sets within r also share one of their rarest shingles. In texts
almost all distances are near 1, so windows around pivots chosen at random would copy every document into
every region. The first regions are therefore laid around pivots that share a rare shingle: each shingle's
pivot is the smallest set that has it among its rarest, and a document lies in the regions of all its
pivots. Within a region distances to its pivot differ; a large region is split further, by Voronoi cells of
pivots of its own with windows of 2r, until cells are small enough to be joined exactly in a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.frames import stored, texts
from tidewatch.llm.simhash import Links
from tidewatch.llm.stars import components

#: Counters of shingles by leading bits of their hash: what a task is sent, however large the corpus.
LOAD_BITS = 18
#: Documents joined in one task; a region with more is split. Pivots a split tries. Cells of a dense block.
CELL = 512
PIVOTS = 16
#: Sets of a region that are held against one another by their histograms.
PRUNED = 4096
DENSE = 1 << 22
#: A cell that keeps more than this share of its region was not split by its pivots.
SHRINK = 0.8
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class _Hashes(dict):
    """64-bit hashes of words, filled as words appear."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(words: list[bytes], size: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words, of all words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        part = codes[k:len(codes) - span + 1 + k] * _MULTIPLIERS[k % 3]
        total = (total ^ (part ^ (part >> np.uint64(29)))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k)
    total ^= total >> np.uint64(32)
    total.sort()
    return total[np.concatenate(([True], total[1:] != total[:-1]))]


def _sets_in(batch: pa.RecordBatch, size: int, hashes: _Hashes) -> Iterator[np.ndarray]:
    for value in batch.column("text"):
        text = value.as_py()
        yield shingle_set(text.encode().lower().split() if text else [], size, hashes)
        if len(hashes) > 1 << 20:
            hashes.clear()


def _key(own: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None


def histogram(own: np.ndarray) -> np.ndarray:
    """Shingles under each value of the leading hash bits, 8 to 16 on average, 255 at most."""
    bits = max(4, math.ceil(math.log2(max(1, len(own)) / 16)))
    counts = np.bincount((own >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """One row per document: id, mark (a hash of the text), n (shingles of its set), key (128 bits of the set;
    null if empty), k (64 of them) and hist; and rows (bucket, load) that count shingles by their leading bits."""
    rows = texts(docs, id_col, text_col).select("id", F.xxhash64("text").alias("mark"), "text")
    kind = rows.schema["id"].dataType

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, loads, ids = _Hashes(), np.zeros(1 << LOAD_BITS, np.int64), None

        def out(columns: list[pa.Array]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(columns, ["id", "mark", "n", "key", "k", "hist", "bucket", "load"])

        for batch in batches:
            sizes, keys, hists, ids = [], [], [], batch.column("id").type
            for own in _sets_in(batch, size, hashes):
                sizes.append(len(own))
                keys.append(_key(own))
                hists.append(histogram(own).tobytes())
                np.add.at(loads, (own >> np.uint64(64 - LOAD_BITS)).astype(np.int64), 1)
            none = pa.nulls(batch.num_rows, pa.int64())
            heads = [None if key is None else int.from_bytes(key[:8], "little", signed=True) for key in keys]
            yield out([batch.column("id"), batch.column("mark"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                       pa.array(heads, pa.int64()), pa.array(hists, pa.binary()), none, none])
        at = np.flatnonzero(loads)
        if len(at):
            null = [pa.nulls(len(at), t) for t in (ids, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary())]
            yield out([*null, pa.array(at), pa.array(loads[at])])

    return rows.mapInArrow(of, f"id {kind.simpleString()}, mark long, n long, key binary, k long, hist binary, bucket long, load long")


def shingle_loads(rows: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall under each value of the leading hash bits; frequent ones stand out."""
    found = rows.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("load").alias("load")).toArrow()
    loads = np.zeros(1 << LOAD_BITS, np.int64)
    loads[found["bucket"].to_numpy()] = found["load"].to_numpy()
    return loads


def rare_shingles(docs: DataFrame, loads: np.ndarray, percent: int, id_col: str = "doc_id", text_col: str = "text",
                  size: int = 3) -> DataFrame:
    """(t, k): the rarest shingles of each set, as many as it may miss of a linked one and one more.

    Any order that is the same for all sets is exact; rare ones first keep regions small. Linked sets differ
    little in size (their distances to the empty set), so t is a shingle with a band of sizes, once for the
    set's own band and once for the next. Sets too small to be linked with any but an equal one give none.
    k, the head of a set's key, ranks sets as pivots.
    """
    known = docs.sparkSession.sparkContext.broadcast(loads)
    band = math.log(100 / percent) * (1 + 1e-6)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads, hashes = known.value, _Hashes()
        for batch in batches:
            tokens, keys = [], []
            for own in _sets_in(batch, size, hashes):
                if 100 * len(own) < percent * (len(own) + 1):
                    continue
                head = int.from_bytes(_key(own)[:8], "little", signed=True)
                lowest = int(math.log(len(own)) / band)
                take = len(own) + (-percent * len(own) // 100) + 1
                load = loads[(own >> np.uint64(64 - LOAD_BITS)).astype(np.int64)]
                if take < len(own):
                    # Ties at the border go by hash, as everywhere: own is sorted.
                    border = np.partition(load, take - 1)[take - 1]
                    less = np.flatnonzero(load < border)
                    own = np.concatenate((own[less], own[np.flatnonzero(load == border)[: take - len(less)]]))
                for step in (lowest, lowest + 1):
                    turned = np.uint64(step * int(_MULTIPLIERS[0]) % 2**64)
                    tokens.append((own ^ turned) * _MULTIPLIERS[1])
                keys.append(np.full(2 * len(own), head, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(keys))], ["t", "k"])

    return texts(docs, id_col, text_col).select("text").mapInArrow(of, "t long, k long")


def first_regions(tokens: DataFrame) -> DataFrame:
    """(cell, k) once each: the sets in the region of each pivot; regions of one set are left out.

    Pivots are written first: while they are few, Spark sends them to the tokens instead of sorting both.
    """
    pivots = stored(tokens.groupBy("t").agg(F.min("k").alias("cell"), F.max("k").alias("last")).where("cell < last").select("t", "cell"))
    return stored(tokens.join(pivots, "t").select("cell", "k").distinct())


def _may_link(sizes: np.ndarray, hists: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of a cell may be linked with another one of it.

    The counts of a histogram are a set's distances to the empty set within parts of all shingles, in the
    metric of the symmetric difference; by the triangle inequality their differences add up to at most the
    shingles that only one of two sets has. Sets are compared within the window of sizes, finer histograms
    being added up to the coarser ones.
    """
    order = np.argsort(sizes, kind="stable")
    sizes, hists = sizes[order], [hists[i] for i in order.tolist()]
    ends = np.searchsorted(sizes, sizes * 100 // percent, "right")
    widths = np.array([len(h) for h in hists])  # they grow with the sizes, twofold within a window at most
    met = np.zeros(len(sizes), bool)
    for width in np.unique(widths).tolist():
        at, end = np.searchsorted(widths, width), np.searchsorted(widths, 2 * width, "right")
        counts = np.stack([h.astype(np.int32).reshape(width, -1).sum(axis=1) for h in hists[at:end]])
        for i in range(at, int(np.searchsorted(widths, width, "right"))):
            others = np.arange(i + 1, ends[i])
            others = others[~met[others]] if met[i] else others
            if len(others):
                apart = np.abs(counts[others - at] - counts[i - at]).sum(axis=1)
                near = apart * (100 + percent) <= (100 - percent) * (sizes[i] + sizes[others])
                met[others[near]] = True
                met[i] |= bool(near.any())
    back = np.empty(len(met), bool)
    back[order] = met
    return back


def _streamed(rows: DataFrame, groups: list[str], solve, schema: str) -> DataFrame:
    """`solve` of each group as a table; a task streams its groups one after another, sorted by key within."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            change = np.zeros(max(table.num_rows - 1, 0), bool)
            for name in groups:
                mark = table[name].to_numpy()
                change |= mark[1:] != mark[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = table.slice(a, b - a)
                if held and any(held[0][name][0] != part[name][0] for name in groups):
                    yield solve(pa.concat_tables(held))
                    held = []
                held.append(part)
        if held:
            yield solve(pa.concat_tables(held))

    return rows.repartition(*groups).sortWithinPartitions(*groups, "key").mapInArrow(of, schema)


def likely_members(members: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """(cell, key) of the sets that histograms do not rule out; regions of more than PRUNED sets are kept whole."""
    sets = docs.select("k", "key", "n", "hist").dropDuplicates(["key"])
    rows = members.join(sets, "k").select("cell", "key", "n", "hist")
    counts = stored(members.groupBy("cell").count())
    large = counts.where(F.col("count") > PRUNED).select("cell")

    def solve(table: pa.Table) -> pa.RecordBatch:
        hists = [np.frombuffer(value.as_buffer(), np.uint8) for value in table["hist"]]
        on = np.flatnonzero(_may_link(table["n"].to_numpy(), hists, percent))
        return pa.RecordBatch.from_arrays([table[name].combine_chunks().take(pa.array(on)) for name in ("cell", "key")], ["cell", "key"])

    small = _streamed(rows.join(large, "cell", "left_anti"), ["cell"], solve, "cell long, key binary")
    return stored(small.unionByName(rows.join(large, "cell", "left_semi").select("cell", "key")))


class Sets:
    """Some sets as rows of a 0/1 matrix over the shingles that at least two of them have."""

    def __init__(self, grams: list[np.ndarray]):
        self.sizes = np.array([len(g) for g in grams], np.int64)
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(grams)), self.sizes)
        order = np.argsort(every, kind="stable")
        every, owner = every[order], owner[order]
        fresh = np.concatenate(([True], every[1:] != every[:-1]))[: len(every)]
        starts = np.flatnonzero(fresh)
        counts = np.diff(np.append(starts, len(every)))
        self.column = np.repeat(np.cumsum(counts > 1) - 1, counts)[np.repeat(counts > 1, counts)]
        self.owner = owner[np.repeat(counts > 1, counts)]
        self.width = int((counts > 1).sum())

    def shared(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Shingles that each of `left` shares with each of `right`, positions of sets."""
        total = np.zeros((len(left), len(right)), np.float64)
        if self.width == 0:
            return total
        row_l, row_r = np.full(len(self.sizes), -1), np.full(len(self.sizes), -1)
        row_l[left], row_r[right] = np.arange(len(left)), np.arange(len(right))
        step = max(1, DENSE // max(len(left), len(right)))
        for at in range(0, self.width, step):
            a, b = np.searchsorted(self.column, [at, at + step])
            column, owner = self.column[a:b] - at, self.owner[a:b]
            sides = []
            for rows, size in ((row_l, len(left)), (row_r, len(right))):
                side = np.zeros((size, min(step, self.width - at)), np.float32)
                mine = rows[owner] >= 0
                side[rows[owner[mine]], column[mine]] = 1
                sides.append(side)
            total += sides[0] @ sides[1].T
        return total

    def distances(self, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard distances, and which of the pairs link; the latter in whole numbers."""
        both = self.shared(left, right)
        union = self.sizes[left][:, None] + self.sizes[right][None, :] - both
        return 1 - both / union, 100 * both >= percent * union


def cell_links(grams: list[np.ndarray], labels: np.ndarray, home: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) that connect all linked sets of a cell, at most one for each set.

    Sets with one label are connected already; two guests are met in another cell. Sets are sorted by their
    distance to the first one, and only those within the window of each other are compared.
    """
    sets, links = Sets(grams), Links(len(grams))
    width = 1 - percent / 100 + 1e-9
    every = np.arange(len(grams))
    far, near = (x[:, 0] for x in sets.distances(every, every[:1], percent))
    first: dict = {}
    same = np.array([first.setdefault(label, i) for i, label in enumerate(labels.tolist())])
    links.add(every[same != every], same[same != every])
    met = near & (home | home[0]) & (every > 0)
    links.add(every[met], np.zeros(met.sum(), np.int64))
    order = np.argsort(far, kind="stable")
    distance = far[order]
    found = [(every[met], np.zeros(met.sum(), np.int64))]
    for at in range(0, len(order), 64):
        rows = order[at:at + 64]
        others = order[at + 1:np.searchsorted(distance, distance[min(at + 63, len(order) - 1)] + width, "right")]
        roots = links.root
        if len(others) == 0 or (np.concatenate((roots[rows], roots[others])) == roots[rows[0]]).all():
            continue
        _, near = sets.distances(rows, others, percent)
        i, j = np.nonzero(near & (home[rows][:, None] | home[others][None, :]))
        i, j = rows[i], others[j]
        apart = links.root[i] != links.root[j]
        i, j = i[apart], j[apart]
        found.append((i, j))
        links.add(i, j)
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return _forest(len(grams), i, j)


def _forest(size: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the pairs."""
    links = Links(size)
    links.add(i, j)
    tied = np.flatnonzero(links.root != np.arange(size))
    return tied, links.root[tied]


_EDGES = "u binary, v binary"
_STATE = ["cell", "key", "grams", "label", "home"]


def _sets_of(table: pa.Table | pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer(), np.uint64) for value in table.column("grams")]


def _edge_batch(keys: pa.Array, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([keys.take(pa.array(i)), keys.take(pa.array(j))], ["u", "v"])


def _joined_cells(state: DataFrame, groups: list[str], percent: int) -> DataFrame:
    """Edges (u, v) that connect the linked sets of each cell; cells are streamed one after another."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        labels = np.array([value.as_py() for value in table["label"]], object)
        home = table["home"].to_numpy()
        keys = table["key"].combine_chunks()
        return _edge_batch(keys, *cell_links(_sets_of(table), labels, home, percent))

    return _streamed(state.select(*dict.fromkeys([*groups, *_STATE])), groups, solve, _EDGES)


def _split(state: DataFrame, counts: DataFrame, percent: int, cell: int) -> DataFrame:
    """Voronoi cells of up to PIVOTS pivots for each region: rows of the new cells, and edges to pivots.

    A set is at home with its nearest pivot and a guest of each whose distance is at most 2r more: by the
    triangle inequality whatever it is linked with finds it there. Pivots lie more than 2r apart, so copies
    of one text get one pivot. A region is dealt to as many groups as its size asks for, each with all pivots.
    """
    width = 1 - percent / 100
    place = Window.partitionBy("cell").orderBy(F.desc("home"), F.desc(F.col("label") == F.col("key")), "key")
    pivots = state.withColumn("place", F.row_number().over(place)).where(F.col("place") <= PIVOTS).select(
        "cell", F.col("key").alias("pivot"), F.col("grams").alias("pivot_grams"))
    parts = counts.select("cell", F.ceil(F.col("rows") / cell).cast("int").alias("parts"))
    dealt = state.join(parts, "cell").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).drop("parts")
    sent = pivots.join(parts, "cell").select(
        F.col("cell").alias("sent_cell"), F.col("pivot").alias("sent_key"), F.col("pivot_grams").alias("sent_grams"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("sent_part"))

    def of(members: pa.Table, chosen: pa.Table) -> pa.Table:
        empty = pa.table({"parent": pa.array([], pa.int64()), "cell": pa.array([], pa.int64()), "key": pa.array([], pa.binary()),
                          "grams": pa.array([], pa.binary()), "label": pa.array([], pa.binary()), "home": pa.array([], pa.bool_())})
        if members.num_rows == 0 or chosen.num_rows == 0:
            return empty
        chosen = chosen.select(["sent_key", "sent_grams"]).rename_columns(["key", "grams"]).sort_by("key")
        every = Sets(_sets_of(chosen) + _sets_of(members))
        ranks, rows = np.arange(chosen.num_rows), np.arange(members.num_rows) + chosen.num_rows
        apart, _ = every.distances(ranks, ranks, percent)
        leaders: list[int] = []
        for rank in ranks.tolist():
            if (apart[rank, leaders] > 2 * width + 1e-9).all():
                leaders.append(rank)
        far, near = every.distances(rows, np.array(leaders), percent)
        own = far.argmin(axis=1)
        inside = far <= far.min(axis=1)[:, None] + 2 * width + 1e-9
        i, j = np.nonzero(inside)
        names = [chosen["key"][rank].as_py() for rank in leaders]
        parent = members["cell"][0].as_py()
        cells = np.array([xxhash.xxh3_64_intdigest(name, parent & (2**64 - 1)) for name in names], np.uint64).view(np.int64)
        labels = members["label"].combine_chunks()
        settled = near[i, j]
        label = pa.array([names[b] if s else labels[a].as_py() for a, b, s in zip(i.tolist(), j.tolist(), settled.tolist(), strict=True)], pa.binary())
        taken = members.take(pa.array(i))
        home = taken["home"].to_numpy() & (own[i] == j)
        a, b = np.nonzero(near)
        edges = pa.table({"parent": pa.array(np.full(len(a), parent)), "cell": pa.nulls(len(a), pa.int64()),
                          "key": members["key"].take(pa.array(a)).combine_chunks(), "grams": pa.nulls(len(a), pa.binary()),
                          "label": pa.array([names[x] for x in b.tolist()], pa.binary()), "home": pa.nulls(len(a), pa.bool_())})
        new = pa.table({"parent": pa.array(np.full(len(i), parent)), "cell": pa.array(cells[j]), "key": taken["key"].combine_chunks(),
                        "grams": taken["grams"].combine_chunks(), "label": label, "home": pa.array(home)})
        return pa.concat_tables([empty, new.cast(empty.schema), edges.cast(empty.schema)])

    grouped = dealt.groupBy("cell", "part").cogroup(sent.groupBy("sent_cell", "sent_part"))
    return grouped.applyInArrow(of, "parent long, cell long, key binary, grams binary, label binary, home boolean")


def _tiles(state: DataFrame, counts: DataFrame, cell: int) -> DataFrame:
    """Cells that pivots do not split, as all pairs of tiles of half a cell each: the exact rest."""
    parts = counts.select("cell", F.ceil(F.col("rows") * 2 / cell).cast("int").alias("parts"))
    dealt = state.join(parts, "cell").withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    every = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return every.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})


def set_links(docs: DataFrame, rows: DataFrame, percent: int = 90, cell: int = CELL, id_col: str = "doc_id",
              text_col: str = "text", size: int = 3) -> DataFrame:
    """Edges (u, v) of keys that connect all distinct sets with 100 * shared >= percent * union.

    `rows` are the stored `sketches` of `docs`. Whole sets are made again for the texts that may be linked
    alone. A star per group of linked sets is returned, not all pairs.
    """
    known = rows.where("bucket IS NULL AND key IS NOT NULL")
    tokens = rare_shingles(docs, shingle_loads(rows), percent, id_col, text_col, size)
    members = likely_members(first_regions(tokens), known, percent)
    needed = stored(known.join(members.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min("mark").alias("mark")))
    chosen = texts(docs, id_col, text_col).select("text").withColumn("mark", F.xxhash64("text")).join(needed.select("mark"), "mark", "left_semi")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for batch in batches:
            own = list(_sets_in(batch, size, hashes))
            yield pa.RecordBatch.from_arrays(
                [pa.array(map(_key, own), pa.binary()), pa.array([x.tobytes() for x in own], pa.binary())], ["key", "grams"])

    pool = stored(chosen.select("text").mapInArrow(whole, "key binary, grams binary").dropDuplicates(["key"]))
    state = members.join(pool, "key").select("cell", "key", "grams", F.col("key").alias("label"), F.lit(True).alias("home"))
    edges: list[DataFrame] = []
    before: DataFrame | None = None
    while True:
        counts = state.groupBy("cell").agg(
            F.count("*").alias("rows"), F.max("home").alias("some"), F.min("label").alias("low"), F.max("label").alias("high"))
        counts = counts.where("some AND low <> high").select("cell", "rows")
        if before is not None:
            parents = state.select("cell", "parent").distinct()
            counts = counts.join(parents, "cell").join(before.select(F.col("cell").alias("parent"), F.col("rows").alias("had")), "parent")
        else:
            counts = counts.withColumn("had", F.lit(None).cast("long"))
        counts = stored(counts)
        small, large = counts.where(F.col("rows") <= cell), counts.where(F.col("rows") > cell)
        edges.append(stored(_joined_cells(state.join(small.select("cell"), "cell", "left_semi"), ["cell"], percent)))
        if large.isEmpty():
            break
        whole = F.coalesce(F.col("rows") > SHRINK * F.col("had"), F.lit(False))
        stuck, large = large.where(whole), large.where(~whole)
        if not stuck.isEmpty():
            edges.append(stored(_joined_cells(_tiles(state.join(stuck.select("cell"), "cell", "left_semi"), stuck, cell), ["cell", "low", "high"], percent)))
        split = stored(_split(state.join(large.select("cell"), "cell", "left_semi").select(*_STATE), large, percent, cell))
        edges.append(split.where("cell IS NULL AND key <> label").select(F.col("key").alias("u"), F.col("label").alias("v")))
        state, before = split.where("cell IS NOT NULL"), large
    found = edges[0]
    for more in edges[1:]:
        found = found.union(more)
    return found


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, percent: int = 90,
                    cell: int = CELL) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable by links).

    A-Z are lower-cased; words are runs without space or control white space; a document's set holds its
    distinct shingles of `size` words, or its whole sequence if it has fewer words. Two documents link when
    100 * shared >= percent * union. A text without words, or null, has an empty set and is linked with
    nothing: component_id is its own id. Rows of equal sets are one class, joined once. component_id is null
    if no row of the component has an id. Repeated rows each give a row; other columns are ignored; no rows
    give no rows. Shingles count as equal when their 64-bit hashes are, sets when 128 bits of these are.
    """
    found = stored(sketches(docs, id_col, text_col, size))
    roots = components(set_links(docs, found, percent, cell, id_col, text_col, size)).select(F.col("node").alias("key"), "root")
    rows = found.where("bucket IS NULL").select("id", "n", "key").join(roots, "key", "left").select(
        "id", "n", F.coalesce("root", "key").alias("root"))
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.join(least, "root", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
