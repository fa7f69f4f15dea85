"""Main text of web pages: what a host repeats from page to page is told from what is a page's own."""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages of a host looked at together, on average; hosts with more are split by a hash of the page. The
#: list of such hosts has at most SPLIT entries, as the number grows once there are more pages than their product.
TOGETHER, SPLIT = 500, 1_000_000
#: Runs of words of such a host are counted in at most so many parts, by their hashes. Bits of a hash that are sent first, for each
#: part: with those, about one run in twenty that no other share has is sent whole in vain.
PARTS, BITS = 1024, 22
#: Words of the shortest repeat; a power of two, as ranks double.
REPEAT = 8
#: Share of a page's own words that makes an element its body: one that says it is, and any other.
DECLARED, OTHER = 0.5, 0.9
#: A class, id or form that holds more than MOST of the page's own words marks nothing, unless a body beside it has BESIDE of all words.
MOST, BESIDE = 0.5, 0.1
#: A run on at most FEW pages or, if that is more, this SHARE of the host's may be a copied text, one on more is boilerplate.
FEW, SHARE = 10, 0.02
#: A page is a copy if this share of its words is on few pages; the second if these may be most of the host's.
COPY, SURE = 0.5, 0.9

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title|svg|math|iframe|object|select|textarea|button)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*>|</?[a-z][^>]*>", re.IGNORECASE | re.DOTALL)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.IGNORECASE)

#: Elements of HTML by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
BODIES = {"article", "main"}
HOLDERS = BODIES | set("body div section td".split())
MARKED = set("nav footer aside dialog menu".split())
#: Their classes and ids tell of the layout or of what the whole page has.
WHOLE = BODIES | set("html head body".split())
#: Words of classes, ids and roles that mark what is no main text.
WORDS = set("ad ads advert advertisement adverts advertising sponsor sponsored promo promotion menu nav navbar navigation breadcrumb "
            "breadcrumbs sidebar footer cookie cookies consent gdpr notice popup modal newsletter subscribe subscription share sharing social "
            "comment comments disqus respond replies related recommended widget login signup search pagination pager skip toolbar "
            "contentinfo complementary banner alert dialog hidden".split())
#: Those that do so outside an article only: an article's own header has its title.
HEADERS = {"header", "masthead"}
#: A class that begins so tells what an element has or is like.
STATES = set("has have with without no not is show hide".split())
LETTERS = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    """Text between two borders of blocks, the elements it is in that can be a body, whether it is marked, and
    the elements it is in that are marked unless they hold most of the page."""

    words: list[str]
    inside: tuple[int, ...]
    marked: bool
    named: tuple[int, ...] = ()


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    #: For each element that can be a body: whether it says so.
    declared: list[bool] = field(default_factory=list)


def parts(name: str) -> set[str]:
    """First and last word of a class or id, without modifiers; none if it tells of a state."""
    words = LETTERS.findall(name.split("--")[0].rsplit("__", 1)[-1])
    return {words[0], words[-1]} if words and words[0] not in STATES else set()


def marks(name: str, attributes: str, in_body: bool) -> tuple[bool, bool]:
    """Whether an element is no main text by what it is, and whether its class or id says so or it is a form."""
    if name in MARKED or (name == "header" and not in_body):
        return True, False
    words: set[str] = set()
    for key, value in ATTRIBUTE.findall(attributes or ""):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
            return True, False
        if key in ("class", "id", "role"):
            words.update(*map(parts, value.split()))
    return False, name not in WHOLE and (name == "form" or bool(words & WORDS) or (not in_body and bool(words & HEADERS)))


def parse(source: str) -> Page:
    """Blocks of a page in order, character references decoded; comments, scripts and the like left out."""
    page, pieces = Page(), []
    open_: list[tuple[str, bool, int, int]] = []  # name, marked by itself or above, number as a holder or -1, number as named or -1
    at = named = 0

    def close() -> None:
        words = "".join(pieces).split()
        pieces.clear()
        if words:
            page.blocks.append(Block(words, tuple(n for _, _, n, _ in open_ if n >= 0), bool(open_) and open_[-1][1],
                                     tuple(m for *_, m in open_ if m >= 0)))

    def text(piece: str) -> None:
        if piece:
            pieces.append(html.unescape(piece) if "&" in piece else piece)

    for tag in TAG.finditer(source):
        text(source[at:tag.start()])
        at = tag.end()
        name = (tag[3] or "").lower()
        if not name:
            if tag[1] and tag[1].lower() not in ("svg", "math", "button"):
                close()
            continue
        if name not in INLINE:
            close()
        if name in VOID:
            continue
        if tag[2]:
            depth = next((k for k in range(len(open_) - 1, -1, -1) if open_[k][0] == name), None)
            if depth is not None:
                del open_[depth:]
            continue
        if open_ and open_[-1][0] == "p" and name not in INLINE:
            open_.pop()
        in_body = any(n >= 0 and page.declared[n] for _, _, n, _ in open_)
        marked, by_name = marks(name, tag[4], in_body)
        holder = -1
        if name in HOLDERS or re.search(r"role\s*=\s*[\"']?main", tag[4]):
            holder = len(page.declared)
            page.declared.append(name in BODIES or name not in HOLDERS or "main" in tag[4].lower() and "role" in tag[4].lower())
        if not tag[4].rstrip().endswith("/"):
            named += by_name
            open_.append((name, marked or (bool(open_) and open_[-1][1]), holder, named - 1 if by_name else -1))
    text(source[at:])
    close()
    return page


def repeated(pages: list[Page], size: int = REPEAT) -> list[np.ndarray]:
    """For each page which words lie in runs of at least `size` words that another page has too."""
    return [n > 1 for n in spread(pages, size)]


def spread(pages: list[Page], size: int = REPEAT, known: tuple[np.ndarray, np.ndarray] | None = None) -> list[np.ndarray]:
    """For each word of each page: on how many pages a run of `size` words is that it lies in, the most of them.

    The pages' words, one after another, are sorted by the `size` words that begin at each: a suffix
    array as deep as is needed. Ranks of one word are doubled to two, four and so on; suffixes of
    equal rank stand together, and the pages they begin on are counted.

    If the pages are a share of a host's, `known` gives the runs that other shares have too: their
    hashes in order, and on how many of the host's pages each is.
    """
    stream = Stream.of([[w for b in p.blocks for w in b.words] for p in pages])
    lengths, page_of = stream.lengths, stream.page_of
    # Between pages stands a number that no other place has, so no repeat runs from page to page.
    rank = stream.numbers() + len(pages)
    for width in (1 << k for k in range(size.bit_length() - 1)):
        after = np.zeros(len(rank), np.int64)
        after[:-width] = rank[width:] + 1
        rank = np.unique(rank * (int(after.max()) + 1) + after, return_inverse=True)[1].reshape(-1)
    suffixes = np.argsort(rank, kind="stable")
    starts = np.flatnonzero(np.diff(rank[suffixes], prepend=-1))
    first = np.diff(page_of[suffixes], prepend=-1) != 0  # stable: the pages of each come in order
    first[starts] = True
    n_pages = np.add.reduceat(first.astype(np.int64), starts)[rank] if len(starts) else np.zeros(0, np.int64)
    if known is not None and len(known[0]):
        hashes, at = stream.runs(size)
        place = np.minimum(np.searchsorted(known[0], hashes), len(known[0]) - 1)
        met = known[0][place] == hashes
        n_pages[at[met]] = known[1][place[met]]
    most = n_pages.copy()
    for k in range(1, size):
        np.maximum(most[k:], n_pages[:-k], out=most[k:])
    borders = np.cumsum(lengths + 1)
    return [most[end - n - 1:end - 1] for end, n in zip(borders.tolist(), lengths.tolist(), strict=True)]


@dataclass
class Stream:
    """The words of pages, one after another, with one place more after each page."""

    #: The words; for each page how many it has; for each word its place, for each place its page and whether a word is there.
    words: list[str]
    lengths: np.ndarray
    at: np.ndarray
    page_of: np.ndarray
    filled: np.ndarray

    @classmethod
    def of(cls, pages: list[list[str]]) -> Stream:
        lengths = np.array(list(map(len, pages)), np.int64)
        at = np.arange(lengths.sum()) + np.repeat(np.arange(len(pages)), lengths)
        filled = np.zeros(len(at) + len(pages), bool)
        filled[at] = True
        return cls([w for own in pages for w in own], lengths, at, np.repeat(np.arange(len(pages)), lengths + 1), filled)

    def numbers(self) -> np.ndarray:
        """Equal numbers from 0 for equal words, and after each page one below 0 that no other place has."""
        numbers = -1 - self.page_of
        numbers[self.at] = pa.array(self.words, pa.string()).dictionary_encode().indices.to_numpy()
        return numbers

    def runs(self, size: int = REPEAT) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of the runs of `size` words of a page, and the places where they begin."""
        each = np.zeros(len(self.filled), np.uint64)
        each[self.at] = pd.util.hash_array(np.array(self.words, object), categorize=False)
        count = max(len(each) - size + 1, 0)
        hashes, whole = np.zeros(count, np.uint64), np.ones(count, bool)
        for k in range(size):
            hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + each[k:k + count]
            whole &= self.filled[k:k + count]
        hashes = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(29)
        at = np.flatnonzero(whole)
        return hashes[at], at


def on_pages(words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of pages, each once and in order, and on how many of the pages each is."""
    stream = Stream.of(words)
    hashes, at = stream.runs()
    order = np.argsort(hashes, kind="stable")  # stable: the pages of each come in order
    hashes, pages = hashes[order], stream.page_of[at[order]]
    new = np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)]
    starts = np.flatnonzero(new)
    first = new | np.append(True, pages[1:] != pages[:-1])[:len(hashes)]
    return hashes[starts], np.add.reduceat(first.astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)


def short(hashes: np.ndarray, shares: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The places of the hashes of each part, for a host of so many shares, and the bits of all hashes that are sent first."""
    parts = min(shares, PARTS)
    bits = BITS + (-(-shares // parts) - 1).bit_length()
    part = ((hashes >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
    places = np.split(np.argsort(part, kind="stable"), np.cumsum(np.bincount(part, minlength=parts))[:-1])
    return places, hashes & np.uint64((1 << bits) - 1)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers in order as what each is more than the one before: first bytes, second bytes and so on, compressed."""
    steps = np.diff(numbers.astype("<u8"), prepend=np.zeros(1, "<u8"))
    wide = (int(steps.max()).bit_length() + 7) // 8 if len(steps) else 0
    return bytes([wide]) + len(steps).to_bytes(8, "little") + zlib.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T[:wide]).tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    wide, count = data[0], int.from_bytes(data[1:9], "little")
    steps = np.zeros((count, 8), np.uint8)
    steps[:, :wide] = np.frombuffer(zlib.decompress(data[9:]), np.uint8).reshape(wide, count).T
    return np.cumsum(steps.view("<u8").reshape(-1), dtype=np.uint64)


def joined(arrays: list[np.ndarray], kind: type = np.uint64) -> np.ndarray:
    return np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)


def in_several(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of numbers that no array has twice: all in order, in how many arrays each is, and the place in these of each given."""
    values, place, count = np.unique(joined(arrays), return_inverse=True, return_counts=True)
    return values, count, place.reshape(-1)


def left_marked(page: Page, own: list[int]) -> list[bool]:
    """For each block whether it is marked, given its own words: a named element that holds most of the page is its layout.

    Outer elements come first. One with more than MOST of the own words stays marked only if there is
    a declared body outside it that is not marked and has BESIDE of all words, repeated or not.
    """
    named = [set() if b.marked else set(b.named) for b in page.blocks]
    words = sum(len(b.words) for b in page.blocks if not b.marked)
    total = sum(n for b, n in zip(page.blocks, own, strict=True) if not b.marked)
    for e in sorted(set().union(*named)):
        if sum(n for names, n in zip(named, own, strict=True) if e in names) > MOST * total:
            beside = sum(len(b.words) for b, names in zip(page.blocks, named, strict=True)
                         if not b.marked and not names and any(page.declared[k] for k in b.inside))
            if beside < BESIDE * words:
                for names in named:
                    names.discard(e)
    return [b.marked or bool(names) for b, names in zip(page.blocks, named, strict=True)]


def main_text(page: Page, covered: np.ndarray, n_pages: np.ndarray | None = None, of: int = 1) -> str:
    """The text of the element that holds most of the page's own words.

    Own words are those of unmarked blocks that no other page repeats. Given on how many pages `of` the
    host a word is repeated, words on few of them are own ones too where the page is a copy, and within
    elements that say they are a body; on a page without own words, all of its unmarked blocks are.
    Of elements that say they are a body the first with a DECLARED share of them is taken, whole but
    for marked blocks, as articles may share passages. If there is none, the innermost element with an
    OTHER share is taken without the words that other pages repeat.
    """
    edges = np.cumsum([0, *(len(b.words) for b in page.blocks)])
    count = lambda which: np.diff(np.append(0, np.cumsum(which))[edges])
    few = covered & (n_pages <= max(FEW, SHARE * of)) if n_pages is not None else np.zeros(len(covered), bool)
    fewer = few & (2 * n_pages <= of) if n_pages is not None else few
    marked = np.array(left_marked(page, count(~covered | fewer).tolist()), bool)
    unmarked = np.repeat(~marked, np.diff(edges))
    own = ~covered & unmarked
    for copied, share in ((fewer, COPY), (few, SURE)):
        if (copied & unmarked).any() and (copied & unmarked).sum() >= share * ((copied | ~covered) & unmarked).sum():
            own |= copied & unmarked
    if not own.any():
        own = unmarked
    said = np.array([any(page.declared[k] for k in b.inside) for b in page.blocks], bool)

    def weigh(words: np.ndarray) -> tuple[list[int], int]:
        weight, each = [0] * len(page.declared), count(words).tolist()
        for block, n in zip(page.blocks, each, strict=True):
            for k in block.inside:
                weight[k] += n
        return weight, sum(each)

    weight, total = weigh(own | (few & unmarked & np.repeat(said, np.diff(edges))))
    bodies = [k for k, said in enumerate(page.declared) if said and total and weight[k] >= DECLARED * total]
    if bodies:
        kept = [w for b, m in zip(page.blocks, marked, strict=True) if not m and bodies[0] in b.inside for w in b.words]
        return " ".join(kept)
    weight, total = weigh(own)
    others = [k for k in range(len(weight)) if total and weight[k] >= OTHER * total]
    body = others[-1] if others else None
    kept = [w for b, a, z in zip(page.blocks, edges[:-1], edges[1:], strict=True) if body is None or body in b.inside
            for w, its in zip(b.words, own[a:z].tolist(), strict=True) if its]
    return " ".join(kept)


def written(page: Page) -> bytes:
    """A page as its words and, in JSON, its layout, compressed."""
    layout = [list(map(int, page.declared)), [[len(b.words), b.inside, int(b.marked), b.named] for b in page.blocks]]
    return zlib.compress(f"{json.dumps(layout, separators=(',', ':'))}\n{' '.join(w for b in page.blocks for w in b.words)}".encode(), 1)


def halves(data: bytes) -> tuple[str, list[str]]:
    """The layout of a written page, and its words, none of which is empty or has white space in it."""
    layout, _, words = zlib.decompress(data).decode().partition("\n")
    return layout, words.split(" ") if words else []


def read(data: bytes) -> Page:
    layout, words = halves(data)
    declared, blocks = json.loads(layout)
    page, at = Page([], [bool(d) for d in declared]), 0
    for n, inside, marked, named in blocks:
        page.blocks.append(Block(words[at:at + n], tuple(inside), bool(marked), tuple(named)))
        at += n
    return page


def counted_across(dealt: DataFrame) -> DataFrame:
    """The runs of words that several shares of a host have: host, share, hashes in order and on how many pages of the host each is.

    Shares send a few bits of the hashes of their runs first, and whole hashes only of those whose bits
    another share has sent, too. Either is met by (host, part of the hashes), so no task gets a whole host.
    """
    def offered(table: pa.Table) -> pa.Table:
        rows, shares = [], table.column("shares")[0].as_py()
        if shares > 1:
            own = {"host": table.column("host")[0].as_py(), "share": table.column("share")[0].as_py()}
            places, bits = short(on_pages([halves(p)[1] for p in table.column("page").to_pylist()])[0], shares)
            rows = [own | {"part": k, "bits": packed(np.unique(bits[at]))} for k, at in enumerate(places) if len(at)]
        return pa.Table.from_pylist(rows, pa.schema([("host", pa.string()), ("part", pa.int64()), ("share", pa.int64()), ("bits", pa.binary())]))

    def met(table: pa.Table) -> pa.Table:
        sent = [unpacked(b) for b in table.column("bits").to_pylist()]
        _, count, place = in_several(sent)
        ends = np.cumsum([len(s) for s in sent])
        kept = [packed(s[count[place[end - len(s):end]] > 1]) for s, end in zip(sent, ends, strict=True)]
        return pa.table({"host": table.column("host"), "part": table.column("part"), "share": table.column("share"), "bits": pa.array(kept, pa.binary())})

    def whole(pages: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = []
        if len(pages) and len(wanted):
            own = {"host": pages.column("host")[0].as_py(), "share": pages.column("share")[0].as_py()}
            hashes, counts = on_pages([halves(p)[1] for p in pages.column("page").to_pylist()])
            places, bits = short(hashes, pages.column("shares")[0].as_py())
            for k, sent in zip(wanted.column("part").to_pylist(), wanted.column("bits").to_pylist(), strict=True):
                at = places[k][np.isin(bits[places[k]], unpacked(sent))]
                if len(at):
                    rows.append(own | {"part": k, "hashes": packed(hashes[at]), "counts": counts[at].astype("<u4").tobytes()})
        return pa.Table.from_pylist(rows, pa.schema([("host", pa.string()), ("part", pa.int64()), ("share", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]))

    def summed(table: pa.Table) -> pa.Table:
        sent = [unpacked(h) for h in table.column("hashes").to_pylist()]
        _, count, place = in_several(sent)
        own = joined([np.frombuffer(c, "<u4") for c in table.column("counts").to_pylist()], np.int64)
        total = np.zeros(len(count), np.int64)
        np.add.at(total, place, own)
        ends, hashes, counts = np.cumsum([len(s) for s in sent]), [], []
        for s, end in zip(sent, ends, strict=True):
            at = place[end - len(s):end]
            shared = count[at] > 1
            hashes.append(packed(s[shared]))
            counts.append(total[at[shared]].astype("<u8").tobytes())
        return pa.table({"host": table.column("host"), "share": table.column("share"), "hashes": pa.array(hashes, pa.binary()), "counts": pa.array(counts, pa.binary())})

    by_share = dealt.groupBy("host", "share")
    wanted = by_share.applyInArrow(offered, "host string, part long, share long, bits binary").groupBy("host", "part").applyInArrow(
        met, "host string, part long, share long, bits binary")
    sent = by_share.cogroup(wanted.groupBy("host", "share")).applyInArrow(whole, "host string, part long, share long, hashes binary, counts binary")
    return sent.groupBy("host", "part").applyInArrow(summed, "host string, share long, hashes binary, counts binary")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (main text, empty if there is none) and n_chars.

    Pages of one host are looked at together: their words form one stream, a suffix array finds the
    runs that distinct pages share, and what is left of a page points to the element that is its body.
    A host with more than TOGETHER pages is split by a hash of the page; runs that several shares have
    are counted over the whole host, so that a split changes no result.

    A null html is empty. A null or odd url has the host ''. Null ids and repeated rows are pages of
    their own. Other columns are ignored; no rows give no rows.
    """
    host = F.lower(F.coalesce(F.regexp_extract(F.col(f"`{url_col}`").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html"), host.alias("host"))
    # No more than SPLIT hosts can have more pages than this.
    size = max(TOGETHER, -(-rows.select("host").count() // SPLIT))
    large = rows.groupBy("host").count().where(F.col("count") > size).select("host", F.col("count").alias("on_host"), F.ceil(F.col("count") / size).alias("shares"))
    mark = F.xxhash64("page_id", "url", "html")
    dealt = rows.join(F.broadcast(large), "host", "left").select(
        "page_id", "url", "html", "host", F.coalesce(F.pmod(mark, F.col("shares")), F.lit(0)).alias("share"),
        F.coalesce("shares", F.lit(1).cast("long")).alias("shares"), F.coalesce("on_host", F.lit(0).cast("long")).alias("on_host"))
    kind = rows.schema["page_id"].dataType.simpleString()

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page = pa.array([written(parse(t.as_py() or "")) for t in batch.column("html")], pa.binary())
            yield pa.RecordBatch.from_arrays([page if c == "html" else batch.column(c) for c in batch.schema.names], ["page" if c == "html" else c for c in batch.schema.names])

    def found(table: pa.Table, known: pa.Table | None = None) -> pa.Table:
        of = max(len(table), table.column("on_host")[0].as_py()) if len(table) else 0
        hashes = counts = None
        if known is not None and len(known):
            hashes = joined([unpacked(h) for h in known.column("hashes").to_pylist()])
            counts = joined([np.frombuffer(c, "<u8") for c in known.column("counts").to_pylist()], np.int64)
            order = np.argsort(hashes)
            hashes, counts = hashes[order], counts[order]
        own = list(map(read, table.column("page").to_pylist()))
        texts = [main_text(p, n > 1, n, of) for p, n in zip(own, spread(own, known=None if hashes is None else (hashes, counts)), strict=True)]
        return pa.table({"page_id": table.column("page_id"), "url": table.column("url"), "text": pa.array(texts, pa.string()),
                         "n_chars": pa.array(list(map(len, texts)), pa.int64())})

    result = f"page_id {kind}, url string, text string, n_chars long"
    dealt = dealt.mapInArrow(parsed, f"page_id {kind}, url string, page binary, host string, share long, shares long, on_host long")
    by_share = dealt.groupBy("host", "share")
    if large.isEmpty():
        return by_share.applyInArrow(lambda table: found(table), result)
    return by_share.cogroup(counted_across(dealt).groupBy("host", "share")).applyInArrow(lambda pages, known: found(pages, known), result)
