"""Large spools: judged and cut into small snapshots in the reader, without ever being held whole.

A spool is JSON text in a string of JSON text, its queue an array of any length. Both are walked block by block: a
first pass takes the checksum and judges every member by the rules of `snapshots`, and remembers where in the data the
queued items stand; a second one gives them out, some megabytes at a time, as snapshots of their own.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import ROUND_HALF_UP, Decimal
from json.decoder import scanstring

from tidewatch import fixed

#: Bytes read at a time, characters of the items in one piece.
BLOCK, PIECE = 1 << 20, 1 << 22
#: Characters of one text within the data that Spark's parser of variants takes.
LONGEST_TEXT = 20_000_000
_SPACE = re.compile(r"[ \t\n\r]*")
_HIGH = re.compile(r"\\u[dD][89abAB][0-9a-fA-F]{2}")
_VERSION = re.compile(r"1(\.0+)?\Z")
#: An escape, or half a character in two escapes, is no longer than this; nor is a word or the end of a number.
_CUT = 12


class Broken(ValueError):
    """The text is no JSON, or none that Spark takes."""


class _Unreadable(Exception):
    """The text around the data is no JSON."""


def _refused(name: str):
    raise Broken(name)


_AROUND = json.JSONDecoder()
_DATA = json.JSONDecoder(parse_float=Decimal, parse_constant=_refused)


def blocks_of(stream, size: int = BLOCK) -> Iterator[str]:
    """The text of a stream of UTF-8, some of it at a time."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    while raw := stream.read(size):
        yield decoder.decode(raw)
    yield decoder.decode(b"", True)


class _Text:
    """JSON text that comes in blocks; only what is not yet read is held."""

    def __init__(self, blocks: Iterator[str], decoder: json.JSONDecoder):
        self.blocks, self.decoder = blocks, decoder
        #: The text held, the place reached in it, and how much was before it.
        self.held, self.at, self.gone = "", 0, 0

    def more(self, least: int = 1) -> bool:
        """Hold at least so much more, and as much again as is unread; False at the end."""
        fresh, length, wanted = [], 0, max(least, len(self.held) - self.at)
        for block in self.blocks:
            fresh.append(block)
            length += len(block)
            if length >= wanted:
                break
        if not length:
            return False
        self.held = self.held[self.at:] + "".join(fresh)
        self.gone, self.at = self.gone + self.at, 0
        return True

    def next(self) -> str:
        """The next character that is no white space, which stays; empty at the end."""
        while True:
            self.at = _SPACE.match(self.held, self.at).end()
            if self.at < len(self.held):
                return self.held[self.at]
            if not self.more():
                return ""

    def take(self, characters: str) -> str:
        found = self.next()
        if not found or found not in characters:
            raise Broken(f"one of {characters} expected")
        self.at += 1
        return found

    def value(self) -> tuple[object, str]:
        """The value that begins here, and its text."""
        self.next()
        while True:
            try:
                found, end = self.decoder.raw_decode(self.held, self.at)
            except json.JSONDecodeError as error:
                open_end = error.msg.startswith("Unterminated") or error.pos > len(self.held) - _CUT
                if open_end and self.more():
                    continue
                raise
            if end > len(self.held) - _CUT and self.more():
                continue
            text = self.held[self.at:end]
            self.at = end
            if len(text) > LONGEST_TEXT and self.decoder is _DATA:
                _fits(found)
            return found, text

    def members(self) -> Iterator[str]:
        """The names of the object that begins here; the caller reads the value after each."""
        self.take("{")
        if self.next() == "}":
            self.at += 1
            return
        while True:
            if self.next() != '"':
                raise Broken("a name expected")
            name = self.value()[0]
            self.take(":")
            yield name
            if self.take(",}") == "}":
                return

    def elements(self, piece: int = PIECE) -> Iterator[tuple[list, int, int]]:
        """The elements of the array that begins here, some at a time, with where their text begins and ends."""
        self.take("[")
        if self.next() == "]":
            self.at += 1
            return
        while True:
            self.next()
            while len(self.held) - self.at < piece and self.more(piece):
                pass
            begin = self.gone + self.at
            found = self._many(piece)
            end = self.gone + self.at
            if not found:
                while True:
                    found.append(self.value()[0])
                    end = self.gone + self.at
                    if end - begin >= piece or self.next() != ",":
                        break
                    self.at += 1
            yield found, begin, end
            if self.take(",]") == "]":
                return

    def _many(self, piece: int) -> list:
        """As many whole elements as `piece` characters hold, none where no cut is sure to be between two.

        Text is read from left to right, so a cut is right if what is before it makes an array.
        """
        for between in ("},{", "}, {"):
            cut = self.held.rfind(between, self.at, self.at + piece) + 1
            if cut:
                try:
                    found = self.decoder.decode(f"[{self.held[self.at:cut]}]")
                except ValueError:
                    continue
                self.at = cut
                return found
        return []

    def string(self) -> Iterator[str]:
        """The string that begins here, some of it at a time."""
        self.take('"')
        while True:
            cut = self._cut()
            if cut > self.at:
                text, end = scanstring(self.held[self.at:cut] + '"', 0, True)
                ended = end <= cut - self.at
                self.at = self.at + end if ended else cut
            elif self.more():
                continue
            else:
                text, self.at = scanstring(self.held, self.at, True)
                ended = True
            yield text
            if ended:
                return

    def _cut(self) -> int:
        """How far the text held goes without the last escapes, which may be cut."""
        last = self.held.rfind("\\", max(self.at, len(self.held) - _CUT))
        if last < 0:
            return len(self.held)
        while True:
            while last > self.at and self.held[last - 1] == "\\":
                last -= 1
            if last - 6 < self.at or not _HIGH.match(self.held, last - 6):
                return last
            last -= 6


def _fits(value: object) -> None:
    """Refuse a text that Spark's parser would refuse."""
    if isinstance(value, str) and len(value) > LONGEST_TEXT:
        raise Broken("a text is too long")
    for part in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        _fits(part)


# ---- the rules of `snapshots` ----

def _whole(value: object, least: int) -> bool:
    """A number without fraction, rounded as the numbers of this library are, from `least` to 2^53-1."""
    if type(value) is not int and not isinstance(value, Decimal):
        return False
    if not least - 1 < value <= fixed.MAX_EXACT_INTEGER:
        return False
    value = value if type(value) is int else value.quantize(Decimal("1e-7"), ROUND_HALF_UP)
    return value == int(value) and least <= value


def _item_ok(item: object) -> bool:
    return isinstance(item, dict) and isinstance(item.get("payload"), dict | list) and _whole(item.get("bytes"), 1)


def _flight_ok(flight: object) -> bool:
    if not isinstance(flight, dict) or not _whole(flight.get("count"), 1) or not isinstance(flight.get("body"), str):
        return False
    try:
        body = _Text(iter([flight["body"]]), _DATA).value()[0]
    except (ValueError, RecursionError):
        return False
    events = body.get("events") if isinstance(body, dict) else None
    return isinstance(events, list) and len(events) == flight["count"]


@dataclass
class Verdict:
    """Why a spool may not be replayed, NULL when it may, and where its events stand in the data."""

    reason: str | None = None
    #: Text of the flight and its events.
    flight: str | None = None
    flown: int = 0
    #: Queued items: where the text of some begins and ends, and how many they are.
    queued: list[tuple[int, int, int]] = field(default_factory=list)
    #: Which of several members named `data` counts.
    member: int = 0


def _judged(text: _Text, piece: int) -> Verdict:
    """A verdict on the data but for its checksum."""
    if (first := text.next()) != "{":
        if first == "[":
            for _ in text.elements(piece):
                pass
            return Verdict("version")
        text.value()
        return Verdict("not_json")
    verdict, top, items_ok, queue = Verdict(), {}, True, False
    for name in text.members():  # of several of one name the last counts, as in Spark's variants
        if name == "queued":
            verdict.queued, items_ok, queue = [], True, text.next() == "["
        if name == "queued" and queue:
            for items, begin, end in text.elements(piece):
                items_ok = items_ok and all(map(_item_ok, items))
                verdict.queued.append((begin, end, len(items)))
        else:
            top[name] = text.value()
    nothing = (None, "")
    dropped, flight = top.get("dropped", nothing)[0], top.get("flight", nothing)
    if not _VERSION.match(top.get("v", nothing)[1]):
        verdict.reason = "version"
    elif not queue and top.get("queued", nothing)[0] != {}:
        verdict.reason = "queue"
    elif not items_ok:
        verdict.reason = "item"
    elif dropped is not None and not _whole(dropped, 0):
        verdict.reason = "dropped"
    elif flight[0] is not None and not _flight_ok(flight[0]):
        verdict.reason = "flight"
    elif flight[0] is not None:
        verdict.flight, verdict.flown = flight[1], int(flight[0]["count"])
    return verdict


def _inspected(blocks: Iterator[str], piece: int) -> tuple[Verdict, str]:
    """(verdict, checksum) of the data, which is read to its end."""
    digest = hashlib.sha256()

    def passing() -> Iterator[str]:
        try:
            for block in blocks:
                digest.update(block.encode("utf-8", "surrogatepass"))
                yield block
        except ValueError as error:
            raise _Unreadable from error

    data = passing()
    try:
        verdict = _judged(_Text(data, _DATA), piece)
    except (ValueError, RecursionError):
        verdict = Verdict("not_json")
    for _ in data:
        pass
    return verdict, digest.hexdigest()


def judged(blocks: Iterator[str], piece: int = PIECE) -> Verdict:
    """The verdict on a spool whose text comes in blocks."""
    text = _Text(blocks, _AROUND)
    found, known, members = None, None, 0
    try:
        for name in text.members():
            if name == "data":
                members += 1
                if text.next() == '"':
                    found = _inspected(text.string(), piece)
                    found[0].member = members
                else:
                    text.value()
                    found = None
            elif name == "sha256":
                known = text.value()[0]
            else:
                text.value()
        whole = text.next() == ""
    except (ValueError, RecursionError, _Unreadable):
        whole = False
    if not whole or found is None or not isinstance(known, str):
        return Verdict("unreadable")
    return found[0] if found[1] == known else Verdict("checksum")


def _snapshot(queued: str, flight: str = "null") -> str:
    data = f'{{"v":1,"queued":[{queued}],"flight":{flight}}}'
    return json.dumps({"data": data, "sha256": hashlib.sha256(data.encode("utf-8", "surrogatepass")).hexdigest()})


def pieces(blocks: Callable[[], Iterator[str]], verdict: Verdict) -> Iterator[tuple[int, str]]:
    """(position of its first event, text) of the snapshots that together are a good spool, read anew."""
    yield 0, _snapshot("", verdict.flight or "null")
    around, members, first = _Text(blocks(), _AROUND), 0, verdict.flown
    for name in around.members():
        members += name == "data"
        if members == verdict.member:
            break
        around.value()
    data = _Text(around.string(), _DATA)
    for begin, end, items in verdict.queued:
        while data.gone + len(data.held) < end:
            if not data.more():
                raise OSError("a spool was changed while it was read")
        yield first, _snapshot(data.held[begin - data.gone:end - data.gone])
        data.at = end - data.gone
        first += items
