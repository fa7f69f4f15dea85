"""Token ids of the public word-level BPE vocabulary, by the tokenizers library, one distinct word part at a time.

The vocabulary's normaliser and its splitting pattern never join what white space separates, so the
ids of a text are those of its words one after another. A part met before costs a look-up.
"""

from __future__ import annotations

import array
import functools
import os
import re
import sys

import public_tokenizers
from tokenizers import Tokenizer

#: The vocabulary's own file name, and the id that ends a document.
VOCABULARY, END = "word_bpe_49k.json", 2
#: Word parts a task remembers: two generations of so many.
REMEMBERED = 200_000
#: Characters for which the rules below are the vocabulary's: Latin-1 letters, digits, signs and plain white space.
PLAIN = bytes([*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
#: The vocabulary's pattern for word parts, over lower-case text of those characters.
PARTS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\\s0-9a-zªµºß-öø-ÿ²³¹¼½¾]+")
#: Byte-level vocabularies show a byte as itself if it prints, and the others in order from 256 up.
PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
HIDDEN = [b for b in range(256) if b not in PRINTED]
VISIBLE = {b: chr(b if b in PRINTED else 256 + HIDDEN.index(b)) for b in range(256)}

assert sys.byteorder == "little" and array.array("I").itemsize == 4


def plain(text: str) -> str | None:
    """The text in lower case, or None if it has characters or special tokens that the library must see."""
    try:
        odd = text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        return None
    return None if odd or "<|" in text else text.lower()


class Recent(dict):
    """Values by key, made by `make` when asked for, and of bounded size.

    When it is full its contents become the older generation, out of which what is asked for comes back.
    """

    def __init__(self, make, size: int = REMEMBERED):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes texts as `Tokenizer.encode(text, add_special_tokens=False)` does, without truncation or padding."""

    def __init__(self, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path or public_tokenizers.path(VOCABULARY))
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.parts = Recent(self.part)

    def part(self, part: str) -> bytes:
        """Ids of one lower-case word part, merged by the library's model."""
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(VISIBLE)
        return array.array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def text(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; null is empty."""
        if not text:
            return b""
        low = plain(text)
        if low is None:
            return b"".join(map(self.odd, text.encode().split()))
        return b"".join(map(self.parts.__getitem__, PARTS.findall(low)))

    def odd(self, word: bytes) -> bytes:
        """Ids of one word of a text that is not plain throughout."""
        text = word.decode()
        low = plain(text)
        if low is None:
            return array.array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.parts.__getitem__, PARTS.findall(low)))


@functools.lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    return Encoder(path)
