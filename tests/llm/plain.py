"""Plain versions of the text operators, one row at a time, to hold the Spark ones against."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

SPACE = re.compile(r"[\x20\x09-\x0D]+")
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def words(text):
    return [w for w in SPACE.split(text or "") if w]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def binary(numbers):
    return np.array(numbers, "<u4").tobytes()


def crc(numbers):
    return zlib.crc32(binary(numbers))


def rank(row):
    """(id, text) in the order of ids, null ids last."""
    return (row[0] is None, row[0] or 0)


def base_rules(text):
    own = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = Counter(tuple(own[i:i + 8]) for i in range(len(own) - 7))
    covered = {i + k for i in range(len(own) - 7) if windows[tuple(own[i:i + 8])] > 1 for k in range(8)}
    repeats = sum(1 for i, x in enumerate(lines) if x in lines[:i])
    return len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"), repeats, len(covered)


def exact(rows):
    """(id, text) to (id, keep_id, group_size, kept, sha256), kept once for repeated rows."""
    body = lambda t: SPACE.sub(" ", t or "")
    groups = {}
    for row in rows:
        groups.setdefault(body(row[1]), []).append(row[0])
    out, kept = [], set()
    for id_, text in rows:
        own = groups[body(text)]
        keep = min((i for i in own if i is not None), default=None)
        first = id_ == keep and body(text) not in kept
        kept |= {body(text)} if first else set()
        out.append((id_, keep, len(own), first, sha(body(text))))
    return out


def fingerprint(text):
    own = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
    shingles = [" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(values, limit=2):
    """For each value the position of the first one reachable by steps of at most `limit` bits."""
    root = list(range(len(values)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= limit:
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(values))]


def windows_removed(units, size):
    """For each list of units, in order, the places covered by a window that starts earlier too."""
    seen, out = set(), []
    for own in units:
        gone = set()
        for i in range(len(own) - size + 1):
            window = tuple(own[i:i + size])
            if window in seen:
                gone |= set(range(i, i + size))
            seen.add(window)
        out.append(gone)
    return out


def passages(rows, size=20):
    """(id, text) in order to (id, n_words, n_removed, kept text)."""
    lists = [words(t) for _, t in rows]
    return [(id_, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone))
            for (id_, _), own, gone in zip(rows, lists, windows_removed(lists, size), strict=True)]


def phrases(rows, top, least, longest=5):
    """(lang, text) to (lang, rank, phrase, a, l, r, n, score), by counting every phrase."""
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        body = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", body):
            own = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] += len(own)
            counts.update((lang, *own[i:i + m]) for m in range(1, longest + 1) for i in range(len(own) - m + 1))
    candidates = {k: a for k, a in counts.items() if len(k) > 2 and a >= least}
    inside = set()
    for key, a in candidates.items():
        for m in range(2, len(key) - 1):
            inside |= {(key[0], *key[i:i + m]) for i in range(1, len(key) - m + 1) if a >= counts[(key[0], *key[i:i + m])]}
    out = []
    for (lang, *own), a in candidates.items():
        if (lang, *own) not in inside:
            cuts = [(counts[(lang, *own[:k])], counts[(lang, *own[k:])], k) for k in range(1, len(own))]
            score, _, left, right = min((1000 * a * sizes[lang] // (x * y), k, x, y) for x, y, k in cuts)
            out.append((lang, " ".join(own), a, left, right, sizes[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    seen, ranked = Counter(), []
    for lang, *rest in out:
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], *rest))
    return ranked


def runs(own, least=6, powers=4):
    """(start, length, period) of the runs of a list of words, by trying every period."""
    out, seen = [], set()
    for period in range(1, len(own) // powers + 1):
        i = 0
        while i + period < len(own):
            j = i
            while j + period < len(own) and own[j] == own[j + period]:
                j += 1
            if j > i and j + period - i >= max(least, powers * period) and (i, j + period) not in seen:
                seen.add((i, j + period))
                out.append((i, j + period - i, period))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(own, found):
    gone = {k for start, length, period in found for k in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def jaccard(rows, percent=90):
    """(id, text) to (id, size of the shingle set, smallest id reachable)."""
    sets = []
    for _, text in rows:
        own = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words(text)]
        sets.append({tuple(own[i:i + 3]) for i in range(max(1, len(own) - 2))} if own else set())
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for i, (own, _) in enumerate(rows):
        if own is not None:
            least[top(i)] = min(own, least.get(top(i), own))
    return [(own, len(sets[i]), least.get(top(i)) if sets[i] else own) for i, (own, _) in enumerate(rows)]
