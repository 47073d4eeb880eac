"""License scans: winnowed fingerprints in an inverted index, then banded alignment.

Templates are cut into words. A match has at least ``COVERAGE`` of a template's
words in order. If it comes about by at most ``slack`` edits (words left out,
put in or exchanged; slack: the words that may be missing), it falls into at
most slack + 1 runs, so some run has ``least / (slack + 1)`` words or more. From
that each template gets its size of grams and its winnowing window, such that a
run of this length always holds a fingerprint that the template has too: every
such match has a seed, however short the template is.

The index maps a fingerprint to its places in the templates. The document's
fingerprints give seeds, and seeds near each other on one diagonal a segment.
Segments of a template are chained over diagonals, in the order of both texts:
between two of them at most ``slack`` words of the template are missing and at
most ``EXTRA`` more words stand in the document, so a paragraph may be put in or
left out at one place. Where the words round a chain can hold a match at all, it
is aligned: along its segments, and between and beside them in bands as wide as
the gap, by bit-parallel longest common subsequence. Templates of up to ``SHORT``
words are aligned through each seed by itself, within ``BAND`` words of its
diagonal, so notices side by side are told apart.
Of matches that overlap the one of most words stays (then of the greatest
coverage, then the tightest), and the others are aligned again in what is left.

Scale: row by row over whole texts, no shuffle. Seeds are looked up in sorted
arrays; a chain inside a match of its template is not aligned again, so a text
of many notices takes time in proportion to its length. The templates are a
parameter; all are sent to every task, some 30 bytes a word.

Edge cases: null and empty texts have no matches; null ids stay; repeated rows
give equal rows; repeated notices are all reported; a very long text is scanned
in full, each alignment reads only what is near its chain; an empty table gives no rows; other
columns are ignored; templates of one word match that word, templates without a
word are refused. Offsets count words and code points.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from importlib.resources import files
from math import ceil
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, small_batches
from .packing import mixed

#: Words that a short template's match may leave its seed's diagonal by.
BAND = 6
#: Words of a template whose neighbouring matches a chain could mix up.
SHORT = 16
#: Words that may be put into a match at one place, and places between two seeds of a segment.
EXTRA, STEP = 64, 8
#: Least share of a template's words that must match.
COVERAGE = 0.8
#: Longest gram of a fingerprint.
GRAM = 3
WORD = re.compile("[0-9a-z]+")

#: Notices that name a license: short, fixed public wordings.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

#: Whole license texts and standard headers, without copyright lines, as ``<license> text`` and ``<license> header``.
TEXTS = {
    f"{p.name.removesuffix('.txt').removesuffix('.header')} {'header' if p.name.endswith('.header.txt') else 'text'}": p.read_text("utf-8")
    for p in sorted((files(__package__) / "licenses").iterdir(), key=lambda p: p.name)
    if p.name.endswith(".txt")
}
TEMPLATES = NOTICES | TEXTS


def cut(text: str) -> list[tuple[str, int, int]]:
    return [(m.group(), m.start(), m.end()) for m in WORD.finditer(text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text))]


def fingerprints(ids: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the winnowed grams: of each ``window`` grams in a row the least (the last of equal ones).

    Words without a number (0) are in no template, so grams and windows with one are left out.
    """
    n = len(ids) - gram + 1
    if n < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h, whole = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(gram):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + n].astype(np.uint64))
        whole &= ids[k : k + n] > 0
    at = np.arange(n - window + 1)
    known = whole[at]
    for k in range(1, window):
        other = np.arange(k, n - window + 1 + k)
        known &= whole[other]
        at = np.where(h[other] <= h[at], other, at)
    at = np.unique(at[known])
    return h[at], at


class Template:
    """A template's words as numbers, and what its matches must hold."""

    def __init__(self, ids: list[int]):
        self.words, self.counts = ids, Counter(ids)
        self.least = ceil(COVERAGE * len(ids))
        self.slack = len(ids) - self.least
        self.short = len(ids) <= SHORT
        run = -(-self.least // (self.slack + 1))
        self.gram = min(GRAM, run)
        self.window = run - self.gram + 1
        # a run of L words has L - run + 1 windows; two windows in a row may have the same least gram, and so on up to their size
        self.votes = 1 if self.short else max(1, ceil((self.least - (run - 1) * (self.slack + 1)) / self.window))

    def possible(self, counts: Counter) -> bool:
        """Whether a document has enough of the words, in any order."""
        missing = 0
        for w, n in self.counts.items():
            have = counts[w]
            if have < n:
                missing += n - have
                if missing > self.slack:
                    return False
        return True

    def align(self, doc: Document, chain: Chain, low: int, high: int) -> tuple[int, int, int] | None:
        """The match along a chain inside these words of the document: words in common, first, last."""
        _, p, j, _, _ = chain[0]
        if self.short:
            a, b = max(low, j - p - BAND), min(high, j - p + len(self.words) + BAND)
            names = doc.ids[a:b]
            if b - a < self.least or sum(map(self.counts.__contains__, names)) < self.least:
                return None
            same, first, last = through(self.words, names, p, j - a)
            first, last = a + first, a + last
        else:
            chain = trimmed(chain, low, high)
            if not chain:
                return None
            (_, p, j, _, _), (_, q, k, size, _) = chain[0], chain[-1]
            head, tail = self.beside(p), self.beside(len(self.words) - q - size)
            around = doc.ids[max(low, j - head) : min(high, k + size + tail)]
            if len(around) < self.least or not self.possible(Counter(around)):
                return None
            before, used = reach(self.words[:p][::-1], doc.ids[max(low, j - head) : j][::-1])
            after, more = reach(self.words[q + size :], doc.ids[k + size : min(high, k + size + tail)])
            same, first, last = before + after, j - used, k + size + more
            for n, (_, p, j, size, _) in enumerate(chain):
                same += sum(map(eq, self.words[p : p + size], doc.ids[j : j + size]))
                if n + 1 < len(chain):
                    _, q, k, _, _ = chain[n + 1]
                    same += common(self.words[p + size : q], doc.ids[j + size : k])
        return (same, first, last) if same >= self.least else None

    def dense(self, segments: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """Segments with enough places of the document that have a seed (``seeds``, ascending) for a match within its length of them."""
        size = len(self.words) + self.slack + EXTRA
        return np.searchsorted(seeds, segments[:, 2] + size, "right") - np.searchsorted(seeds, segments[:, 2] - size) >= self.votes

    def beside(self, missing: int) -> int:
        """Words of the document beside a chain in which so many words of the template are looked for."""
        return missing + (EXTRA if missing > STEP else BAND) if missing else 0

    def find(self, doc: Document, places: np.ndarray, at: np.ndarray) -> Iterator[tuple[Chain, tuple[int, int, int]]]:
        """(chain, match) of the seeds at these places of the template and of the document."""
        diagonal = at - places
        order = np.lexsort((at, diagonal))
        d, p, j = diagonal[order], places[order], at[order]
        if self.short:
            done: dict[int, int] = {}  # where the last match of each diagonal ends
            for x, y, z in zip(d.tolist(), p.tolist(), j.tolist(), strict=True):
                if z >= done.get(x, -1) and (m := self.align(doc, [(x, y, z, self.gram, 1)], 0, len(doc.ids))):
                    yield [(x, y, z, self.gram, 1)], m
                    done[x] = m[2]
            return
        new = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (j[1:] - j[:-1] > STEP)]))
        last = np.append(new[1:], len(d)) - 1
        segments = np.stack([d[new], p[new], j[new], j[last] - j[new] + self.gram, last - new + 1], 1)
        segments = segments[np.lexsort((segments[:, 1], segments[:, 2]))]
        found: list[tuple[int, int]] = []  # spans of matches, in order
        seeds = np.unique(j)
        # first the segments of several seeds; then all that no match of those covers
        for least in (3, 1):
            some = segments[(segments[:, 4] >= least) & ~covered(segments, found)]
            for chain in chains(some[self.dense(some, seeds)], self.slack + STEP):
                if sum(x[4] for x in chain) < self.votes:  # any match by at most ``slack`` edits has as many seeds
                    continue
                first, end = chain[0][2], chain[-1][2] + chain[-1][3]
                at = bisect_right(found, (first, len(doc.ids) + 1))
                if at and found[at - 1][1] >= end:
                    continue
                if m := self.align(doc, chain, 0, len(doc.ids)):
                    yield chain, m
                    insort(found, m[1:])


#: Segments (diagonal, place in the template, place in the document, words, seeds) in the order of both texts.
Chain = list[tuple[int, int, int, int, int]]


def covered(segments: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether each segment lies inside one of these spans of the document."""
    if not spans:
        return np.zeros(len(segments), bool)
    first, last = np.array(spans).T
    at = np.searchsorted(first, segments[:, 2], "right") - 1
    return (at >= 0) & (np.maximum.accumulate(last)[np.maximum(at, 0)] >= segments[:, 2] + segments[:, 3])


def chains(segments: np.ndarray, slack: int) -> list[Chain]:
    """The segments (in order of the document) in chains, each in one: the heaviest chains first.

    A segment follows one that begins before it in both texts, at most ``slack`` words
    of the template and so many and ``EXTRA`` of the document after its end. Leaving a diagonal
    costs a little, so a chain keeps to it where it can.
    """
    d, p, j, size, _ = segments.T
    p_end, j_end = p + size, j + size
    score, before = size.astype(np.float64), np.full(len(d), -1)
    low = np.searchsorted(np.maximum.accumulate(j_end), j - slack - EXTRA)
    for i in range(len(d)):
        k = slice(low[i], i)
        missing, more = p[i] - p_end[k], j[i] - j_end[k]
        follows = (p[k] < p[i]) & (j[k] < j[i]) & (p_end[k] < p_end[i]) & (j_end[k] < j_end[i]) & (missing <= slack) & (more <= np.maximum(missing, 0) + EXTRA)
        if follows.any():
            value = np.where(follows, score[k] - np.maximum(0, np.maximum(-missing, -more)) - 0.05 * np.abs(d[k] - d[i]), 0.0)
            best = int(value.argmax())
            if value[best] > 0:
                score[i] += value[best]
                before[i] = low[i] + best
    rows, before = list(map(tuple, segments.tolist())), before.tolist()
    used, out = [False] * len(rows), []
    for i in np.lexsort((np.arange(len(rows)), -score)).tolist():
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(rows[i])
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def trimmed(chain: Chain, low: int, high: int) -> Chain:
    """The chain's segments inside these words, each beginning where the one before has ended in both texts."""
    out: Chain = []
    for d, p, j, size, seeds in chain:
        cut_off = max(0, low - j)
        if out:
            _, q, r, length, _ = out[-1]
            cut_off = max(cut_off, q + length - p, r + length - j)
        p, j, size = p + cut_off, j + cut_off, min(size - cut_off, high - j - cut_off)
        if size > 0:
            out.append((d, p, j, size, seeds))
    return out


class Document:
    """A text's words, as numbers of the templates' vocabulary."""

    def __init__(self, text: str, vocabulary: dict[str, int]):
        self.places = cut(text)
        self.ids = [vocabulary.get(w, 0) for w, _, _ in self.places]


class Index:
    """All templates, and an inverted index of their fingerprints for each size of grams and window."""

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.vocabulary: dict[str, int] = {}
        self.templates = [Template([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w, _, _ in cut(templates[n])] or self._refuse(n)) for n in self.names]
        rows = defaultdict(list)
        for t, x in enumerate(self.templates):
            h, at = fingerprints(np.array(x.words), x.gram, x.window)
            rows[x.gram, x.window].append((h, np.full(len(h), t), at))
        self.index = {}
        for kind, parts in rows.items():
            h, t, at = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.index[kind] = h[order], t[order], at[order]

    @staticmethod
    def _refuse(name: str):
        raise ValueError(f"{name}: a template without words")

    def seeds(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Template, places in it and places in the document of all fingerprints in common."""
        for (gram, window), (known, templates, places) in self.index.items():
            h, at = fingerprints(ids, gram, window)
            low, high = np.searchsorted(known, h), np.searchsorted(known, h, "right")
            n = high - low
            if not n.any():
                continue
            row = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            own, where = templates[row], np.repeat(at, n)
            order = np.argsort(own, kind="stable")
            own, row, where = own[order], row[order], where[order]
            for part in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1):
                yield int(own[part[0]]), places[row[part]], where[part]

    def matches(self, text: str | None) -> list[dict]:
        if not text:
            return []
        doc = Document(text, self.vocabulary)
        heap, counts, kept = [], None, []
        key = lambda m, t, c: (-m[0], -m[0] / len(self.templates[t].words), m[2] - m[1], m[1], m[2], t, c)
        for t, places, at in self.seeds(np.array(doc.ids, np.int64)):
            template = self.templates[t]
            if len(at) >= template.votes and len(doc.ids) >= template.least:
                counts = counts or Counter(doc.ids)
                if template.possible(counts):
                    for chain, m in template.find(doc, places, at):
                        kept.append((max(chain, key=lambda x: x[3])[2], chain))
                        heap.append(key(m, t, len(kept) - 1))
        heapify(heap)
        taken: list[tuple[int, int]] = []
        out = []
        while heap:  # of matches that overlap, the one of most words stays
            same, share, _, first, last, t, c = heappop(heap)
            j, chain = kept[c]
            low, high = gap(taken, j, len(doc.ids))
            if low <= first and last <= high:
                insort(taken, (first, last))
                out.append({"license": self.names[t], "coverage": -share, "matched": -same, "first_word": first, "last_word": last, "start": doc.places[first][1], "stop": doc.places[last - 1][2]})
            elif low < high and (m := self.templates[t].align(doc, chain, low, high)):
                heappush(heap, key(m, t, c))
        return sorted(out, key=lambda m: m["start"])


def gap(taken: list[tuple[int, int]], j: int, n: int) -> tuple[int, int]:
    """The words around j that no span has taken; none if one has taken j."""
    at = bisect_right(taken, (j, n + 1))
    low, high = taken[at - 1][1] if at else 0, taken[at][0] if at < len(taken) else n
    return (low, high) if low <= j else (j, j)


def extend(template: list[int], words: list[int], band: int = BAND) -> tuple[int, int]:
    """Longest common subsequence of a template and the words, within a band of the diagonal: words in common, and the fewest words that hold them."""
    none = (0, 0)
    above = [none] * (2 * band + 2)
    best = none
    for i, w in enumerate(template):
        row = [none] * (2 * band + 2)
        for d in range(max(0, band - i), 2 * band + 1):
            j = i + d - band
            here = max(above[d + 1], row[d - 1] if d else none)
            if j < len(words) and words[j] == w:
                here = max(here, (above[d][0] + 1, -(j + 1)))
            row[d] = here
            best = max(best, here)
        above = row
    return best[0], -best[1]


def through(template: list[int], words: list[int], p: int, j: int) -> tuple[int, int, int]:
    """The best alignment that has template word p at word j: words in common, first, last."""
    left, before = extend(template[:p][::-1], words[:j][::-1])
    right, after = extend(template[p + 1 :], words[j + 1 :])
    return left + 1 + right, j - before, j + 1 + after


def masks_of(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def common(template: list[int], words: list[int]) -> int:
    """Length of the longest common subsequence: a bit for each word of the template, all updated at once by each word."""
    if not template or not words:
        return 0
    masks, full = masks_of(template), (1 << len(template)) - 1
    row = full
    for w in words:
        if m := masks.get(w):
            both = row & m
            row = ((row + both) | (row - both)) & full
    return len(template) - row.bit_count()


def reach(template: list[int], words: list[int]) -> tuple[int, int]:
    """Length of the longest common subsequence, and the fewest words from the first on that hold it."""
    if not template or not words:
        return 0, 0
    masks, full = masks_of(template), (1 << len(template)) - 1
    row, best, used = full, 0, 0
    for k, w in enumerate(words, 1):
        if m := masks.get(w):
            both = row & m
            row = ((row + both) | (row - both)) & full
            n = len(template) - row.bit_count()
            if n > best:
                best, used = n, k
                if n == len(template):
                    break
    return best, used


MATCHES = "array<struct<license:string,coverage:double,matched:int,first_word:int,last_word:int,start:int,stop:int>>"


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_matches, best license and all matches (coverage and span) of each whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(Index(templates or TEMPLATES))
    struct = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("matched", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [sent.value.matches(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(out, struct)], ["doc_id", "matches"])

    found = pick(docs, "doc_id", "text").mapInArrow(read, f"doc_id long, matches {MATCHES}")
    best = F.element_at(F.array_sort(F.transform("matches", lambda m: F.struct((-m["matched"]).alias("c"), m["start"].alias("s"), m["license"].alias("l")))), 1)["l"]
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), F.when(F.size("matches") > 0, best).alias("license"), "matches")


def whole_alignment(template: str, text: str) -> int:
    """Words in common of the longest common subsequence, without a band: for tests of recall."""
    a, b = ([w for w, _, _ in cut(x)] for x in (template, text))
    row = [0] * (len(b) + 1)
    for w in a:
        last = 0
        for j, v in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if v == w else max(row[j + 1], row[j])
    return row[-1]
