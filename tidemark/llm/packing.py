"""Hashes of words in arrays, and an exchange of packed sorted hashes.

Counting the n-grams of a corpus needs each n-gram's rows in one place. A row
for each is slow and wide; here a group of documents sends one row for each
bucket of the hash space with its distinct hashes, sorted and cut into byte
planes (which the shuffle's compression likes). A bucket decides about its
hashes and answers every group with those that the group should know. A hash
that is in a third of all documents comes once from each group, so no task
sees more than one entry of it for each group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

#: Hashes that one bucket holds, about.
BUCKET_HASHES = 1_500_000
SENT = "bucket int, g int, hashes binary, notes binary"
ANSWER = "g int, hashes binary, notes binary"
SENT_SCHEMA = pa.schema([("bucket", pa.int32()), ("g", pa.int32()), ("hashes", pa.binary()), ("notes", pa.binary())])
ANSWER_SCHEMA = pa.schema([("g", pa.int32()), ("hashes", pa.binary()), ("notes", pa.binary())])

BASE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MASK = (1 << 64) - 1


def planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def unplaned(data: bytes, kind=np.uint64) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


class Words:
    """The words of some texts (runs of other than space and 0x09-0x0D), as hashes one after the other.

    ``hashes``: of each word; ``starts``, ``ends``: of each text in them.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        ends -= ends[0]
        names = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
        codes = coded.indices.to_numpy(zero_copy_only=False)
        if b"" in names:  # white space at a text's start or end
            real = codes != names.index(b"")
            ends = np.concatenate([[0], np.cumsum(real)])[ends]
            codes = codes[real]
        self.names, self.codes = names, codes
        self.hashes = table[codes] if len(names) else np.zeros(0, np.uint64)
        self.starts, self.ends = ends[:-1], ends[1:]
        self.text_of = np.repeat(np.arange(len(self.starts)), self.ends - self.starts)

    def __len__(self) -> int:
        return len(self.hashes)

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words with a space after each, and where each begins (and the last one's end)."""
        size = np.fromiter(map(len, self.names), np.int64, len(self.names))[self.codes] + 1 if len(self.names) else np.zeros(0, np.int64)
        return b" ".join([*map(self.names.__getitem__, self.codes.tolist()), b""]), np.concatenate([[0], np.cumsum(size)])


class Rolling:
    """Hashes of any spans of a row of words: sums of powers of an odd base, modulo 2^64."""

    def __init__(self, hashes: np.ndarray, which: int = 0):
        base, n = BASE[which], len(hashes)
        self.inverse = _powers(pow(base, -1, 1 << 64), n + 1)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(base, n + 1)[:n], dtype=np.uint64)])

    def spans(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        raw = (self.prefix[last] - self.prefix[first]) * self.inverse[first]
        return mixed(raw + (last - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def windows(self, k: int) -> np.ndarray:
        """The hash of the k words from each place on (places whose window would leave the row are cut off)."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.prefix[k:] - self.prefix[:n]) * self.inverse[:n] + np.uint64(k * 0x9E3779B97F4A7C15 & MASK))


_kept: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _kept.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = _kept[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


class Known:
    """A sorted table of hashes: which of many hashes are in it, and where."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.marks = np.zeros(1 << 22, bool)
        self.marks[(hashes >> np.uint64(42)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash in the table, or -1."""
        out = np.full(len(h), -1, np.int64)
        if len(self.hashes):
            maybe = np.flatnonzero(self.marks[(h >> np.uint64(42)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            hit = self.hashes[at] == h[maybe]
            out[maybe[hit]] = at[hit]
        return out


def sent_rows(g: int, hashes: np.ndarray, notes: np.ndarray, buckets: int) -> pa.Table:
    """A group's sorted distinct hashes, and a note (a fixed-size number) on each, by bucket."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(bucket, np.arange(buckets + 1))
    full = np.flatnonzero(np.diff(cuts))
    parts = [(cuts[b], cuts[b + 1]) for b in full.tolist()]
    return pa.table(
        [pa.array(full, pa.int32()), pa.array(np.full(len(full), g), pa.int32()), pa.array([planes(hashes[i:j]) for i, j in parts], pa.binary()), pa.array([planes(notes[i:j]) for i, j in parts], pa.binary())],
        schema=SENT_SCHEMA,
    )


def buckets_for(hashes: int) -> int:
    return max(16, -(-hashes // BUCKET_HASHES))


Decision = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def answered(sent: DataFrame, decide: Decision, kind=np.uint32, out_kind=np.uint32) -> DataFrame:
    """What the buckets answer.

    ``decide(first, notes)`` gets the notes in order of their hashes and where each
    hash's notes begin; it returns which hashes to answer and a note on each hash.
    """

    def bucket(table: pa.Table) -> pa.Table:
        groups = table.column("g").to_pylist()
        parts = [unplaned(x) for x in table.column("hashes").to_pylist()]
        hashes = np.concatenate(parts)
        notes = np.concatenate([unplaned(x, kind) for x in table.column("notes").to_pylist()])
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
        keep, note = decide(np.flatnonzero(new), notes[order])
        own = np.empty(len(hashes), np.int64)
        own[order] = np.cumsum(new) - 1
        ends = np.cumsum([len(p) for p in parts])
        rows = []
        for g, i, j in zip(groups, (ends - [len(p) for p in parts]).tolist(), ends.tolist(), strict=True):
            which = keep[own[i:j]]
            if which.any():
                rows.append((g, planes(hashes[i:j][which]), planes(note[own[i:j][which]].astype(out_kind))))
        g, h, n = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table([pa.array(g, pa.int32()), pa.array(h, pa.binary()), pa.array(n, pa.binary())], schema=ANSWER_SCHEMA)

    return sent.groupBy("bucket").applyInArrow(bucket, ANSWER)


def known_of(table: pa.Table, kind=np.uint32) -> tuple[Known, np.ndarray]:
    """A group's answers as one sorted table with notes."""
    rows = [(unplaned(h), unplaned(n, kind)) for h, n in zip(table.column("hashes").to_pylist(), table.column("notes").to_pylist(), strict=True) if h is not None]
    if not rows:
        return Known(np.zeros(0, np.uint64)), np.zeros(0, kind)
    hashes, notes = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.argsort(hashes, kind="stable")
    return Known(hashes[order]), notes[order]


