"""Benchmark decontamination by suffix arrays of the training texts.

Each worker builds a suffix array over a shard of whole documents (a bounded
number of words) and binary-searches every suffix of the test items in it. The
array is sorted in two steps: by a window's words, which tells the places where
test suffixes occur at all; then those places by all the words that follow, as
far as any test suffix goes on. A test suffix stands in that array between the
training suffixes it has most words in common with, so its neighbours give its
longest verbatim match and the places of it (``item_matches``), and the nearest
test suffixes of a training suffix give the longest match of a document
(``verbatim_matches``). Only suffixes whose first words also open some test
suffix enter the shard's array: no others can be found.

Scale: one pass over the documents, no shuffle of texts and no group of
documents anywhere. A test suffix is searched once, however many items and
places share it, and a place in a document is noted once for each length of
window. The items travel in blocks of about ``BLOCK_BYTES``; if there are
several, each block takes a pass of its own, written before the next, so a
worker holds one block; what they find meets by the document's id and a hash of its text.

Edge cases: null and empty texts have no words and never match; an item
without words is ignored; an item of fewer words than a window is one window;
repeated items and rows each count under their own id (an item with null id
marks words but is not listed); each row gives one row, also rows with equal or
null ids; of longest matches the first in the document counts, then the item
that sorts first as text (a null id last); extra columns are ignored. One
item's text is searched as a whole by each task, so it has to fit in memory.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_texts, deleted, noted, passed, pick, small_batches, text_size, written

#: Bytes of item texts that are sent to the workers at once, about: some 40 MB sent, and 80 MB in a worker (6,000 items).
BLOCK_BYTES = 4_000_000
#: Words of one suffix array (a longer document has one of its own).
SHARD_WORDS = 250_000
#: Documents and bytes of rows that wait for a shard to fill, at most.
SHARD_ROWS, SHARD_BYTES = 20_000, 64_000_000
#: Leading words by which suffixes are preselected, at most.
OPENING = 4
#: Lower-cases A-Z and turns every byte that no word has into a space.
FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
ODD = np.uint64(0x9E3779B97F4A7C15)

MATCHES = "doc_id long, k long, n_words long, n_hit long, items array<string>, spans array<struct<first:int,last:int>>, longest int, longest_at int, longest_item string"
SPAN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
NAMES = ["doc_id", "k", "n_words", "n_hit", "items", "spans", "longest", "longest_at", "longest_item"]
KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), SPAN, pa.int32(), pa.int32(), pa.string())
PLACES = "item_id string, longest int, item_at int, doc_id long, doc_at int"
PLACE_NAMES = ["item_id", "longest", "item_at", "doc_id", "doc_at"]
PLACE_KINDS = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int32())


def words(text: bytes | None) -> list[bytes]:
    return text.translate(FOLD).split() if text else []


class SuffixArray:
    """The places of a shard where windows of test items occur, and the places of those windows in the items, as
    suffixes in one order.

    A suffix is the row of window numbers from its place to where such places in a row end. Numbers are ranked by
    doubled length, up to the longest row of the items: beyond it no match goes on.
    """

    def __init__(self, places: np.ndarray, windows: np.ndarray, test_places: np.ndarray, test_windows: np.ndarray):
        shard, runs, _ = laid(places)
        test, test_runs, longest = laid(test_places)
        at = np.concatenate([shard, test + len(shard) + runs])
        row = np.empty(len(at) + runs + test_runs, np.int64)
        ends = np.ones(len(row), bool)
        ends[at] = False
        row[ends] = np.arange(runs + test_runs)  # each row ends in a number of its own: no match goes over it
        row[at] = runs + test_runs + np.concatenate([windows, test_windows])
        self.ranks, k = [np.unique(row, return_inverse=True)[1].astype(np.int32)], 1
        while k <= longest:
            rank = self.ranks[-1].astype(np.int64)
            ahead = np.concatenate([rank[k:] + 1, np.zeros(min(k, len(rank)), np.int64)])
            self.ranks.append(np.unique(rank * (len(rank) + 1) + ahead, return_inverse=True)[1].astype(np.int32))
            k *= 2
        #: The suffixes in the order of their places, and the numbers by which they are sorted.
        self.shard, self.test = at[: len(shard)], at[len(shard) :]
        self.rank = self.ranks[-1]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The windows that suffixes of the shard and of the items have in common from their starts on."""
        n = np.zeros(len(a), np.int64)
        for j in range(len(self.ranks) - 1, -1, -1):
            n += (self.ranks[j][a + n] == self.ranks[j][b + n]).astype(np.int64) << j
        return n

    def longest(self, own: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The most windows that each suffix has in common with any of the others (sorted), by binary search."""
        x = np.searchsorted(self.rank[others], self.rank[own])
        below = np.where(x > 0, self.common(own, others[np.maximum(x - 1, 0)]), 0)
        return np.maximum(below, np.where(x < len(others), self.common(own, others[np.minimum(x, len(others) - 1)]), 0))

    def least(self, own: np.ndarray, others: np.ndarray, n: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The least value of the others (sorted) with which each suffix has its first n windows in common."""
        x = np.searchsorted(self.rank[others], self.rank[own])
        first, low = np.zeros(len(own), np.int64), x.copy()  # others[low:x] have them in common, others[:first] not
        high, last = x.copy(), np.full(len(own), len(others))  # others[x:high] have them, others[last:] not
        while len(open_ := np.flatnonzero(first < low)):
            m = (first[open_] + low[open_]) // 2
            same = self.common(own[open_], others[m]) >= n[open_]
            low[open_], first[open_] = np.where(same, m, low[open_]), np.where(same, first[open_], m + 1)
        while len(open_ := np.flatnonzero(high < last)):
            m = (high[open_] + last[open_]) // 2
            same = self.common(own[open_], others[m]) >= n[open_]
            high[open_], last[open_] = np.where(same, m + 1, high[open_]), np.where(same, last[open_], m)
        ranges, which = np.unique(np.stack([low, high], 1), axis=0, return_inverse=True)
        return np.array([values[a:b].min() for a, b in ranges.tolist()], np.int64)[which.ravel()]

    def sorted(self, suffixes: np.ndarray) -> np.ndarray:
        return np.argsort(self.rank[suffixes], kind="stable")


def laid(places: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Where places go in one row with a gap after each run of them, the number of runs, and the longest one."""
    cuts = np.flatnonzero(np.diff(places) != 1) + 1
    run = np.zeros(len(places), np.int64)
    run[cuts] = 1
    bounds = np.concatenate([[0], cuts, [len(places)]])
    return np.arange(len(places)) + np.cumsum(run), len(cuts) + (len(places) > 0), int(np.diff(bounds).max())


class TestSuffixes:
    """The test suffixes: the distinct windows that open them, in order, and the window at each place of the items."""

    __test__ = False

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.window, self.vocabulary = window, {}
        lists = [(name, ids) for name, text in items if (ids := [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)])]
        names = sorted({str(name) for name, _ in lists if name is not None})
        #: Items by the order of their names; the last one, without a name, stands for null ids.
        self.names: list[str | None] = [*names, None]
        number = {n: i for i, n in enumerate(names)} | {None: len(names)}
        sizes = np.array([len(ids) for _, ids in lists], np.int64)
        text = np.zeros(int(sizes.sum()) + len(sizes) + window, np.uint32)  # a 0 ends each item
        begins = np.cumsum(sizes + 1) - sizes - 1
        for at, (_, ids) in zip(begins.tolist(), lists, strict=True):
            text[at : at + len(ids)] = ids
        self.item = np.repeat(np.array([number[None if n is None else str(n)] for n, _ in lists], np.int32), sizes + 1)
        self.begin = np.repeat(begins, sizes + 1)
        n_windows = np.maximum(1, sizes - window + 1)
        starts = np.repeat(begins - (np.cumsum(n_windows) - n_windows), n_windows) + np.arange(int(n_windows.sum()))
        rows = text[starts[:, None] + np.arange(window)]
        rows[~np.logical_and.accumulate(rows > 0, axis=1)] = 0
        self.windows, first, own = np.unique(_keys(rows), return_index=True, return_inverse=True)
        self.sizes = (rows[first] > 0).sum(1) if len(first) else np.zeros(0, np.int64)
        own = own.ravel()
        pairs = np.unique(np.stack([own, self.item[starts]], 1), axis=0) if len(starts) else np.zeros((0, 2), np.int64)
        self.items_at, self.items = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1)), pairs[:, 1]
        whole = self.sizes[own] == window
        #: The places of whole windows in the items, and their numbers.
        self.places, self.numbers = starts[whole], own[whole].astype(np.int32)
        self.opens = {q: np.unique(fingerprint(rows[first][np.minimum(self.sizes, OPENING) == q][:, :q], q)) for q in set(np.minimum(self.sizes, OPENING).tolist())}

    def ends(self) -> np.ndarray:
        """The highest key that each window opens."""
        out = np.frombuffer(self.windows.astype(f"S{4 * self.window}").tobytes(), np.uint8).reshape(-1, 4 * self.window).copy()
        out[np.arange(4 * self.window)[None, :] >= 4 * self.sizes[:, None]] = 0xFF
        return out.reshape(-1).view(f"S{4 * self.window}")

    def ready(self) -> None:
        """What every task derives for itself and is not sent."""
        if not hasattr(self, "high"):
            self.high = self.ends()

    def __getstate__(self):
        return {k: v for k, v in vars(self).items() if k != "high"}

    def suffix_array(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the suffixes that may matter, in order of their words, and those words."""
        n = len(ids)
        padded = np.concatenate([ids, np.zeros(self.window, ids.dtype)])
        mask = np.zeros(n, bool)
        for q, known in self.opens.items():
            at = np.flatnonzero(np.logical_and.reduce([padded[k : n + k] > 0 for k in range(q)]))
            got = fingerprint(np.stack([padded[at + k] for k in range(q)], 1), q)
            near = np.minimum(np.searchsorted(known, got), len(known) - 1)
            mask[at[known[near] == got]] = True
        at = np.flatnonzero(mask)
        keys = _keys(padded[at[:, None] + np.arange(self.window)])
        order = np.argsort(keys, kind="stable")
        return at[order], keys[order]

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start in the shard and number of the window, for each occurrence of a test window."""
        self.ready()
        at, keys = self.suffix_array(ids)
        if not len(at):
            return at, at
        low, high = np.searchsorted(keys, self.windows), np.searchsorted(keys, self.high, "right")
        found = np.flatnonzero(low < high)
        n = (high - low)[found]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return at[np.repeat(low[found], n) + inside], np.repeat(found, n)

    def extended(self, start: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, SuffixArray]:
        """The shard's places of whole windows, the items' places of the same windows, and both as suffixes in order."""
        whole = np.flatnonzero(self.sizes[window] == self.window)
        whole = whole[np.argsort(start[whole], kind="stable")]
        found = np.zeros(len(self.windows), bool)
        found[window[whole]] = True
        test = np.flatnonzero(found[self.numbers])
        return start[whole], self.places[test], SuffixArray(start[whole], window[whole], self.places[test], self.numbers[test])


def _keys(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like them."""
    rows = np.ascontiguousarray(rows.astype(">u4"))
    return rows.view(f"S{4 * rows.shape[1]}").ravel()


def fingerprint(rows: np.ndarray, q: int) -> np.ndarray:
    out = np.zeros(len(rows), np.uint64)
    for k in range(q):
        out = (out ^ rows[:, k].astype(np.uint64)) * ODD
        out ^= out >> np.uint64(29)
    return out


class Shard:
    """Whole documents and where windows of the test items occur in them."""

    def __init__(self, suffixes: TestSuffixes, lists: list[list[bytes]]):
        number, self.sizes = suffixes.vocabulary.get, [len(x) for x in lists]
        ids = np.zeros(sum(self.sizes) + len(lists), np.int64)  # a 0 ends each document
        self.starts = np.cumsum([0, *[n + 1 for n in self.sizes[:-1]]])
        for k, x, n in zip(self.starts.tolist(), lists, self.sizes, strict=True):
            ids[k : k + n] = np.fromiter(map(number, x, repeat(0)), np.int64, n)
        start, window = suffixes.search(ids)
        doc = self.doc_of(start)
        order = np.argsort(doc, kind="stable")
        self.start, self.window, self.suffixes = start[order], window[order], suffixes
        self.cuts = np.searchsorted(doc[order], np.arange(len(lists) + 1))

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, "right") - 1

    def longest(self) -> dict[int, tuple[int, int, int]]:
        """Words, place and item of the longest match of each document that has one of a window or more."""
        places, test, array = self.suffixes.extended(self.start, self.window)
        if not len(places):
            return {}
        by_order = array.sorted(array.test)
        n = array.longest(array.shard, array.test[by_order])
        doc = self.doc_of(places)
        order = np.lexsort((places, -n, doc))
        best = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
        item = array.least(array.shard[best], array.test[by_order], n[best], self.suffixes.item[test[by_order]])
        words_ = n[best] + self.suffixes.window - 1
        return dict(zip(doc[best].tolist(), zip(words_.tolist(), (places[best] - self.starts[doc[best]]).tolist(), item.tolist(), strict=True), strict=True))

    def item_rows(self, doc_ids: list) -> list[tuple]:
        """(item, words, place in the item, document, place in the document) of the longest match of each named item that has one."""
        out, s = [], self.suffixes
        #: The places of the shard by document (a null id last) and place.
        first = sorted(range(len(doc_ids)), key=lambda d: (doc_ids[d] is None, doc_ids[d] or 0))
        turn = np.empty(len(first), np.int64)
        turn[first] = np.arange(len(first))
        whole = turn[self.doc_of(self.start)] if len(self.start) else np.zeros(0, np.int64)
        order = np.lexsort((self.start, whole))
        value = np.empty(len(order), np.int64)
        value[order] = np.arange(len(order))

        def row(item: int, n: int, at: int, least: int) -> tuple:
            place = self.start[order[least]]
            d = int(self.doc_of(place))
            return s.names[item], n, at, doc_ids[d], int(place - self.starts[d])

        for w in np.unique(self.window[s.sizes[self.window] < s.window]).tolist():  # items of fewer words than a window
            least = int(value[self.window == w].min())
            out += [row(item, int(s.sizes[w]), 0, least) for item in s.items[s.items_at[w] : s.items_at[w + 1]].tolist() if s.names[item] is not None]
        places, test, array = s.extended(self.start, self.window)
        if not len(places):
            return out
        mine = np.flatnonzero(s.sizes[self.window] == s.window)
        mine = mine[np.argsort(self.start[mine], kind="stable")]
        by_order = array.sorted(array.shard)
        n = array.longest(array.test, array.shard[by_order])
        item, inside = s.item[test], test - s.begin[test]
        best = np.lexsort((test, inside, -n, item))
        best = best[np.flatnonzero(np.diff(item[best], prepend=-1))]
        least = array.least(array.test[best], array.shard[by_order], n[best], value[mine][by_order])
        for i, k, at, v in zip(item[best].tolist(), n[best].tolist(), inside[best].tolist(), least.tolist(), strict=True):
            if s.names[i] is not None:
                out.append(row(i, k + s.window - 1, at, v))
        return out


def shard_rows(suffixes: TestSuffixes, doc_ids: list, keys: list, lists: list[list[bytes]], details: bool = True) -> list[tuple]:
    """A result row for each document of a shard."""
    shard = Shard(suffixes, lists)
    best, out = shard.longest() if details else {}, []
    for d, (doc_id, key, n) in enumerate(zip(doc_ids, keys, shard.sizes, strict=True)):
        i, j = shard.cuts[d], shard.cuts[d + 1]
        if i == j:
            out.append((doc_id, key, n, 0, [], [], 0, None, None))
            continue
        if not details:
            out.append((doc_id, key, n, 1, [], [], 0, None, None))
            continue
        at, own = shard.start[i:j] - shard.starts[d], shard.window[i:j]
        first, last = merged(at, at + suffixes.sizes[own])
        items = np.unique(np.concatenate([suffixes.items[suffixes.items_at[w] : suffixes.items_at[w + 1]] for w in np.unique(own).tolist()]))
        named = [s for x in items.tolist() if (s := suffixes.names[x]) is not None]
        length, place, item = best[d] if d in best else shortest(suffixes, at, own)
        spans = [{"first": a, "last": b} for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        out.append((doc_id, key, n, int((last - first).sum()), named, spans, length, place, suffixes.names[item]))
    return out


def shortest(suffixes: TestSuffixes, at: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Words, place and item of the longest match of a document that holds only items of fewer words than a window."""
    size = suffixes.sizes[window]
    best = int(size.max())
    place = int(at[size == best].min())
    w = int(window[(size == best) & (at == place)][0])
    return best, place, int(suffixes.items[suffixes.items_at[w]])


def merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open intervals, as disjoint ones."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1]])
    return first[new], np.maximum.reduceat(last, np.flatnonzero(new))


def test_blocks(benchmark: DataFrame, window: int) -> Iterator[TestSuffixes]:
    """The test suffixes, in blocks of bounded size; an item that is repeated whole counts once."""
    bench = pick(benchmark, "item_id", "text").distinct()
    _, size = text_size(bench)
    blocks = max(1, -(-size // BLOCK_BYTES))
    for k in range(blocks):
        block = bench.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else bench
        yield TestSuffixes([(r["item_id"], None if r["text"] is None else r["text"].encode()) for r in block.collect()], window)


def verbatim_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Words, hit words, items and longest match of each document against the whole benchmark: one row for each row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("k"))
    found: list[DataFrame] = []
    held = None
    for suffixes in test_blocks(benchmark, window):
        if held is not None:
            found.append(written(held, "matches"))
        held = rows.mapInArrow(_searcher(spark.sparkContext.broadcast(suffixes)), MATCHES)
    if not found:
        return held.drop("k")
    found.append(written(held, "matches"))
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    merged_spans = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("spans"))),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a["n"] + F.greatest(F.lit(0), x["last"] - F.greatest(x["first"], a["end"]))).alias("n"), F.greatest(a["end"], x["last"]).alias("end")),
    )
    # rows with the same id and text find the same: they go through as one, with their number
    best = F.min(F.struct((-F.col("longest")).alias("n"), F.col("longest_at").alias("at"), F.col("longest_item").isNull().alias("unnamed"), F.col("longest_item").alias("item")))
    together = every.groupBy("doc_id", "k", "n_words").agg(
        (F.count(F.lit(1)) / len(found)).cast("int").alias("copies"),
        merged_spans["n"].cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        best.alias("best"),
    )
    out = together.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return out.select("doc_id", "n_words", "n_hit", "items", "spans", (-F.col("best.n")).alias("longest"), F.col("best.at").alias("longest_at"), F.col("best.item").alias("longest_item"))


def item_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The longest verbatim match of each item with any document, and where: a row for each named item of which a window occurs.

    ``item_id`` as text, ``longest`` in words, its place in the item, and the document and the place there that hold it. Of equally
    long ones the first in the item counts, then the least doc_id (null last), then the first place. A shard gives a row an item.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("k"))
    every = None
    for suffixes in test_blocks(benchmark, window):
        found = written(rows.mapInArrow(_searcher(spark.sparkContext.broadcast(suffixes), of_items=True), PLACES), "places")
        every = found if every is None else every.unionByName(found)
    best = F.min(F.struct((-F.col("longest")).alias("n"), "item_at", F.col("doc_id").isNull().alias("unnamed"), "doc_id", "doc_at")).alias("best")
    return every.groupBy("item_id").agg(best).select("item_id", (-F.col("best.n")).alias("longest"), "best.item_at", "best.doc_id", "best.doc_at")


def _searcher(sent, of_items: bool = False):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = (PLACE_NAMES, PLACE_KINDS) if of_items else (NAMES, KINDS)
        ids, keys, lists, held = [], [], [], 0

        def result():
            found = Shard(sent.value, lists).item_rows(ids) if of_items else shard_rows(sent.value, ids, keys, lists)
            columns = zip(*found, strict=True) if found else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

        for b in batches:
            for doc_id, key, text in zip(b.column("doc_id").to_pylist(), b.column("k").to_pylist(), byte_texts(b), strict=True):
                ids.append(doc_id)
                keys.append(key)
                lists.append(words(text))
                held += len(lists[-1])
                if held >= SHARD_WORDS or len(ids) >= SHARD_ROWS:
                    yield result()
                    ids, keys, lists, held = [], [], [], 0
        if ids:
            yield result()

    return rows


def digest(matches: DataFrame) -> DataFrame:
    return matches.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.col("longest").cast("long").alias("longest_words"),
        F.col("longest_at").cast("long").alias("longest_at"),
        F.col("longest_item"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, whole and in their columns, that hold no window of any item. Nothing is shuffled.

    Of several blocks of items each takes the documents that those before have
    left, which are written between them: no task runs more than one block's worker.
    Rows without text or words stay, null ids too; an empty table stays empty; columns of any name pass through.
    """
    spark = docs.sparkSession
    small_batches(spark)
    before: list[str] = []
    for n, suffixes in enumerate(test_blocks(benchmark, window)):
        if n:
            with noted() as made:
                docs = written(docs, "cleaned")
            deleted(spark, before)
            before = made
        docs = passed(docs, _cleaner(spark.sparkContext.broadcast(suffixes)))
    return docs


def _cleaner(sent):
    return lambda text: functools.partial(_clean_rows, sent, text)


def _clean_rows(sent, text: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, lists, count, size = [], [], 0, 0

    def clean():
        blank = [None] * len(lists)
        found = shard_rows(sent.value, blank, blank, lists, details=False)
        at = 0
        for b in held:
            yield b.filter(pa.array([x[3] == 0 for x in found[at : at + b.num_rows]], pa.bool_()))
            at += b.num_rows

    for b in batches:
        own = [words(t) for t in byte_texts(b, text)]
        held.append(b)
        lists += own
        count, size = count + sum(map(len, own)), size + b.nbytes
        if count >= SHARD_WORDS or len(lists) >= SHARD_ROWS or size >= SHARD_BYTES:
            yield from clean()
            held, lists, count, size = [], [], 0, 0
    if held:
        yield from clean()


def reference(docs: list[tuple], items: list[tuple], window: int = 10) -> list[tuple]:
    """Brute force, for tests: the query's columns, the longest match from every pair of places."""
    out, tests = [], []
    for name, text in items:
        w = words(None if text is None else text.encode())
        if w:
            tests.append((None if name is None else str(name), w, {tuple(w[i : i + window]) for i in range(max(1, len(w) - window + 1))}))
    for doc_id, text in docs:
        w = words(None if text is None else text.encode())
        hit, ids, best = set(), set(), None
        for name, item, windows in tests:
            least = min(window, len(item))
            for x in windows:
                for i in range(len(w) - len(x) + 1):
                    if tuple(w[i : i + len(x)]) == x:
                        hit.update(range(i, i + len(x)))
                        ids.add(name)
            for i in range(len(w)):
                for j in range(len(item)):
                    n = 0
                    while i + n < len(w) and j + n < len(item) and w[i + n] == item[j + n]:
                        n += 1
                    if n >= least:
                        best = min(best or (0, 0, True, ""), (-n, i, name is None, name or ""))
        named = sorted(i for i in ids if i is not None)
        found = (0, None, None) if best is None else (-best[0], best[1], None if best[2] else best[3])
        out.append((doc_id, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit), *found))
    return out
