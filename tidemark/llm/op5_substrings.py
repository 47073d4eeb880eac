"""Substring dedup by compaction of a de Bruijn graph of words.

Windows of ``window`` consecutive words are the graph's edges; their first and
last window - 1 words are its nodes. A node is *inner* if every occurrence of
it in the corpus has the same word before it and the same word after it, and
there are several. A path through inner nodes does not branch, and neither
begins nor ends inside for any document, so it compacts into one piece: where
one of its edges occurs, the whole piece occurs. A join of the pieces on their
content (a 128-bit hash of all their bytes) finds each piece's first source
coordinate (doc_id, place). The words that stand there are fetched and compared
with every later occurrence: only where they are the same, they are removed.

Steps, all over groups of whole documents (a group is a hash of the row):

1. Minimizers (the least hash of ten words in each node) that occur once rule
   out nodes that occur once: only a small part of all places goes further.
2. Nodes that are left meet by hash and learn whether they repeat and are inner.
3. Each group walks its documents, cuts runs of repeated nodes at those that
   are not inner, and gives pieces with their coordinates. Of the same piece
   within a group only the first coordinates go on; the others are decided.
4. Pieces meet by content: an aggregate finds the first coordinate of each.
5. The group of each first coordinate fetches the words there, once.
6. A join brings them to the later occurrences.
7. Each group compares them with its spans, and writes the result.

Scale: texts move once (the shuffle into groups is reused by all steps);
hashes move packed, one entry a group however often they occur; pieces of hot
passages come once from each group, and their words go once to each; a source is
asked once, however many groups hold its passage. Rows that are equal in id and text
are counted before they are grouped, and go through as one (where there are any,
for one more exchange of the texts). No pair of documents is ever formed. Groups have some ``GROUP_BYTES`` of text: a bucket gets
an entry from each group for a hash that all hold, so larger executors do well
with larger groups.

Edge cases: null and empty texts have no words; documents shorter than a
window lose nothing; a document's own repetition loses its later windows; of
documents with equal ids none is earlier, so both keep what they share; a null
id is before all others; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packing
from .common import GROUP_BYTES, byte_texts, partitions, repeated, repeats, text_size
from .packing import Rolling, Words

SPAN_SCHEMA = pa.schema([("g", pa.int32()), ("k", pa.int64()), ("o", pa.int64()), ("at", pa.int32()), ("n", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("done", pa.bool_())])
SPANS = "g int, k long, o long, at int, n int, hi long, lo long, done boolean"
SOURCE_SCHEMA = pa.schema([("hi1", pa.int64()), ("lo1", pa.int64()), ("o1", pa.int64()), ("at1", pa.int32()), ("body", pa.binary())])
SOURCES = "hi1 long, lo1 long, o1 long, at1 int, body binary"
RESULT_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()), ("copies", pa.int64())])


class Nodes:
    """The nodes of a group's documents: where they start, their hashes and minimizers."""

    def __init__(self, texts: pa.ChunkedArray, window: int):
        self.words = w = Words(texts)
        self.size = window - 1
        self.gram = max(1, self.size // 2)
        self.roll = Rolling(w.hashes)
        n = max(0, len(w) - self.size + 1)
        inside = w.ends[w.text_of[:n]] - np.arange(n) >= self.size if n else np.zeros(0, bool)
        self.at = np.flatnonzero(inside)  # a node starts here
        self.inside = inside

    def minimizers(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all short grams, and the least of them in each node (by place)."""
        grams = self.roll.windows(self.gram)
        n = len(self.inside)
        least = grams[:n].copy()
        for d in range(1, self.size - self.gram + 1):
            np.minimum(least, grams[d : d + n], out=least)
        return grams, least

    def hashes(self, at: np.ndarray) -> np.ndarray:
        return self.roll.spans(at, at + self.size)

    def contexts(self, at: np.ndarray) -> np.ndarray:
        """A 63-bit hash of the words before and after each node; 0 if the document begins or ends there."""
        w = self.words
        doc = w.text_of[at]
        whole = (at > w.starts[doc]) & (at + self.size < w.ends[doc])
        before, after = w.hashes[np.maximum(at - 1, 0)], w.hashes[np.minimum(at + self.size, len(w) - 1)]
        out = packing.mixed(packing.mixed(before) * np.uint64(0x9FB21C651E98DF25) + after) >> np.uint64(1)
        return np.where(whole, np.maximum(out, np.uint64(1)), np.uint64(0))


def _minimizer_rows(table: pa.Table, window: int, buckets: int) -> pa.Table:
    nodes = Nodes(table.column("text"), window)
    if not len(nodes.at):
        return packing.SENT_SCHEMA.empty_table()
    grams, least = nodes.minimizers()
    n = len(least)
    chosen = np.zeros(len(grams), bool)
    for d in range(nodes.size - nodes.gram + 1):
        chosen[d : d + n] |= (grams[d : d + n] == least) & nodes.inside
    hashes, counts = np.unique(grams[chosen], return_counts=True)
    return packing.sent_rows(table.column("g")[0].as_py(), hashes, np.minimum(counts, 2).astype(np.uint32), buckets)


def _repeated(first: np.ndarray, notes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    many = np.add.reduceat(notes.astype(np.int64), first) > 1
    return many, many.astype(np.uint32)


def _node_rows(docs: pa.Table, answers: pa.Table, window: int, buckets: int) -> pa.Table:
    known, _ = packing.known_of(answers, np.uint8)
    if not docs.num_rows or not len(known.hashes):
        return packing.SENT_SCHEMA.empty_table()
    nodes = Nodes(docs.column("text"), window)
    _, least = nodes.minimizers()
    at = nodes.at[known.find(least[nodes.at]) >= 0]
    if not len(at):
        return packing.SENT_SCHEMA.empty_table()
    hashes, contexts = nodes.hashes(at), nodes.contexts(at)
    order = np.argsort(hashes, kind="stable")
    hashes, contexts = hashes[order], contexts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    low, high = np.minimum.reduceat(contexts, first), np.maximum.reduceat(contexts, first)
    many = np.diff(np.append(first, len(hashes))) > 1
    notes = np.where(low == high, low, np.uint64(0)) << np.uint64(1) | many.astype(np.uint64)
    return packing.sent_rows(docs.column("g")[0].as_py(), hashes[first], notes, buckets)


def _inner(first: np.ndarray, notes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which nodes repeat; note 2 if inner, 1 if a piece ends there."""
    count = np.diff(np.append(first, len(notes)))
    many = (count > 1) | (notes[first] & np.uint64(1) > 0)
    context = notes >> np.uint64(1)
    low, high = np.minimum.reduceat(context, first), np.maximum.reduceat(context, first)
    return many, np.where((low == high) & (low > 0), 2, 1).astype(np.uint32)


def _piece_rows(docs: pa.Table, answers: pa.Table, window: int) -> pa.Table:
    known, notes = packing.known_of(answers, np.uint8)
    if not docs.num_rows or not len(known.hashes):
        return SPAN_SCHEMA.empty_table()
    nodes = Nodes(docs.column("text"), window)
    flag = np.zeros(len(nodes.inside) + 1, np.uint8)
    found = known.find(nodes.hashes(nodes.at))
    flag[nodes.at[found >= 0]] = notes[found[found >= 0]]
    w = nodes.words
    # an edge starts where a repeated node is followed by one of the same document
    edge = (flag[:-1] > 0) & (flag[1:] > 0)
    edge[:-1] &= w.text_of[: len(edge) - 1] == w.text_of[1 : len(edge)]
    begin = edge & np.concatenate([[True], ~edge[:-1] | (flag[1:-1] == 1)])
    at = np.flatnonzero(begin)
    if not len(at):
        return SPAN_SCHEMA.empty_table()
    piece = np.cumsum(begin)[edge] - 1
    n = np.bincount(piece, minlength=len(at))
    last = at + n + window - 1
    doc = w.text_of[at]
    ids = docs.column("o").to_numpy()[doc]
    place = at - w.starts[doc]
    text, begins = w.joined()
    bodies = [text[i:j] for i, j in zip(begins[at].tolist(), begins[last].tolist(), strict=True)]
    digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, bodies)), "<i8").reshape(-1, 2)
    hi, lo = digest[:, 0], digest[:, 1]
    order = np.lexsort((place, ids, lo, hi))
    # the same piece: the same words, compared as they stand
    same = np.array([False, *(bodies[i] == bodies[j] for i, j in zip(order[1:].tolist(), order[:-1].tolist(), strict=True))])
    # of a piece's occurrences in this group only the first go on; those after them are decided
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
    later = np.zeros(len(at), bool)
    later[order] = (ids[order] > ids[lead]) | (place[order] > place[lead])
    k = docs.column("k").to_numpy()[doc]
    first = np.flatnonzero(~later)
    a, n2, k2, o2 = _joined(at[later], last[later], k[later], ids[later], w.starts[doc[later]])
    g = docs.column("g")[0].as_py()
    both = lambda x, y, t: pa.array(np.concatenate([x, y]), t)
    return pa.table(
        [
            pa.array(np.full(len(first) + len(a), g), pa.int32()),
            both(k[first], k2, pa.int64()),
            both(ids[first], o2, pa.int64()),
            both(place[first], a, pa.int32()),
            both((last - at)[first], n2, pa.int32()),
            both(hi[first], k2, pa.int64()),  # decided spans have no content to meet by: their document's key deals them out
            both(lo[first], a, pa.int64()),
            both(np.zeros(len(first), bool), np.ones(len(a), bool), pa.bool_()),
        ],
        schema=SPAN_SCHEMA,
    )


def _joined(first, last, k, ids, start):
    """Spans in order, joined where they touch: places in the document and numbers of words."""
    if not len(first):
        return first, first, k, ids
    order = np.argsort(first, kind="stable")
    first, last, k, ids, start = (x[order] for x in (first, last, k, ids, start))
    ends = np.maximum.accumulate(last)
    new = np.concatenate([[True], (first[1:] > ends[:-1]) | (start[1:] != start[:-1])])
    lead = np.flatnonzero(new)
    return first[lead] - start[lead], np.maximum.reduceat(last, lead) - first[lead], k[lead], ids[lead]


def _source_rows(docs: pa.Table, asked: pa.Table) -> pa.Table:
    """The words at the asked coordinates of this group's documents."""
    wanted = set(asked.column("k").to_pylist())
    lists = {k: text.split() for k, text in zip(docs.column("k").to_pylist(), byte_texts(docs), strict=True) if k in wanted and text}
    rows = [(hi, lo, o, at, b" ".join(lists[k][at : at + n])) for k, o, at, n, hi, lo in zip(*(asked.column(c).to_pylist() for c in ("k", "o", "at", "n", "hi", "lo")), strict=True)]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), SOURCE_SCHEMA, strict=True)], schema=SOURCE_SCHEMA) if rows else SOURCE_SCHEMA.empty_table()


def _result(docs: pa.Table, spans: pa.Table, keep_text: bool) -> pa.Table:
    removed: dict[int, list[tuple[int, int, bytes | None]]] = {}
    for k, at, n, body in zip(*(spans.column(c).to_pylist() for c in ("k", "at", "n", "body")), strict=True):
        removed.setdefault(k, []).append((at, n, body))
    rows = []
    for doc_id, k, copies, text in zip(*(docs.column(c).to_pylist() for c in ("doc_id", "k", "copies")), byte_texts(docs), strict=True):
        words = text.split() if text else []
        total, gone = len(words), 0
        if k in removed:
            keep = np.ones(total, bool)
            for at, n, body in removed[k]:
                # verified: the same words stand at the source's coordinate (those decided in their group were compared there)
                if body is None or b" ".join(words[at : at + n]) == body:
                    keep[at : at + n] = False
            gone = total - int(keep.sum())
            words = list(compress(words, keep.tolist()))
        kept = b" ".join(words)
        rows.append((doc_id, total, gone, hashlib.sha256(kept).hexdigest(), kept.decode() if keep_text else None, copies))
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), RESULT_SCHEMA, strict=True)], schema=RESULT_SCHEMA) if rows else RESULT_SCHEMA.empty_table()


def dedup_substrings(docs: DataFrame, window: int = 20, keep_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (unless not asked for) the kept words of each document."""
    if window < 2:
        raise ValueError("a window has two words at least")
    spark = docs.sparkSession
    _, size = text_size(docs)
    groups = max(1, -(-size // GROUP_BYTES))
    buckets = packing.buckets_for(size // 20)
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).withColumn("k", F.xxhash64("doc_id", "text"))
    again = repeats(rows.select("k"), "k")
    if again:  # rows equal in id and text have equal results: one of them goes through the groups
        rows = rows.groupBy("doc_id", "text", "k").agg(F.count(F.lit(1)).alias("copies"))
    else:
        rows = rows.withColumn("copies", F.lit(1).cast("long"))
    rows = rows.withColumns({"o": F.coalesce("doc_id", F.lit(-(2**63))), "g": F.pmod("k", F.lit(groups)).cast("int")})
    rows = rows.repartition(partitions(spark, groups), "g")

    grouped = rows.groupBy("g")
    sent = grouped.applyInArrow(lambda t: _minimizer_rows(t, window, buckets), packing.SENT)
    answers = packing.answered(sent, _repeated, out_kind=np.uint8)
    sent = grouped.cogroup(answers.groupBy("g")).applyInArrow(lambda d, a: _node_rows(d, a, window, buckets), packing.SENT)
    answers = packing.answered(sent, _inner, np.uint64, np.uint8)
    pieces = grouped.cogroup(answers.groupBy("g")).applyInArrow(lambda d, a: _piece_rows(d, a, window), SPANS)
    pieces = pieces.repartition(partitions(spark, groups), "hi", "lo")  # one exchange, which the aggregate and the join both read
    # no filter below it and the same columns on both sides, or the planner would make the pieces twice
    first = F.min(F.when(~F.col("done"), F.struct("o", "at", "n", "g", "k"))).alias("first")
    firsts = pieces.groupBy("hi", "lo").agg(first, F.count_if(~F.col("done")).alias("met")).filter("met > 1")
    asked = firsts.select("first.g", "first.k", "first.o", "first.at", "first.n", "hi", "lo")
    sources = grouped.cogroup(asked.groupBy("g")).applyInArrow(_source_rows, SOURCES)
    met = pieces.join(sources, (F.col("hi") == F.col("hi1")) & (F.col("lo") == F.col("lo1")) & ~F.col("done"), "left")
    spans = met.filter(F.col("done") | (F.col("body").isNotNull() & (F.struct("o", "at") > F.struct("o1", "at1")))).select("g", "k", "at", "n", "body")
    names = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, copies long"
    out = grouped.cogroup(spans.groupBy("g")).applyInArrow(lambda d, s: _result(d, s, keep_text), names)
    return repeated(out, "copies", "doc_id", "kept_sha256").drop("nth") if again else out.drop("copies")


def reference(docs: list[tuple], window: int = 20) -> list[tuple]:
    """Brute force, for tests."""
    seen: dict[tuple, tuple] = {}
    lists = [(i, (t or "").encode().split()) for i, t in docs]
    for i, words in lists:
        for at in range(len(words) - window + 1):
            key, here = tuple(words[at : at + window]), (-(2**63) if i is None else i, at)
            seen[key] = min(seen.get(key, here), here)
    out = []
    for i, words in lists:
        keep = [True] * len(words)
        for at in range(len(words) - window + 1):
            if seen[tuple(words[at : at + window])] < (-(2**63) if i is None else i, at):
                keep[at : at + window] = [False] * window
        kept = b" ".join(compress(words, keep))
        out.append((i, len(words), len(words) - sum(keep), hashlib.sha256(kept).hexdigest()))
    return out
