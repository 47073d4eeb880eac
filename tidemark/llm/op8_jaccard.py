"""N-gram Jaccard join with token-combination prefixes.

Documents are sets of word shingles. Documents of one word sequence are one
class; the join works on one document of each class.

All shingles are put in one order, rarest first. Two sets that link share at
least t of their shingles (t: the threshold's part of the larger set), so the
first that they share stands among the first n - t + 1 of both. If it is rare
(in at most ``RARE`` documents), it is a signature by itself. If it is not, all
that they share are frequent; then both prefixes are extended by c shingles
and hold c + 1 common ones, frequent shingles are dealt into c classes by
their hash, and two common ones fall into one class: pairs of frequent
shingles of a class are the signatures. c grows with the set; each set signs
at its own c and half of it, and sets that can link have one of them in
common. Sets that share fewer than t shingles with all others end here.

Candidates with a common signature are verified exactly on their sets:

1. each document against its signatures' pivots (of each signature the set of
   which the largest part occurs in other documents, as a family's original
   does), the likeliest first, then those not yet in one component with it;
2. signatures that still hold several components: their documents, gathered by
   pivot into families, are compared block by block inside tasks, which give
   the links that join components and no other pair.

So every link is found or joins what is joined already, and copies are never
expanded into all pairs.

Scale: shingles and signatures travel packed, one entry a group of documents
however often they occur; texts move once; a pivot's set moves once to each
group that asks for it. Intermediate tables are written to the shared folder.

Edge cases: null and empty texts have no shingles and their own id as
component; fewer words than a shingle are one shingle; a null id takes no part
and gets a null component; rows with equal ids are one node; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packing
from .common import GROUP_BYTES, byte_texts, group_of, partitions, repeats, small_batches, text_size, written
from .components import components
from .packing import Rolling, Words

#: Documents that a shingle of the rare class occurs in, at most.
RARE = 64
#: Documents of a block in a family, about, and shingles that are compared at once.
FAMILY, COLUMNS = 256, 8192
#: Prefix shingles for each class of frequent shingles, about.
PER_CLASS = 4

SETS = "id long, k long, n int, shared binary, signs binary"
SETS_SCHEMA = pa.schema([("id", pa.int64()), ("k", pa.int64()), ("n", pa.int32()), ("shared", pa.binary()), ("signs", pa.binary())])
PAIR_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("votes", pa.int32())])
DONE_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("same", pa.int64()), ("total", pa.int64())])
HOLD_SCHEMA = pa.schema([("pivot", pa.int64()), ("id", pa.int64()), ("component", pa.int64())])
#: A document as a signature's pivot: the parts in a million of its set that occur in no other document, and its id.
PIVOT = np.dtype([("own", "<i8"), ("id", "<i8")])
SPLIT = np.iinfo(np.int64).min  # a signature with several components in one group


def class_keys(docs: DataFrame, groups: int) -> DataFrame:
    """id, k, g of each document, and a 128-bit key of its lower-cased word sequence (null without words)."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).withColumn("k", F.xxhash64("doc_id", "text"))

    def keys(batches):
        for b in batches:
            hi, lo = [], []
            for text in byte_texts(b):
                words = text.lower().split() if text else []
                d = xxhash.xxh3_128_intdigest(b" ".join(words)) if words else None
                hi.append(None if d is None else (d >> 64) - (1 << 63))
                lo.append(None if d is None else (d & packing.MASK) - (1 << 63))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("k"), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], ["id", "k", "hi", "lo"])

    return rows.mapInArrow(keys, "id long, k long, hi long, lo long").withColumn("g", F.pmod("k", F.lit(groups)).cast("int"))


class Shingles:
    """Distinct (shingle, document) of the asked documents of a group, ordered by shingle."""

    def __init__(self, docs: pa.Table, wanted: set[int], size: int):
        ks = docs.column("k").to_pylist()
        rows = [i for i, k in enumerate(ks) if k in wanted]
        seen, keep = set(), []
        for i in rows:  # a row that is there twice counts once
            if ks[i] not in seen:
                seen.add(ks[i])
                keep.append(i)
        self.docs = docs.take(pa.array(keep, pa.int64()))
        w = Words(self.docs.column("text"), lower=True)
        roll = Rolling(w.hashes)
        grams = roll.windows(size)
        inside = w.ends[w.text_of[: len(grams)]] - np.arange(len(grams)) >= size if len(grams) else np.zeros(0, bool)
        short = np.flatnonzero((w.ends - w.starts < size) & (w.ends > w.starts))
        hashes = np.concatenate([grams[inside], roll.spans(w.starts[short], w.ends[short])])
        doc = np.concatenate([w.text_of[: len(grams)][inside], short]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        hashes, doc = hashes[order], doc[order]
        # a stable sort keeps the documents of a shingle in order, but for short ones, which have no other shingle
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])]) if len(hashes) else np.zeros(0, bool)
        self.hashes, self.doc = hashes[new], doc[new]


def _shingle_rows(docs: pa.Table, reps: pa.Table, size: int, buckets: int) -> pa.Table:
    if not docs.num_rows or not reps.num_rows:
        return packing.SENT_SCHEMA.empty_table()
    s = Shingles(docs, set(reps.column("k").to_pylist()), size)
    if not len(s.hashes):
        return packing.SENT_SCHEMA.empty_table()
    hashes, counts = np.unique(s.hashes, return_counts=True)
    return packing.sent_rows(docs.column("g")[0].as_py(), hashes, counts.astype(np.uint32), buckets)


def _frequency(first: np.ndarray, notes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = np.add.reduceat(notes.astype(np.int64), first)
    return total > 1, np.minimum(total, 2**32 - 1)


def classes_for(t: int) -> int:
    """Classes of frequent shingles for sets that need t in common: a power of two, less than t."""
    c = 1
    while 2 * c <= (t - 1) // PER_CLASS:
        c *= 2
    return c


def signatures(hashes: np.ndarray, count: np.ndarray, threshold: int) -> np.ndarray:
    """Signatures of one set; ``count``: documents of each of its shingles. ``hashes`` in any order."""
    n = len(hashes)
    t = -(-threshold * n // 100)
    order = np.lexsort((hashes, count))
    hashes, count = hashes[order], count[order]
    if t < 2:
        return hashes
    head = slice(0, n - t + 1)
    out = [hashes[head][(count[head] > 1) & (count[head] <= RARE)]]
    c = classes_for(t)
    for level in {c, max(1, c // 2)}:
        part = slice(0, n - t + level + 1)
        frequent = hashes[part][count[part] > RARE]
        if len(frequent) < 2:
            continue
        kind = (frequent >> np.uint64(7)) & np.uint64(level - 1)
        by = np.argsort(kind, kind="stable")
        for own in np.split(frequent[by], np.flatnonzero(np.diff(kind[by])) + 1):
            i, j = np.triu_indices(len(own), 1)
            out.append(packing.mixed(own[i] * np.uint64(0x9FB21C651E98DF25) + own[j] * np.uint64(0xD6E8FEB86659FD93) + np.uint64(level)))
    return np.unique(np.concatenate(out))


def _set_rows(docs: pa.Table, side: pa.Table, size: int, threshold: int) -> pa.Table:
    reps = set(side.column("k").to_pylist()) - {None}
    if not docs.num_rows or not reps:
        return SETS_SCHEMA.empty_table()
    s = Shingles(docs, reps, size)
    known, counts = packing.known_of(side)
    at = known.find(s.hashes)
    count = np.where(at >= 0, counts[np.maximum(at, 0)] if len(counts) else 0, 1).astype(np.int64)
    number = s.docs.num_rows
    n = np.bincount(s.doc, minlength=number)
    common = np.bincount(s.doc[count > 1], minlength=number)
    rows = []
    alive = (n > 0) & (100 * common >= threshold * n)
    mine = alive[s.doc]
    order = np.argsort(s.doc[mine], kind="stable")
    hashes, count, doc = s.hashes[mine][order], count[mine][order], s.doc[mine][order]
    cuts = np.searchsorted(doc, np.arange(number + 1))
    for d, (i, k) in enumerate(zip(s.docs.column("doc_id").to_pylist(), s.docs.column("k").to_pylist(), strict=True)):
        if not alive[d] or i is None:
            rows.append((i, k, int(n[d]), None, None))
            continue
        own, c = hashes[cuts[d] : cuts[d + 1]], count[cuts[d] : cuts[d + 1]]
        rows.append((i, k, int(n[d]), packing.planes(own[c > 1]), packing.planes(signatures(own, c, threshold))))
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), SETS_SCHEMA, strict=True)], schema=SETS_SCHEMA)


def _signs(sets: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All signatures of a group's sets, the row of each, and the rows' ids."""
    parts = [packing.unplaned(x) for x in sets.column("signs").to_pylist()]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), row, sets.column("id").to_numpy()


def _worth(sets: pa.Table) -> np.ndarray:
    """Parts in a million of each set that occur in no other document: the least are nearest to a family's centre."""
    common = np.array([len(x) // 8 for x in sets.column("shared").to_pylist()], np.int64)
    n = sets.column("n").to_numpy().astype(np.int64)
    return (n - common) * 1_000_000 // np.maximum(n, 1)


def _pivot_rows(sets: pa.Table, buckets: int) -> pa.Table:
    signs, row, ids = _signs(sets)
    if not len(signs):
        return packing.SENT_SCHEMA.empty_table()
    own = _worth(sets)[row]
    order = np.lexsort((ids[row], own, signs))
    signs = signs[order]
    first = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]]))
    notes = np.empty(len(first), PIVOT)
    notes["own"], notes["id"] = own[order][first], ids[row][order][first]
    return packing.sent_rows(sets.column("g")[0].as_py(), signs[first], notes, buckets)


def _best(first: np.ndarray, notes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of several groups, and the best pivot of each."""
    count = np.diff(np.append(first, len(notes)))
    order = np.lexsort((notes["id"], notes["own"], np.repeat(np.arange(len(first)), count)))
    return count > 1, notes["id"][order][first]


def _with_pivots(sets: pa.Table, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each signature of each set: the signature, the set's id and the signature's pivot."""
    signs, row, ids = _signs(sets)
    own = ids[row]
    known, pivots = packing.known_of(answers, np.int64)
    order = np.lexsort((own, _worth(sets)[row], signs))
    signs, own = signs[order], own[order]
    new = np.concatenate([[True], signs[1:] != signs[:-1]]) if len(signs) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    pivot = own[first]
    at = known.find(signs[first])
    if len(pivots):
        pivot = np.where(at >= 0, pivots[np.maximum(at, 0)], pivot)
    return signs, own, pivot[np.cumsum(new) - 1] if len(signs) else own


def _pair_rows(sets: pa.Table, answers: pa.Table) -> pa.Table:
    if not sets.num_rows:
        return PAIR_SCHEMA.empty_table()
    _, own, pivot = _with_pivots(sets, answers)
    other = own != pivot
    own, pivot = own[other], pivot[other]
    order = np.lexsort((pivot, own))
    own, pivot = own[order], pivot[order]
    if not len(own):
        return PAIR_SCHEMA.empty_table()
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (pivot[1:] != pivot[:-1])]))
    votes = np.diff(np.append(first, len(own)))
    return pa.table([pa.array(own[first]), pa.array(pivot[first]), pa.array(votes, pa.int32())], schema=PAIR_SCHEMA)


def _verified_rows(sets: pa.Table, side: pa.Table) -> pa.Table:
    mine: dict[int, list] = {}
    for i, n, x in zip(*(sets.column(c).to_pylist() for c in ("id", "n", "shared")), strict=True):
        mine.setdefault(i, []).append((n, packing.unplaned(x)))
    theirs: dict[int, list] = {}
    pairs = []
    for a, b, n, x in zip(*(side.column(c).to_pylist() for c in ("a", "b", "n", "shared")), strict=True):
        if x is None:
            pairs.append((a, b))
        else:
            theirs.setdefault(b, []).append((n, packing.unplaned(x)))
    rows = []
    for a, b in pairs:
        best = (0, 1)
        for n, x in mine.get(a, ()):
            for m, y in theirs.get(b, ()):
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                same = int((y[at] == x).sum())
                best = max(best, (same, n + m - same), key=lambda p: p[0] / p[1])
        rows.append((a, b, *best))
    return pa.table([pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)], schema=DONE_SCHEMA) if rows else DONE_SCHEMA.empty_table()


def _component_rows(sets: pa.Table, labels: pa.Table, buckets: int) -> pa.Table:
    signs, row, ids = _signs(sets)
    if not len(signs):
        return packing.SENT_SCHEMA.empty_table()
    label = _labels(ids, labels)[row]
    order = np.lexsort((label, signs))
    signs, label = signs[order], label[order]
    first = np.flatnonzero(np.concatenate([[True], signs[1:] != signs[:-1]]))
    last = np.append(first[1:], len(signs)) - 1
    return packing.sent_rows(sets.column("g")[0].as_py(), signs[first], np.where(label[first] == label[last], label[first], SPLIT), buckets)


def _labels(ids: np.ndarray, labels: pa.Table) -> np.ndarray:
    known = dict(zip(labels.column("id").to_pylist(), labels.column("component").to_pylist(), strict=True))
    return np.array([known.get(i, i) for i in ids.tolist()], np.int64)


def _divided(first: np.ndarray, notes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low, high = np.minimum.reduceat(notes, first), np.maximum.reduceat(notes, first)
    return (low != high) | (low == SPLIT), low


def _holder_rows(sets: pa.Table, side: pa.Table) -> pa.Table:
    kind = side.column("kind").to_numpy() if side.num_rows else np.zeros(0)
    part = lambda k: side.filter(pa.array(kind == k))
    if not sets.num_rows or not side.num_rows:
        return HOLD_SCHEMA.empty_table()
    divided, _ = packing.known_of(part(0), np.int64)
    signs, own, pivot = _with_pivots(sets, part(1))
    which = divided.find(signs) >= 0
    rows = np.unique(np.stack([pivot[which], own[which]], 1), axis=0)
    return pa.table([pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(_labels(rows[:, 1], part(2)))], schema=HOLD_SCHEMA)


def _family_rows(members: pa.Table, threshold: int) -> pa.Table:
    """Links between different components among the members of two blocks: a forest of them."""
    ids, parts = members.column("id").to_pylist(), [packing.unplaned(x) for x in members.column("shared").to_pylist()]
    n, count = members.column("n").to_numpy().astype(np.int64), len(parts)
    size = [len(p) for p in parts]
    row = np.repeat(np.arange(count), size)
    tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    _, token, often = np.unique(tokens, return_inverse=True, return_counts=True)
    row, token = row[often[token] > 1], token[often[token] > 1]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    token = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) if len(token) else token
    same = np.zeros((count, count), np.float32)
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
        i, j = np.searchsorted(token, [low, low + COLUMNS])
        part = np.zeros((count, COLUMNS), np.float32)
        part[row[i:j], token[i:j] - low] = 1
        same += part @ part.T
    same = same.astype(np.int64)
    a, b = np.nonzero(np.triu(same * (100 + threshold) >= threshold * (n[:, None] + n[None, :]), 1))
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x] = parent[parent[x]]
        return x

    labels, links = members.column("component").to_pylist(), []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(labels[i]), root(labels[j])
        if x != y:
            parent[y] = x
            links.append((ids[i], ids[j]))
    x, y = zip(*links, strict=True) if links else ((), ())
    return pa.table([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])


def family_pairs(held: DataFrame) -> DataFrame:
    """(pivot, x, y, id, component): the documents of each pair of blocks x and y that is compared."""
    sizes = held.groupBy("pivot", "component").agg(F.count(F.lit(1)).alias("size"))
    own = F.col("size") >= FAMILY // 2
    sizes = sizes.select("pivot", "component", "size", own.alias("own"), F.when(own, F.col("component")).otherwise(F.lit(0).cast("long")).alias("part"))
    kinds = sizes.groupBy("pivot", "own", "part").agg(F.ceil(F.sum("size") / FAMILY).cast("int").alias("blocks"), F.sum("size").alias("size"))
    name = lambda i: F.concat_ws(":", F.col("own").cast("string"), F.col("part").cast("string"), i.cast("string"))
    rows = held.join(sizes.drop("size"), ["pivot", "component"]).join(kinds.drop("size"), ["pivot", "own", "part"])
    rows = rows.select("pivot", name(F.pmod(F.xxhash64("id", "pivot"), "blocks")).alias("block"), "id", "component")
    # the largest component with blocks of its own meets the other blocks; its blocks begin no pair
    main = kinds.filter("own").groupBy("pivot").agg(F.max_by("part", F.struct("size", "part")).alias("main"))
    blocks = kinds.join(main, "pivot", "left").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.select("pivot", name(F.col("i")).alias("x"), F.when(F.col("own"), F.col("part")).alias("of"), (F.col("own") & (F.col("part") == F.col("main"))).alias("is_main"))
    others = blocks.select(F.col("pivot").alias("q"), F.col("x").alias("y"), F.col("of").alias("other"), F.col("is_main").alias("main"))
    meets = (F.col("pivot") == F.col("q")) & (F.col("main") | (F.col("x") <= F.col("y"))) & ~F.coalesce(F.col("of") == F.col("other"), F.lit(False))
    pairs = blocks.filter(~F.coalesce("is_main", F.lit(False))).join(others.withColumn("main", F.coalesce("main", F.lit(False))), meets).select("pivot", "x", "y")
    return pairs.withColumn("block", F.explode(F.array_distinct(F.array("x", "y")))).join(rows, ["pivot", "block"]).select("pivot", "x", "y", "id", "component")


class Join:
    """The sets that may link, in groups, and what is verified on them."""

    def __init__(self, sets: DataFrame):
        spark = sets.sparkSession
        alive = sets.filter("shared IS NOT NULL")
        self.size = alive.agg(F.sum(F.octet_length("shared")).alias("x"), F.sum(F.octet_length("signs")).alias("y")).first()
        self.groups = max(1, -(-((self.size["x"] or 0) + (self.size["y"] or 0)) // GROUP_BYTES))
        self.buckets = packing.buckets_for((self.size["y"] or 0) // 8)
        self.count = partitions(spark, self.groups)
        self.sets = alive.select("id", "n", "shared", "signs").withColumn("g", group_of(self.groups, "id"))

    def grouped(self):
        return self.sets.repartition(self.count, "g").groupBy("g")

    def pivots(self) -> DataFrame:
        buckets = self.buckets
        return packing.answered(self.grouped().applyInArrow(lambda t: _pivot_rows(t, buckets), packing.SENT), _best, PIVOT, np.int64)

    def candidates(self) -> DataFrame:
        return self.grouped().cogroup(self.pivots().groupBy("g")).applyInArrow(_pair_rows, "a long, b long, votes int")

    def verify(self, pairs: DataFrame, name: str) -> DataFrame:
        """(a, b, same, total): the sizes of both sets' intersection and union."""
        asked = pairs.select("a", "b").withColumn("g", group_of(self.groups, "a"))
        # by as many partitions as the sets ask for, not as the session has
        sent = asked.select("g", "b").distinct().repartition(self.count, "b").join(self.sets.select(F.col("id").alias("b"), "n", "shared").repartition(self.count, "b"), "b")
        side = asked.select("g", "a", "b", F.lit(None).cast("int").alias("n"), F.lit(None).cast("binary").alias("shared")).unionByName(sent.select("g", F.lit(None).cast("long").alias("a"), "b", "n", "shared"))
        sets = self.sets.select("g", "id", "n", "shared").repartition(self.count, "g").groupBy("g")
        return written(sets.cogroup(side.groupBy("g")).applyInArrow(_verified_rows, "a long, b long, same long, total long"), name)

    def holders(self, labels: DataFrame) -> DataFrame:
        """(pivot, id, component): the documents of signatures that hold several components, by the signatures' pivots."""
        buckets = self.buckets
        label = labels.withColumn("g", group_of(self.groups, "id"))
        divided = packing.answered(self.grouped().cogroup(label.groupBy("g")).applyInArrow(lambda s, x: _component_rows(s, x, buckets), packing.SENT), _divided, np.int64, np.int64)
        none = {"hashes": F.lit(None).cast("binary"), "notes": F.lit(None).cast("binary")}
        no_label = {"id": F.lit(None).cast("long"), "component": F.lit(None).cast("long")}
        side = divided.withColumns(no_label | {"kind": F.lit(0)}).unionByName(self.pivots().withColumns(no_label | {"kind": F.lit(1)})).unionByName(label.withColumns(none | {"kind": F.lit(2)}))
        return self.grouped().cogroup(side.groupBy("g")).applyInArrow(_holder_rows, "pivot long, id long, component long")

    def family_links(self, held: DataFrame, threshold: int) -> DataFrame:
        """Links (a, b) between different components among the documents of one pivot.

        A family is cut into blocks of bounded size: large components have blocks of
        their own, small ones share some. Each task takes two blocks that hold
        different components and gives links alone, at most one less than it has
        documents. Blocks of one component never meet, so a family that is one
        component but for a few documents is read once for each block of those few.
        """
        sets = self.sets.select("id", "n", "shared").repartition(self.count, "id")
        rows = family_pairs(held).join(sets, "id")
        return rows.groupBy("pivot", "x", "y").applyInArrow(lambda t: _family_rows(t, threshold), "a long, b long")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ids are in different components."""
    a = labels.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    b = labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    out = pairs.join(a, "a", "left").join(b, "b", "left")
    return out.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")


def linked(sets: DataFrame, threshold: int = 75) -> DataFrame:
    """(id, component) of every id that a link reaches."""
    join = Join(sets)
    link = F.col("same") * 100 >= F.col("total") * threshold
    pairs = written(join.candidates(), "candidates")
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("votes", -F.col("b"))).alias("b"))
    done = join.verify(best, "verified")
    labels = components(done.filter(link))
    labels = written(labels, "components")
    more = _apart(pairs.join(done, ["a", "b"], "left_anti"), labels)
    second = join.verify(more, "verified")
    done = done.unionByName(second)
    labels = components(second.filter(link), labels)

    held = written(join.holders(labels), "holders")
    if held.isEmpty():
        return labels
    last = written(join.family_links(held, threshold).distinct(), "families")
    return components(last, labels)


def similar(docs: DataFrame, size: int = 5, threshold: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id of each document.

    Documents link when 100 * intersection >= threshold * union of their sets of
    ``size``-word shingles; a component is named by its least doc_id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    _, total = text_size(docs)
    groups = max(1, -(-total // GROUP_BYTES))
    buckets = packing.buckets_for(total // 7)
    keys = written(class_keys(docs, groups), "classes")
    reps = keys.filter("hi IS NOT NULL AND id IS NOT NULL").groupBy("hi", "lo").agg(F.min(F.struct("id", "k", "g")).alias("r"))
    lone = keys.filter("hi IS NOT NULL AND id IS NULL")  # a null id: counted, never linked
    asked = reps.select("r.g", "r.k").unionByName(lone.select("g", "k").distinct())
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).withColumn("k", F.xxhash64("doc_id", "text")).withColumn("g", F.pmod("k", F.lit(groups)).cast("int"))
    if repeats(keys, "k"):  # rows equal in id and text are one document, however many they are
        rows = rows.distinct()
    grouped = rows.repartition(partitions(spark, groups), "g").groupBy("g")
    sent = grouped.cogroup(asked.groupBy("g")).applyInArrow(lambda d, r: _shingle_rows(d, r, size, buckets), packing.SENT)
    counts = packing.answered(sent, _frequency)
    none = F.lit(None).cast("binary")
    side = asked.select("g", "k", none.alias("hashes"), none.alias("notes")).unionByName(counts.select("g", F.lit(None).cast("long").alias("k"), "hashes", "notes"))
    sets = written(grouped.cogroup(side.groupBy("g")).applyInArrow(lambda d, x: _set_rows(d, x, size, threshold), SETS), "sets")
    labels = linked(sets, threshold)

    sized = sets.select("k", "n").dropDuplicates(["k"])
    classes = reps.select("hi", "lo", F.col("r.id").alias("rep"), F.col("r.k").alias("k")).join(sized, "k", "left").drop("k")
    classes = classes.join(labels, classes["rep"] == labels["id"], "left").select("hi", "lo", "n", F.coalesce("component", "rep").alias("component"))
    known = keys.filter("hi IS NOT NULL AND id IS NOT NULL").join(classes, ["hi", "lo"]).select("id", "n", "component")
    alone = lone.join(sized, "k", "left").select("id", "n", F.lit(None).cast("long").alias("component"))
    blank = keys.filter("hi IS NULL").select("id", F.lit(0).alias("n"), F.col("id").alias("component"))
    every = known.unionByName(alone).unionByName(blank)
    return every.select(F.col("id").alias("doc_id"), F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, threshold: int = 75) -> DataFrame:
    """The documents, in their columns, that name their component: one of each group of near copies.

    Of rows repeated with the same doc_id (or none) and the same text one stays. A
    row without an id is no node: it is not held against other texts, nor are rows
    that share an id but not a text, which are one node. Null and empty texts stay;
    columns of any name pass through; an empty table stays empty.
    """
    col = lambda c: F.col("`" + c.replace("`", "``") + "`")
    plain = [col(c) for c, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    # the columns travel in a struct, so none meets a name of this operator's own
    rows = docs.select(F.struct(*map(col, docs.columns)).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64(*plain).alias("tie"))
    gone = similar(docs, size, threshold).filter("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    kept = rows.join(gone, F.col("id") == F.col("gone"), "left_anti")
    again = docs.groupBy(F.col("doc_id").cast("long").alias("again")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("again")
    if not again.isEmpty():
        same = F.col("id").eqNullSafe(F.col("again"))
        one = kept.join(again, same, "left_semi").groupBy("id", F.col("doc.text").alias("text")).agg(F.min_by("doc", "tie").alias("doc"))
        kept = kept.join(again, same, "left_anti").select("doc").unionByName(one.select("doc"))
    return kept.select("doc.*")


def reference(docs: list[tuple], size: int = 5, threshold: int = 75) -> list[tuple]:
    """Brute force, for tests."""
    sets, parent = {}, {}
    for i, text in docs:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
        parent[i] = i

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 4 * len(a) >= 3 * len(b) * threshold / 75 - 1 and 4 * len(b) >= 3 * len(a) * threshold / 75 - 1:
                same = len(a & b)
                if 100 * same >= threshold * (len(a) + len(b) - same):
                    low, high = sorted((root(i), root(j)))
                    parent[high] = low
    return [(i, len(sets[i]), root(i)) for i in ids]
