"""SimHash near-dedup by bit-sliced comparison.

A text's fingerprint has 64 bits: of the hashes of its 3-word shingles, repeats
included, the majority at each bit. Texts link where their fingerprints differ
in at most ``RADIUS`` bits; a group of copies has one fingerprint and is one
node from there on.

The fingerprint's bits are dealt into ``CHUNKS`` chunks. Two fingerprints within
the radius differ in at most three chunks, so two chunks are equal: of each pair
of chunks the value is a key, and only fingerprints with a key in common are
compared. A key's fingerprints stand next to each other, in a run. Many runs are
compared at once, by bit planes: plane i holds bit i of all fingerprints, 64 of
them in a word. The planes moved by s places and the planes themselves differ
where the fingerprint s further on differs; carry-save counters (one word a
digit, for 64 comparisons) add up the differences plane by plane, and a word is
abandoned as soon as all of its comparisons exceed the radius or none counts.
Comparisons of what is joined already are left out, so a dense family costs
little more than its first comparisons.

A run of more than ``BLOCK`` fingerprints is cut into blocks by a hash. Blocks are
compared in themselves first; then each two blocks of a run, where only
comparisons between different components count. Tasks give a forest of links,
at most one less than they have fingerprints, never all pairs.

Scale: one pass over whole texts makes (id, fingerprint); distinct fingerprints
travel once for each of the ten keys, some 20 bytes each time. Ids meet their
components by group of ids, so no task gets all rows of one fingerprint.
Intermediate tables are written to the shared folder, and deleted when done.

Edge cases: a text that is null or without words has fingerprint 0 and links
like any other; with fewer words than a shingle the whole sequence is one; a
null id takes part but names nothing, a component of null ids alone has a null
id; repeated rows, and rows with one id and several texts, each get their own
row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deleted, looked_up, noted, pick, small_batches, written
from .components import components
from .packing import Words

#: Differing bits of two fingerprints that link, at most.
RADIUS = 3
#: First and last bit of each chunk; any two are a key.
CHUNKS = ((0, 13), (13, 26), (26, 39), (39, 52), (52, 64))
#: Fingerprints of a block of a run at most, about, and rows of keys in a task's group.
BLOCK, GROUP_ROWS = 1 << 15, 1 << 18
#: Shingles whose bits are counted at once.
PIECE = 1 << 16
#: Planes between two looks at which words can be abandoned.
STEP = 6
#: Runs of several blocks whose list is sent to every task, at most (16 bytes each); beyond, it is joined.
SENT_RUNS = 1 << 20

ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def fingerprints(texts: pa.Array, size: int = 3) -> np.ndarray:
    """The fingerprint of each text."""
    w = Words(texts, lower=True)
    out = np.zeros(len(w.starts), np.uint64)
    if not len(w):
        return out
    buf, at = w.joined()
    number = np.where(w.ends > w.starts, np.maximum(w.ends - w.starts - size + 1, 1), 0)
    before = np.concatenate([[0], np.cumsum(number)])
    counts = np.zeros((len(out), 64), np.int64)
    for low in range(0, int(before[-1]), PIECE):
        high = min(low + PIECE, int(before[-1]))
        text = np.searchsorted(before, np.arange(low, high), "right") - 1
        first = w.starts[text] + np.arange(low, high) - before[text]
        last = np.minimum(first + size, w.ends[text])
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(buf[i:j], 42) for i, j in zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)), np.uint64, high - low)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        counts[text[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    majority = (2 * counts > number[:, None]).astype(np.uint8)
    return np.packbits(majority, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprinted(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp) of every row."""

    def read(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(fingerprints(b.column("text"), size).view(np.int64))], ["doc_id", "fp"])

    return pick(docs, "doc_id", "text").mapInArrow(read, "doc_id long, fp long")


def mask_of(chunks: tuple[int, ...]) -> int:
    return sum((1 << high) - (1 << low) for low, high in (CHUNKS[c] for c in chunks))


#: The bits of each key.
MASKS = [mask_of(c) for c in combinations(range(len(CHUNKS)), 2)]


class Planes:
    """Bit planes of fingerprints: 64 rows, a word for every 64 fingerprints, and one word more."""

    def __init__(self, fps: np.ndarray, first: int):
        """``first``: the key's mask; the planes outside of it come first, as only they differ within runs."""
        order = [i for i in range(64) if not first >> i & 1] + [i for i in range(64) if first >> i & 1]
        self.words = -(-len(fps) // 64)
        bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, order].T
        self.planes = np.zeros((64, self.words + 1), np.uint64)
        packed = np.packbits(bits, axis=1, bitorder="little")
        self.planes.view(np.uint8)[:, : packed.shape[1]] = packed

    def moved(self, s: int) -> np.ndarray:
        """The planes moved by fewer than 64 places: bit j of the result is bit j + s."""
        if not s:
            return self.planes
        out = self.planes >> np.uint64(s)
        out[:, :-1] |= self.planes[:, 1:] << np.uint64(64 - s)
        return out


def within(planes: np.ndarray, moved: np.ndarray, at: np.ndarray, skip: int, counting: np.ndarray, radius: int) -> np.ndarray:
    """Of the comparisons that count, those within the radius: words ``at`` of the planes against ``skip`` words further on.

    Digits of the number of differences are words; the counter starts such that its overflow means more than the radius.
    """
    digits = radius.bit_length()
    start = (1 << digits) - 1 - radius
    out = np.zeros(len(at), np.uint64)
    live = np.arange(len(at))
    open_ = counting.copy()
    count = [np.full(len(at), ALL if start >> k & 1 else 0, np.uint64) for k in range(digits)]
    for plane in range(64):
        x = planes[plane, at] ^ moved[plane, at + skip]
        for k in range(digits):
            count[k], x = count[k] ^ x, count[k] & x
        open_ &= ~x
        if plane % STEP == STEP - 1:
            left = open_ != 0
            if not left.all():
                at, live, open_ = at[left], live[left], open_[left]
                count = [c[left] for c in count]
                if not len(at):
                    return out
    out[live] = open_
    return out


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def forest(fps: np.ndarray, run: np.ndarray, mask: int, label: np.ndarray | None = None, side: np.ndarray | None = None, radius: int = RADIUS) -> np.ndarray:
    """Links (rows of places) that join fingerprints of a run within the radius, none between what is joined.

    ``run``: the number of each one's run, ascending. ``label``: components found
    before. ``side``: only fingerprints of different sides are compared.
    """
    n = len(fps)
    links: list[np.ndarray] = []
    parent = np.arange(n)
    if label is not None:
        _, first, inverse = np.unique(label, return_index=True, return_inverse=True)
        parent = first[inverse]
    if n < 2:
        return np.zeros((0, 2), np.int64)
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
    length = np.diff(np.append(first, n))
    room = np.repeat(first + length, length) - 1 - np.arange(n)  # how many of its run come after each one
    by_room = np.argsort(-room, kind="stable")
    rooms = -room[by_room]
    planes = Planes(fps, mask)
    longest = int(length.max())
    for s in range(min(64, longest)):
        moved = planes.moved(s)
        for skip in range(-(-longest // 64)):
            d = 64 * skip + s
            if not 0 < d < longest:
                continue
            here = by_room[: np.searchsorted(rooms, -d, "right")]
            here = here[parent[here] != parent[here + d]]
            if side is not None:
                here = here[side[here] != side[here + d]]
            if not len(here):
                continue
            counting = np.zeros(planes.words * 64, np.uint8)
            counting[here] = 1
            counting = np.packbits(counting, bitorder="little").view(np.uint64)
            at = np.flatnonzero(counting)
            hits = within(planes.planes, moved, at, skip, counting[at], radius)
            hits = np.flatnonzero(np.unpackbits(hits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").ravel())
            if not len(hits):
                continue
            a = at[hits // 64] * 64 + hits % 64
            parent, new = _joined(parent, a, a + d)
            links.append(new)
    return np.concatenate(links) if links else np.zeros((0, 2), np.int64)


def _joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components after these links, and those of them that joined two."""
    top: dict[int, int] = {}

    def root(x: int) -> int:
        while top.get(x, x) != x:
            top[x] = top.get(top[x], top[x])
            x = top[x]
        return x

    used = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(parent[a].tolist(), parent[b].tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            top[max(x, y)] = min(x, y)
            used[i] = True
    parent = parent.copy()
    for x in list(top):
        parent[x] = root(x)
    return roots(parent), np.stack([a[used], b[used]], 1)


def _runs(table: pa.Table, order: np.ndarray, *names: str) -> np.ndarray:
    """The number of each row's run of equal values, in the given order."""
    new = np.zeros(len(order), bool)
    for name in names:
        x = table.column(name).to_numpy()[order]
        new[1:] |= x[1:] != x[:-1]
    return np.cumsum(new)


def _links(fps: np.ndarray, links: list[np.ndarray]) -> pa.Table:
    at = np.concatenate(links) if links else np.zeros((0, 2), np.int64)
    return pa.table([pa.array(fps[at[:, 0]]), pa.array(fps[at[:, 1]])], schema=LINKS)


def _within_blocks(table: pa.Table, radius: int) -> pa.Table:
    """Links within each (key, block) of a group of keys."""
    kind, value, block, fps = (table.column(c).to_numpy() for c in ("kind", "value", "block", "fp"))
    order = np.lexsort((fps, block, value, kind))
    run = _runs(table, order, "kind", "value", "block")
    alone = np.bincount(run)[run] == 1
    order, run = order[~alone], run[~alone]
    out = []
    for k in np.unique(kind[order]).tolist():
        mine = kind[order] == k
        out.append(order[mine][forest(fps[order[mine]].view(np.uint64), run[mine], MASKS[k], radius=radius)])
    return _links(fps, out)


def _between_blocks(table: pa.Table, radius: int) -> pa.Table:
    """Links between the two blocks of a run, where they join different components."""
    kind, block, fps, label = (table.column(c).to_numpy() for c in ("kind", "block", "fp", "component"))
    at = forest(fps.view(np.uint64), np.zeros(len(fps), np.int64), MASKS[int(kind[0])], label, block, radius) if len(fps) else np.zeros((0, 2), np.int64)
    return _links(fps, [at])


def keyed(fps: DataFrame) -> DataFrame:
    """(kind, value, fp): each fingerprint once for each key."""
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("value")) for k, m in enumerate(MASKS)])
    return fps.select(F.explode(keys).alias("key"), "fp").select("key.kind", "key.value", "fp")


def links(fps: DataFrame, number: int, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(id, component) of distinct fingerprints that a link reaches; ``number``: how many there are."""
    if radius > RADIUS:
        raise ValueError(f"two equal chunks are only certain up to {RADIUS} differing bits")
    rows = keyed(fps)
    groups = max(1, -(-len(MASKS) * number // GROUP_ROWS))
    large = rows.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    large = written(large.select("kind", "value", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "runs")
    runs = large.count()
    if runs:
        rows = rows.join(F.broadcast(large) if runs <= SENT_RUNS else large, ["kind", "value"], "left")
    else:
        rows = rows.withColumn("blocks", F.lit(1))
    dealt = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    rows = rows.select("kind", "value", dealt.alias("block"), "fp")
    group = F.pmod(F.xxhash64("kind", "value", "block"), F.lit(groups)).cast("int").alias("g")
    found = rows.select("*", group).groupBy("g").applyInArrow(lambda t: _within_blocks(t, radius), "a long, b long")
    labels = written(components(written(found, "links")), "components")
    if not runs:
        return labels
    # blocks of a run meet in pairs; each is sent once for each of the others
    names = large.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = names.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other <> block")
    pairs = pairs.select("kind", "value", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    named = looked_up(fps.select("fp"), "fp", "fp", labels.select(F.col("id").alias("fp"), "component"))
    own = keyed(fps).join(F.broadcast(large) if runs <= SENT_RUNS else large, ["kind", "value"]).select("kind", "value", dealt.alias("block"), "fp")
    own = own.join(named, "fp").select("kind", "value", "block", "fp", F.coalesce("component", "fp").alias("component"))
    met = own.join(pairs, ["kind", "value", "block"]).groupBy("kind", "value", "x", "y").applyInArrow(lambda t: _between_blocks(t, radius), "a long, b long")
    return components(written(met, "links"), labels)


def near_copies(docs: DataFrame, size: int = 3, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the least doc_id that links reach) of each row."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = written(fingerprinted(docs, size), "fingerprints")
    with noted() as made:
        nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
        labels = links(nodes.select("fp"), nodes.count(), radius, block)
        named = nodes.join(labels, nodes["fp"] == labels["id"], "left").select("fp", F.coalesce("component", "fp").alias("component"), "least")
        least = named.groupBy("component").agg(F.min("least").alias("component_id"))
        named = written(looked_up(named.select("fp", "component"), "fp", "component", least).select("fp", "component_id"), "named")
    deleted(spark, made[:-1])
    out = looked_up(rows, "doc_id", "fp", named)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def reference(docs: list[tuple], size: int = 3, radius: int = RADIUS) -> list[tuple]:
    """Brute force, for tests."""
    prints, parent = [], list(range(len(docs)))
    for _, text in docs:
        w = (text or "").encode().lower().split()
        shingles = [b" ".join(w[j : j + size]) for j in range(max(1, len(w) - size + 1))] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints.append(sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(docs):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return [(name, f"{prints[i]:016x}", least.get(root(i))) for i, (name, _) in enumerate(docs)]
