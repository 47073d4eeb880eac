"""Mixing sources to target weights by Pfair scheduling; documents are placed by DataFrame functions only.

Each source's documents are cut into blocks of equal size. Time runs in slots
of one block. With weight w, block k of a source is released at floor(k / w)
and due at ceil((k + 1) / w); in every slot the released block that is due
earliest runs (ties: the source that sorts first). When a source runs out, the
others go on with their weights scaled up, and the windows follow: the target
is the fluid mix, in which all sources run at once, each at its share of the
weights of those that have blocks left. As the shares always add up to 1, no
block misses its window, so each source is less than one block away from its
target at any time, over the whole schedule.

Weights are exact fractions: windows are computed in whole numbers of any size.

Scale: documents are numbered within (source, bucket) groups of bounded size,
then shifted by the buckets' running counts: no source, however large, is
sorted in one task. A bucket of more than ``FULL`` times its documents holds rows of one id and
text: then equal rows are counted before they are numbered, go through as one, and are
dealt out again in parts. The driver plans the slots, one step a block in the time of
a heap's operation; it holds 8 bytes a block and a row a source and a bucket. A
block has ``BLOCK`` documents and a bucket ``BUCKET``, and more where that would
be over ``MOST_BLOCKS`` blocks or ``MOST_BUCKETS`` buckets, so the plan stays at
some hundred MB and a minute whatever the corpus; a bucket's slots travel with
its row in the table that is joined. There may be any number of sources: only those of more than
``BUCKET`` documents, at most one in so many documents, are sent to every task.

Edge cases: a null source is a source of its own; a source without a weight
gets its share of the documents; repeated rows each get a place; an empty
table gives no rows; no column is lost, renamed or overwritten, whatever its
name; rows with null or equal ids are told apart by their texts. Rows that are equal in id and text
but differ in a further column stay in one bucket, as do equal ones of a table with maps or variants.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left
from collections import Counter
from fractions import Fraction
from heapq import heappop, heappush
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from .common import repeated, shared_path

#: Documents of a block, at least, and blocks that the driver plans at most.
BLOCK, MOST_BLOCKS = 16, 1 << 22
#: Documents of a numbering bucket, about, at least, and buckets whose sizes the driver holds beside one a source:
#: each source has as many buckets as its size asks for.
BUCKET, MOST_BUCKETS = 2_000, 1 << 20
#: Times the documents of a bucket that different ones never reach: they are dealt by 64-bit hashes.
FULL = 2
#: Times of the fluid mix that are remembered, by weight and block: sources of one size ask for the same.
KNOWN = 1 << 16
#: Slots and buckets of the plan in one write, about.
PIECE = 250_000
#: The name under which a null source is mixed.
NULL_SOURCE = "(null)"


class Fluid:
    """When the fluid mix has passed k blocks of a source.

    At level v each source has passed min(n, w * v) blocks. Between the levels n / w
    at which sources run out, the slots passed are ``done`` + ``rate`` * v, with whole
    numbers of blocks of those that ran out and weights of those that are left.
    """

    def __init__(self, blocks: list[int], weights: list[int]):
        ends: dict[Fraction, list[int]] = {}  # blocks and weights of all sources that run out at a level
        for (n, w), many in Counter(zip(blocks, weights, strict=True)).items():
            own = ends.setdefault(Fraction(n, w), [0, 0])
            own[0] += n * many
            own[1] += w * many
        self.exact = sorted(ends)
        self.levels = [float(x) for x in self.exact]
        self.done, self.rate = [0], [sum(weights)]
        for level in self.exact:
            n, w = ends[level]
            self.done.append(self.done[-1] + n)
            self.rate.append(self.rate[-1] - w)
        self.known: dict[tuple[int, int], tuple[int, int]] = {}

    def at(self, w: int, k: int) -> tuple[int, int]:
        """The slots passed at block k of a source of this weight, rounded down and up."""
        if (w, k) not in self.known:
            if len(self.known) >= KNOWN:
                self.known.clear()
            level = Fraction(k, w)
            j = bisect_left(self.levels, float(level))  # nearly: the levels are compared exactly from there
            while j < len(self.exact) and self.exact[j] < level:
                j += 1
            while j and self.exact[j - 1] >= level:
                j -= 1
            slots, part = divmod(self.rate[j] * k, w)
            self.known[w, k] = self.done[j] + slots, self.done[j] + slots + (part > 0)
        return self.known[w, k]


def slots_of(blocks: dict[str, int], weights: dict[str, float | Fraction]) -> dict[str, array]:
    """The slot of each block of each source, by earliest deadline first against the fluid mix."""
    names = sorted(s for s, n in blocks.items() if n)
    exact = [Fraction(weights[s]) for s in names]
    if any(w <= 0 for w in exact):
        raise ValueError("weights must be positive")
    unit = lcm(*[w.denominator for w in exact])
    count = [blocks[s] for s in names]
    whole = [w.numerator * (unit // w.denominator) for w in exact]
    fluid = Fluid(count, whole)
    out = [array("q") for _ in names]
    ready: list[tuple[int, int]] = []
    waiting: list[tuple[int, int, int]] = []
    for i in range(len(names)):
        heappush(ready, (fluid.at(whole[i], 1)[1], i))
    for t in range(sum(count)):
        while waiting and waiting[0][0] <= t:
            heappush(ready, heappop(waiting)[1:])
        _, i = heappop(ready)
        out[i].append(t)
        k = len(out[i])
        if k < count[i]:
            heappush(waiting, (fluid.at(whole[i], k)[0], fluid.at(whole[i], k + 1)[1], i))
    return dict(zip(names, out, strict=True))


def bucket_plan(spark: SparkSession, sizes: list[tuple[str, int, int]], slots: dict[str, array], block: int, most: int) -> DataFrame:
    """(mix_s, mix_b, mix_piece, mix_before, mix_slots): for each piece of at most so many documents of a bucket the
    documents of the source before it, and the slots of the blocks that it meets."""
    kinds = pa.schema([("mix_s", pa.string()), ("mix_b", pa.int32()), ("mix_piece", pa.int64()), ("mix_before", pa.int64()), ("mix_slots", pa.list_(pa.int64()))])
    path, rows, held, before, last = shared_path(spark, "mix"), [], 0, 0, None

    def write() -> None:
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        df = spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in columns], schema=kinds))
        df.write.mode("append").parquet(path)

    for s, b, n in sorted(sizes):
        before = before if s == last else 0
        for piece, first in enumerate(range(0, n, most)):
            begin, end = before + first, before + min(n, first + most)
            own = slots[s][begin // block : (end - 1) // block + 1]
            rows.append((s, b, piece, begin, own))
            held += 1 + len(own)
            if held >= PIECE:
                write()
                rows, held = [], 0
        before, last = before + n, s
    if rows:
        write()
    return spark.read.schema("mix_s string, mix_b int, mix_piece long, mix_before long, mix_slots array<long>").parquet(path)


def _rows(df: DataFrame) -> list[tuple]:
    """The rows of a narrow table, sent as Arrow."""
    return list(zip(*df.toArrow().to_pydict().values(), strict=True))


def block_size(rows: int) -> int:
    """Documents of a block: ``BLOCK``, doubled until the driver plans at most ``MOST_BLOCKS``."""
    return _doubled(BLOCK, rows, MOST_BLOCKS)


def bucket_size(rows: int) -> int:
    """Documents of a numbering bucket: ``BUCKET``, doubled until there are at most ``MOST_BUCKETS`` and one a source."""
    return _doubled(BUCKET, rows, MOST_BUCKETS)


def _doubled(size: int, rows: int, most: int) -> int:
    while rows > size * most:
        size *= 2
    return size


def placed(docs: DataFrame, carry: list[str], weights: dict[str, float] | None = None, block: int | None = None) -> DataFrame:
    """``doc`` (a struct of the carried columns), source, block, slot and place of every row.

    The documents' columns travel inside the struct, so none meets a name of this operator's own.
    """
    spark = docs.sparkSession
    col = lambda c: F.col("`" + c.replace("`", "``") + "`")
    plain = [c for c, kind in docs.dtypes if c in carry and "map<" not in kind and kind != "variant"]
    name = F.coalesce(F.col("source").cast("string"), F.lit(NULL_SOURCE))
    content = F.xxhash64("doc_id", *(["text"] if "text" in docs.columns else []))
    counts = dict(_rows(docs.groupBy(name.alias("s")).agg(F.count(F.lit(1)).alias("n"))))
    total = sum(counts.values())
    block = block or block_size(total)
    rows = docs.select(F.struct(*[col(c) for c in carry]).alias("doc"), name.alias("source"), content.alias("h"), F.xxhash64(*[col(c) for c in plain], *[col(c).isNull() for c in plain]).alias("tie"), F.col("doc_id").cast("string").alias("name"))
    if not total:
        none = F.lit(None).cast("long")
        return rows.select("doc", "source", none.alias("block"), none.alias("slot"), none.alias("place"))
    given = {s: n**0.5 for s, n in counts.items()} if weights is None else {s: weights.get(s, n / total) for s, n in counts.items()}
    bucket_rows = bucket_size(total)
    large = [(s, -(-n // bucket_rows)) for s, n in counts.items() if n > bucket_rows]
    kinds = pa.schema([("mix_large", pa.string()), ("mix_buckets", pa.int32())])
    large = F.broadcast(spark.createDataFrame(pa.Table.from_pylist([dict(zip(kinds.names, x, strict=True)) for x in large], kinds)))
    bucket = F.pmod("h", F.coalesce("mix_buckets", F.lit(1))).cast("int").alias("b")
    dealt = lambda df: df.join(large, F.col("source") == F.col("mix_large"), "left").select(*df.columns, bucket)
    sizes = _rows(dealt(docs.select(name.alias("source"), content.alias("h"))).groupBy("source", "b").agg(F.count(F.lit(1)).alias("n")))
    slots = slots_of({s: -(-n // block) for s, n in counts.items()}, given)
    most = FULL * bucket_rows
    plan = bucket_plan(spark, sizes, slots, block, most)
    # every order key is the row's own content, so a task that runs again numbers its rows as before
    inside = Window.partitionBy("source", "b").orderBy(F.xxhash64("h", F.lit("mix")), "name", "tie")
    bucket_is = (F.col("source") == F.col("mix_s")) & (F.col("b") == F.col("mix_b"))
    if max(n for _, _, n in sizes) <= most:  # each bucket is one piece
        rows = dealt(rows).withColumn("n", F.row_number().over(inside) - 1).join(plan, bucket_is)
    else:
        rows = numbered(dealt(rows), carry if len(plain) == len(carry) else None, inside)
        rows = rows.withColumn("piece", F.floor(F.col("n") / most)).join(plan, bucket_is & (F.col("piece") == F.col("mix_piece")))
        rows = rows.withColumn("n", F.col("n") - F.col("piece") * most)
    rows = rows.withColumn("n", F.col("n") + F.col("mix_before")).withColumn("block", F.floor(F.col("n") / block))
    slot = F.element_at("mix_slots", (F.col("block") - F.floor(F.col("mix_before") / block) + 1).cast("int"))
    return rows.select("doc", "source", "block", slot.alias("slot"), (F.col("n") % block).alias("place"))


def numbered(rows: DataFrame, carried: list[str] | None, inside: WindowSpec) -> DataFrame:
    """``rows`` with their number ``n`` in their bucket, where some bucket is full of equal rows: these go through as one.

    Equal means in every carried column; tables with columns that Spark cannot compare (None) are numbered row by row.
    """
    if carried is None:
        return rows.withColumn("n", F.row_number().over(inside) - 1)
    keys = ["source", "b", "h", "tie", "name"]
    fields = {f"mix_c{i}": F.col("doc").getField(c) for i, c in enumerate(carried)}
    once = rows.select(*keys, *[c.alias(k) for k, c in fields.items()]).groupBy(*keys, *fields).agg(F.count(F.lit(1)).alias("copies"))
    once = once.withColumn("n", F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies"))
    doc = F.struct(*[F.col(k).alias(c) for k, c in zip(fields, carried, strict=True)]).alias("doc")
    return repeated(once, "copies", "h").select("source", "b", doc, (F.col("n") + F.col("nth")).alias("n"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block: int | None = None) -> DataFrame:
    """The documents with ``mix_source``, ``mix_block`` (of its source), ``mix_slot`` and ``mix_index`` (in its block).

    The mixed order is that of (mix_slot, mix_index); within a source documents
    are in hashed order. ``weights``: a positive target for each source; those
    not named get their share of the documents. Unset: the square root of each
    source's number of documents, which flattens the sizes. ``block``: documents of a block,
    the same at every size of the corpus. Where the documents have a column of such a name, the new one gets underscores added.
    """
    def free(name: str) -> str:
        return name if name.lower() not in {c.lower() for c in docs.columns} else free(name + "_")

    own = {"source": "mix_source", "block": "mix_block", "slot": "mix_slot", "place": "mix_index"}
    return placed(docs, docs.columns, weights, block).select("doc.*", *[F.col(k).alias(free(v)) for k, v in own.items()])


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block: int | None = None) -> DataFrame:
    """doc_id, source, block, slot and place of each document, without its text."""
    return placed(docs, ["doc_id"], weights, block).select("doc.doc_id", "source", "block", "slot", "place")


def in_mixed_order(docs: DataFrame, weights: dict[str, float] | None = None, block: int | None = None) -> DataFrame:
    """All documents, in their columns, as sorted ranges of the mixed order: files written from it keep that order.

    Rows with null or repeated ids, null sources and empty texts all get a place; an empty table stays empty.
    """
    parts = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return placed(docs, docs.columns, weights, block).repartitionByRange(parts, "slot", "place").sortWithinPartitions("slot", "place").select("doc.*")


def reference(blocks: dict[str, int], weights: dict[str, Fraction]) -> list[str]:
    """The source of each slot by brute force, for tests: the fluid mix is followed from one source's end to the next."""
    names = sorted(blocks)
    passed: dict[str, list[Fraction]] = {s: [Fraction(0)] for s in names}  # the time at which the mix has passed each block
    done, now = dict.fromkeys(names, Fraction(0)), Fraction(0)
    while left := [s for s in names if done[s] < blocks[s]]:
        rate = sum(weights[s] for s in left)
        step = min((blocks[s] - done[s]) * rate / weights[s] for s in left)
        for s in left:
            upto = done[s] + step * weights[s] / rate
            passed[s] += [now + (k - done[s]) * rate / weights[s] for k in range(len(passed[s]), int(upto) + 1)]
            done[s] = upto
        now += step
    ran, out = dict.fromkeys(names, 0), []
    for t in range(sum(blocks.values())):
        ready = [(-(-passed[s][ran[s] + 1] // 1), s) for s in names if ran[s] < blocks[s] and passed[s][ran[s]] // 1 <= t]
        _, s = min(ready)
        ran[s] += 1
        out.append(s)
    return out
