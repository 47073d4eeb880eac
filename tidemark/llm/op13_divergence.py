"""Source divergence audit by sort-based streaming.

Which sources of a language use its terms unlike the others? A language keeps
the terms that ``LEAST_DOCS`` of its documents hold. Every group (language,
source) and every language has a smoothed share of each kept term in
thousand-millionths, ``1 + floor(10^9 * (count + 5) / (N + 5 * V))`` with N the
counts of all kept terms and V their number. Part ``pair`` sums the differences
of two sources' shares over all kept terms; part ``term`` lists the terms that a
source uses more than its language.

Rows (language, term, source, document) are dealt by (language, term, source),
sorted, and scanned as a stream: a run of one key becomes one row with its
document frequency and count. A second scan, sorted by (language, term, source),
sums a term's runs to those of its language and drops terms of too few
documents. A third one makes of each kept term's run its partial pairs: the
shares of all sources of the language, the unseen ones at their least share, and
the differences of each two, added up over the terms of a task.

Scale: documents are counted where they are read, in a table of bounded size, so
a row stands for one or more documents (named by the first of them; a document
is never split over rows of one key) and a term of all documents comes once a
table and source. A run is never held: sums are carried from batch to batch.
The third scan holds a term's sources and, for each language, a square of
its sources: as large as the result's part ``pair``; for more than ``HELD_SOURCES`` sources
partial squares are passed on row by row instead. The driver holds a row a group
for it: the square root of the result. All arithmetic is exact (decimals of 38 digits).

Edge cases: null text, language and source are empty strings; each row is a
document, so repeated rows count each; a language without kept terms has pairs
of value 0 and no terms; a group without terms has the least share of each; ties
go to the item that sorts first by UTF-8; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import deleted, noted, small_batches, written

#: Documents of a language that hold a kept term, at least; what is added to each count; ranks of terms.
LEAST_DOCS, ADDED, RANKS = 30, 5, 50
#: Different terms and sources that a task counts before it passes them on.
HELD = 500_000
#: Cells (terms by sources) of one step of the third scan, and sources of a language whose square a task holds.
CELLS, HELD_SOURCES = 1 << 20, 1024

#: Every byte that is neither an ASCII letter nor of a character beyond ASCII becomes a blank.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.lower().translate(TERM_BYTES).split()


def plain(docs: DataFrame) -> DataFrame:
    """doc (id), lang, source and text, none of them null."""
    empty = lambda c: F.coalesce(docs[c].cast("string"), F.lit("")).alias(c)
    return docs.select(docs["doc_id"].cast("string").alias("doc"), empty("lang"), empty("source"), empty("text"))


ROWS = "lang string, term string, source string, doc string, docs long, n long"
ROWS_SCHEMA = pa.schema([("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("doc", pa.string()), ("docs", pa.int64()), ("n", pa.int64())])


def counted(docs: DataFrame, most: int = HELD) -> DataFrame:
    """Rows (lang, term, source, doc, docs, n): documents that hold a term and its occurrences, one or more documents a row."""

    def rows(found: dict) -> pa.RecordBatch:
        out = [(lang, w.decode(), source, doc, k, n[w]) for (lang, source), (doc, n, held) in found.items() for w, k in held.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True) if out else [()] * 6, ROWS_SCHEMA, strict=True)], schema=ROWS_SCHEMA)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], tuple[str, Counter, Counter]] = {}
        size = 0
        for b in batches:
            texts = b.column("text").cast(pa.binary()).to_pylist()
            for doc, lang, source, text in zip(*(b.column(c).to_pylist() for c in ("doc", "lang", "source")), texts, strict=True):
                words = terms(text)
                if (lang, source) not in found:
                    found[lang, source] = (doc, Counter(), Counter())
                _, n, held = found[lang, source]
                size -= len(held)
                n.update(words)
                held.update(set(words))
                size += len(held)
                if size > most:
                    yield rows(found)
                    found, size = {}, 0
        yield rows(found)

    return plain(docs).mapInArrow(read, ROWS)


def changes(table: pa.Table, *names: str) -> np.ndarray:
    """Where a new run begins in sorted rows."""
    new = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        new[1:] = False
        for name in names:
            x = table.column(name).combine_chunks()
            new[1:] |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
    return new


def whole_runs(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[pa.Table]:
    """The rows in tables that never cut a run; the last run waits for the next batch."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        table = pa.Table.from_batches([*rest, b])
        last = int(np.flatnonzero(changes(table, *names))[-1])
        if last:
            yield table.slice(0, last)
        rest = table.slice(last).combine_chunks().to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def summed_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First scan: one row (lang, term, source, docs, n) a run; sums are carried, rows are not."""
    names = ["lang", "term", "source"]
    held: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        table = pa.Table.from_batches([b]).select([*names, "docs", "n"])
        table = table if held is None else pa.concat_tables([held, table])
        first = np.flatnonzero(changes(table, *names))
        sums = [pa.array(np.add.reduceat(table.column(c).to_numpy(), first)) for c in ("docs", "n")]
        short = table.select(names).take(pa.array(first)).append_column("docs", sums[0]).append_column("n", sums[1])
        held = short.slice(len(first) - 1)
        yield from short.slice(0, len(first) - 1).combine_chunks().to_batches()
    if held is not None:
        yield from held.combine_chunks().to_batches()


def kept_runs(least: int):
    """Second scan: the rows of terms that enough documents hold, with the language's count; the first of a term's rows is marked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "lang", "term"):
            new = changes(table, "lang", "term")
            first, run = np.flatnonzero(new), np.cumsum(new) - 1
            docs, n = (np.add.reduceat(table.column(c).to_numpy(), first)[run] for c in ("docs", "n"))
            out = table.drop_columns(["docs"]).append_column("lang_n", pa.array(n)).append_column("first", pa.array(new)).filter(pa.array(docs >= least))
            yield from out.combine_chunks().to_batches()

    return read


KEPT = "lang string, term string, source string, n long, lang_n long, first boolean"


def sorted_by(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, *keys).sortWithinPartitions(*order)


def share(n: str | Column, total: str, v: str) -> Column:
    """1 + floor(10^9 * (n + 5) / (total + 5 * v)), exactly."""
    n = F.col(n) if isinstance(n, str) else n
    of = lambda c: c.cast("decimal(19,0)")
    top = (of(n) + F.lit(ADDED)).cast("decimal(20,0)") * F.lit(10**9).cast("decimal(10,0)")
    below = (of(F.col(total)) + of(F.col(v)) * F.lit(ADDED).cast("decimal(1,0)")).cast("decimal(22,0)")
    return (F.call_function("div", top, below) + 1).cast("long")


def partial_pairs(least_share: dict[str, dict[str, int]], most: int = HELD_SOURCES):
    """Third scan: (lang, source, others, sums), the differences of a source's shares to those of the sources ``others``, over some terms."""
    numbers = {lang: {s: i for i, s in enumerate(sorted(own, key=str.encode))} for lang, own in least_share.items()}
    base = {lang: np.array([own[s] for s in numbers[lang]], np.int64) for lang, own in least_share.items()}

    def square(lang: str, rows: np.ndarray, source: np.ndarray, p: np.ndarray, number: int) -> Iterator[tuple[int, np.ndarray]]:
        """The differences to each source, summed over ``number`` terms of which the given ones have shares of their own."""
        dense = np.repeat(base[lang][None, :], number, 0)
        dense[rows, source] = p
        for i in range(dense.shape[1]):
            yield i, np.abs(dense - dense[:, i : i + 1]).sum(0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for table in whole_runs(batches, "lang", "term"):
            term = np.cumsum(changes(table, "lang", "term")) - 1
            first = np.flatnonzero(changes(table, "lang"))
            p = table.column("p").to_numpy()
            for low, high in zip(first.tolist(), [*first[1:].tolist(), table.num_rows]):
                lang = table.column("lang")[low].as_py()
                of, size = numbers[lang], len(numbers[lang])
                source = np.array([of[s] for s in table.column("source").slice(low, high - low).to_pylist()], np.int64)
                own = term[low:high] - term[low]
                step = max(1, CELLS // size)
                for begin in range(0, int(own[-1]) + 1, step):
                    i, j = np.searchsorted(own, [begin, begin + step])
                    parts = square(lang, own[i:j] - begin, source[i:j], p[low + i : low + j], min(step, int(own[-1]) + 1 - begin))
                    if size > most:
                        for k, sums in parts:
                            yield passed_on(lang, k, sums)
                    else:
                        mine = held.setdefault(lang, np.zeros((size, size), np.int64))
                        for k, sums in parts:
                            mine[k] += sums
        for lang, mine in held.items():
            for k, sums in enumerate(mine):
                yield passed_on(lang, k, sums)

    def passed_on(lang: str, k: int, sums: np.ndarray) -> pa.RecordBatch:
        names = list(numbers[lang])
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(names)), pa.array([names[k]] * len(names)), pa.array(names), pa.array(sums)], ["lang", "source", "item", "value"])

    return read


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS, held: int = HELD, held_sources: int = HELD_SOURCES) -> DataFrame:
    """lang, source, part, item, value and rank: how each source differs from its language's others, and by which terms.

    ``held`` and ``held_sources`` bound what a task holds; they change no result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    key = ["lang", "term", "source"]
    with noted() as made:
        runs = sorted_by(counted(docs, held), key, [*key, "doc"]).mapInArrow(summed_runs, "lang string, term string, source string, docs long, n long")
        kept = written(sorted_by(runs, ["lang", "term"], key).mapInArrow(kept_runs(least_docs), KEPT), "kept")
        occurring = plain(docs).select("lang", "source").distinct()
        own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum(F.col("first").cast("long")).alias("v"))
        groups = occurring.join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        groups = written(groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "v")]), "groups")
        shared = kept.join(groups, ["lang", "source"]).select(*key, share("n", "total", "v").alias("p"), share("lang_n", "lang_total", "v").alias("q"))
        shared = written(shared, "shares")

        least: dict[str, dict[str, int]] = defaultdict(dict)
        for r in groups.filter("v > 0").select("lang", "source", share(F.lit(0), "total", "v").alias("p")).toLocalIterator():
            least[r["lang"]][r["source"]] = r["p"]
        parts = sorted_by(shared.select(*key, "p"), ["lang", "term"], key).mapInArrow(partial_pairs(dict(least), held_sources), "lang string, source string, item string, value long")
        sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
        pairs = pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
        over = shared.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        nth = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        ranked = over.withColumn("rank", nth).filter(F.col("rank") <= ranks).unionByName(pairs.withColumn("rank", nth))
        out = written(ranked.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")), "divergence")
    deleted(spark, made[:-1])
    return out


def reference(docs: list[tuple], least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> list[tuple]:
    """Brute force over (text, lang, source), for tests."""
    count: dict[tuple, Counter] = {}
    held: dict[str, Counter] = defaultdict(Counter)
    for text, lang, source in docs:
        lang, source = lang or "", source or ""
        words = ["".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        count.setdefault((lang, source), Counter()).update(words)
        held[lang].update(set(words))
    out = []
    for lang in {k[0] for k in count}:
        kept = [w for w, n in held[lang].items() if n >= least_docs]
        sources = [s for k, s in count if k == lang]
        shares = {}
        for name, own in [(s, count[lang, s]) for s in sources] + [(None, sum((count[lang, s] for s in sources), Counter()))]:
            total = sum(own[w] for w in kept)
            shares[name] = {w: 1 + 10**9 * (own[w] + 5) // (total + 5 * len(kept)) for w in kept}
        for s in sources:
            pairs = sorted((-sum(abs(shares[s][w] - shares[o][w]) for w in kept), o.encode(), o) for o in sources if o != s)
            over = sorted((shares[None][w] - shares[s][w], w.encode(), w) for w in kept if count[lang, s][w] and shares[s][w] > shares[None][w])
            out += [(lang, s, "pair", x, -v, i + 1) for i, (v, _, x) in enumerate(pairs)]
            out += [(lang, s, "term", x, -v, i + 1) for i, (v, _, x) in enumerate(over[:ranks])]
    return sorted(out)
