"""Token counts by an exact length histogram.

Documents are aggregated by encoded length. Suffix sums over the histogram
answer, for every context limit, how many documents are longer, how many
tokens they hold, and what is left of the corpus if each document is cut at
the limit; prefix sums answer quantiles.

Scale: one pass over the texts, then a histogram that is partially aggregated
before its only large shuffle. The sums run in two levels, over bands of
lengths and within a band, so no task sees the whole histogram.

Edge cases: null and empty texts have length 0 (they count as documents);
repeated rows count as often as they occur; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import pick, small_batches, written
from .tokens import encoder, pieces, vocabulary_path

#: Lengths of a band in the two-level sums.
BAND = 256


def token_lengths(docs: DataFrame, vocabulary: str | None = None, end_tokens: int = 0) -> DataFrame:
    """``n_tokens`` of each text, with so many end tokens."""
    path = vocabulary or vocabulary_path()
    small_batches(docs.sparkSession)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            _, n = encoder(path).encode_many(b.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(n + end_tokens)], ["n_tokens"])

    return pick(docs, "text").mapInArrow(lengths, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """One row for each length that occurs, with its suffix and prefix sums.

    Columns: n_tokens (a context limit), n_docs of just that length, docs_at_most
    and tokens_at_most (prefix sums), docs_longer and tokens_longer (suffix sums),
    truncated_tokens (all tokens if every document is cut at this limit), quantile
    (share of documents of at most this length).
    """
    # two sums read the histogram, which is small: written out, the texts are encoded once
    hist = written(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    hist = hist.withColumn("band", F.floor(F.col("n_tokens") / BAND))
    bands = hist.groupBy("band").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    bands = bands.select(
        "band",
        F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d0"),
        F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"),
        F.sum("d").over(every).alias("d_all"),
        F.sum("t").over(every).alias("t_all"),
    )
    inside = Window.partitionBy("band").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    out = hist.join(bands, "band").select(
        "n_tokens",
        "n_docs",
        (F.col("d0") + F.sum("n_docs").over(inside)).alias("docs_at_most"),
        (F.col("t0") + F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside)).alias("tokens_at_most"),
        "d_all",
        "t_all",
    )
    return out.select(
        "n_tokens",
        "n_docs",
        "docs_at_most",
        "tokens_at_most",
        (F.col("d_all") - F.col("docs_at_most")).alias("docs_longer"),
        (F.col("t_all") - F.col("tokens_at_most")).alias("tokens_longer"),
        (F.col("tokens_at_most") + F.col("n_tokens") * (F.col("d_all") - F.col("docs_at_most"))).alias("truncated_tokens"),
        (F.col("docs_at_most") / F.col("d_all")).alias("quantile"),
    )


def answer(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """What each asked context limit leaves: the sums at the largest length that is not above it."""
    ask = histogram.sparkSession.createDataFrame([(int(x),) for x in limits], "context_limit long")
    at = F.max_by(F.struct("docs_longer", "tokens_at_most"), "n_tokens")
    h, total = histogram, histogram.agg(F.sum("n_docs").alias("all_docs"))
    found = ask.join(h, F.col("n_tokens") <= F.col("context_limit"), "left").groupBy("context_limit").agg(at.alias("x")).crossJoin(total)
    longer = F.coalesce(F.col("x.docs_longer"), F.col("all_docs"), F.lit(0))
    return found.select("context_limit", longer.alias("docs_longer"), (F.coalesce(F.col("x.tokens_at_most"), F.lit(0)) + longer * F.col("context_limit")).alias("truncated_tokens"))


def length_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The least length that at least this share of the documents does not exceed."""
    return histogram.filter(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens"))
