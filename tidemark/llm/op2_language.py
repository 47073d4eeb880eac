"""Language identification by rank-order profiles of character n-grams.

A profile is a language's most frequent n-grams (one to three letters, words
padded with a blank) in order of frequency. A document's own most frequent
n-grams are compared with each profile by the out-of-place distance: the sum
of the differences in rank, with a fixed most for n-grams that a profile
lacks. The nearest profile names the language.

Profiles are fitted on a bounded sample of the labelled texts (``SAMPLE`` a
language, by a hash of the text, so the same at every partitioning; equal texts
count once, so a large group of copies weighs no more than one, and a language
with fewer different texts than that keeps them all).
Prediction reads every whole text once and nothing but the text; no shuffle.

Edge cases: a text that is null or without letters is ``und`` with score 0;
letters of any script, any number of different ones, have n-grams; null ids stay;
ties go to the language that sorts first; with no labelled rows every
document is ``und``; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import passed, pick, small_batches

#: Labelled rows of each language that its profile is fitted on, about; a bound in expectation.
SAMPLE = 1500
#: N-grams of a profile and of a document.
RANKS = 300
#: Longest n-gram.
LONGEST = 3
#: Below this score a document resembles no profile.
LEAST_SCORE = 0.02


#: Bits of a letter: every code point plus one fits, and three of them fit into 63 bits. The blank is 1.
BITS, BLANK = 21, 1


class Alphabet:
    """Which code points are letters, asked once for each that occurs."""

    def __init__(self):
        self.known = np.zeros(0x110000, np.int8)  # 0 not asked yet, 1 a letter, 2 none

    def codes(self, text: str) -> np.ndarray:
        """A number for each character: the code point plus one for letters, the blank for all others."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        kind = self.known[points]
        if not kind.all():
            new = np.unique(points[kind == 0])
            self.known[new] = [1 if chr(p).isalpha() else 2 for p in new.tolist()]
            kind = self.known[points]
        return np.where(kind == 1, points.astype(np.uint64) + np.uint64(1), np.uint64(BLANK))


def grams(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams as numbers (one to three letters, the first in the highest bits) and how often each occurs; blanks alone don't count."""
    letter = codes != BLANK
    if not letter.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    end = np.array([BLANK], np.uint64)
    c = np.concatenate([end, codes, end])
    is_letter = c != BLANK
    keep = np.concatenate([[True], is_letter[1:] | is_letter[:-1]])
    c, is_letter = c[keep], is_letter[keep]  # one blank between words
    s = np.uint64(BITS)
    two = c[:-1] << s | c[1:]
    three = (two[:-1] << s | c[2:])[is_letter[1:-1]]
    return np.unique(np.concatenate([c[is_letter], two, three]), return_counts=True)


def gram_text(number: int) -> str:
    parts = [number >> BITS * k & (1 << BITS) - 1 for k in reversed(range(3))]
    return "".join(" " if x == BLANK else chr(x - 1) for x in parts if x)


def gram_number(gram: str) -> int:
    out = 0
    for c in gram:
        out = out << BITS | (BLANK if c == " " else ord(c) + 1)
    return out


def fit(labelled: DataFrame, sample: int = SAMPLE, ranks: int = RANKS) -> dict[str, list[str]]:
    """The profile of each language, from rows with ``text`` and a non-null ``lang``."""
    spark = labelled.sparkSession
    small_batches(spark)
    rows = pick(labelled, "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("text"))
    # of the language's different texts: a language of many copies keeps all it has up to the sample
    share = rows.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(sample)) / F.approx_count_distinct("h", 0.02)).alias("share"))
    taken = rows.join(F.broadcast(share), "lang").filter(F.pmod("h", F.lit(1_000_000)) < F.col("share") * 1_000_000)
    taken = taken.groupBy("lang", "h").agg(F.first("text").alias("text"))  # of copies, one

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alphabet, sums = Alphabet(), {}
        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                for k, n in zip(*(x.tolist() for x in grams(alphabet.codes(text))), strict=True):
                    sums.setdefault(lang, Counter())[k] += n
        for lang, found in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found)), pa.array([gram_text(k) for k in found]), pa.array(list(found.values()), pa.int64())], ["lang", "gram", "n"]
            )

    sums = taken.select("text", "lang").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # two levels: the best of each of 16 shares, then the best of those on the driver (languages x 16 x ranks at most)
    sums = sums.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(16)))
    best = sums.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(F.desc("n"), "gram"))).filter(F.col("r") <= ranks)
    profiles: dict[str, list] = {}
    for r in best.select("lang", "gram", "n").collect():
        profiles.setdefault(r["lang"], []).append((-r["n"], r["gram"]))
    return {lang: [g for _, g in sorted(profiles[lang])[:ranks]] for lang in sorted(profiles)}


class Model:
    """Profiles as rank tables."""

    def __init__(self, profiles: dict[str, list[str]], ranks: int = RANKS):
        self.ranks, self.langs, self.alphabet = ranks, sorted(profiles), Alphabet()
        numbers = {}
        for lang in self.langs:
            for g in profiles[lang]:
                numbers.setdefault(g, gram_number(g))
        self.grams = np.array(sorted(numbers.values()), np.uint64)
        where = {g: int(np.searchsorted(self.grams, np.uint64(n))) for g, n in numbers.items()}
        self.rank = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            for r, g in enumerate(profiles[lang]):
                self.rank[k, where[g]] = r

    def predict(self, text: str | None) -> tuple[str, float]:
        found, n = grams(self.alphabet.codes(text or ""))
        if not len(found) or not self.langs:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.grams, found), len(self.grams) - 1)
        at[self.grams[at] != found] = len(self.grams)
        # most frequent first; ties: n-grams of profiles in their fixed order, then the others
        if len(found) > self.ranks:
            least = np.partition(n, len(n) - self.ranks)[len(n) - self.ranks]
            keep = n >= least
            n, at = n[keep], at[keep]
        top = np.lexsort((at, -n))[: self.ranks]
        at = at[top]
        rank = self.rank[:, at]
        away = np.where(rank < 0, self.ranks, np.abs(rank - np.arange(len(top))))
        distance = away.sum(1)
        k = int(np.argmin(distance))
        return self.langs[k], 1.0 - float(distance[k]) / (self.ranks * len(top))


def predict(docs: DataFrame, profiles: dict[str, list[str]]) -> DataFrame:
    """doc_id, lang_pred and score (1: the profile's own order, 0: nothing in common) of each whole text."""
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(profiles)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(sent.value)
        for b in batches:
            out = [model.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())], ["doc_id", "lang_pred", "score"])

    return pick(docs, "doc_id", "text").mapInArrow(read, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, profiles: dict[str, list[str]], least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents, in their columns, in which some language is recognised: not ``und``, and not below ``least_score``.

    Null and empty texts go; repeated rows and null ids stay; columns of any name pass through; an empty table stays empty.
    """
    spark = docs.sparkSession
    small_batches(spark)
    sent = spark.sparkContext.broadcast(profiles)

    def read(text: str):
        def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = Model(sent.value)
            for b in batches:
                found = [model.predict(t) for t in b.column(text).to_pylist()]
                yield b.filter(pa.array([lang != "und" and score >= least_score for lang, score in found], pa.bool_()))

        return kept

    return passed(docs, read)


def held_out(doc_id: str = "doc_id"):
    """The rows that are never learned from: every fourth by the checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the rows that are not held out; predict all."""
    profiles = fit(docs.filter(~held_out()))
    return predict(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def reference(text: str, profiles: dict[str, list[str]], ranks: int = RANKS) -> dict[str, int]:
    """Brute force, for tests: the out-of-place distance of a text to each profile, with its n-grams as strings."""
    padded = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())
    padded = f" {padded} "
    counts = Counter(padded[i : i + n] for n in range(1, LONGEST + 1) for i in range(len(padded) - n + 1) if (padded[i : i + n] if n < 3 else padded[i + 1 : i + 2]).strip())
    order = {g: i for i, g in enumerate(sorted({g for p in profiles.values() for g in p}, key=gram_number))}
    top = sorted(counts, key=lambda g: (-counts[g], order.get(g, len(order))))[:ranks]
    return {lang: sum(abs(profile.index(g) - i) if g in profile else ranks for i, g in enumerate(top)) for lang, profile in profiles.items()}
