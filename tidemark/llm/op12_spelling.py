"""Spelling variants by a positional q-gram inverted index with a count filter.

Words within one edit (one letter put in, left out or exchanged) are near. A
word's form is the near word that occurs most, if that is at least ``TIMES`` as
often; following forms leads to the root of a group of variants.

The index is cut into cells. A word of n letters has ceil(n / 3) parts of two
or three letters. One edit touches one part and leaves the rest, so two near
words meet in the cell of that rest: the longer word (or both, of equal length)
is indexed there, the shorter one asks there. Inside a cell the part and the
letters next to it are cut into 2-grams. The index has for each 2-gram and its
position the numbers of the cell's words, ascending. A word asks with its own
2-grams, at the position limits of one edit: the same place for words of equal
length, the same or the next for a word one letter longer. The lists are merged
by a heap; a number that comes up as often as one edit leaves it (the 2-grams of
the longer word less two) is a candidate and is verified letter by letter. A pair
whose letter could be left out in several parts counts in the last of these.

Scale: the words of a task's texts are counted there in a table of bounded size
before they are shuffled. A cell's words differ in at most three letters, so its
size is bounded by the alphabet (89 letters of the default pattern, squared and
cubed), whatever the corpus. A cell gives a row for each of its words that has a near one,
with their number and the best of them; pairs never leave the task. Roots are
found by doubling, in rounds of the logarithm of the longest chain.

Edge cases: null and empty texts have no words; a null doc_id counts as the
empty string in the checksum; repeated rows count each; of near words that occur
equally often the one that sorts first (by code points) is the form; very long
texts are counted like others, in one pass; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from heapq import merge
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deleted, looked_up, noted, pick, small_batches, written

#: Letters of a word and its occurrences, at least.
LEAST_LETTERS, LEAST_TIMES = 5, 3
#: A form occurs so many times as often.
TIMES = 2
#: One of so many words of a document loses a letter.
DAMAGE = 97
#: Letters of a part, at most.
PART = 3
#: Different words that a task counts before it passes them on, and rows of cells in a task's group, about.
HELD, GROUP_ROWS = 400_000, 200_000

#: Every byte that is no letter of ISO 8859-1 in [A-Za-zÀ-ÿ] becomes a blank.
LETTERS = bytes(b if chr(b).isascii() and chr(b).isalpha() or b >= 0xC0 else 0x20 for b in range(256))


def runs(text: str) -> list[bytes]:
    """The runs of letters, A-Z lowered, as ISO 8859-1: a byte for each letter (characters beyond are no letters)."""
    return text.encode("latin-1", "replace").lower().translate(LETTERS).split()


def without(word: bytes, at: int) -> bytes:
    return word[:at] + word[at + 1 :]


def checksum(word: bytes, before: int) -> int:
    """The checksum of what ``before`` is the checksum of and the word in UTF-8."""
    return zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), before)


def counted(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts after the damage, and how often each occurs."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def rows(found: Counter) -> pa.RecordBatch:
        some = [(w.decode("latin-1"), n) for w, n in found.items() if n and len(w) >= LEAST_LETTERS]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())], schema=schema)

    def read(batches):
        found: Counter = Counter()
        for b in batches:
            for name, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                words = runs(text)
                found.update(words)
                before = zlib.crc32(f"{name or ''}:".encode())
                damaged = {w: h % len(w) for w in set(words) if not (h := checksum(w, before)) % DAMAGE}
                if damaged:
                    own = Counter(w for w in words if w in damaged)
                    for w, at in damaged.items():
                        found[w] -= own[w]
                        found[without(w, at)] += own[w]
                if len(found) > HELD:
                    yield rows(found)
                    found = Counter()
        yield rows(found)

    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("string"))
    return docs.mapInArrow(read, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def cuts(n: int) -> list[int]:
    """Where the parts of a word of n letters begin, and its end."""
    parts = -(-n // PART)
    return [i * n // parts for i in range(parts + 1)]


def cells(words: DataFrame) -> DataFrame:
    """(cell, word, n): each word in the cells of its own length and in those of words one letter longer."""
    schema = pa.schema([("cell", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def read(batches):
        for b in batches:
            cell, word, times = [], [], []
            for w, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
                for size in (len(w), len(w) + 1):
                    at, less = cuts(size), size - len(w)
                    for i, (low, high) in enumerate(zip(at, at[1:])):
                        cell.append(f"{size}:{i}:{w[:low]} {w[high - less :]}")
                        word.append(w)
                        times.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.string()), pa.array(word, pa.string()), pa.array(times, pa.int64())], schema=schema)

    return words.select("word", "n").mapInArrow(read, "cell string, word string, n long")


class Cell:
    """The positional index of a cell: numbers of words by 2-gram and position."""

    def __init__(self, size: int, part: int):
        self.size, (self.low, self.high) = size, cuts(size)[part : part + 2]
        self.bound = self.high - self.low - 1  # 2-grams of the longer word's part and its neighbours, less two
        self.words: list[str] = []
        self.postings: dict[tuple[str, int], list[int]] = defaultdict(list)

    def grams(self, word: str) -> list[tuple[str, int]]:
        """The 2-grams of the part with the letters next to it, and their positions."""
        region = f"^{word}$"[self.low : self.high + 2 - (self.size - len(word))]
        return [(region[i : i + 2], i) for i in range(len(region) - 1)]

    def near(self, word: str) -> list[str]:
        """The indexed words within one edit of this one that this cell answers for."""
        moves = (0,) if len(word) == self.size else (0, 1)
        lists = [own for g, p in self.grams(word) for m in moves if (own := self.postings.get((g, p + m)))]
        out = []
        for number, times in groupby(merge(*lists)):
            if sum(1 for _ in times) >= self.bound and self.edited(self.words[number], word):
                out.append(self.words[number])
        return out

    def edited(self, longer: str, word: str) -> bool:
        """Whether one edit in this part makes one word of the other; the rest is equal."""
        if len(longer) == len(word):
            return sum(a != b for a, b in zip(longer[self.low : self.high], word[self.low : self.high], strict=True)) == 1
        at = next((i for i, (a, b) in enumerate(zip(longer, word, strict=False)) if a != b), len(word))
        return self.low <= at < self.high and longer[at + 1 :] == word[at:]

    def add(self, word: str) -> None:
        for key in self.grams(word):
            self.postings[key].append(len(self.words))
        self.words.append(word)


def _near_rows(table: pa.Table) -> pa.Table:
    """For each word of these cells with near ones: their number and the best of them."""
    by_cell: dict[str, list[str]] = defaultdict(list)
    times: dict[str, int] = {}
    for c, w, n in zip(*(table.column(x).to_pylist() for x in ("cell", "word", "n")), strict=True):
        by_cell[c].append(w)
        times[w] = n
    number: Counter = Counter()
    best: dict[str, tuple[int, str]] = {}
    for name, words in by_cell.items():
        if len(words) < 2:
            continue
        size, part, _ = name.split(":", 2)
        cell = Cell(int(size), int(part))
        for w in sorted(words, key=lambda w: (-len(w), w)):
            for v in cell.near(w):
                for a, b in ((v, w), (w, v)):
                    number[a] += 1
                    if a not in best or (-times[b], b) < best[a]:
                        best[a] = (-times[b], b)
            if len(w) == cell.size:
                cell.add(w)
    rows = [(w, k, *best[w]) for w, k in number.items()]
    columns = zip(*rows, strict=True) if rows else ((), (), (), ())
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["word", "n_near", "less", "form"])


def near_words(words: DataFrame, number: int) -> DataFrame:
    """(word, n_near, less, form): near words of each word that has some, the one that occurs most and its negated count."""
    groups = max(1, -(-8 * number // GROUP_ROWS))
    rows = cells(words).withColumn("g", F.pmod(F.xxhash64("cell"), F.lit(groups)).cast("int"))
    found = rows.groupBy("g").applyInArrow(_near_rows, "word string, n_near long, less long, form string")
    best = F.min(F.struct("less", "form")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", "b.less", "b.form")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: what following forms from there ends at."""
    moving = forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        moving = written(moving, "roots")
        step = looked_up(moving, "word", "root", moving.select(F.col("word").alias("root"), F.col("root").alias("next")))
        step = written(step, "roots")
        moving = step.select("word", F.coalesce("next", "root").alias("root"))
        if step.filter("next IS NOT NULL").isEmpty():
            return moving


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of each word of ``LEAST_LETTERS`` letters and ``LEAST_TIMES`` occurrences or more."""
    spark = docs.sparkSession
    small_batches(spark)
    with noted() as made:
        words = written(counted(docs).filter(F.col("n") >= LEAST_TIMES), "words")
        near = words.join(near_words(words, words.count()), "word", "left")
        is_form = -F.col("less") >= TIMES * F.col("n")
        forms = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("form")).alias("form"), F.when(is_form, -F.col("less")).alias("form_n")), "forms")
        out = forms.join(roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        out = written(out, "variants")
    deleted(spark, made[:-1])
    return out


def reference(docs: list[tuple]) -> list[tuple]:
    """Brute force, for tests."""
    count: Counter = Counter()
    for name, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if name is None else name}:{w}".encode())
            count[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 97 == 0 else w] += 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}

    def one_edit(a: str, b: str) -> bool:
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    near = {w: [v for v in count if one_edit(v, w)] for w in count}
    form = {}
    for w, n in count.items():
        top = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = top if top is not None and count[top] >= 2 * n else None
    out = []
    for w, n in count.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out)
