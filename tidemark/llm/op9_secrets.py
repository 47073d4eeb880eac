"""Secret scans, in DataFrame functions only.

Three kinds of base spans come from fixed patterns. The method adds spans: two
Markov models of characters, one of random strings and one of ordinary
identifiers, give each character pair of a long unbroken string a
log-likelihood ratio. The pairs' ratios, less a fixed ``DRIFT``, are added up
from left to right and start anew at zero; a string in which the sum reaches
``EVIDENCE`` somewhere is a span of kind ``markov``. So a key inside a path or
after a long name counts as much as one that stands alone. Strings in the form
of a UUID are identifiers by definition and are not judged.

Training: the models count character pairs of labelled strings. Random ones
are made from hashes of numbers (hexadecimal, base 64, letters and digits);
ordinary ones are words of a bounded sample of the documents (``SAMPLE`` texts
in expectation, by a hash of the text, equal texts once), alone and put together
as paths, names and slugs, and numbers, dates and versions from rules. A fourth of the
labelled strings, by hash, is never trained on: ``held_out_quality`` judges it.

Scale: spans are found row by row without a shuffle, in time in proportion to
the text's length: strings are split into characters once, and running sums go
in two levels. The model is one small aggregate, sent as a literal array of
``SIZE`` squared numbers.

Edge cases: a null text is empty and has no spans; offsets count code points;
repeated rows give equal rows; null ids stay; an empty table trains on the
labelled strings from rules alone and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the base kinds, with the least length of the group that counts.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Strings that the models judge: unbroken, of at least this length.
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
#: Fixed form of a UUID.
UUID = "^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$"
#: What a pair's ratio (natural logarithm) must exceed to count for randomness.
DRIFT = 0.2
#: Sum of ratios above the drift from which a string counts as random.
EVIDENCE = 12.0
#: Texts that ordinary words are taken from, about.
SAMPLE = 3000
#: Labelled strings of each sort that comes from a rule.
RULES = 4000
#: Words that paths, packages and settings are often made of.
COMMON = (
    "usr local lib share bin etc var log tmp home user opt src main test java python3 scala resources org com net io github apache example service client server model "
    "controller util common core api v1 v2 internal config settings default cache index static assets images site-packages node_modules docs build target release debug "
    "data input output train schema table column value number string list array map set queue stream reader writer handler factory manager builder context session "
    "request response message event process thread worker task job status error warning info wiki history of the united states category article page list new old"
)
#: The kinds of ordinary strings that come from rules, in the order of their rules.
ORDINARY = (
    "bases", "upper bases", "residues", "upper alphabet", "alphabet", "keyboard", "character set", "compound", "capital compound", "wheel", "package", "product url", "folder", "path", "snake", "kebab",
    "camel", "constant", "class path", "numbered", "digit run", "rule line", "date stamp", "dated image", "release", "padded number", "phone stamp",
)
#: Characters of the models; any other is one more class.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(LETTERS) + 1
#: Values of one part of a running fold.
PART = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """The fold of an array up to each of its places, by an operation with ``zero`` as its identity.

    Parts of ``PART`` values are folded by themselves, then moved by the fold of
    the parts before them: no list is copied more often than a part has values.
    """
    kind = "array<bigint>"
    start = F.struct(zero.alias("sum"), F.array().cast(kind).alias("out"))
    after = lambda a, v: F.struct(add(a["sum"], v).alias("sum"), F.concat(a["out"], F.array(add(a["sum"], v))).alias("out"))
    before = lambda a, p: F.struct(add(a["sum"], p["sum"]).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out"))

    def parts(v: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / PART)), lambda k: F.slice(v, (k * PART + 1).cast("int"), PART))
        return let(F.transform(cut, lambda p: F.aggregate(p, start, after)), moved)

    def moved(ps: Column) -> Column:
        return F.flatten(F.zip_with(ps, F.aggregate(ps, start, before, lambda a: a["out"]), lambda p, by: F.transform(p["out"], lambda x: add(by, x))))

    return let(values, lambda v: F.when(F.size(v) > 0, parts(v)).otherwise(F.array().cast(kind)))


def code(c: Column) -> Column:
    """1 to 67 for the models' characters, 0 for others."""
    table = F.lit([LETTERS.find(chr(b)) + 1 for b in range(128)])
    return F.coalesce(F.get(table, F.ascii(c)), F.lit(0))


def _random(spark) -> DataFrame:
    n = spark.range(RULES)
    digest = lambda tag: F.sha2(F.concat(F.lit(tag), F.col("id")), 256)
    keys = lambda tag: F.base64(F.unhex(digest(tag)))
    size = F.pmod(F.xxhash64("id"), F.lit(22)).cast("int") + 20
    sorts = {
        "hex": F.substring(digest("hex"), F.lit(1), size), "base64": keys("key"), "upper": F.upper(F.translate(keys("up"), "+/=", "")),
        "alnum": F.substring(F.translate(keys("plain"), "+/=", ""), F.lit(1), size), "url key": F.translate(keys("url"), "+/=", "-_"),
    }
    return _kinds(n, sorts)


def _kinds(rows: DataFrame, sorts: dict[str, Column]) -> DataFrame:
    """(kind, sample): one sample of each kind for each row."""
    return rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("sample")) for k, c in sorts.items()])).alias("x")).select("x.*")


def _by_rule(spark) -> DataFrame:
    """Paths, names, numbers, dates, versions, counters, sequences and alphabets, as they stand in ordinary texts."""
    n = F.col("id")
    day = F.date_add(F.lit("2001-01-01").cast("date"), (n * 37 % 12_000).cast("int"))
    stamp = F.concat(F.date_format(day, "yyyyMMdd"), F.lpad((n * 7919 % 240_000).cast("string"), 6, "0"))
    words = F.lit(COMMON.split())
    word = lambda step: F.element_at(words, (F.pmod(F.xxhash64(n, F.lit(step)), F.size(words)) + 1).cast("int"))
    parts = [word(i) for i in range(5)]
    digest = F.sha2(F.concat(F.lit("ordinary"), n), 256)
    size = (20 + n % 40).cast("int")
    cut = lambda text: F.substring(F.repeat(F.lit(text), 4), (n % len(text) + 1).cast("int"), size)
    bases = F.translate(F.concat(digest, digest), "0123456789abcdef", "acgtacgtacgtacgt")
    # the residues' own frequencies are uneven; here each of 64 characters stands for one of 20
    residues = F.translate(F.base64(F.unhex(digest)), LETTERS[:64] + "=", ("LAGVESIKRDTPNQFYMHCW" * 4)[:64])
    wheels = F.concat(F.lit("cp3"), n % 14, F.lit("-cp3"), n % 14, F.lit("-"), F.element_at(F.array(*map(F.lit, ("manylinux_2_17_x86_64", "macosx_11_0_arm64", "musllinux_1_1_aarch64"))), (n % 3 + 1).cast("int")))
    sorts = [
        F.substring(bases, F.lit(1), size), F.upper(F.substring(bases, F.lit(3), size)), F.substring(residues, F.lit(1), size),
        cut("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), cut("abcdefghijklmnopqrstuvwxyz"), cut("qwertyuiopasdfghjklzxcvbnm"), cut("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
        F.concat_ws("", *parts), F.initcap(F.concat_ws("", *parts[1:])), wheels, F.concat(word(6), F.lit("-"), n % 9, F.lit("_"), n % 30, F.lit("_"), n % 7, F.lit("-"), word(7), F.lit("-py3-none-any")),
        F.concat(F.lit("/"), word(8), F.lit("/"), F.concat_ws("-", *parts[:3]), F.lit("-"), n * 7919 % 1_000_000, F.lit("/"), word(9), F.lit("-"), n % 1000),
        F.concat(F.lit("/"), F.concat_ws("/", *parts), F.lit("/")), F.concat_ws("/", *parts[:4]), F.concat_ws("_", *parts), F.concat_ws("-", *parts), F.concat_ws("", *map(F.initcap, parts)),
        F.upper(F.concat_ws("_", *parts[:4])), F.concat(F.concat_ws("/", *parts[:3]), F.lit("/"), F.concat_ws("_", *map(F.initcap, parts[2:]))), F.concat(F.concat_ws("_", *parts[:4]), F.lit("_"), n % 3000),
        F.repeat((n % 10).cast("string"), (20 + n % 30).cast("int")),
        F.repeat(F.element_at(F.array(*map(F.lit, ("-", "=", "_", "abc", "ha", "xy-", "=-"))), (n % 7 + 1).cast("int")), (12 + n % 30).cast("int")),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("-"), stamp),
        F.concat(F.lit("/"), F.date_format(day, "yyyy/MM/dd"), F.lit("/img_"), F.lpad(n.cast("string"), 5, "0")),
        F.concat(F.lit("release-"), n % 20, F.lit("-"), n % 7, F.lit("-build-"), stamp),
        F.lpad(n.cast("string"), 24, "0"),
        F.concat(F.lit("00491512"), F.lpad((n * 104_729 % 10_000_000).cast("string"), 7, "0"), F.lit("-"), stamp),
    ]
    return _kinds(spark.range(RULES // 4), dict(zip(ORDINARY, sorts, strict=True)))


def _from_words(docs: DataFrame) -> DataFrame:
    """Words of a bounded sample of texts, alone and as parts of longer names."""
    total = max(1, docs.filter(docs["text"].isNotNull()).count())
    share = min(1.0, SAMPLE / total)
    some = docs.select(docs["text"], F.xxhash64(docs["text"]).alias("h")).filter((F.col("text").isNotNull()) & (F.pmod("h", F.lit(1_000_000)) < share * 1_000_000))
    some = some.groupBy("h").agg(F.first("text").alias("text"))
    words = some.select("h", F.regexp_extract_all("text", F.lit("[A-Za-z_-]{2,}"), 0).alias("w"))
    piece = lambda first, n: F.slice(F.col("w"), first, n)
    number = F.pmod("h", F.lit(997)).cast("string")
    joined = [
        F.concat(F.lit("/"), F.concat_ws("/", piece(1, 6))), F.concat_ws("_", piece(7, 4)), F.concat_ws("-", piece(11, 5)),
        F.concat_ws("", F.transform(piece(16, 5), F.initcap)), F.concat(F.concat_ws("/", piece(21, 4)), number, F.lit("/"), F.concat_ws("_", piece(25, 3)), number),
        F.upper(F.concat_ws("_", piece(28, 4))), F.concat(F.lit("wiki/"), F.concat_ws("_", F.transform(piece(32, 5), F.initcap))),
        F.concat(F.lit("/"), F.lower(F.concat_ws("/", piece(37, 3))), F.lit("/v"), F.pmod("h", F.lit(9)).cast("string"), F.lit("/"), number, F.lit("/"), F.lower(F.concat_ws("-", piece(40, 4)))),
    ]
    long = F.filter("w", lambda x: F.char_length(x) >= 8)
    compound = F.concat_ws("", F.transform(piece(44, 5), F.lower))
    named = lambda c, k: F.struct(F.lit(k).alias("kind"), c.alias("sample"))
    every = F.concat(F.transform(long, lambda x: named(x, "word")), F.array(*[named(c, "text name") for c in joined], named(compound, "text compound"), named(F.initcap(compound), "text compound")))
    return words.select(F.explode(every).alias("x")).select("x.*").filter(F.char_length("sample") >= 8)


def labelled_samples(docs: DataFrame) -> DataFrame:
    """(kind, sample, random, held_out): labelled strings for both models, and whether they are kept from training."""
    spark = docs.sparkSession
    ordinary = _by_rule(spark).unionAll(_from_words(docs))
    both = _random(spark).withColumn("random", F.lit(True)).unionAll(ordinary.withColumn("random", F.lit(False)))
    return both.withColumn("held_out", F.pmod(F.xxhash64("sample"), F.lit(4)) == 0)


def train(samples: DataFrame) -> list[float]:
    """Log ratios of the models' transition probabilities (add-one smoothing), by SIZE * first + second.

    Samples with a true ``held_out`` are left out.
    """
    if "held_out" in samples.columns:
        samples = samples.filter(~F.col("held_out"))
    chars = samples.select("random", F.split("sample", "").alias("c")).filter(F.size("c") > 1)
    pairs = chars.select("random", F.explode(F.arrays_zip(F.slice("c", 1, F.size("c") - 1).alias("a"), F.slice("c", 2, F.size("c") - 1).alias("b"))).alias("p"))
    counts = pairs.groupBy("random", code(F.col("p.a")).alias("a"), code(F.col("p.b")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    found = {(r["random"], r["a"], r["b"]): r["n"] for r in counts.collect()}  # 2 x SIZE x SIZE rows at most
    out = []
    for a in range(SIZE):
        sums = {label: sum(found.get((label, a, b), 0) for b in range(SIZE)) + SIZE for label in (True, False)}
        for b in range(SIZE):
            p, q = ((found.get((label, a, b), 0) + 1) / sums[label] for label in (True, False))
            out.append(math.log(p / q))
    return out


def evidence(s: Column, model: list[float], drift: float = DRIFT) -> Column:
    """The greatest sum of ratios less the drift over a run of the string's character pairs."""
    table = F.lit(model)

    def step(acc: Column, c: Column) -> Column:
        ratio = F.when(acc["last"] < 0, F.lit(0.0)).otherwise(F.element_at(table, acc["last"] * SIZE + c + 1) - F.lit(drift))
        now = F.greatest(F.lit(0.0), acc["now"] + ratio)
        return F.struct(c.alias("last"), now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    zero = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("now"), F.lit(0.0).alias("most"))
    return F.aggregate(F.transform(F.split(s, ""), code), zero, step, lambda a: a["most"])


def is_random(s: Column, model: list[float], least: float = EVIDENCE) -> Column:
    return ~s.rlike(UUID) & (evidence(s, model) >= least)


def held_out_quality(samples: DataFrame, model: list[float], least: float = EVIDENCE) -> DataFrame:
    """One row: strings found and missed of the held-out random ones, and wrongly flagged of the ordinary ones (of those long enough to be judged)."""
    judged = samples.filter("held_out").filter(F.col("sample").rlike(f"^{CANDIDATE}$")).select("random", is_random(F.col("sample"), model, least).alias("flagged"))
    counts = judged.agg(*[F.count_if((F.col("random") == r) & (F.col("flagged") == f)).alias(k) for k, r, f in (("found", True, True), ("missed", True, False), ("wrong", False, True), ("right", False, False))])
    return counts.withColumns({"precision": F.try_divide("found", F.col("found") + F.col("wrong")), "recall": F.try_divide("found", F.col("found") + F.col("missed"))})


def quality_by_kind(samples: DataFrame, model: list[float], least: float = EVIDENCE) -> DataFrame:
    """Of each kind of strings (long enough to be judged): whether they are random, their number, and the share that is judged rightly."""
    judged = samples.filter(F.col("sample").rlike(f"^{CANDIDATE}$")).select("kind", "random", is_random(F.col("sample"), model, least).alias("flagged"))
    return judged.groupBy("kind", "random").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("flagged") == F.col("random")).cast("double")).alias("right"))


def quality_of_unseen_kinds(samples: DataFrame, folds: int = 4, least: float = EVIDENCE) -> DataFrame:
    """``quality_by_kind`` by models that have seen no string of the kind: the kinds are dealt into folds, each left out once."""
    fold = F.pmod(F.xxhash64("kind"), F.lit(folds))
    parts = [quality_by_kind(samples.filter(fold == k), train(samples.drop("held_out").filter(fold != k)), least) for k in range(folds)]
    return reduce(DataFrame.unionByName, parts)


NO_SPANS = "array<struct<start:bigint,rank:int,kind:string,stop:bigint,value:string>>"


def spans(text: Column, kind: str, rank: int, pattern: str) -> Column:
    """All matches of a pattern, left to right: array of (start, rank, kind, stop, value), in code points.

    The text between matches and the matches alternate, so their lengths give the places.
    """
    gaps = F.split(text, pattern, -1)
    sizes = lambda hits: F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: (F.char_length(g) + F.char_length(h)).cast("bigint"))
    row = lambda stop, h: F.struct((stop - F.char_length(h)).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), stop.alias("stop"), h.alias("value"))
    every = let(F.regexp_extract_all(text, F.lit(pattern), 0), lambda hits: F.zip_with(running(sizes(hits), F.lit(0).cast("bigint"), lambda a, b: a + b), hits, row))
    return F.when(text.rlike(pattern), every).otherwise(F.array().cast(NO_SPANS))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def apart(candidates: Column, base: Column) -> Column:
    """The candidates that no base span meets: none before them reaches into them, none begins inside."""
    most = F.lit(2**62)
    is_base = lambda x: x["kind"] != "markov"

    def checked(every: Column) -> Column:
        reach = running(F.transform(every, lambda x: F.when(is_base(x), x["stop"]).otherwise(F.lit(0))), F.lit(0).cast("bigint"), F.greatest)
        ahead = F.reverse(running(F.reverse(F.transform(every, lambda x: F.when(is_base(x), x["start"]).otherwise(most))), most, F.least))
        free = F.filter(F.arrays_zip(every.alias("x"), reach.alias("reach"), ahead.alias("ahead")), lambda z: (z["x"]["kind"] == "markov") & (z["reach"] <= z["x"]["start"]) & (z["ahead"] >= z["x"]["stop"]))
        return F.transform(free, lambda z: z["x"])

    both = let(F.array_sort(F.concat(candidates, base)), checked)
    return F.when(F.size(candidates) == 0, candidates).when(F.size(base) == 0, candidates).otherwise(both)


def scan(docs: DataFrame, model: list[float], least: float = EVIDENCE) -> DataFrame:
    """doc_id, base spans of each kind, and those that the models add outside them."""
    rows = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))
    text = F.col("text")
    value = lambda x: F.regexp_extract(x["value"], ASSIGN, 2)
    rows = rows.select(
        "doc_id",
        F.filter(spans(text, "assign", 0, ASSIGN), lambda x: F.char_length(value(x)) >= LEAST["assign"]).alias("assign"),
        F.filter(spans(text, "access", 1, ACCESS), lambda x: F.char_length(x["value"]) >= LEAST["access"]).alias("access"),
        spans(text, "hex", 2, HEX).alias("hex"),
        F.filter(spans(text, "markov", 3, CANDIDATE), lambda x: is_random(x["value"], model, least)).alias("long"),
    )
    rows = rows.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    rows = rows.withColumn("markov", apart(F.col("long"), F.col("base")))
    return rows.select("doc_id", "assign", "access", "hex", "base", "markov")


def digest(found: DataFrame) -> DataFrame:
    every = F.array_sort(F.concat("base", "markov"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(every).alias("spans"),
        F.size("markov").cast("long").alias("n_markov"),
    )


def find_secrets(docs: DataFrame, samples: DataFrame | None = None) -> DataFrame:
    """Train on labelled samples (``sample``, ``random``), or on the default ones, and scan every text."""
    return scan(docs, train(samples if samples is not None else labelled_samples(docs)))


def reference_evidence(s: str, model: list[float], drift: float = DRIFT) -> float:
    """Brute force, for tests: every run of pairs is added up."""
    codes = [LETTERS.find(c) + 1 for c in s]
    pairs = [model[a * SIZE + b] - drift for a, b in zip(codes, codes[1:])]
    return max([0.0, *(math.fsum(pairs[i:j]) for i in range(len(pairs)) for j in range(i + 1, len(pairs) + 1))])
