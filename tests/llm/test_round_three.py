"""SimHash links, spelling variants and source divergence against brute force, with odd rows and extra columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import op11_simhash, op12_spelling, op13_divergence

from .test_operators import ODD, docs_of


def components_of(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return [root(i) for i in range(n)]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_comparison_is_brute_force(radius):
    rng = np.random.default_rng(radius)
    flip = lambda n: np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    for trial in range(20):
        n = int(rng.integers(2, 400))
        fps = np.unique(rng.integers(0, 2**63, 4, dtype=np.uint64)[rng.integers(0, 4, n)] ^ flip(n) ^ flip(n) ^ flip(n))
        run, side = np.sort(rng.integers(0, 4, len(fps))), rng.integers(0, 2, len(fps))
        near = [(i, j) for i in range(len(fps)) for j in range(i) if run[i] == run[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= radius]
        links = op11_simhash.forest(fps, run, op11_simhash.MASKS[trial % 10], radius=radius).tolist()
        assert components_of(len(fps), links) == components_of(len(fps), near)
        assert len(links) == len(fps) - len(set(components_of(len(fps), near)))  # a forest, never all pairs
        across = [(i, j) for i, j in near if side[i] != side[j]]
        links = op11_simhash.forest(fps, run, op11_simhash.MASKS[0], np.arange(len(fps)), side, radius).tolist()
        assert components_of(len(fps), links) == components_of(len(fps), across)


def test_any_two_fingerprints_within_the_radius_have_a_key_in_common():
    rng = random.Random(1)
    for _ in range(2000):
        x = rng.getrandbits(64)
        y = x ^ sum(1 << b for b in rng.sample(range(64), op11_simhash.RADIUS))
        assert any(x & m == y & m for m in op11_simhash.MASKS)


@pytest.mark.parametrize("block", [op11_simhash.BLOCK, 5])
def test_op11_brute_force(spark, block):
    rng = random.Random(3)
    rows = [(100_000 + i, t) for i, t in enumerate(ODD[:-1])] + [(1, "w " * 3000), (1, "w " * 3000), (1, "other text of one id"), (None, "A b c"), (None, None), (2, "a B c"), (3, "a B c")]
    for i in range(70):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.choice([1, 2, 3, 40, 150]))]
        rows.append((1000 - i, " ".join(words)))
        for _ in range(2 if len(words) > 100 else 0):  # a family of copies with one word exchanged
            words[rng.randrange(len(words))] = "x"
            rows.append((rng.randrange(10**6), " ".join(words)))
    rows += [(5000 + i, rows[-1][1]) for i in range(40)]
    got = op11_simhash.near_copies(docs_of(spark, rows), block=block)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, op11_simhash.reference(rows)))
    assert len({r["component_id"] for r in got.collect()}) > 20


def test_op11_empty_and_radius(spark):
    assert op11_simhash.near_copies(docs_of(spark, [])).collect() == []
    assert [tuple(r) for r in op11_simhash.near_copies(docs_of(spark, [(None, None)])).collect()] == [(None, "0" * 16, None)]
    with pytest.raises(ValueError):
        op11_simhash.near_copies(docs_of(spark, [(1, "a")]), radius=4)


def test_op12_brute_force(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("abéz") for _ in range(rng.randrange(3, 11))) for _ in range(150)]
    rows = [(i, ", ".join(rng.choice(base[: 1 + int(150 * rng.random() ** 2)]).title() for _ in range(50))) for i in range(400)]
    rows += [(None, "hello hello hello"), (7, None), (8, ""), (9, "ÀÉ×÷ ÿþñ€ABCDE ABCDE abcde Āabcde"), (9, "ÀÉ×÷ ÿþñ€ABCDE ABCDE abcde Āabcde"), (10, "hallo " * 5000), (11, "aaaab aaaab aaaab aaaa aaab aaaac " * 9)]
    want = op12_spelling.reference(rows)
    assert sum(r[1] is not None for r in want) > 10 and max(r[4] for r in want) >= 3
    assert sorted(tuple(r) for r in op12_spelling.variants(docs_of(spark, rows)).collect()) == want
    assert op12_spelling.variants(docs_of(spark, [])).collect() == [] == op12_spelling.variants(docs_of(spark, [(1, None), (None, "")])).collect()


def test_op12_cells_find_each_pair_once():
    """All words of two letters around a core: every pair within one edit, once, whatever the letters that repeat."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(300)})
    found = []
    cells = {}
    for w in words:
        for size in (len(w), len(w) + 1):
            at, less = op12_spelling.cuts(size), size - len(w)
            for i, (low, high) in enumerate(zip(at, at[1:])):
                cells.setdefault((size, i, w[:low], w[high - less :]), []).append(w)
    for (size, part, _, _), members in cells.items():
        cell = op12_spelling.Cell(size, part)
        for w in sorted(members, key=lambda w: (-len(w), w)):
            found += [tuple(sorted((v, w))) for v in cell.near(w)]
            if len(w) == size:
                cell.add(w)

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    assert sorted(found) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))


def test_op12_chains_of_forms(spark):
    """Each form is three times as frequent as the one before: the root is the last of the chain."""
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc"]
    rows = [(i, w) for k, w in enumerate(chain) for i in range(4 * 3**k)]
    got = {r["word"]: r["root"] for r in op12_spelling.variants(docs_of(spark, rows)).collect() if r["word"] in chain}
    assert set(got.values()) == {chain[-1]}


def divergence_rows():
    rng = random.Random(1)
    words = ["w" + chr(97 + i) for i in range(26)] + ["É" + chr(97 + i) for i in range(26)]
    rows = [(i, " ".join(rng.choice(words[: 1 + int(52 * rng.random() ** 2)]).title() + rng.choice(["", "1", "-"]) for _ in range(rng.randrange(30))), rng.choice(["en", "de", None]), rng.choice(["a", "b", "ç", "z", None])) for i in range(300)]
    return rows + [(1, None, "xx", "a"), (2, "", "xx", "b"), (3, "one two", "xx", "b"), (None, "w", "en", ""), (4, "", "en", "only"), (4, "wa " * 9000, "en", "only"), (4, "wa " * 9000, "en", "only")]


@pytest.mark.parametrize("least,bounds", [(25, {}), (25, {"held": 20, "held_sources": 2}), (60, {})])
def test_op13_brute_force(spark, least, bounds):
    rows = divergence_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumns({c: F.lit(1) for c in ("term", "doc", "n", "p", "q", "v", "total", "rank")})
    got = op13_divergence.divergence(docs, least, **bounds)
    assert sorted(map(tuple, got.collect())) == op13_divergence.reference([r[1:] for r in rows], least)


def test_op13_nothing(spark):
    kinds = "doc_id long, text string, lang string, source string"
    assert op13_divergence.divergence(spark.createDataFrame([], kinds)).collect() == []
    assert op13_divergence.divergence(spark.createDataFrame([(None, None, None, None)], kinds)).collect() == []
    got = op13_divergence.divergence(spark.createDataFrame([(1, None, None, None), (1, "a", None, "s")], kinds)).collect()
    assert sorted((r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got) == [("", "pair", "s", 0, 1), ("s", "pair", "", 0, 1)]


def test_op13_shares_are_exact(spark):
    """Counts beyond 64 bits once they are multiplied."""
    n, total, v = 9_000_000_000_000_001, 9_999_999_999_999_999, 77_777
    got = spark.createDataFrame([(n, total, v)], "n long, total long, v long").select(op13_divergence.share("n", "total", "v")).first()[0]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * v)
