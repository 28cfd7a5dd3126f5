"""The prefix trie and the vector codes against plain Python, and the awkward rows both must bear."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import prefix_trie, vector_codes


def _plain_trie(paths):
    """``paths``: conversation id -> list of (role, text)."""
    nodes = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    own = {p: (len(m) - 1) * len(plain.WORD.findall(p[-1][1])) if p else 0 for p, m in nodes.items()}
    children = {p: sum(len(q) == len(p) + 1 and q[: len(p)] == p for q in nodes) for p in nodes}
    found = set()
    for p, members in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        ends = ",".join(str(c) for c in sorted(c for c in members if tuple(paths[c]) == p))
        parent = min(nodes[p[:-1]]) if p else None
        found.add((min(members), len(p), parent, len(members), children[p], sum(not children[q] for q in below), sum(own[q] for q in below), hashlib.sha256(ends.encode()).hexdigest()))
    return found


def _trie(spark, paths):
    rows = [(c, i, r, t) for c, path in paths.items() for i, (r, t) in enumerate(path)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.select("conv_id", "turn", prefix_trie.turn_id(F.col("role"), F.col("text")).alias("id"))
    return prefix_trie.prefix_trie(turns, spark.createDataFrame([(c,) for c in paths], "conv_id long"))


def test_trie_plain(spark):
    rng = random.Random(3)
    say = [("user", "a b"), ("assistant", "c"), ("user", ""), ("assistant", "d e f")]
    paths = {c: [rng.choice(say) for _ in range(rng.choice((0, 1, 2, 3, 7, 8, 9, 16, 17)))] for c in [*range(-20, 40), 9000, 20000]}
    paths |= {100 + c: paths[5] for c in range(30)} | {c + 8190: [say[0]] * 40 for c in range(4)}
    assert {tuple(r) for r in _trie(spark, paths).collect()} == _plain_trie(paths)


def test_trie_awkward(spark):
    rows = [(1, None, None, None, 5), (1, 0, "user", "x y", 5), (1, 0, "user", "x y", 5), (2, None, "", "", 6), (None, 0, "user", "lost", 7), (3, 1, "user", "w " * 50000, 8)]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, k1 int").withColumn("m", F.lit(1))
    turns = turns.withColumn("id", prefix_trie.turn_id(F.col("role"), F.col("text")))
    got = {tuple(r) for r in prefix_trie.prefix_trie(turns).collect()}
    # null role and text are empty, null turns come first, repeated rows are turns each, rows without a conversation go
    assert got == _plain_trie({1: [("", ""), ("user", "x y"), ("user", "x y")], 2: [("", "")], 3: [("user", "w " * 50000)]})
    assert prefix_trie.prefix_trie(turns.filter("false")).count() == 0


def test_trie_tells_turns_apart(spark):
    paths = {1: [("user", "1:a")], 2: [("user1", ":a")], 3: [("", "user1:a")], 4: [("user", "a"), ("user", "b")], 5: [("user", "b"), ("user", "a")]}
    assert {tuple(r) for r in _trie(spark, paths).collect()} == _plain_trie(paths)


@pytest.mark.parametrize("n", [1, 2, 4, 8, 16])
def test_sequency(n):
    rows = vector_codes.transform(np.eye(n, dtype=np.int64)).T
    assert [(np.diff(r) != 0).sum() for r in rows] == list(range(n)) and (rows @ rows.T == n * np.eye(n)).all()


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("width", [1, 3, 5, 8])
def test_nearest_entry(kind, width):
    rng = np.random.default_rng(width)
    parts, entries = rng.integers(-4, 5, (400, width)).astype(kind), rng.integers(-4, 5, (16, width)).astype(kind)
    far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    index, least = vector_codes.nearest(parts, entries)
    assert (index == np.argmin(far, axis=1)).all() and (least == far.min(axis=1)).all()


def _plain_codes(vectors, parts, entries, rounds):
    """``vectors``: (id, vector) in order of id."""
    usable = [(i, v) for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v in usable), default=0) // parts))
    whole = [[math.floor(Fraction(x) * 4096) for x in v] + [0] * (parts * width - len(v)) for _, v in usable]
    cut = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    assign = lambda: [[min((far(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [c[p] for c, f in zip(cut, found) if f[p][1] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    return {i: ("".join(f"{k:02x}" for _, k in f), min(2**63 - 1, sum(d for d, _ in f))) for (i, _), f in zip(usable, found)}, books


@pytest.mark.parametrize("scale", [1.0, 1e5, 1e18, 1e300])
def test_codes_plain(spark, scale):
    """Also beyond 64 bits: errors over the largest long are reported as that, assignments stay exact."""
    rng = random.Random(1)
    vectors = [(i, [scale * rng.gauss(0, 1) for _ in range(rng.choice((0, 5, 10)))]) for i in range(60)]
    vectors += [(100, None), (101, [1.0, None]), (102, [float("nan")]), (103, [float("inf"), 1.0]), (104, vectors[3][1])]
    df = spark.createDataFrame([(i, v, i % 3 or None, "x") for i, v in vectors], "vec_id int, embedding array<double>, label int, code string")
    coded, books = vector_codes.compress_vectors(df, parts=3, entries=4, rounds=2)
    expected, plain_books = _plain_codes(vectors, 3, 4, 2)
    assert {r.vec_id: (r.code, r.error) for r in coded.collect()} == expected and books == plain_books
    report = vector_codes.code_report(df, parts=3, entries=4, rounds=2).collect()
    for label in (None, 1, 2):
        total = min(2**63 - 1, sum(e for i, (_, e) in expected.items() if (i % 3 or None) == label))
        assert {r.label_error for r in report if (r.vec_id % 3 or None) == label} == {total}


def test_codes_of_little(spark):
    df = spark.createDataFrame([(None, [0.5, -0.5], None), (1, [0.5, -0.5], None), (1, [0.25, 0.0], "a")], "vec_id long, embedding array<float>, label string")
    coded, books = vector_codes.compress_vectors(df, parts=2)
    # the null id comes last, equal ids by vector: fewer entries than vectors asked for
    assert books == [[[1024], [2048], [2048]], [[0], [-2048], [-2048]]]
    assert sorted(((r.vec_id or 0, r.label or "", r.code, r.error) for r in coded.collect())) == [(0, "", "0101", 0), (1, "", "0101", 0), (1, "a", "0000", 0)]
    assert vector_codes.code_report(df.filter("false")).collect() == []
