"""Near-duplicate vectors by an epsilon grid order join.

Cosine >= c between unit vectors means a distance of at most
``sqrt(2 * (1 - c))`` (epsilon), and no projection makes a distance larger. The
vectors are projected on leading principal directions and cut into cells of side
epsilon; linked vectors lie in equal or adjacent cells in every direction. Cells
are cut into intervals of bounded size, and every pair of intervals of adjacent
cells is one task: both sequences are sorted by grid cell on more directions and
halved recursively, and halves whose boxes are further apart than epsilon are
skipped. The rest is compared by matrix product in double precision.

A task gives back a number of rows in proportion to its vectors: how many links
each has, and a tree of each connected part, not the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import Scratch, connected_components, small

# rows of the sample the principal directions are fitted on; they decide speed, never the result
SAMPLE_ROWS = 20_000
# directions of the grid that deals vectors to tasks, and of the order within a task
GRID_DIRECTIONS, ORDER_DIRECTIONS = 2, 8
# vectors of one interval, and of one side of a matrix product
INTERVAL, LEAF = 2048, 256
# room for rounding in projections
_SLACK = 1e-9


def _unit(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.float64)
    scale = np.abs(values).max(axis=1, keepdims=True)  # squares of extreme components stay in range
    values = values / scale
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def principal_directions(sample: list[list[float]]) -> dict[int, np.ndarray]:
    """Leading principal directions as columns, by vector length."""
    by_length: dict[int, list] = {}
    for v in sample:
        by_length.setdefault(len(v), []).append(v)
    found = {}
    for length, vectors in by_length.items():
        unit = _unit(np.array(vectors))
        centred = unit - unit.mean(axis=0)
        _, directions = np.linalg.eigh(centred.T @ centred)
        found[length] = np.ascontiguousarray(directions[:, ::-1][:, :ORDER_DIRECTIONS])
    return found


def _cell_rows(directions: dict[int, np.ndarray], epsilon: float):
    """Batches of (node, vector) with the grid cell of each vector."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.zeros((batch.num_rows, GRID_DIRECTIONS), np.int32)
            vectors = batch.column(1).to_pylist()
            lengths = np.array([len(v) for v in vectors])
            for length in np.unique(lengths):
                if (d := directions.get(int(length))) is not None:
                    at = np.flatnonzero(lengths == length)
                    d = d[:, :GRID_DIRECTIONS]
                    cells[at, : d.shape[1]] = np.floor(_unit(np.array([vectors[i] for i in at])) @ d / epsilon)
            columns = [pa.array(cells[:, i]) for i in range(GRID_DIRECTIONS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["node", *[f"c{i}" for i in range(GRID_DIRECTIONS)]])

    return rows


class _Found:
    """Links of one task: weighted counts per vector and a forest of the connected parts."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.counts = np.zeros(len(weights), np.int64)
        self.parent = list(range(len(weights)))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, linked: np.ndarray, a: np.ndarray, b: np.ndarray, mirrored: bool) -> None:
        """``linked[i, j]``: a[i] and b[j] link; ``mirrored``: the matrix also holds the links from b to a."""
        if not linked.any():
            return
        self.counts[a] += linked @ self.weights[b]
        if not mirrored:
            self.counts[b] += linked.T @ self.weights[a]
        # smallest place reachable inside this matrix, then one union for each vector
        at_a, at_b = a.copy(), b.copy()
        top = max(a.max(), b.max()) + 1
        while True:
            low_b = np.minimum(at_b, np.where(linked, at_a[:, None], top).min(axis=0))
            low_a = np.minimum(at_a, np.where(linked, low_b[None, :], top).min(axis=1))
            if (low_a == at_a).all() and (low_b == at_b).all():
                break
            at_a, at_b = low_a, low_b
        for i, j in zip(np.concatenate((a, b)).tolist(), np.concatenate((at_a, at_b)).tolist()):
            if i != j:
                i, j = self.root(i), self.root(j)
                self.parent[max(i, j)] = min(i, j)


def _join(unit: np.ndarray, place: np.ndarray, a: np.ndarray, b: np.ndarray, cosine: float, epsilon: float, found: _Found, same: bool) -> None:
    """Join the sequences ``a`` and ``b`` (indices, in grid order), skipping halves too far apart."""
    if not same:
        pa_, pb = place[a], place[b]
        gap = np.maximum(0, np.maximum(pa_.min(axis=0) - pb.max(axis=0), pb.min(axis=0) - pa_.max(axis=0)))
        if (gap * gap).sum() > (epsilon + _SLACK) ** 2:
            return
    if len(a) <= LEAF and len(b) <= LEAF:
        linked = unit[a] @ unit[b].T >= cosine
        if same:
            np.fill_diagonal(linked, False)
        found.add(linked, a, b, same)
    elif same:
        half = len(a) // 2
        _join(unit, place, a[:half], a[:half], cosine, epsilon, found, True)
        _join(unit, place, a[half:], a[half:], cosine, epsilon, found, True)
        _join(unit, place, a[:half], a[half:], cosine, epsilon, found, False)
    elif len(a) >= len(b):
        for part in (a[: len(a) // 2], a[len(a) // 2 :]):
            _join(unit, place, part, b, cosine, epsilon, found, False)
    else:
        for part in (b[: len(b) // 2], b[len(b) // 2 :]):
            _join(unit, place, a, part, cosine, epsilon, found, False)


def _task(directions: dict[int, np.ndarray], cosine: float, epsilon: float):
    """One pair of intervals: rows (second, node, size, vector) to (node, other, links)."""

    def run(table: pa.Table) -> pa.Table:
        vectors = table.column("vector").to_pylist()
        nodes = table.column("node").to_numpy()
        second = table.column("second").to_numpy(zero_copy_only=False).astype(bool)
        unit = _unit(np.array(vectors))
        d = directions.get(unit.shape[1])
        place = unit @ d if d is not None else np.zeros((len(unit), 1))
        order = np.lexsort(np.floor(place / epsilon).T[::-1])
        found = _Found(table.column("size").to_numpy())
        a, b = order[~second[order]], order[second[order]]
        if len(b):
            _join(unit, place, a, b, cosine, epsilon, found, False)
        elif len(a):
            _join(unit, place, a, a, cosine, epsilon, found, True)
        at = np.flatnonzero(found.counts)
        roots = nodes[[found.root(int(i)) for i in at]] if len(at) else np.empty(0, np.int64)
        return pa.table({"node": nodes[at], "other": roots, "links": found.counts[at]})

    return run


def embedding_links(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = 0.93
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``vectors``.

    Vectors of equal label and equal length link when their cosine, in double
    precision, is at least ``cosine``. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable, itself included, and
    ``kept`` marks the row whose id that is.

    A null label, a null, empty or zero vector, or one with a null or non-finite
    component links with nothing and is its own component. Rows with equal ids
    are separate vectors. A null id takes part in links, is no component's id
    unless all are null, and is not kept. Other columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "grid-join")
    epsilon = float(np.sqrt(max(0.0, 2 * (1 - cosine)))) or 1e-6
    given = vectors.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.transform(vector_column, lambda x: x.cast("double")).alias("vector")
    )
    sound = F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    sound = F.coalesce(sound & F.exists("vector", lambda x: x != 0), F.lit(False))
    # equal vectors of one label are one node
    rows = given.withColumn("node", F.when(sound, F.xxhash64("label", "vector")))
    rows = scratch.save(rows, "rows")
    nodes, seen = scratch.save_counted(
        rows.filter("node is not null").groupBy("node", "label", "vector").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("min_id")), "nodes"
    )
    share = SAMPLE_ROWS / max(seen["n"], 1)
    sampled = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1) if share < 1 else nodes
    directions = principal_directions([r[0] for r in sampled.select("vector").limit(SAMPLE_ROWS).collect()])
    names = [f"c{i}" for i in range(GRID_DIRECTIONS)]
    cells = nodes.select("node", "vector").mapInArrow(_cell_rows(directions, epsilon), "node bigint, " + ", ".join(f"{c} int" for c in names))
    placed = nodes.join(cells, "node").withColumn("length", F.size("vector"))
    placed = scratch.save(placed, "placed")
    key = ["label", "length", *names]
    counts = placed.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    counts, n_cells = scratch.save_counted(counts.withColumn("intervals", F.ceil(F.col("n") / INTERVAL).cast("int")).drop("n"), "cells")
    # intervals of a cell are dealt by hash; a pair of intervals is listed once, from the smaller cell
    dealt = placed.join(small(counts, n_cells["n"], 64), key).withColumn("part", F.pmod(F.xxhash64("node"), F.col("intervals")).cast("int"))
    near = counts
    for c in names:
        near = near.withColumn(f"{c}_b", F.explode(F.array(*[F.col(c) + i for i in (-1, 0, 1)])))
    mine, theirs = F.struct(*names), F.struct(*[F.col(f"{c}_b").alias(c) for c in names])
    near = near.filter(mine <= theirs).withColumnRenamed("intervals", "intervals_a")
    other = counts.select("label", "length", *[F.col(c).alias(f"{c}_b") for c in names], F.col("intervals").alias("intervals_b"))
    near = near.join(other, ["label", "length", *[f"{c}_b" for c in names]])
    near = near.withColumn("a", F.explode(F.sequence(F.lit(0), F.col("intervals_a") - 1))).withColumn("b", F.explode(F.sequence(F.lit(0), F.col("intervals_b") - 1)))
    near = near.filter((mine < theirs) | (F.col("a") <= F.col("b")))
    pair = F.xxhash64(*key, *[f"{c}_b" for c in names], "a", "b")
    near = near.withColumn("pair", pair).withColumn("self", (mine == theirs) & (F.col("a") == F.col("b")))
    near = scratch.save(near, "pairs")
    first = near.select(*key, F.col("a").alias("part"), "pair", F.lit(False).alias("second"))
    second = near.filter("not self").select("label", "length", *[F.col(f"{c}_b").alias(c) for c in names], F.col("b").alias("part"), "pair", F.lit(True).alias("second"))
    work = dealt.join(first.union(second), [*key, "part"]).select("pair", "second", "node", "size", "vector")
    found = work.groupBy("pair").applyInArrow(_task(directions, cosine, epsilon), "node bigint, other bigint, links bigint")
    found = scratch.save(found, "found")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("node").alias("u"), F.col("other").alias("v")), scratch, "parts")
    least = nodes.select("node", "min_id", "size").join(parts, "node", "left").join(links, "node", "left")
    least = scratch.save(least.withColumn("root", F.coalesce("root", "node")), "least")
    part_ids = least.groupBy("root").agg(F.min("min_id").alias("part_id"))
    # the root is a node of the component, so its rows need no second key
    stats = least.join(part_ids, "root").select("node", "part_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("part_id"))
    return rows.select("id", "node").join(stats, "node", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
