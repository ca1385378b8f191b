"""Nearest neighbours by inner product in a hierarchical k-means tree.

The tree is fitted on a bounded sample: every node with more than ``leaf_sample`` sampled vectors is split into
``branching`` clusters. For inner products, vectors get one more component that brings all to the same length, which
turns the largest product into the smallest distance. Every vector is then put into its leaf.

A query walks the tree best bin first: a priority queue over all branches seen so far, nearest centre first, yields
leaves in order. How many leaves are visited is calibrated: a bounded sample of queries is searched exactly against
all vectors, and visits are doubled until the sample's recall reaches the target; the last leaf bounds the search.

Leaves are cut into slices of about ``slice_rows`` rows by a hash of the id, so a leaf of many equal vectors is no
larger a task than others, and slices are dealt over partitions. A partition scores its rows only for the queries
that visit its leaves and returns the best of each query.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesdw.staging import Staging


@dataclass
class Tree:
    """Node n has ``children[n]`` (none for leaves), ``centres[n]`` and, for leaves, ``leaf[n]`` from 0."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    longest: float

    @property
    def leaves(self) -> int:
        return max(self.leaf) + 1


def _raised(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
    return np.concatenate([scaled, rest[:, None]], axis=1)


def _k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Cluster numbers; centres start at random distinct points."""
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(rounds):
        nearest = (np.einsum("ij,ij->i", centres, centres)[None] - 2 * points @ centres.T).argmin(axis=1)
        centres = np.stack([points[nearest == c].mean(axis=0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
    return (np.einsum("ij,ij->i", centres, centres)[None] - 2 * points @ centres.T).argmin(axis=1)


def fit_tree(sample: np.ndarray, longest: float, branching: int = 8, leaf_sample: int = 64, seed: int = 7) -> Tree:
    """``longest``: the length of the longest vector of all."""
    rng = np.random.default_rng(seed)
    points = _raised(sample, longest)
    centres, children, leaf, count = [points.mean(axis=0)], [[]], [-1], 0
    waiting = [(0, np.arange(len(points)))]
    while waiting:
        node, rows = waiting.pop()
        groups = []
        if len(rows) > leaf_sample:
            cluster = _k_means(points[rows], branching, rng)
            groups = [rows[cluster == c] for c in np.unique(cluster)]
        if len(groups) < 2:
            leaf[node], count = count, count + 1
            continue
        for group in groups:
            centres.append(points[group].mean(axis=0))
            children.append([])
            leaf.append(-1)
            children[node].append(len(centres) - 1)
            waiting.append((len(centres) - 1, group))
    return Tree(np.stack(centres), children, leaf, longest)


def leaf_of(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    """Each vector goes down to the nearest child."""
    points = _raised(vectors, tree.longest)
    result = np.zeros(len(points), np.int64)
    waiting = [(0, np.arange(len(points)))]
    while waiting:
        node, rows = waiting.pop()
        below = tree.children[node]
        if not below:
            result[rows] = tree.leaf[node]
            continue
        centres = tree.centres[below]
        nearest = (np.einsum("ij,ij->i", centres, centres)[None] - 2 * points[rows] @ centres.T).argmin(axis=1)
        waiting += [(child, rows[nearest == at]) for at, child in enumerate(below) if (nearest == at).any()]
    return result


def leaves_in_order(tree: Tree, query: np.ndarray, visits: int) -> list[int]:
    """The first ``visits`` leaves of a best-bin-first walk."""
    size = np.sqrt(query @ query)
    point = np.append(query / size, 0.0)
    queue, found = [(0.0, 0)], []
    while queue and len(found) < visits:
        _, node = heapq.heappop(queue)
        below = tree.children[node]
        if not below:
            found.append(tree.leaf[node])
            continue
        away = tree.centres[below] - point
        for distance, child in zip(np.einsum("ij,ij->i", away, away).tolist(), below):
            heapq.heappush(queue, (distance, child))
    return found


def usable(vectors: DataFrame, name: str = "vec_id", column: str = "embedding") -> DataFrame:
    """id and vector (doubles) of the rows that take part: no null, no null or non-finite component, not all zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vector = F.col(column).cast("array<double>")
    return vectors.select(F.col(name).alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0)
    )


def one_per_id(vectors: DataFrame) -> DataFrame:
    """One row per id, of repeated ones the smallest vector; only vectors of the most frequent length (ties: the longer)."""
    size = F.size("vector")
    common = vectors.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return vectors.where(size == F.lit(common["size"] if common else 0)).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    plain = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return plain.flatten().to_numpy(zero_copy_only=False).reshape(len(plain), -1)


def _best(ids: np.ndarray, vectors: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest products, ties to smaller ids. Scores are summed alike for equal vectors, wherever they stand."""
    rough = vectors @ query
    others = ids != query_id
    if others.sum() > k:
        least = np.partition(rough[others], -k)[-k]
        others &= rough >= least - 1e-9 * max(1.0, abs(least))
    chosen = np.flatnonzero(others)
    scores = (vectors[chosen] * query).sum(axis=1)
    order = np.lexsort((ids[chosen], -scores))[:k]
    return ids[chosen][order], scores[order]


RESULT = "query_id long, vec_id long, score double"


def _result(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    return pa.table(
        {
            "query_id": pa.array(np.repeat([q for q, _, _ in rows], [len(i) for _, i, _ in rows]).astype(np.int64)),
            "vec_id": pa.array(np.concatenate([i for _, i, _ in rows]) if rows else np.zeros(0, np.int64)),
            "score": pa.array(np.concatenate([s for _, _, s in rows]) if rows else np.zeros(0)),
        }
    )


def search(
    vectors: DataFrame,
    queries: DataFrame,
    staging: Staging,
    k: int = 20,
    sample_rows: int = 20_000,
    calibration_queries: int = 200,
    recall: float = 0.97,
    slice_rows: int = 2_000,
) -> DataFrame:
    """The k nearest of each query among ``vectors``: query_id, rank, vec_id, score (inner product of doubles).

    ``vectors`` and ``queries`` come from ``usable``. Repeated ids count once and vectors of another than the most
    frequent length take no part (``one_per_id``); a query is not its own neighbour. The tree is fitted on at most ``sample_rows`` vectors, the leaf visits on at most
    ``calibration_queries`` queries; both are taken by a hash of the id. No vectors or no queries give no rows.
    """
    spark = vectors.sparkSession
    vectors = staging.put(one_per_id(vectors), "vectors")
    size = F.size("vector")
    asked_size = vectors.select(size.alias("size")).first()
    queries = queries.where(size == F.lit(asked_size["size"] if asked_size else 0))
    queries = staging.put(queries.groupBy("vec_id").agg(F.min("vector").alias("vector")), "queries")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    total, longest = vectors.agg(F.count("*"), F.max(length)).first()
    if not total:
        return _ranked(spark.createDataFrame([], RESULT), k)
    by_hash = F.xxhash64("vec_id")
    sample = vectors.orderBy(by_hash, "vec_id").limit(sample_rows).select("vector").toArrow()
    tree = fit_tree(_matrix(sample["vector"]), float(longest))
    model = spark.sparkContext.broadcast(tree)

    def placed(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("leaf", pa.array(leaf_of(model.value, _matrix(batch.column("vector")))))

    leaved = staging.put(vectors.mapInArrow(placed, "vec_id long, vector array<double>, leaf long"), "leaves")
    slices = leaved.groupBy("leaf").agg(F.ceil(F.count("*") / slice_rows).alias("slices"))
    parts = max(1, -(-total // (4 * slice_rows)))
    part_of = F.pmod(F.xxhash64("leaf", "slice"), F.lit(parts)).alias("part")
    dealt = leaved.join(slices, "leaf").withColumn("slice", F.pmod(by_hash, F.col("slices")))
    dealt = staging.put(dealt.select("vec_id", "vector", "leaf", part_of), "dealt")
    everywhere = slices.select("leaf", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    where = staging.put(everywhere.select("leaf", part_of).distinct(), "where")

    def exact(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return _result([])
        ids, points = rows["vec_id"].to_numpy(), _matrix(rows["vector"])
        names, wanted = asked["vec_id"].to_numpy(), _matrix(asked["vector"])
        return _result([(n, *_best(ids, points, n, q, k)) for n, q in zip(names.tolist(), wanted)])

    tests = queries.orderBy(by_hash, "vec_id").limit(calibration_queries)
    test_rows = tests.toArrow()
    names, points = test_rows["vec_id"].to_pylist(), _matrix(test_rows["vector"])
    if not names:
        return _ranked(spark.createDataFrame([], RESULT), k)
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<bigint>")).alias("part")
    sent = spark.createDataFrame(test_rows).select("vec_id", "vector", all_parts)
    truth = _ranked(dealt.groupBy("part").cogroup(sent.groupBy("part")).applyInArrow(exact, RESULT), k)
    true_leaves: dict[int, list[int]] = {name: [] for name in names}
    in_leaf = truth.join(leaved.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf")
    for query_id, leaf in in_leaf.collect():  # k rows for each calibration query
        true_leaves[query_id].append(leaf)
    order = {name: leaves_in_order(tree, point, tree.leaves) for name, point in zip(names, points)}
    place = {name: {leaf: at for at, leaf in enumerate(leaves)} for name, leaves in order.items()}
    needed = np.array([place[name][leaf] + 1 for name, leaves in true_leaves.items() for leaf in leaves])
    visits = 1
    while len(needed) and visits < tree.leaves and (needed <= visits).mean() < recall:
        visits = min(2 * visits, tree.leaves)

    def visited(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            walks = [leaves_in_order(model.value, point, visits) for point in _matrix(batch.column("vector"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(walks, pa.list_(pa.int64()))], names=["vec_id", "walk"]
            )

    walks = queries.mapInArrow(visited, "vec_id long, walk array<long>")
    asked = walks.select("vec_id", F.explode("walk").alias("leaf")).join(where, "leaf")
    asked = asked.groupBy("part", "vec_id").agg(F.collect_set("leaf").alias("walk"))
    asked = asked.join(queries, "vec_id").select("part", "vec_id", "vector", "walk")

    def scored(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        if not rows.num_rows or not wanted.num_rows:
            return _result([])
        leaf = rows["leaf"].to_numpy()
        order = np.argsort(leaf, kind="stable")
        ids, vectors, leaf = rows["vec_id"].to_numpy()[order], _matrix(rows["vector"])[order], leaf[order]
        values, begins, sizes = np.unique(leaf, return_index=True, return_counts=True)
        places = {value: np.arange(at, at + size) for value, at, size in zip(values.tolist(), begins, sizes)}
        found = []
        for name, query, walk in zip(wanted["vec_id"].to_pylist(), _matrix(wanted["vector"]), wanted["walk"].to_pylist()):
            chosen = np.concatenate([places[one] for one in walk if one in places] or [values[:0]])
            found.append((name, *_best(ids[chosen], vectors[chosen], name, query, k)))
        return _result(found)

    return _ranked(dealt.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(scored, RESULT), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
