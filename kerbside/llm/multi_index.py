"""Nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut in two halves and each half is quantised by its own k-means, fitted on a
bounded sample. A cell of the index is a pair of centroids; every vector goes to its cell. A query
visits cells in the order of the summed squared distance of its halves to the two centroids, taken
from a heap. Every vector of a visited cell is reranked by its exact cosine.

A query stops by a bound: the ``k``-th best vector of the sample gives a squared distance that the ``k``
nearest do not exceed, and a neighbour's cell lies at most a ``margin`` further, but for a share of
1 - ``reach`` of all neighbours. The margin is measured on the sample's own neighbours. So where
vectors have structure few cells are visited, and many where they have none; the size of the table
plays no part.

A visit is written as a set of second centroids per first centroid, so a query goes to at most as
many lists as there are centroids of one half. A list is held in blocks, each by one task, to which
its vectors go once, and queries stream past it: what is shuffled is a row per vector and one per
visit of a block.

Vectors that are null, zero or not finite take no part, nor do rows with a null id. A query's candidates
are the vectors of its own length; each length has an index of its own, so lengths should be few.
Repeated ids are candidates of their own, but none of a query's own id. Equal scores are ordered by
the smaller id. Extra columns are ignored.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.groups import grouped_rows
from kerbside.llm.vectors import cosines, is_direction, lengths_of, unit
from kerbside.sources import stored

# Vectors of a list that a task holds, and queries that it looks at together.
BLOCK, QUERIES = 4096, 512
# Sample vectors whose neighbours the margin is measured on.
MEASURED = 256
_GROUP = ["first", "part"]


def k_means(points: np.ndarray, count: int, seed: int, rounds: int = 20) -> np.ndarray:
    """Centroids of some points; as many as there are points, where those are fewer."""
    random = np.random.default_rng(seed)
    centers = points[random.permutation(len(points))[:count]].copy()
    for _ in range(rounds):
        nearest = np.argmin(distances(points, centers), axis=1)
        held = np.bincount(nearest, minlength=len(centers))
        for axis in range(points.shape[1]):
            total = np.bincount(nearest, points[:, axis], len(centers))
            centers[held > 0, axis] = total[held > 0] / held[held > 0]
    return centers


def distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of every point to every centre."""
    return (points**2).sum(1)[:, None] - 2 * points @ centers.T + (centers**2).sum(1)


class MultiIndex:
    """Centroids of both halves, the number of vectors in each cell, and the sample for the bound."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, centroids: int, k: int, reach: float, seed: int):
        self.half, self.k = sample.shape[1] // 2, k
        self.sample, self.ids = sample, ids
        self.first = k_means(sample[:, : self.half], centroids, seed)
        self.second = k_means(sample[:, self.half :], centroids, seed + 1)
        self.held = np.zeros((len(self.first), len(self.second)), np.int64)
        self.margin = self._margin(reach)

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, second = self.to_centroids(vectors)
        return first.argmin(1), second.argmin(1)

    def to_centroids(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = distances(vectors[:, : self.half], self.first)
        return first, distances(vectors[:, self.half :], self.second)

    def _margin(self, reach: float) -> float:
        """How much further than a neighbour its cell lies, for a share ``reach`` of neighbours."""
        if len(self.sample) <= self.k:
            return np.inf
        some = self.sample[:MEASURED]
        near = some @ self.sample.T
        near[np.arange(len(some)), np.arange(len(some))] = -9
        found = np.argsort(-near, axis=1)[:, : self.k]
        first, second = self.to_centroids(some)
        own = [cells[found] for cells in self.cells(self.sample)]
        row = np.arange(len(some))[:, None]
        excess = first[row, own[0]] + second[row, own[1]] - (2 - 2 * near[row, found])
        return float(np.quantile(excess, reach))

    def limits(self, ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """The summed distance beyond which each query visits no cell."""
        near = queries @ self.sample.T
        near[ids[:, None] == self.ids[None, :]] = -9
        if near.shape[1] < self.k:
            return np.full(len(queries), np.inf)
        score = -np.partition(-near, self.k - 1, axis=1)[:, self.k - 1]
        return np.where(score < -5, np.inf, 2 - 2 * score + self.margin)

    def visits(self, query: np.ndarray, limit: float) -> dict[int, int]:
        """First centroid -> bits of the second centroids visited with it: cells within the limit, and
        more until there are as many vectors as are asked for besides the query itself."""
        to_first, to_second = (each[0] for each in self.to_centroids(query[None]))
        rows, columns = np.argsort(to_first, kind="stable"), np.argsort(to_second, kind="stable")
        near, far = to_first[rows].tolist(), to_second[columns].tolist()
        held = self.held[rows][:, columns].tolist()
        heap, found, seen = [(near[0] + far[0], 0, 0)], 0, {}
        while heap and (heap[0][0] <= limit or found <= self.k):
            _, i, j = heapq.heappop(heap)
            found += held[i][j]
            seen[i] = seen.get(i, 0) | 1 << int(columns[j])
            # Each cell enters once: along the second list, and down the first from its start.
            if j + 1 < len(far):
                heapq.heappush(heap, (near[i] + far[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(near):
                heapq.heappush(heap, (near[i + 1] + far[0], i + 1, 0))
        return {int(rows[i]): bits for i, bits in seen.items()}


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _indexer(index: MultiIndex):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                first, second = index.cells(unit(_matrix(batch.column(1))))
                columns = [pa.array(each.astype(np.int32)) for each in (first, second)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *columns], names=["id", "vector", "first", "second"]
                )

    return assign


def _traverser(index: MultiIndex):
    def traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            queries, limits = unit(_matrix(batch.column(1))), []
            for at in range(0, len(queries), QUERIES):
                ids = batch.column(0).slice(at, QUERIES).to_numpy(zero_copy_only=False)
                limits += index.limits(ids, queries[at : at + QUERIES]).tolist()
            visits = [index.visits(query, limit) for query, limit in zip(queries, limits)]
            row = np.repeat(np.arange(len(visits)), [len(each) for each in visits])
            cells = [item for each in visits for item in each.items()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    batch.column(1).take(pa.array(row)),
                    pa.array([first for first, _ in cells], pa.int32()),
                    pa.array([bits for _, bits in cells], pa.int64()),
                ],
                names=["id", "vector", "first", "bits"],
            )

    return traverse


def _reranker(k: int):
    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, units = None, None
        for rows, entries, asked in grouped_rows(batches, _GROUP, "is_query"):
            if rows is not known:
                known, units = rows, unit(rows["vector"])
            for at in range(0, len(asked) if len(entries) else 0, QUERIES):
                queries = asked[at : at + QUERIES]
                near = units[queries] @ units[entries].T
                visited = rows["cells"][queries][:, None] >> rows["cells"][entries][None, :] & 1
                visited &= rows["id"][queries][:, None] != rows["id"][entries][None, :]
                near[visited == 0] = -9
                last = min(k, len(entries)) - 1
                least = -np.partition(-near, last, axis=1)[:, last]
                # With room for rounding; the kept ones are scored alike wherever they stand.
                q, e = np.nonzero((near >= least[:, None] - 1e-9) & (near > -5))
                query, given = rows["id"][queries[q]], rows["id"][entries[e]]
                score = cosines(rows["vector"][queries[q]], rows["vector"][entries[e]])
                order = np.lexsort((given, -score, q))
                first = np.searchsorted(q[order], q[order])
                order = order[np.arange(len(order)) - first < k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query[order]), pa.array(given[order]), pa.array(score[order])],
                    names=["query_id", "vec_id", "score"],
                )

    return rerank


_FOUND = "query_id long, vec_id long, score double"


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = 32,
    reach: float = 0.92,
    sample_rows: int = 8192,
    seed: int = 7,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest of each query.

    ``is_query`` is a condition on column ``id``. The index is fitted on ``sample_rows`` vectors, picked
    by hash of the id; ``centroids`` is 63 at most.
    """
    taken = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("vector"))
    usable = taken.filter(F.col("id").isNotNull() & is_direction(F.col("vector")))
    found = taken.sparkSession.createDataFrame([], _FOUND)
    for dimensions in lengths_of(usable, "vector"):
        own = usable.filter(F.size("vector") == dimensions)
        found = found.unionAll(_searched(own, is_query, k, centroids, reach, sample_rows, seed))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searched(
    vectors: DataFrame, is_query: Column, k: int, centroids: int, reach: float, sample_rows: int, seed: int
) -> DataFrame:
    """The best ``k`` of every block that a query visits, among vectors of one length."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
    points = unit(np.array([row["vector"] for row in sample]))
    index = MultiIndex(points, np.array([row["id"] for row in sample]), centroids, k, reach, seed)
    kind = vectors.schema["vector"].dataType.simpleString()
    placed = vectors.mapInArrow(_indexer(index), f"id long, vector {kind}, first int, second int")
    placed = stored(placed, "multi-index")
    # A row per cell: at most the square of the number of centroids.
    for cell in placed.groupBy("first", "second").count().collect():
        index.held[cell["first"], cell["second"]] = cell["count"]

    parts = np.maximum(1, -(-index.held.sum(axis=1) // BLOCK)).tolist()
    part_count = F.element_at(F.array(*map(F.lit, parts)), F.col("first") + 1).cast("int")
    visits = placed.filter(is_query).select("id", "vector").mapInArrow(
        _traverser(index), f"id long, vector {kind}, first int, bits long"
    )
    visits = visits.select(
        "first",
        F.explode(F.sequence(F.lit(0), part_count - 1)).alias("part"),
        F.lit(True).alias("is_query"),
        "id",
        "vector",
        F.col("bits").alias("cells"),
    )
    entries = placed.select(
        "first",
        F.pmod(F.xxhash64("id"), part_count).cast("int").alias("part"),
        F.lit(False).alias("is_query"),
        "id",
        "vector",
        F.col("second").cast("bigint").alias("cells"),
    )
    rows = visits.unionAll(entries).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "is_query")
    return rows.mapInArrow(_reranker(k), _FOUND)
