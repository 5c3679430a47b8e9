"""Near-duplicate vectors by spherical-cap filters with random product codes.

A filter is a direction; a vector belongs to it if their inner product reaches ``alpha``. Filters
are structured: after a random rotation the two halves of a vector meet a code of their own, and
each pair of codewords is a filter. So all filters that a vector belongs to are decoded from two
short lists of inner products. Vectors are joined on filters and compared exactly there.

Equal vectors are one vector with a weight. Every vector is first compared with the smallest vector
of all its filters. Those within half the angle of the threshold about one vector are a ball: any
two of them are linked, and counted at once, so a tight group costs a row per member. What remains
are pairs of different balls: filter by filter, members outside the largest ball meet all others in
blocks. A pair is counted in the smallest filter it shares and nowhere else, so every link counts
once; of the links only a forest between balls is handed out.

The rule for the filters (``filter_sizes``): ``alpha`` is where a cap holds a share of the sphere such
that a filter has some ``occupancy`` members in the mean, whatever the number of vectors, but is 0.5 at
least and no cap holds more than ``cap``. The codes are as large as lets two vectors at the threshold
share ``shared`` filters in the mean, by the share of a cap that another one at that angle covers, up to
``WORDS`` words; beyond some hundred million vectors filters fill up instead. Chances of missing a
link fall with exp(-shared).

Vectors that are null, zero or not finite link with nothing, nor do rows with a null id. Only vectors
of one length are compared; each length is a job of its own, so they should be few. Repeated rows
count as vectors of their own. Extra columns are ignored.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.components import connected_components, forest
from kerbside.llm.groups import (
    by_leader,
    in_stars,
    meeting_pairs,
    meetings,
    met,
    open_buckets,
    shared_buckets,
    star_rows,
)
from kerbside.llm.vectors import cosines, is_direction, lengths_of, unit
from kerbside.sources import stored

ROTATIONS, WORDS = 48, 4096
# Members of a star in a task; residents of a filter that a task holds, and passers that come by.
STAR, BLOCK, PASSERS = 4096, 4096, 1 << 16
# Room for rounding in angles and products.
_ROOM = 1e-9


def cap_share(dimensions: int, alpha: float) -> float:
    """The share of the unit sphere within a cap of height ``alpha``."""
    at = np.linspace(0, np.pi, 200_001)
    density = np.sin(at) ** (dimensions - 2)
    return float(density[np.cos(at) >= alpha].sum() / density.sum())


def cap_height(dimensions: int, cap: float, most: float) -> float:
    """The height at which a cap has a share of the sphere, ``most`` at most."""
    low, high = 0.0, most
    if cap_share(dimensions, high) > cap:
        return most
    for _ in range(30):
        middle = (low + high) / 2
        low, high = (middle, high) if cap_share(dimensions, middle) > cap else (low, middle)
    return high


def covered(dimensions: int, alpha: float, cosine: float) -> float:
    """The share of a cap that belongs to the cap about a direction at some cosine, too."""
    at = np.linspace(0, np.pi, 20_001)
    density = np.sin(at) ** (dimensions - 2)
    height, density = np.cos(at)[np.cos(at) >= alpha], density[np.cos(at) >= alpha]
    if dimensions < 3:
        return max(1 - np.arccos(cosine) / (2 * np.arccos(alpha)), 1e-3)
    # What is left of a direction has a random one in one dimension less.
    rest = np.sin(at) ** (dimensions - 3)
    tail = np.cumsum(rest) / rest.sum()
    width = np.sqrt(1 - cosine**2) * np.sqrt(np.maximum(1 - height**2, 1e-300))
    needed = np.clip((alpha - cosine * height) / width, -1, 1)
    inside = np.interp(np.arccos(needed), at, tail)
    return float((density * inside).sum() / density.sum())


def filter_sizes(
    dimensions: int, count: int, threshold: float, occupancy: float, shared: float, cap: float
) -> tuple[float, int]:
    """``alpha`` and the number of words of each code, for a number of vectors."""
    alpha = cap_height(dimensions, min(cap, occupancy / max(count, 1)), most=0.9)
    while True:
        per_vector = shared / covered(dimensions, alpha, threshold)
        words = max(1, round(np.sqrt(per_vector / ROTATIONS / cap_share(dimensions, alpha))))
        if words <= WORDS or alpha < 0.01:
            return alpha, words
        alpha -= 0.005


class ProductCode:
    """Rotations with two codes each, made from a seed."""

    def __init__(self, dimensions: int, alpha: float, words: int, seed: int):
        random = np.random.default_rng(seed)
        self.width = max(2, dimensions + dimensions % 2)
        self.alpha, self.words, half = alpha, words, self.width // 2
        self.rotations = []
        for _ in range(ROTATIONS):
            turn = np.linalg.qr(random.standard_normal((self.width, self.width)))[0]
            codes = random.standard_normal((2, words, half))
            codes /= np.linalg.norm(codes, axis=2, keepdims=True) * np.sqrt(2)
            self.rotations.append((turn, codes))

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and filter of every membership, by row and then filter."""
        padded = np.zeros((len(vectors), self.width))
        padded[:, : vectors.shape[1]] = vectors
        half, rows, filters = self.width // 2, [], []
        for number, (turn, codes) in enumerate(self.rotations):
            turned = padded @ turn
            first, second = turned[:, :half] @ codes[0].T, turned[:, half:] @ codes[1].T
            # Only codewords that can still reach alpha with the best of the other half.
            row, i = np.nonzero(first >= self.alpha - second.max(axis=1, keepdims=True))
            at, j = np.nonzero(first[row, i][:, None] + second[row] >= self.alpha)
            rows.append(row[at])
            filters.append((number * self.words + i[at]) * self.words + j)
        rows, filters = np.concatenate(rows), np.concatenate(filters)
        order = np.lexsort((filters, rows))
        return rows[order], filters[order].astype(np.int64)


@lru_cache(maxsize=1)
def _code(dimensions: int, alpha: float, words: int, seed: int) -> ProductCode:
    return ProductCode(dimensions, alpha, words, seed)


def _decoder(*settings):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code(*settings)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                values = part.column(1).flatten().to_numpy(zero_copy_only=False)
                rows, filters = code.decode(unit(values.reshape(part.num_rows, -1)))
                ends = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(filters))
                held = [filters[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(held, pa.binary())],
                    names=["id", "filters", "packed"],
                )

    return decode


def _ball_members(threshold: float):
    """Members linked with their leader, and whether they lie in the ball about it."""
    half = np.cos(np.arccos(min(threshold, 1.0)) / 2) + _ROOM

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, members, leaders in by_leader(batches):
            near = cosines(rows["vector"][leaders], rows["vector"][members])
            linked = near >= threshold
            columns = [rows["a"][members][linked], rows["id"][members][linked], near[linked] >= half]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["a", "b", "tight"])

    return compare


def first_meeting(rows: dict, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the filter of some pairs of rows is the smallest that each pair shares."""
    members, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    lists = [np.frombuffer(rows["filters"][member], np.int64) for member in members]
    lists = [held[held < own] for held, own in zip(lists, rows["filter"][members])]
    owner = np.repeat(np.arange(len(members)), [len(each) for each in lists])
    _, column, held = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    owner, column = owner[held[column] > 1], column[held[column] > 1]
    _, column = np.unique(column, return_inverse=True)
    bits = np.zeros((len(members), (int(column.max()) >> 6) + 1 if len(column) else 1), np.uint64)
    np.bitwise_or.at(bits, (owner, column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    first, second = at[: len(a)], at[len(a) :]
    step = max(1, (1 << 20) // bits.shape[1])
    none = np.ones(len(a), bool)
    for start in range(0, len(a), step):
        part = slice(start, start + step)
        none[part] = ~(bits[first[part]] & bits[second[part]]).any(axis=1)
    return none


class _Links:
    """Sums of links between balls, and forests of the balls that they join."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.rows, self.unit = None, None

    def near(self, rows: dict, stay: np.ndarray, go: np.ndarray) -> np.ndarray:
        if rows is not self.rows:
            self.rows, self.unit = rows, unit(rows["vector"])
        return self.unit[stay] @ self.unit[go].T >= self.threshold - _ROOM

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, a, b, _ in meeting_pairs(batches, ["filter"], self.near):
            linked = [np.zeros(0, bool)]
            for at in range(0, len(a), 20_000):
                part = slice(at, at + 20_000)
                linked.append(cosines(rows["vector"][a[part]], rows["vector"][b[part]]) >= self.threshold)
            linked = np.concatenate(linked)
            a, b = a[linked], b[linked]
            if len(a) == 0:
                continue
            own = first_meeting(rows, a, b)
            a, b = a[own], b[own]
            links = np.bincount(a, rows["weight"][b], len(rows["id"]))
            links += np.bincount(b, rows["weight"][a], len(rows["id"]))
            counted = np.flatnonzero(links)
            first, second = forest(rows["label"][a], rows["label"][b])
            none = pa.nulls(len(counted), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([pa.array(rows["id"][counted]), pa.array(first)]),
                    pa.concat_arrays([none, pa.array(second)]),
                    pa.array(np.concatenate([links[counted], np.zeros(len(first))]).astype(np.int64)),
                ],
                names=["id", "other", "links"],
            )


def near_duplicate_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    occupancy: float = 0.12,
    shared: float = 20.0,
    cap: float = 1.1e-5,
    seed: int = 7,
) -> DataFrame:
    """Per row: ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    taken = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("vector")
    )
    usable = F.col("vec_id").isNotNull() & is_direction(F.col("vector"))
    compared = taken.filter(usable)
    every = taken.filter(~usable).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    for dimensions in lengths_of(compared, "vector"):
        own = compared.filter(F.size("vector") == dimensions)
        every = every.unionAll(_linked(own, dimensions, threshold, occupancy, shared, cap, seed))
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _linked(
    compared: DataFrame, dimensions: int, threshold: float, occupancy: float, shared: float, cap: float, seed: int
) -> DataFrame:
    """``vec_id``, ``n_links`` and ``component_id`` of vectors of one length."""
    classes = compared.groupBy("vector").agg(
        F.min("vec_id").alias("name"), F.count("*").alias("weight")
    )
    # A repeated id may stand for several vectors, so a class has a number of its own.
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()), "vector-classes")
    nodes = classes.select("id", "vector", "weight")

    width = max(2, dimensions + dimensions % 2)
    alpha, words = filter_sizes(width, classes.count(), threshold, occupancy, shared, cap)
    decoded = nodes.select("id", "vector").mapInArrow(
        _decoder(dimensions, alpha, words, seed), "id long, filters array<bigint>, packed binary"
    )
    decoded = stored(decoded, "cap-filters")
    buckets = shared_buckets(decoded.select("id", F.explode("filters").alias("filter")), ["filter"])
    buckets = stored(buckets, "shared-filters")

    pairs = buckets.filter("id != leader").groupBy(F.col("id").alias("b")).agg(F.min("leader").alias("a"))
    stars = stored(in_stars(pairs, STAR), "stars")
    stars = star_rows(stars, nodes.select("id", "vector"))
    stars = stored(stars.mapInArrow(_ball_members(threshold), "a long, b long, tight boolean"), "linked-stars")
    balls = stars.filter("tight").select(F.col("b").alias("id"), F.col("a").alias("ball"))
    named = nodes.select("id", "weight").join(balls, "id", "left")
    named = stored(named.select("id", "weight", F.coalesce("ball", "id").alias("label")), "balls")

    members = buckets.select("filter", "id").join(named.select("id", "label"), "id")
    rows = stored(meetings(open_buckets(members, ["filter"]), ["filter"], BLOCK, PASSERS), "meetings")
    carried = nodes.join(decoded.select("id", F.col("packed").alias("filters")), "id")
    found = met(rows.join(carried, "id"), ["filter"]).mapInArrow(
        _Links(threshold), "id long, other long, links long"
    )
    found = stored(found, "vector-links")

    edges = found.filter("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))
    parts = connected_components(edges.unionAll(stars.select("a", "b")))
    inside = named.groupBy("label").agg(F.sum("weight").alias("held"))
    across = found.groupBy("id").agg(F.sum("links").alias("links"))
    # Linked are all others of the ball, copies of the vector among them, and those of other balls.
    placed = (
        named.join(inside, "label")
        .join(across, "id", "left")
        .join(parts.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "id",
            (F.col("held") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    placed = stored(placed.join(classes.select("id", "name"), "id"), "placed-classes")
    least = placed.groupBy("component").agg(F.min("name").alias("component_id"))
    info = placed.join(least, "component").select("id", "n_links", "component_id")
    info = stored(classes.select("id", "vector").join(info, "id").drop("id"), "vector-results")
    return compared.join(info, "vector").select("vec_id", "n_links", "component_id")
