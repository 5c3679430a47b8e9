"""Connected components of an edge table, by contraction."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.sources import stored

# Edges that a task gathers before it reduces them to a forest.
GATHERED = 1 << 18


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the smallest node of each component to its other nodes."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    first, second = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[first], label[second])
        if (label[first] == label[second]).all():
            break
        np.minimum.at(label, label[first], low)
        np.minimum.at(label, label[second], low)
        while (label[label] != label).any():
            label = label[label]
    other = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[other]], nodes[other]


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def reduced() -> tuple[np.ndarray, np.ndarray]:
        return forest(*(np.concatenate(side) for side in zip(*held)))

    for batch in batches:
        held.append(tuple(column.to_numpy(zero_copy_only=False) for column in batch.columns))
        size += batch.num_rows
        if size >= GATHERED:
            held = [reduced()]
            size = len(held[0][0])
            if 2 * size > GATHERED:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), names=["low", "high"])
                held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(list(map(pa.array, reduced())), names=["low", "high"])


def _is_stars(edges: DataFrame) -> bool:
    """Whether no node is both a lower and an upper end, and none an upper end twice."""
    ends = edges.select(F.col("high").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("low", F.lit(0), F.lit(1))
    )
    roles = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter("up > 1 OR up = 1 AND down = 1").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node of an edge.

    ``edges`` has columns ``a`` and ``b``. Tasks first reduce their own edges to forests. Then two
    steps alternate until every component is a star about its smallest node: each node links its
    larger neighbours to the least of its neighbourhood, and then itself and its smaller neighbours
    to the least of those. Ends are so replaced by smaller ones and equal edges fold into one. A
    step's join has a row per edge, minima are combined before they are shuffled, and what goes from
    round to round is a stored table; the driver only sees whether all are stars.
    """
    ends = edges.filter(F.col("a") != F.col("b")).select("a", "b")
    held = stored(ends.mapInArrow(_forests, "low long, high long").distinct(), "edges")
    while not _is_stars(held):
        near = held.select(F.col("low").alias("node"), F.col("high").alias("near")).unionAll(
            held.select("high", "low")
        )
        least = near.groupBy("node").agg(F.min("near").alias("least"))
        large = held.join(least, held["low"] == least["node"]).select(F.least("least", "low").alias("low"), "high")
        large = stored(large.distinct(), "edges")
        root = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
        moved = large.join(root, large["high"] == root["node"]).filter(F.col("low") != F.col("root"))
        small = moved.select(F.col("root").alias("low"), F.col("low").alias("high")).unionAll(
            root.select("root", "node")
        )
        held = stored(small.distinct(), "edges")
    upper = held.select(F.col("high").alias("node"), F.col("low").alias("component"))
    return upper.unionAll(held.select("low", "low").distinct())
