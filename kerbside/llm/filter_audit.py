"""How filters of documents interact: count-weighted decision diagrams over failure masks.

1. One pass gives each document the mask of the filters that it fails; the filter on copies joins
   with the smallest id of each text that several rows have. Spark counts documents, good ones and
   toxic ones by part and mask. A part has 2**5 masks at most, however many documents.
2. A part's counts become a decision diagram: a level per filter, a branch for pass and one for
   fail, and in the leaves the counts. Equal subdiagrams are one node, so the diagram is reduced.
3. The audit goes through all orders of the filters by swaps of adjacent levels. A swap rebuilds
   the nodes of the upper of the two levels and leaves everything above and below as it is.
4. An order's path of passes gives its steps: the weight of the node that it reaches is what the
   filters so far have kept, the weight of the branch that it leaves aside is what a step removes.

Null text counts as empty; a null ``lang`` is the part of the empty string. A null id fails no filter
on copies and is nobody's smaller id; rows of one id are none of each other's copies. Of repeated
labels of an id a document has the largest. Very long texts are counted whole. Extra columns are
ignored. An empty table has no parts and so no rows.
"""

import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.sources import stored

FILTERS = "ABCDE"
# Separators of words, and the signs of filter D.
_SPACES = r"[\x20\x09-\x0D]+"
_SIGNS = r"[#$%&*|]"

Counts = tuple[int, int, int]
_NOTHING: Counts = (0, 0, 0)


def _plus(first: Counts, second: Counts) -> Counts:
    return (first[0] + second[0], first[1] + second[1], first[2] + second[2])


class FailureDiagram:
    """A reduced ordered diagram of failure masks with a weight in every node.

    ``order[i]`` is the filter tested at level ``i``. A node is a number; ``branch`` has its level and
    its two successors, pass and fail, and ``weight`` the counts of all documents below it.
    """

    def __init__(self, masks: dict[int, Counts], filters: int):
        self.order = list(range(filters))
        self.branch: list[tuple[int, int, int]] = []
        self.weight: list[Counts] = []
        self._known: dict[tuple, int] = {}
        self.root = self._build(masks, 0, 0)

    def _node(self, level: int, passed: int, failed: int) -> int:
        key = (level, passed, failed)
        if key not in self._known:
            self._known[key] = len(self.branch)
            self.branch.append(key)
            self.weight.append(_plus(self.weight[passed], self.weight[failed]))
        return self._known[key]

    def _leaf(self, counts: Counts) -> int:
        key = ("leaf", *counts)
        if key not in self._known:
            self._known[key] = len(self.branch)
            self.branch.append((len(self.order), -1, -1))
            self.weight.append(counts)
        return self._known[key]

    def _build(self, masks: dict[int, Counts], level: int, failed: int) -> int:
        if level == len(self.order):
            return self._leaf(masks.get(failed, _NOTHING))
        passes = self._build(masks, level + 1, failed)
        return self._node(level, passes, self._build(masks, level + 1, failed | 1 << level))

    def swap(self, level: int) -> None:
        """Exchange the filters of two neighbouring levels.

        A node of the upper level tests the other filter first, so its four grandchildren change
        places crosswise. Nodes above only learn their new successors.
        """
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]
        changed: dict[int, int] = {}
        self.root = self._swapped(self.root, level, changed)

    def _swapped(self, node: int, level: int, changed: dict[int, int]) -> int:
        if node not in changed:
            own, passed, failed = self.branch[node]
            if own < level:
                successors = (self._swapped(each, level, changed) for each in (passed, failed))
                changed[node] = self._node(own, *successors)
            else:
                (_, both, second), (_, first, none) = self.branch[passed], self.branch[failed]
                upper = self._node(level + 1, both, first), self._node(level + 1, second, none)
                changed[node] = self._node(level, *upper)
        return changed[node]

    def steps(self) -> list[tuple[int, Counts, Counts]]:
        """Per step of the present order: its filter, what it keeps and what it removes."""
        node, found = self.root, []
        for number in self.order:
            _, passed, failed = self.branch[node]
            found.append((number, self.weight[passed], self.weight[failed]))
            node = passed
        return found


def adjacent_swaps(size: int) -> list[int]:
    """Upper levels of the swaps that lead through all orders of ``size`` filters, each once.

    Recursive: the last filter wanders through all places, to and fro, between two swaps of the
    others' sequence; while it stands first the others' levels lie one further down.
    """
    if size < 2:
        return []
    found: list[int] = []
    up = list(range(size - 2, -1, -1))
    for number, other in enumerate([*adjacent_swaps(size - 1), None]):
        wander = up if number % 2 == 0 else up[::-1]
        found += wander
        if other is not None:
            found.append(other + (number % 2 == 0))
    return found


def audit(masks: dict[int, Counts], filters: int) -> Iterator[tuple]:
    """Rows (order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    diagram = FailureDiagram(masks, filters)
    orders = [(tuple(diagram.order), diagram.steps())]
    for level in adjacent_swaps(filters):
        diagram.swap(level)
        orders.append((tuple(diagram.order), diagram.steps()))
    failing, alone, shapley = [0] * filters, [0] * filters, [0] * filters
    # A filter that stands first removes all that fail it; one that stands last, what fails it only.
    for _, steps in orders:
        for place, (number, _, removed) in enumerate(steps):
            shapley[number] += removed[0]
            if place == 0:
                failing[number] = removed[0]
            if place == filters - 1:
                alone[number] = removed[0]
    for order, steps in orders:
        for place, (number, kept, removed) in enumerate(steps, 1):
            yield (
                order, place, kept[0], removed[0], failing[number] - removed[0], alone[number],
                removed[1], removed[2], shapley[number],
            )


_COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _auditor(names: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = {m["mask"]: (m["n"], m["good"], m["toxic"]) for m in masks}
                orders, *columns = zip(*audit(counts, len(names)))
                written = ["".join(names[i] for i in order) for order in orders]
                arrays = [pa.array([part] * len(written)), pa.array(written)]
                arrays += [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.int64()) for c in columns[1:]]]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "filter_order", "step", *_COUNTS])

    return run


def audit_filters(masks: DataFrame, names: str = FILTERS) -> DataFrame:
    """The audit of documents given as ``part``, ``mask``, ``good`` and ``toxic`` (0 or 1 each).

    Bit ``i`` of ``mask`` says that a document fails the filter whose letter is ``names[i]``. All orders
    of the filters are listed, so there should be few: seven have 5,040 orders.
    """
    counted = masks.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    entry = F.struct("mask", "n", "good", "toxic")
    parts = counted.groupBy("part").agg(F.collect_list(entry).alias("masks"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)
    return parts.mapInArrow(_auditor(names), schema)


def failure_mask(text: Column, words: Column) -> Column:
    """Bits 0 to 3: the filters that look at one text alone."""
    held = F.size(words)
    fails = [
        held < 100,
        100 * F.size(F.array_distinct(words)) < 80 * held,
        100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        text.rlike(_SIGNS),
    ]
    return sum((F.when(each, 1 << i).otherwise(0) for i, each in enumerate(fails)), F.lit(0))


def failures(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Per document ``part``, ``mask``, ``good`` and ``toxic``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, _SPACES), "").alias("words"),
    ).select(
        "id",
        "part",
        failure_mask(F.col("text"), F.col("words")).cast("int").alias("mask"),
        F.unhex(F.sha2("text", 256)).alias("digest"),
    )
    rows = stored(rows, "failure-masks")
    copies = rows.filter("id IS NOT NULL").groupBy("digest").agg(
        F.min("id").alias("least"), F.max("id").alias("most")
    )
    copies = stored(copies.filter("most > least").select("digest", "least"), "copied-texts")
    marked = labels.groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    copied = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return (
        rows.join(copies, "digest", "left")
        .join(marked, "id", "left")
        .select(
            "part",
            (F.col("mask") + F.when(copied, 16).otherwise(0)).alias("mask"),
            F.coalesce("good", F.lit(0)).alias("good"),
            F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
    )


def oracle() -> str:
    """The audit in DuckDB's SQL: every order against the counted masks."""
    orders = ", ".join(
        f"('{''.join(order)}', {step}, {sum(1 << FILTERS.index(x) for x in order[:step - 1])},"
        f" {1 << FILTERS.index(order[step - 1])})"
        for order in itertools.permutations(FILTERS)
        for step in range(1, 6)
    )
    return rf"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
    FROM documents
), marked AS (
    SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
    FROM labels GROUP BY doc_id
), masked AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)
                  THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
    FROM words LEFT JOIN marked USING (doc_id)
), counted AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY ALL
), orders(filter_order, step, earlier, own) AS (VALUES {orders}),
steps AS (
    SELECT part, filter_order, step, own,
           coalesce(sum(n) FILTER (WHERE mask & (earlier | own) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (WHERE mask & earlier = 0 AND mask & own > 0), 0) AS removed,
           coalesce(sum(n) FILTER (WHERE mask & earlier > 0 AND mask & own > 0), 0) AS redundant,
           coalesce(sum(n) FILTER (WHERE mask = own), 0) AS unique_fails,
           coalesce(sum(good) FILTER (WHERE mask & earlier = 0 AND mask & own > 0), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (WHERE mask & earlier = 0 AND mask & own > 0), 0) AS toxic_lost
    FROM counted CROSS JOIN orders GROUP BY part, filter_order, step, earlier, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM steps
"""
