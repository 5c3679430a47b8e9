"""Filter audit: SQL on the tables, diagrams against a walk over all masks."""

import itertools
import random

import duckdb
import pytest
from compare import differences
from texts import empty, frame, invented, odd

from kerbside.llm.filter_audit import FailureDiagram, adjacent_swaps, audit, audit_filters, failures, oracle

LABELS = "doc_id long, quality int, toxic int"


def plain_audit(masks, filters):
    """Every order by applying it to every mask."""
    rows, removed_by = [], [0] * filters
    for order in itertools.permutations(range(filters)):
        earlier = 0
        for step, number in enumerate(order, 1):
            own = 1 << number
            kept, here, lost = 0, 0, [0, 0]
            redundant, alone = 0, 0
            for mask, (n, good, toxic) in masks.items():
                kept += n * (not mask & (earlier | own))
                if mask & own:
                    redundant += n * bool(mask & earlier)
                    alone += n * (mask == own)
                    if not mask & earlier:
                        here, lost = here + n, [lost[0] + good, lost[1] + toxic]
            removed_by[number] += here
            rows.append([order, step, kept, here, redundant, alone, *lost, number])
            earlier |= own
    return sorted((*row[:-1], removed_by[row[-1]]) for row in rows)


@pytest.mark.parametrize("filters", [1, 2, 3, 4, 5])
def test_diagrams_against_all_masks(filters):
    pick = random.Random(filters)
    for _ in range(5):
        masks = {
            mask: (pick.randrange(0, 9), pick.randrange(3), pick.randrange(3))
            for mask in range(1 << filters)
            if pick.random() < 0.6
        }
        assert sorted(audit(masks, filters)) == plain_audit(masks, filters)


def test_swaps_visit_every_order_once():
    for size in range(1, 7):
        order, seen = list(range(size)), set()
        seen.add(tuple(order))
        for level in adjacent_swaps(size):
            order[level], order[level + 1] = order[level + 1], order[level]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert len(seen) == len(list(itertools.permutations(range(size))))


def test_a_swap_back_gives_the_same_diagram():
    """Equal subdiagrams are one node, so the root is the same one again."""
    diagram = FailureDiagram({0: (4, 1, 0), 3: (2, 0, 0), 5: (2, 0, 1), 7: (1, 1, 1)}, 3)
    root, nodes = diagram.root, len(diagram.branch)
    for level in (0, 1):
        diagram.swap(level)
        diagram.swap(level)
        assert diagram.root == root and diagram.order == [0, 1, 2]
    assert len(diagram.branch) > nodes
    # Counts that look like a node of small numbers are no node.
    assert FailureDiagram({0: (1, 0, 1), 1: (0, 0, 1)}, 1).steps() == [(0, (1, 0, 1), (0, 0, 1))]


@pytest.mark.parametrize("tables", ["sf0.001", "sf0.01"])
def test_matches_sql(spark, tables):
    db, folder = duckdb.connect(), f"/root/testdata/{tables}"
    for name in ("documents", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    assert differences(audit_filters(failures(docs, labels)), db, oracle()) == []


def test_edges_of_the_filters(spark):
    plain = " ".join(f"w{i}" for i in range(100))
    texts = [
        plain,
        " ".join(f"w{i}" for i in range(99)),
        " ".join(f"w{i % 80}" for i in range(100)),
        " ".join(f"w{i % 79}" for i in range(100)),
        plain + "A" * 43,
        plain + "A" * 44,
        plain + " |",
        plain,
        plain.upper().replace("W", "w"),
        "",
        None,
    ]
    labels = spark.createDataFrame([(7, 1, 0), (7, 0, 1), (6, 1, 1), (99, 1, 1)], LABELS)
    rows = failures(frame(spark, texts), labels).collect()
    masks = sorted((r["mask"], r["good"], r["toxic"]) for r in rows)
    want = [(0, 0, 0), (1, 0, 0), (0, 0, 0), (2, 0, 0), (0, 0, 0), (4, 0, 0), (8, 1, 1), (16, 1, 1), (16, 0, 0), (1, 0, 0), (17, 0, 0)]
    assert masks == sorted(want)


def test_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (None, 1, 1), (4, None, None)], LABELS)
    rows = audit_filters(failures(odd(spark), labels)).collect()
    assert {r["part"] for r in rows} == {""} and len(rows) == 600
    assert {r["kept"] + r["removed"] for r in rows if r["step"] == 1} == {11}
    assert audit_filters(failures(empty(spark), labels)).count() == 0


def test_copies_of_a_third_of_all_rows(spark):
    texts = [invented(0) if i % 3 == 0 else invented(i) for i in range(900)]
    labels = spark.createDataFrame([], LABELS)
    rows = audit_filters(failures(frame(spark, texts), labels)).filter("filter_order = 'EABCD'").collect()
    assert [r["removed"] for r in sorted(rows, key=lambda r: r["step"])][0] == 299
