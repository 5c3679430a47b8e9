"""Exact duplicates: SQL on the tables, and small cases by hand."""

import duckdb
import numpy as np
import pytest
from compare import differences
from pyspark.sql import functions as F
from texts import empty, frame, invented, odd

from kerbside.llm import digest_runs
from kerbside.llm.digest_runs import ORACLE, exact_duplicates, one_of_equals, reduced, rounds

TABLES = "/root/testdata/sf0.01"


@pytest.mark.parametrize("fan, part_rows", [(2, 100), (4, 60), (16, 1 << 15)])
def test_every_depth_of_the_tree_matches_sql(spark, monkeypatch, fan, part_rows):
    monkeypatch.setattr(digest_runs, "BLOCK", 8)
    monkeypatch.setattr(digest_runs, "BUFFER", 40)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{TABLES}/documents.parquet'")
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").repartition(7)
    assert differences(exact_duplicates(docs, keep="largest", fan=fan, part_rows=part_rows), db, ORACLE) == []


def test_a_third_of_all_rows_in_one_group(spark):
    texts = [invented(i % 400 if i % 3 else 0, 8) for i in range(3000)]
    docs = frame(spark, texts).repartition(12)
    rows = exact_duplicates(docs, part_rows=100, fan=4).collect()
    groups = {}
    for i, text in enumerate(texts):
        groups.setdefault(text, []).append(i)
    assert len(rows) == 3000
    for r in rows:
        group = groups[texts[r["doc_id"]]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (group[0], len(group), r["doc_id"] == group[0])


def test_runs_hand_on_one_entry_a_text(spark):
    """However large a group, a level's output has at most one entry of it per part."""
    docs = frame(spark, ["same"] * 5000 + [f"t{i}" for i in range(50)]).repartition(8)
    hashed = digest_runs._hashed(docs, "doc_id", "text", None)
    own = F.pmod(F.spark_partition_id(), F.lit(8)).cast("int").alias("part")
    runs = hashed.select(own, "digest", "size", "id", "row").sortWithinPartitions("digest", "size")
    level = runs.mapInArrow(digest_runs._FirstRuns(False, 3, 0, 3), digest_runs._RUN_SCHEMA).collect()
    entries = sum(len(r["entries"]) // digest_runs._ENTRY.itemsize for r in level)
    assert entries <= 50 + hashed.rdd.getNumPartitions()


def test_rounds_settle_all_bits_once():
    for width in range(0, 20):
        for bits in (1, 2, 4):
            steps = rounds(width, bits)
            assert sum(b for _, b in steps) == width
            assert [done for done, _ in steps] == [sum(b for _, b in steps[:i]) for i in range(len(steps))]


def test_texts_that_share_64_bits_are_told_apart():
    """Entries of one key but different digests or lengths, in any order, stay entries of their own."""
    entries = np.zeros(6, digest_runs._ENTRY)
    entries["key"], entries["count"], entries["known"] = 7, 1, 1
    entries["digest"] = [b"a" * 32, b"b" * 32, b"a" * 32, b"c" * 32, b"b" * 32, b"a" * 32]
    entries["size"] = [1, 1, 1, 1, 1, 2]
    entries["id"] = [5, 4, 3, 2, 1, 0]
    found = reduced(entries, largest=False)
    assert [(e["digest"][:1], e["size"], e["id"], e["count"]) for e in found] == [
        (b"a", 1, 3, 2), (b"a", 2, 0, 1), (b"b", 1, 1, 2), (b"c", 1, 2, 1)
    ]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_ids_null_repeated_and_extreme(spark, keep):
    low, high = -(2**63), 2**63 - 1
    docs = frame(spark, ["a"] * 5 + ["b", "b", None, ""], ids=[3, None, low, high, high, None, None, 1, 2])
    rows = exact_duplicates(docs, keep=keep).collect()
    of_a = [r for r in rows if r["group_size"] == 5]
    assert {r["keep_id"] for r in of_a} == {low if keep == "smallest" else high}
    assert sum(r["kept"] for r in of_a) == 1
    of_b = [r for r in rows if r["doc_id"] is None and r["group_size"] == 2]
    assert [r["keep_id"] for r in of_b] == [None, None] and sorted(r["kept"] for r in of_b) == [False, True]
    nothing = {r["doc_id"]: r["kept"] for r in rows if r["doc_id"] in (1, 2)}
    assert nothing == ({1: True, 2: False} if keep == "smallest" else {1: False, 2: True})


def test_odd_rows(spark):
    docs = odd(spark)
    rows = exact_duplicates(docs).collect()
    assert len(rows) == 11 and sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})
    left = one_of_equals(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    assert sorted(r["text"] or "" for r in kept) == sorted({r["text"] or "" for r in docs.collect()})
    assert exact_duplicates(empty(spark)).count() == 0 and one_of_equals(empty(spark)).count() == 0


def test_normalised_texts(spark):
    docs = frame(spark, ["A b", "a B", "c", None])
    rows = {r["doc_id"]: r for r in exact_duplicates(docs, normalise=F.lower).collect()}
    assert rows[1]["keep_id"] == 0 and not rows[1]["kept"] and rows[2]["kept"]
    assert one_of_equals(docs, normalise=F.lower).count() == 3


def test_settings(spark):
    for bad in ({"keep": "first"}, {"fan": 3}):
        with pytest.raises(ValueError):
            exact_duplicates(empty(spark), **bad)
