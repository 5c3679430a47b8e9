import random
import re

import numpy as np
import pyarrow as pa
import pytest
from texts import empty, frame, invented, odd

from kerbside.llm import components, minhash
from kerbside.llm.components import connected_components
from kerbside.llm.groups import likely_rows
from kerbside.llm.minhash import near_duplicates, one_of_each
from kerbside.llm.words import shingles_of, text_slices, words_of
from kerbside.sources import stored

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_force(rows):
    """component and set size by id, from all pairs."""
    sets = {i: shingle_set(text) for i, text in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    low, high = sorted((find(a), find(b)))
                    parent[high] = low
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def edited(text, edits, pick):
    words = text.split()
    for _ in range(edits):
        words[pick.randrange(len(words))] = f"new{pick.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    made = [invented(i, pick.randrange(20, 200)) for i in range(40)]
    # Similarities all around the threshold.
    made += [edited(made[i % 40], pick.randrange(0, 6), pick) for i in range(120)]
    made += [made[0], made[0].upper(), made[1] + "\n", "a b", "A  b", "a b c", "", None, "é È", "é è"]
    return made


def answers(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_against_all_pairs(spark, texts):
    docs = frame(spark, texts)
    assert answers(near_duplicates(docs)) == brute_force(list(enumerate(texts)))


def test_a_large_group_around_the_threshold_in_blocks(spark, monkeypatch):
    """A dense group whose pairs lie above and below the threshold, over several blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    pick = random.Random(9)
    base = invented(77, 150)
    texts = [edited(base, pick.randrange(0, 7), pick) for _ in range(90)]
    found = answers(near_duplicates(frame(spark, texts)))
    assert found == brute_force(list(enumerate(texts)))
    assert len({component for _, component, _ in found.values()}) > 1


def test_odd_rows(spark):
    got = near_duplicates(odd(spark)).collect()
    assert len(got) == 11
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by_id[0]["n_shingles"] == by_id[1]["n_shingles"] == by_id[2]["n_shingles"] == 0
    assert by_id[4]["component_id"] == 3 and not by_id[4]["kept"] and by_id[3]["kept"]
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)


def test_one_of_each_keeps_columns_and_one_row(spark):
    docs = odd(spark)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 6, 7]
    assert ids.count(None) == 2


def test_no_rows(spark):
    assert near_duplicates(empty(spark)).count() == 0
    assert one_of_each(empty(spark)).count() == 0


def test_posterior_bounds():
    needed = minhash.fewest_matches(0.75, 1e-6)
    assert needed == sorted(needed)
    for matches, seen in zip(needed, range(32, 129, 32)):
        assert minhash._upper_beta(matches + 1, seen - matches + 1, 0.75) >= 1e-6
        assert minhash._upper_beta(matches, seen - matches + 2, 0.75) < 1e-6


@pytest.mark.parametrize("limit", [1, 40, 1 << 20])
def test_words_and_shingles_of_a_column(texts, limit):
    found = {}
    for text in text_slices(pa.array(texts), limit):
        shingles = shingles_of(words_of(text))
        for row, start, end in zip(shingles.rows, shingles.starts, shingles.ends()):
            found[text.first + row] = len(np.unique(shingles.hash[start:end]))
    assert found == {i: len(shingle_set(t)) for i, t in enumerate(texts) if shingle_set(t)}


def test_components_of_random_edges(spark):
    pick = random.Random(3)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 900)]
    parent = {i: i for edge in edges for i in edge}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r[0]: r[1] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    # A node whose only edge is to itself has no neighbour and no row.
    assert got == {i: find(i) for i in parent if any(i in e and e[0] != e[1] for e in edges)}


def test_repeated_ids_are_placed_by_their_own_text(spark):
    x, y = invented(1, 100), invented(2, 100)
    docs = frame(spark, [x, y, x + " more", y + " more", y], ids=[5, 5, 3, 9, 5])
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == [(3, 97, 3, True), (5, 96, 3, False), (5, 96, 5, True), (5, 96, 5, True), (9, 97, 5, False)]
    left = sorted((r["doc_id"], r["text"]) for r in one_of_each(docs).collect())
    assert left == [(3, x + " more"), (5, y)]


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_chains_and_groups_with_any_number_of_rounds(spark, monkeypatch, rounds):
    """Groups that lie side by side, chains of small steps, and lone texts near a group."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "PASSERS", 16)
    monkeypatch.setattr(minhash, "STAR", 4)
    pick = random.Random(21)
    texts = []
    for start in range(3):
        text = invented(100 + start, 120)
        for _ in range(25):
            texts.append(text)
            text = edited(text, 3, pick)
        texts += [edited(texts[-1], pick.randrange(3, 9), pick) for _ in range(30)]
    pick.shuffle(texts)
    got = answers(near_duplicates(frame(spark, texts), rounds=rounds))
    assert got == brute_force(list(enumerate(texts)))


def rows_of(spark, monkeypatch, texts, rounds):
    """Rows of every table that the links go through, by name."""
    counts = {}

    def counting(df, name):
        held = stored(df, name)
        counts[name] = counts.get(name, 0) + held.count()
        return held

    for module in (minhash, components):
        monkeypatch.setattr(module, "stored", counting)
    near_duplicates(frame(spark, texts), rounds=rounds).count()
    return counts


@pytest.mark.parametrize("edits, rounds, most", [(1, 1, 2.2), (3, 2, 2.4)])
def test_rows_grow_with_a_group_and_not_with_its_square(spark, monkeypatch, edits, rounds, most):
    """Near copies, and, with a round of leaders more, a group of which about half of all pairs are
    below the threshold."""
    pick = random.Random(8)
    base = invented(3, 200)
    texts = [edited(base, edits, pick) for _ in range(2000)]
    small = rows_of(spark, monkeypatch, texts[:1000], rounds)
    large = rows_of(spark, monkeypatch, texts, rounds)
    for name in ("buckets", "stars", "surviving-pairs", "confirmed-pairs", "edges"):
        assert large[name] <= most * small[name], name
    assert large.get("meetings", 0) <= 2 * large["buckets"]


def test_rows_that_a_join_is_to_see(spark):
    """All wanted rows, and a sixteenth of the others at most, but for chance."""
    rows = spark.range(20_000).selectExpr("IF(id % 50 = 1, NULL, id) AS a", "id * 7 AS b", "'x' AS text")
    wanted = rows.filter("b % 41 = 3").select("a", "b")
    got = likely_rows(rows, wanted, ["a", "b"])
    assert got.columns == rows.columns
    assert wanted.exceptAll(got.select("a", "b")).isEmpty()
    assert got.count() - wanted.count() < 20_000 / 10
    assert likely_rows(rows, wanted.limit(0), ["a", "b"]).isEmpty()
    # With fewer bits than wanted rows nearly all pass, and none that is wanted is lost.
    crowded = likely_rows(rows, rows, ["a", "b"], most=15)
    assert crowded.count() == 20_000


def test_joins_of_components_have_a_row_per_edge(spark, monkeypatch):
    """A star of many edges, listed often: tasks fold it before the first join."""
    edges = spark.range(0, 40_000, numPartitions=4).selectExpr("0 AS a", "id % 5000 AS b")
    sizes = []

    def counting(df, name):
        held = stored(df, name)
        sizes.append(held.count())
        return held

    monkeypatch.setattr(components, "stored", counting)
    assert connected_components(edges).filter("component = 0").count() == 5000
    assert max(sizes) <= 4999
