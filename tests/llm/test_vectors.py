import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kerbside.llm import cap_filters, components, multi_index
from kerbside.llm.cap_filters import near_duplicate_vectors
from kerbside.llm.multi_index import nearest_neighbours
from kerbside.sources import stored

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [
        (i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "y")
        for i, v in zip(ids, vectors)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def clusters():
    random = np.random.default_rng(4)
    centres = random.standard_normal((30, 32))
    spread = random.uniform(0.02, 0.5, (400, 1))
    made = centres[random.integers(0, 30, 400)] + spread * random.standard_normal((400, 32))
    made[200:230] = made[0] + 0.05 * random.standard_normal((30, 32))
    made[300:310] = made[5]
    return made.astype(np.float32)


def cosines(vectors):
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    return unit @ unit.T


def brute_force_links(vectors):
    linked = cosines(vectors) >= 0.95
    np.fill_diagonal(linked, False)
    component = np.arange(len(vectors))
    while True:
        least = np.where(linked, component[None, :], len(vectors)).min(axis=1)
        after = np.minimum(component, least)
        if (after == component).all():
            return linked.sum(axis=1), component
        component = after


@pytest.mark.parametrize("block", [256, 8])
def test_links_against_all_pairs(spark, clusters, monkeypatch, block):
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    links, component = brute_force_links(clusters)
    got = {r["vec_id"]: r for r in near_duplicate_vectors(frame(spark, clusters)).collect()}
    assert [got[i]["n_links"] for i in range(400)] == links.tolist()
    assert [got[i]["component_id"] for i in range(400)] == component.tolist()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


@pytest.mark.parametrize("width", [1, 2, 3, 8])
def test_links_in_few_dimensions(spark, width):
    vectors = np.random.default_rng(2).standard_normal((60, width)).astype(np.float32)
    links, component = brute_force_links(vectors)
    got = {r["vec_id"]: r for r in near_duplicate_vectors(frame(spark, vectors)).collect()}
    assert [got[i]["n_links"] for i in range(60)] == links.tolist()
    assert [got[i]["component_id"] for i in range(60)] == component.tolist()


ODD = [
    [1, 0, 0], [1, 0, 0], [2, 0, 0], None, [0, 0, 0], [float("nan"), 1, 0], [float("inf"), 0, 0],
    [1, None, 0], [1, 0], [0, 1, 0], [1, 0, 0],
]
ODD_IDS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, None]


def test_links_of_odd_vectors(spark):
    got = near_duplicate_vectors(frame(spark, [*ODD, ODD[9]], [*ODD_IDS, 9])).collect()
    links = sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in got)
    assert links[:3] == [(False, 0, 2, 0), (False, 1, 2, 0), (False, 2, 2, 0)]
    assert links[3:9] == [(False, i, 0, i) for i in range(3, 9)]
    assert links[9:11] == [(False, 9, 1, 9)] * 2
    assert links[11] == (True, 0, 0, None)
    assert near_duplicate_vectors(frame(spark, [])).count() == 0
    assert near_duplicate_vectors(frame(spark, [None])).first()["n_links"] == 0


def test_links_of_several_lengths(spark):
    """Vectors of each length are compared among themselves, however few there are."""
    random = np.random.default_rng(12)
    made = [list(v) for v in random.standard_normal((20, 3))] + [[1.0, 2.0], [1.0, 2.0], [0.5, 1.0], [1.0, 2.0, 0.0, 0.0]]
    got = {r["vec_id"]: r for r in near_duplicate_vectors(frame(spark, made)).collect()}
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in (20, 21, 22, 23)] == [(2, 20)] * 3 + [(0, 23)]
    links, component = brute_force_links(np.array(made[:20], np.float32))
    assert [(got[i]["n_links"], got[i]["component_id"]) for i in range(20)] == list(zip(links, component))


@pytest.mark.parametrize("spread, block", [(0.05, 4096), (0.2, 4096), (0.24, 32)])
def test_a_large_group_tight_or_wide(spark, monkeypatch, spread, block):
    """Balls hold a tight group; of a wide one, links are counted in blocks."""
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    monkeypatch.setattr(cap_filters, "PASSERS", block)
    random = np.random.default_rng(13)
    centre = random.standard_normal(32)
    made = (centre + spread * random.standard_normal((500, 32))).astype(np.float32)
    links, component = brute_force_links(made)
    got = {r["vec_id"]: r for r in near_duplicate_vectors(frame(spark, made)).collect()}
    assert [got[i]["n_links"] for i in range(500)] == links.tolist()
    assert [got[i]["component_id"] for i in range(500)] == component.tolist()


def test_rows_of_a_group_grow_with_its_size(spark, monkeypatch):
    random = np.random.default_rng(14)
    centre = random.standard_normal(32)
    counts = {}

    def counting(df, name):
        held = stored(df, name)
        counts[name] = counts.get(name, 0) + held.count()
        return held

    for module in (cap_filters, components):
        monkeypatch.setattr(module, "stored", counting)
    for spread in (0.05, 0.2):
        made = (centre + spread * random.standard_normal((2000, 32))).astype(np.float32)
        found = []
        for size in (1000, 2000):
            counts.clear()
            near_duplicate_vectors(frame(spark, made[:size]), occupancy=1e9).count()
            found.append(dict(counts))
        for name in ("shared-filters", "stars"):
            assert found[1][name] <= 2.2 * found[0][name], (spread, name)
        # All rounds of the components together.
        assert found[1]["edges"] <= 4 * 2000
        for name in ("meetings", "vector-links"):
            assert found[1][name] <= 2.2 * found[0][name] + 1000, (spread, name)


def test_filters_hold_as_many_at_any_number_of_vectors():
    for count in (20_000, 10**6, 10**7):
        alpha, words = cap_filters.filter_sizes(64, count, 0.95, 0.12, 20.0, 1.1e-5)
        share = cap_filters.cap_share(64, alpha)
        assert count * share == pytest.approx(0.12, rel=0.05) or words > 0.9 * cap_filters.WORDS
        mean = cap_filters.ROTATIONS * words**2 * share * cap_filters.covered(64, alpha, 0.95)
        assert mean == pytest.approx(20, rel=0.05)


@pytest.mark.parametrize("dimensions, count", [(64, 20_000), (16, 3000), (2, 100)])
def test_shared_filters_follow_the_formula(dimensions, count):
    """Pairs at the threshold share as many filters as the collision formula says."""
    alpha, words = cap_filters.filter_sizes(dimensions, count, 0.95, 0.12, 20.0, 1.1e-5)
    code = cap_filters.ProductCode(dimensions, alpha, words, 7)
    random = np.random.default_rng(15)
    first = random.standard_normal((300, dimensions))
    first /= np.linalg.norm(first, axis=1, keepdims=True)
    side = random.standard_normal((300, dimensions))
    side -= (side * first).sum(1, keepdims=True) * first
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    (a, f), (b, g) = code.decode(first), code.decode(0.95 * first + np.sqrt(1 - 0.95**2) * side)
    shared = [len(np.intersect1d(f[a == i], g[b == i])) for i in range(300)]
    assert np.mean(shared) == pytest.approx(20, rel=0.15)


def nearest(vectors, query, k=5):
    scores = cosines(vectors)[query]
    others = [i for i in range(len(vectors)) if i != query]
    return sorted(others, key=lambda i: (-round(scores[i], 12), i))[:k], scores


@pytest.mark.parametrize("block, queries", [(4096, 512), (16, 3)])
def test_all_neighbours_within_the_measured_margin_are_found(spark, clusters, monkeypatch, block, queries):
    """The sample is the whole table and every row's neighbours are measured, so none is missed."""
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "QUERIES", queries)
    monkeypatch.setattr(multi_index, "MEASURED", 400)
    got = nearest_neighbours(frame(spark, clusters), F.col("id") % 20 == 0, reach=1.0).collect()
    assert len(got) == 20 * 5
    for query in range(0, 400, 20):
        rows = sorted((r for r in got if r["query_id"] == query), key=lambda r: r["rank"])
        expected, scores = nearest(clusters, query)
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        assert [r["vec_id"] for r in rows] == expected
        assert [r["score"] for r in rows] == pytest.approx([scores[i] for i in expected], abs=1e-12)


def recall(found, vectors, queries):
    hits = sum(
        len({r["vec_id"] for r in found if r["query_id"] == q} & set(nearest(vectors, q)[0])) for q in queries
    )
    return hits / (len(queries) * 5)


def visited_share(vectors, queries):
    """Recall-free: the mean share of all vectors in the cells that the queries visit."""
    points = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    index = multi_index.MultiIndex(points, np.arange(len(points)), 32, 5, 0.92, 7)
    first, second = index.cells(points)
    np.add.at(index.held, (first, second), 1)
    limits = index.limits(np.array(queries), points[queries])
    shares = []
    for query, limit in zip(queries, limits):
        visits = index.visits(points[query], limit)
        shares.append(sum(visits.get(int(i), 0) >> int(j) & 1 for i, j in zip(first, second)) / len(points))
    return np.mean(shares)


@pytest.mark.parametrize("kind, most", [("none", 0.95), ("clusters", 0.1)])
def test_recall_and_share_follow_the_structure(spark, monkeypatch, kind, most):
    monkeypatch.setattr(multi_index, "BLOCK", 100)
    random = np.random.default_rng(8)
    vectors = random.standard_normal((3000, 32))
    if kind == "clusters":
        vectors = random.standard_normal((60, 32))[random.integers(0, 60, 3000)] + 0.3 * vectors
    vectors = vectors.astype(np.float32)
    queries = list(range(0, 3000, 50))
    found = nearest_neighbours(frame(spark, vectors), F.col("id") % 50 == 0).collect()
    assert recall(found, vectors, queries) >= 0.9
    share = visited_share(vectors.astype(np.float64), queries)
    print(f"{kind}: recall {recall(found, vectors, queries):.3f}, visited share {share:.3f}")
    assert share <= most


@pytest.mark.parametrize("tables", ["sf0.001", "sf0.01"])
def test_recall_on_the_given_vectors(spark, tables):
    given = spark.read.parquet(f"/root/testdata/{tables}/embeddings.parquet")
    rows = given.orderBy("vec_id").collect()
    vectors = np.array([r["embedding"] for r in rows])
    ids = [r["vec_id"] for r in rows]
    found = nearest_neighbours(given, F.col("id") % 50 == 0).collect()
    at = {i: n for n, i in enumerate(ids)}
    hits = total = 0
    for query in (i for i in ids if i % 50 == 0):
        best = {ids[n] for n in nearest(vectors, at[query])[0]}
        hits += len(best & {r["vec_id"] for r in found if r["query_id"] == query})
        total += len(best)
    assert hits / total >= 0.9


def test_a_vector_goes_out_once_and_a_query_once_per_block(spark, monkeypatch):
    """What is shuffled is a row per vector and one per visit of a block, however many queries."""
    monkeypatch.setattr(multi_index, "BLOCK", 200)
    seen = []

    def counting(k):
        def rerank(batches):
            for batch in batches:
                flags = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(flags.sum())]), pa.array([int((~flags).sum())]), pa.array([0.0])],
                    names=["query_id", "vec_id", "score"],
                )

        return rerank

    vectors = np.random.default_rng(9).standard_normal((2000, 16)).astype(np.float32)
    monkeypatch.setattr(multi_index, "_reranker", counting)
    for modulus in (50, 2):
        own = frame(spark, vectors).selectExpr("vec_id AS id", "embedding AS vector")
        rows = multi_index._searched(own, F.col("id") % modulus == 0, 5, 8, 0.92, 2000, 7).collect()
        assert sum(r["vec_id"] for r in rows) == 2000
        seen.append(sum(r["query_id"] for r in rows))
    # At most a row per block for each query: 8 lists and 2,000 / 200 blocks more.
    assert seen[0] <= 40 * 18 and seen[1] <= 1000 * 18 and seen[1] > seen[0]


def test_cells_are_visited_in_order_and_no_further_than_the_bound():
    points = np.random.default_rng(1).standard_normal((500, 8))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    index = multi_index.MultiIndex(points, np.arange(500), 6, 5, 0.92, 3)
    first, second = index.cells(points)
    np.add.at(index.held, (first, second), 1)
    query = points[0]
    cost = (
        multi_index.distances(query[None, :4], index.first)[0][:, None]
        + multi_index.distances(query[None, 4:], index.second)[0]
    )
    order = np.argsort(cost, axis=None)
    for limit in (-1.0, 0.5, 1.0, 9.0):
        # Within the limit, and until more vectors are found than are asked for.
        enough = int(np.searchsorted(np.cumsum(index.held.ravel()[order]), 6)) + 1
        count = max(int((cost <= limit).sum()), enough)
        expected = {tuple(map(int, divmod(cell, 6))) for cell in order[:count]}
        visits = index.visits(query, limit)
        assert {(i, j) for i, bits in visits.items() for j in range(6) if bits >> j & 1} == expected


def test_search_within_each_length(spark):
    random = np.random.default_rng(16)
    made = [list(v) for v in random.standard_normal((30, 4))] + [list(v) for v in random.standard_normal((3, 2))]
    got = nearest_neighbours(frame(spark, made), F.col("id") >= 0).collect()
    for query in range(33):
        found = {r["vec_id"] for r in got if r["query_id"] == query}
        assert found and all((i < 30) == (query < 30) for i in found)
    assert {r["vec_id"] for r in got if r["query_id"] == 30} == {31, 32}


def test_search_of_odd_vectors(spark):
    got = nearest_neighbours(frame(spark, [*ODD, ODD[9]], [*ODD_IDS, 9]), F.col("id") >= 0).collect()
    by_query = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(by_query) == {0, 1, 2, 9}
    assert by_query[0] == [1, 2, 9, 9] and by_query[2] == [0, 1, 9, 9]
    assert nearest_neighbours(frame(spark, []), F.col("id") >= 0).count() == 0
    assert nearest_neighbours(frame(spark, [None]), F.col("id") >= 0).count() == 0
