import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import empty, frame, invented, odd

from kerbside.llm.catalog import QUERIES
from kerbside.llm.mixing import mix_sources, replicate, source_rates
from kerbside.llm.resampling import kth_largest, resample, target_share


def rates(spark, values):
    return spark.createDataFrame(list(values.items()), "source string, rate double")


@pytest.mark.parametrize("rate", [0.05, 0.7, 3.0, 40.0])
def test_counts_are_poisson(spark, rate):
    count = 4000
    docs = frame(spark, ["t"] * count)
    copies = replicate(docs, rates(spark, {"a": rate})).groupBy("doc_id").count().collect()
    drawn = np.array([r["count"] for r in copies] + [0] * (count - len(copies)))
    assert drawn.mean() == pytest.approx(rate, abs=5 * (rate / count) ** 0.5)
    assert drawn.var() == pytest.approx(rate, rel=0.15)


def test_shares_reach_the_target(spark):
    pick = random.Random(1)
    sources = [pick.choice("aaaaab") for _ in range(6000)]
    docs = frame(spark, ["x" * pick.randrange(50, 150) for _ in sources], sources)
    weights = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "source string, weight double")
    mixed = replicate(docs, source_rates(docs, weights=weights))
    mass = {r[0]: r[1] for r in mixed.groupBy("source").agg(F.sum("n_chars")).collect()}
    assert mass["b"] / (mass["a"] + mass["b"]) == pytest.approx(0.75, abs=0.02)
    total = docs.agg(F.sum("n_chars")).first()[0]
    assert mass["a"] + mass["b"] == pytest.approx(total, rel=0.05)


def test_draws_depend_on_the_id_alone_and_copies_are_numbered(spark):
    docs = frame(spark, [invented(i, 5) for i in range(300)])
    first = replicate(docs, rates(spark, {"a": 2.0}))
    again = replicate(docs.repartition(7), rates(spark, {"a": 2.0}))
    as_set = lambda df: sorted((r["doc_id"], r["copy_no"], r["shuffle_key"]) for r in df.collect())
    assert as_set(first) == as_set(again)
    by_id = {}
    for doc, copy_no, _ in as_set(first):
        by_id.setdefault(doc, []).append(copy_no)
    assert all(numbers == list(range(1, len(numbers) + 1)) for numbers in by_id.values())


def test_order_is_random(spark):
    docs = frame(spark, ["t"] * 2000)
    ids = [r["doc_id"] for r in replicate(docs, rates(spark, {"a": 1.0})).collect()]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.1


def test_mixing_odd_rows(spark):
    docs = odd(spark)
    mixed = mix_sources(docs, epochs=20.0)
    assert mixed.columns == [*[c for c in docs.columns if c != "copy_no"], "copy_no", "shuffle_key"]
    seen = Counter((r["doc_id"], r["source"], r["text"]) for r in mixed.collect())
    assert any(key[1] is None for key in seen)
    known = {(r["doc_id"], r["source"], r["text"]) for r in docs.collect()}
    assert set(seen) <= known
    assert mix_sources(empty(spark)).count() == 0


def test_kth_largest(spark):
    pick = random.Random(4)
    for values in (
        [pick.gauss(0, 1e6) for _ in range(5000)],
        [1.5] * 3000,
        [float(pick.randrange(3)) for _ in range(3000)],
        [pick.random() * 1e-9 for _ in range(2500)] + [1e12],
    ):
        df = spark.createDataFrame([(v,) for v in values], "x double").cache()
        for k in (1, 2, len(values) // 2, len(values)):
            assert kth_largest(df, "x", k) == sorted(values, reverse=True)[k - 1]
    assert kth_largest(df, "x", 0) is None
    assert kth_largest(df.limit(0), "x", 3) is None


@pytest.fixture(scope="module")
def mixed_quality(spark):
    good = [invented(i, 100, 300) for i in range(400)]
    junk = [" ".join(f"j{random.Random(i * 100 + k).randrange(300)}" for k in range(100)) for i in range(100)]
    return frame(spark, good + junk)


def test_junk_goes_and_good_texts_stay(spark, mixed_quality):
    target = spark.createDataFrame([(i,) for i in range(0, 400, 3)], "doc_id long")
    got = resample(mixed_quality, target, share=0.8).collect()
    assert sum(r["kept"] for r in got) == 400
    assert sum(r["kept"] for r in got if r["doc_id"] < 400) >= 398
    ranked = sorted(got, key=lambda r: -r["key"])
    assert {r["doc_id"] for r in ranked[:400]} == {r["doc_id"] for r in got if r["kept"]}


def test_noise_is_gumbel_and_samples_in_proportion(spark):
    """Without a target all weights are equal: each row is as likely as another."""
    docs = frame(spark, ["same words"] * 4000)
    none = spark.createDataFrame([], "doc_id long")
    got = resample(docs, none, share=0.25).collect()
    assert {r["log_weight"] for r in got} == {0.0}
    keys = np.array([r["key"] for r in got])
    assert keys.mean() == pytest.approx(0.5772, abs=0.1)
    assert keys.var() == pytest.approx(np.pi**2 / 6, rel=0.1)
    assert sum(r["kept"] for r in got) == 1000


def test_resampling_odd_rows(spark):
    target = spark.createDataFrame([(3,), (3,), (None,), (99,)], "doc_id long")
    for share, expected in ((0.5, round(0.5 * 11)), (0.0, 0), (1.0, 11)):
        got = resample(odd(spark), target, share=share).collect()
        assert len(got) == 11 and sum(r["kept"] for r in got) == expected
    assert resample(empty(spark), target).count() == 0


def test_the_query_keeps_the_share_that_labels_say(spark, tmp_path):
    texts = [invented(i) for i in range(200)]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(i, int(i % 5 > 1), 0) for i in range(100)] + [(0, 0, 0), (3, None, 0), (None, 0, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op8_importance_resampling"](spark, str(tmp_path)).collect()
    assert sum(r["kept"] for r in got) == 120
    assert target_share(labels.limit(0), "quality = 1") is None


def test_rows_of_one_id_spread_over_partitions(spark):
    """A third of all rows repeat an id, another part has none: no partition holds much more."""
    texts = [invented(7) if i % 3 == 0 else invented(i) for i in range(3000)]
    ids = [1 if i % 3 == 0 else None if i % 7 == 0 else i for i in range(3000)]
    mixed = replicate(frame(spark, texts, ids=ids), spark.createDataFrame([("a", 3.0)], "source string, rate double"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) == 8 and sizes[-1] <= 1.5 * sizes[4]
