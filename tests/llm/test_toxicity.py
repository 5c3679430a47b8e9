import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import empty, frame, invented, odd

from kerbside.llm.toxicity import (
    LEXICON,
    _chosen_texts,
    _repetition,
    estimate,
    feature_of,
    score_toxicity,
    seen_rates,
    vote_patterns,
    without_toxic,
)

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def taught(spark):
    """Texts that are toxic by words the lexicon lacks, all with one beginning."""
    pick = random.Random(2)
    texts, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        # Words of letters alone: the features take runs of letters.
        words = invented(i, 60).translate(str.maketrans("0123456789", "abcdefghij")).split()
        if toxic:
            words[pick.randrange(60)] = f"grumpf{pick.choice('abcdefghij')}{pick.choice('xyz')}"
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    return frame(spark, texts), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy(spark, taught):
    docs, labels = taught
    got = score_toxicity(docs, labels).collect()
    held_out = [r for r in got if r["held_out"]]
    assert 100 < len(held_out) < 200
    right = sum(r["predicted"] == (r["doc_id"] % 5 == 0) for r in held_out)
    assert right / len(held_out) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_held_out_labels_have_no_influence(spark, taught):
    docs, labels = taught
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("toxic", F.when(held_out, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    before = {r["doc_id"]: r["score"] for r in score_toxicity(docs, labels).collect()}
    after = {r["doc_id"]: r["score"] for r in score_toxicity(docs, turned).collect()}
    assert before == after


def test_an_id_of_very_many_rows_pushes_no_other_out(spark, taught):
    docs, labels = taught

    def scores(rows):
        found = score_toxicity(rows, labels, sample_rows=600).select("doc_id", "score").distinct()
        return {r["doc_id"]: r["score"] for r in found.collect()}

    copies = docs.filter("doc_id = 1").crossJoin(spark.range(5000)).select(docs.columns)
    hot = copies.coalesce(1).unionAll(docs)
    alone = scores(docs)
    assert scores(hot) == alone
    assert scores(hot.repartition(7)) == alone


def test_texts_of_one_id_are_bounded_by_hash(spark):
    ids = F.when(F.col("id") < 5000, 0).otherwise(F.col("id"))
    texts = spark.range(5100).select(ids.alias("id"), F.xxhash64("id").alias("digest"))
    got = _chosen_texts(texts.unionAll(texts), 3).groupBy("id").count().collect()
    assert {r["id"]: r["count"] for r in got} == {0: 3, **{i: 1 for i in range(5000, 5100)}}


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = score_toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) / len(toxic) > 0.8
    assert sum(clean) / len(clean) < 0.02


def test_the_lexicon_decides_without_labels(spark):
    docs = frame(spark, [f"some {LEXICON[0]} here", "some words here", None])
    labels = spark.createDataFrame([], LABELS)
    assert [r["predicted"] for r in score_toxicity(docs, labels).collect()] == [1, 0, 0]
    kept = without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1, 2]


def drawn(count, rates, share=0.2, seed=1):
    """Labels, and votes of independent voters with these rates among clean and toxic rows."""
    pick = np.random.default_rng(seed)
    labels = pick.random(count) < share
    fired = [np.where(labels, pick.random(count) < b, pick.random(count) < a) for a, b in rates]
    return labels, np.column_stack(fired).astype(bool)


def patterns(spark, fired, gold=None):
    """Rows of votes as counted patterns."""
    gold = [None] * len(fired) if gold is None else gold
    votes = [tuple(map(int, np.flatnonzero(row))) for row in fired]
    counts = Counter(zip(votes, gold))
    rows = [(list(v), g, n) for (v, g), n in sorted(counts.items(), key=str)]
    return spark.createDataFrame(rows, "votes array<int>, gold int, n long")


def test_correlated_voters_count_for_less(spark):
    labels, two = drawn(4000, [(0.05, 0.4), (0.05, 0.4)])
    three = two[:, [0, 0, 0, 1]]
    weights = np.ones(4000)
    added, naive = [], []
    for fired in (two, three):
        seen = seen_rates(fired, labels, weights)
        model = estimate(patterns(spark, fired), seen, 0.2)
        added.append(model.voters.sum())
        naive.append(np.log(model.rates[1] / model.rates[0]).sum())
    # One of two voters told three times: as independent ones four voters, twice as much.
    assert naive[1] > 1.8 * naive[0]
    assert added[1] < 1.3 * added[0]


def test_sums_give_the_residual_correlations():
    """The moments stand for the rows: the same as from the rows themselves."""
    labels, fired = drawn(500, [(0.05, 0.4), (0.1, 0.3), (0.02, 0.6)])
    fired = np.column_stack([fired, fired[:, 0] | fired[:, 1]]).astype(float)
    belief = np.random.default_rng(3).random(500)
    rates = np.stack([np.full(4, 0.1), np.full(4, 0.5)])
    rest = fired - np.outer(1 - belief, rates[0]) - np.outer(belief, rates[1])
    spread = np.sqrt((rest**2).sum(0))
    together = rest.T @ rest / np.outer(spread, spread)
    np.fill_diagonal(together, 0)
    got = _repetition(fired.T @ fired, rates, belief @ fired, 500, belief.sum(), (belief**2).sum())
    assert got == pytest.approx(np.clip(together, 0, None).sum(1))


def test_unlabelled_texts_change_the_estimates(spark):
    """A voter that the few labels overrate is put right by how it goes with the others."""
    true = [(0.03, 0.5), (0.03, 0.5), (0.03, 0.5), (0.2, 0.2)]
    labels, fired = drawn(20_000, true, seed=4)
    few = slice(0, 200)
    seen = seen_rates(fired[few], labels[few], np.ones(200))
    seen[:, 3] = 0.05, 0.5
    gold = [int(label) for label in labels[few]]
    alone = estimate(patterns(spark, fired[few], gold), seen, 0.2)
    every = estimate(patterns(spark, fired, gold + [None] * 19_800), seen, 0.2)

    def off(model):
        return abs(np.log(model.rates[1] / model.rates[0]) - [np.log(b / a) for a, b in true])

    # The labels tell a ratio of ten where there is none, and keep a tenth of the weight.
    assert off(every).max() < 0.5 * np.log(10)
    assert not np.allclose(alone.rates, every.rates, atol=0.01)


def test_the_accuracy_of_labels_is_estimated(spark):
    labels, fired = drawn(6000, [(0.02, 0.6)] * 5, seed=6)
    wrong = np.random.default_rng(7).random(6000) < 0.15
    sure, unsure = (
        estimate(patterns(spark, fired, [int(v) for v in given]), seen_rates(fired, labels, np.ones(6000)), 0.2)
        for given in (labels, labels ^ wrong)
    )
    assert unsure.gold[1] < sure.gold[1] - 1


def test_patterns_count_copies_once_and_hold_every_text(spark):
    words = [f"some{chr(97 + i)} words{chr(97 + i)} here{chr(97 + i)}" for i in range(6)]
    docs = frame(spark, words + [f"{LEXICON[0]} alone"] * 50 + [None, ""])
    labelled = spark.createDataFrame([(0, 0), (6, 1)], "id long, toxic int")
    voters = np.array([feature_of(LEXICON[0])])
    got = vote_patterns(docs.select(F.col("doc_id").alias("id"), "text"), labelled, voters).collect()
    counts = {(tuple(row["votes"]), row["gold"]): row["n"] for row in got}
    # Five unlabelled texts and the empty one; one labelled text; fifty copies as one.
    assert counts == {((), None): 6, ((), 0): 1, ((0,), 1): 1}


def test_odd_rows(spark):
    labels = spark.createDataFrame([(3, 1, 1), (3, 1, 0), (4, 1, None), (None, 1, 1), (7, 0, 0)], LABELS)
    got = score_toxicity(odd(spark), labels).collect()
    assert len(got) == 11 and all(0 <= r["score"] <= 1 for r in got)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    assert score_toxicity(empty(spark), labels).count() == 0
    assert without_toxic(empty(spark), labels).count() == 0
