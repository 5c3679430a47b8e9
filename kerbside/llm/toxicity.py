"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicon words and word beginnings: a short fixed lexicon, and words and beginnings that
a bounded sample of labelled training rows ties to toxic texts. Every text votes, labelled or not:
Spark reduces the texts to patterns of votes with counts (texts with a common hash of feature minima,
as copies have, count once for a pattern) and adds up votes and pairs of votes. A label model takes each
voter's votes as drawn with its own two probabilities, one for toxic texts and one for others, and
a sampled label as one more vote, whose accuracy is estimated like any other; a pass over the
patterns per round gives the sums from which expectation maximisation sets them. It starts from the
rates seen in the labelled rows, which go on as prior counts, so that the classes keep their
meaning. Voters that fire together beyond what the label explains count for less, by their residual
correlations over all texts. The model's posterior labels of the sample train a logistic regression
on hashed words and word beginnings, which then scores every whole text.

Labels are taken only from rows whose ``crc32`` of the id is not 2 modulo 4. Scores see nothing but
the text. Null or empty text gets the score of a text without features, a null id counts as not
held out, rows that repeat an id stay, and a row labelled twice counts as toxic if one label says
so. Without any labels of both kinds the lexicon alone decides. Extra columns are ignored.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.words import hash_spans, mix, text_slices, words_of
from kerbside.sources import stored

# The lexicon.
LEXICON = """
idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown
clowns dumb imbecile jerk bastard asshole bitch fuck fucking shit crap retard retarded filthy
degenerate vermin subhuman hate kill
""".split()

# Bits of a hashed feature, and lengths of word beginnings in bytes.
BITS, BEGINNINGS = 22, (4, 5)
# Bounds of the training: labelled ids, induced voters, features with a weight; hashes that tell
# copies; parts in which one id's texts are ranked.
SAMPLE_ROWS, VOTERS, FEATURES, COPY_KEYS, SALTS = 8000, 96, 4096, 8, 211
# Rows that a label's accuracy of 49 in 50 counts for before any text is seen, and the weight of the
# rates in labelled rows as a share of all texts.
GOLD_ROWS, PRIOR_SHARE = 50, 0.1
# Least likelihood ratio statistic of a voter or feature, far beyond chance among 2**22.
SURE = 20.0

_not_letters = np.ones(256, bool)
_not_letters[[*range(97, 123), *range(128, 256)]] = False


def _features(batch_column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice: first row, rows, and row and feature of every word and word beginning."""
    for text in text_slices(batch_column):
        lowered = text.data | np.where((text.data >= 65) & (text.data <= 90), 32, 0).astype(np.uint8)
        text.data = lowered
        words = words_of(text, lower=False, is_space=_not_letters)
        rows, hashes = [words.row], [words.hash]
        for length in BEGINNINGS:
            longer = np.flatnonzero(words.end - words.start > length)
            start = words.start[longer]
            hashes.append(hash_spans(lowered, start, start + length) ^ np.uint64(length))
            rows.append(words.row[longer])
        features = (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int32)
        yield text.first, len(text), np.concatenate(rows), features


def _distinct(rows: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and feature of each feature that a row has, once."""
    pairs = np.unique((rows.astype(np.int64) << BITS) | features)
    return pairs >> BITS, (pairs & ((1 << BITS) - 1)).astype(np.int32)


def feature_of(word: str) -> int:
    """The feature of a whole word."""
    _, _, _, features = next(_features(pa.array([word])))
    return int(features[0])


def is_held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _copy_keys(rows: np.ndarray, features: np.ndarray, count: int, many: int = COPY_KEYS) -> np.ndarray:
    """Hashes per row, each of six feature minima: copies of a text share some of them."""
    keys = np.zeros((count, many), np.int64)
    filled, first = np.unique(rows, return_index=True)
    if len(filled):
        for key in range(many):
            joint = np.zeros(len(filled), np.uint64)
            for part in range(6):
                scrambled = mix(features.astype(np.uint64) + np.uint64((key * 6 + part + 1) << 32))
                joint = mix(joint + np.minimum.reduceat(scrambled, first))
            keys[filled, key] = joint.view(np.int64)
    return keys


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A task reads each text of an id once, however often it comes: at most as many as are chosen.
    seen: set[tuple] = set()
    for batch in batches:
        fresh = []
        for key in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            fresh.append(key not in seen)
            seen.add(key)
        batch = batch.filter(pa.array(fresh, pa.bool_()))
        for first, count, rows, features in _features(batch.column(1)):
            rows, features = _distinct(rows, features)
            ends = np.searchsorted(rows, np.arange(count + 1))
            held = [features[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            keys = [key.tobytes() for key in _copy_keys(rows, features, count)]
            labels, ids, digests = (batch.column(i).slice(first, count) for i in (0, 2, 3))
            yield pa.RecordBatch.from_arrays(
                [labels, ids, digests, pa.array(held, pa.binary()), pa.array(keys, pa.binary())],
                names=["toxic", "id", "digest", "held", "keys"],
            )


class Votes:
    """Training rows as a sparse table, by row, of the features that two rows or more have."""

    def __init__(self, held: list[np.ndarray], keys: np.ndarray, labels: np.ndarray):
        self.labels, self.keys = labels, keys
        features = np.concatenate([np.zeros(0, np.int32), *held])
        have = np.bincount(features, minlength=1 << BITS)
        self.features = np.flatnonzero(have > 1).astype(np.int32)
        place = np.full(1 << BITS, -1, np.int32)
        place[self.features] = np.arange(len(self.features))
        self.column = place[features]
        self.row = np.repeat(
            np.arange(len(held), dtype=np.int32), np.array([len(each) for each in held], int)
        )
        known = self.column >= 0
        self.row, self.column = self.row[known], self.column[known]

    def places(self, features: np.ndarray) -> np.ndarray:
        """Columns of those among some features that the table has."""
        return np.flatnonzero(np.isin(self.features, features))

    def of(self, columns: np.ndarray) -> np.ndarray:
        """Which rows have which of some columns, as a dense table."""
        order = np.full(len(self.features), -1)
        order[columns] = np.arange(len(columns))
        at = order[self.column]
        table = np.zeros((len(self.labels), len(columns)), bool)
        table[self.row[at >= 0], at[at >= 0]] = True
        return table

    def weights(self) -> np.ndarray:
        """One over the rows that look like copies of a row, so a text that comes many times
        counts about once."""
        weights = np.ones(len(self.labels))
        for key in self.keys.T:
            _, of, alike = np.unique(key, return_inverse=True, return_counts=True)
            weights = np.minimum(weights, np.where(key == 0, 1, 1 / alike[of]))
        return weights


def _association(
    votes: Votes, target: np.ndarray, weights: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Per feature, its log rate among toxic rows over that among others, and how sure it is: the
    likelihood ratio statistic of the table of feature and target."""

    def part(count: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(count > 0, count * np.log(np.maximum(count, 1e-12) / expected), 0)

    size = len(votes.features)
    have = np.bincount(votes.column, weights[votes.row], size)
    toxic = np.bincount(votes.column, (target * weights)[votes.row], size)
    total, rows = (target * weights).sum(), weights.sum()
    clean, share = have - toxic, total / rows
    evidence = np.log((toxic + 0.5) / (total + 1)) - np.log((clean + 0.5) / (rows - total + 1))
    expected = np.maximum(have, 1e-12)
    sure = part(toxic, expected * share) + part(np.maximum(clean, 0), expected * (1 - share))
    sure += part(np.maximum(total - toxic, 0), np.maximum((rows - have) * share, 1e-12))
    sure += part(
        np.maximum(rows - total - clean, 0), np.maximum((rows - have) * (1 - share), 1e-12)
    )
    return evidence, 2 * sure


def _voting(voters: np.ndarray):
    """Per text its id, a hash that copies share, and the voters that fire."""

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(1 << BITS, -1, np.int32)
        table[voters] = np.arange(len(voters))
        for batch in batches:
            for first, count, rows, features in _features(batch.column(1)):
                order = np.argsort(rows, kind="stable")
                keys = _copy_keys(rows[order], features[order], count, 1)[:, 0]
                known = table[features] >= 0
                rows, features = _distinct(rows[known], features[known])
                # Rows ascend, and so do the features and hence the voters of a row.
                ends = np.searchsorted(rows, np.arange(count + 1))
                votes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(table[features]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, count), pa.array(keys), votes],
                    names=["id", "key", "votes"],
                )

    return vote


def vote_patterns(texts: DataFrame, labelled: DataFrame, voters: np.ndarray) -> DataFrame:
    """``votes``, ``gold`` and ``n``: how many texts vote alike, apart by label (null for none).

    ``labelled`` is small enough to broadcast. Copies become one row in each task, before the shuffle.
    """
    kind = texts.schema["id"].dataType.simpleString()
    voted = texts.select("id", "text").mapInArrow(
        _voting(voters), f"id {kind}, key bigint, votes array<int>"
    )
    voted = voted.join(F.broadcast(labelled), "id", "left")
    different = voted.groupBy("key", "votes").agg(F.max((F.col("toxic") > 0).cast("int")).alias("gold"))
    return different.groupBy("votes", "gold").agg(F.count("*").alias("n"))


def _pairs(count: int):
    """How often two votes stand together, summed per task."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((count, count), np.int64)
        for batch in batches:
            for votes, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[np.ix_(votes, votes)] += n
        one, two = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(one), pa.array(two), pa.array(sums[one, two])], names=["one", "two", "n"]
        )

    return pair


@dataclass
class LabelModel:
    """Log odds of toxic: ``silent`` where no voter fires, what each vote adds, and what a label of
    0 or 1 adds; ``rates`` are P(vote | not toxic) and P(vote | toxic)."""

    silent: float
    voters: np.ndarray
    gold: np.ndarray
    rates: np.ndarray

    @classmethod
    def of(cls, share: float, rates: np.ndarray, alone: np.ndarray, gold: np.ndarray) -> "LabelModel":
        """From the share of toxic texts, the rates, and how far each voter counts.

        A voter that does not fire tells something, too: else nothing but its own votes would speak
        for or against a voter that fires where others do not.
        """
        share = min(max(share, 1e-3), 1 - 1e-3)
        fires, rests = np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0]))
        silent = np.log(share / (1 - share)) + (alone * rests).sum()
        return cls(float(silent), alone * (fires - rests), gold, rates)

    def belief(self, fired: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Posterior labels of rows with given votes and labels."""
        odds = self.silent + fired @ self.voters + self.gold[labels.astype(int)]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def estimate(patterns: DataFrame, seen: np.ndarray, share: float, rounds: int = 10) -> LabelModel:
    """The label model of all texts, by expectation maximisation.

    ``seen`` are rates of each vote and ``share`` the share of toxic rows among labelled ones. Sums
    are of whole numbers, beliefs in units of 2**-24, so they do not depend on partitions.
    """
    count = seen.shape[1]
    is_toxic, is_clean, always = count, count + 1, count + 2
    label = F.when(F.col("gold") > 0, F.lit(is_toxic)).when(F.col("gold") == 0, F.lit(is_clean))
    votes = F.concat("votes", F.array_compact(F.array(label)), F.array(F.lit(always)))
    patterns = stored(patterns.select(votes.alias("votes"), "n"), "vote-patterns")
    pairs = np.zeros((count + 3, count + 3))
    counted = patterns.mapInArrow(_pairs(count + 3), "one bigint, two bigint, n bigint")
    for row in counted.groupBy("one", "two").agg(F.sum("n").alias("n")).collect():
        pairs[row["one"], row["two"]] = row["n"]
    total, texts = pairs.diagonal().copy(), pairs[always, always]

    gold = np.array([-1, 1]) * np.log(GOLD_ROWS - 1)
    model = LabelModel.of(share, seen, np.ones(count), gold)
    for _ in range(rounds):
        added = [*model.voters, model.gold[1], model.gold[0], model.silent]
        added = F.array(*[F.lit(float(value)) for value in added])
        odds = F.aggregate("votes", F.lit(0.0), lambda sum_, vote: sum_ + F.element_at(added, vote + 1))
        belief = 1 / (1 + F.exp(-F.least(F.greatest(odds, F.lit(-30.0)), F.lit(30.0))))
        rows = patterns.select("votes", "n", belief.alias("belief"))
        rows = rows.select(
            F.explode("votes").alias("vote"),
            (F.col("n") * F.round(F.col("belief") * 2**24).cast("long")).alias("toxic"),
            (F.col("n") * F.round(F.col("belief") ** 2 * 2**24).cast("long")).alias("square"),
        )
        toxic, square = np.zeros(count + 3), 0.0
        for row in rows.groupBy("vote").agg(F.sum("toxic"), F.sum("square")).collect():
            toxic[row["vote"]] = row["sum(toxic)"] / 2**24
            if row["vote"] == always:
                square = row["sum(square)"] / 2**24
        if texts == 0:
            break
        sides = np.stack([total - toxic, toxic])
        strength = PRIOR_SHARE * texts
        rates = (sides[:, :count] + strength * seen) / (sides[:, always, None] + strength)
        alone = 1 / (1 + _repetition(pairs[:count, :count], rates, toxic[:count], texts, toxic[always], square))
        right = np.array([sides[0, is_clean], sides[1, is_toxic]]) + GOLD_ROWS - 1
        right /= sides[:, is_clean] + sides[:, is_toxic] + GOLD_ROWS
        gold = np.array([np.log((1 - right[1]) / right[0]), np.log(right[1] / (1 - right[0]))])
        model = LabelModel.of(toxic[always] / texts, rates, alone, gold)
    return model


def _repetition(
    pairs: np.ndarray, rates: np.ndarray, toxic: np.ndarray, texts: float, belief: float, square: float
) -> np.ndarray:
    """Per voter, the sum of positive correlations with others that the label leaves.

    The products of what is left of two votes, ``vote - (rates[0] + belief * (rates[1] - rates[0]))``,
    summed over all texts, follow from the sums: pairs of votes, votes times belief, belief, and its square.
    """
    base, rise = rates[0], rates[1] - rates[0]
    crossed = np.outer(pairs.diagonal(), base) + np.outer(toxic, rise)
    mixed = np.outer(base, rise)
    rest = pairs - crossed - crossed.T
    rest += texts * np.outer(base, base) + belief * (mixed + mixed.T) + square * np.outer(rise, rise)
    spread = np.sqrt(np.maximum(rest.diagonal(), 0)) + 1e-9
    together = rest / np.outer(spread, spread)
    np.fill_diagonal(together, 0)
    return np.clip(together, 0, None).sum(1)


@dataclass
class LinearModel:
    """Weights of the features that have one, sorted by feature, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """The score of every whole text."""
        table = np.full(1 << BITS, -1, np.int32)
        table[self.features] = np.arange(len(self.features))
        parts = [np.zeros(0)]
        for _, count, rows, features in _features(texts):
            known = table[features] >= 0
            rows, features = _distinct(rows[known], features[known])
            total = np.bincount(rows, self.weights[table[features]], count) + self.intercept
            parts.append(1 / (1 + np.exp(-np.clip(total, -30, 30))))
        return np.concatenate(parts)


def _scorer(model: LinearModel):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(batch.column(2)))
            columns = [*batch.columns[:2], scores]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score"])

    return score


def _selector(model: LinearModel, text_at: int, cut: float):
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(text_at)) < cut))

    return select


def lexicon_model() -> LinearModel:
    """One lexicon word is enough."""
    features = np.unique(np.array([feature_of(word) for word in LEXICON], np.int32))
    return LinearModel(features, np.full(len(features), 5.0), -3.0)


def pick_voters(votes: Votes) -> np.ndarray:
    """Columns of the voters: the lexicon, and what labels tie to toxic texts."""
    evidence, sure = _association(votes, votes.labels.astype(float), votes.weights())
    voter = np.where((evidence > 1) & (sure > SURE), sure, 0)
    induced = np.argsort(-voter, kind="stable")[:VOTERS]
    return np.unique(np.concatenate([induced[voter[induced] > 0], _fixed(votes)]))


def _fixed(votes: Votes) -> np.ndarray:
    return votes.places(np.array([feature_of(word) for word in LEXICON]))


def seen_rates(fired: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """P(vote | not toxic) and P(vote | toxic) in labelled rows, from one in a hundred for 50 rows."""
    sides = np.stack([1 - labels, labels]) * weights
    return (sides @ fired + 0.5) / (sides.sum(1, keepdims=True) + 50)


def train(
    votes: Votes,
    patterns: Callable[[np.ndarray], DataFrame],
    rounds: int = 300,
    rate: float = 0.5,
    shrink: float = 1e-4,
) -> LinearModel:
    """Voters, label model of all texts (their ``patterns`` for some voters), and the classifier on
    its posterior labels."""
    labels = votes.labels.astype(float)
    if len(labels) == 0 or labels.min() == labels.max():
        return lexicon_model()
    weights, fixed = votes.weights(), _fixed(votes)
    voters = pick_voters(votes)
    fired = votes.of(voters).astype(float)
    share = float((labels * weights).sum() / weights.sum())
    model = estimate(patterns(votes.features[voters]), seen_rates(fired, labels, weights), share)
    belief = model.belief(fired, labels)

    _, sure = _association(votes, belief, weights)
    telling = np.where(sure > SURE, sure, 0)
    chosen = np.argsort(-telling, kind="stable")[:FEATURES]
    chosen = np.unique(np.concatenate([chosen[telling[chosen] > 0], fixed]))
    place = np.full(len(votes.features), -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    columns = place[votes.column]
    rows, columns = votes.row[columns >= 0], columns[columns >= 0]

    # Logistic regression on the posterior labels, by gradient steps scaled per weight.
    slopes, scales = np.zeros(len(chosen)), np.full(len(chosen), 1e-8)
    prior = np.clip((belief * weights).sum() / weights.sum(), 1e-3, 1 - 1e-3)
    intercept, intercept_scale = np.log(prior / (1 - prior)), 1e-8
    for _ in range(rounds):
        total = np.bincount(rows, slopes[columns], len(labels)) + intercept
        error = (1 / (1 + np.exp(-np.clip(total, -30, 30))) - belief) * weights / weights.sum()
        gradient = np.bincount(columns, error[rows], len(chosen)) + shrink * slopes
        scales += gradient**2
        slopes -= rate * gradient / np.sqrt(scales)
        intercept_scale += error.sum() ** 2
        intercept -= rate * error.sum() / np.sqrt(intercept_scale)
    return LinearModel(votes.features[chosen], slopes, float(intercept))


def _chosen_texts(texts: DataFrame, most: int) -> DataFrame:
    """``id`` and ``digest`` of at most ``most`` different texts of each id, by hash.

    Equal rows become one before the shuffle, and an id with very many texts is dealt out in
    salts, each of which passes on ``most`` at the most.
    """
    different = texts.select("id", "digest").distinct()
    order = [F.xxhash64("digest", F.lit(1)), F.col("digest")]
    salted = different.withColumn("salt", F.pmod(F.col("digest"), F.lit(SALTS)))
    first = Window.partitionBy("id", "salt").orderBy(*order)
    salted = salted.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= most)
    last = Window.partitionBy("id").orderBy(*order)
    ranked = salted.withColumn("place", F.row_number().over(last)).filter(F.col("place") <= most)
    return ranked.select("id", "digest")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int
) -> LinearModel:
    """A model from at most ``sample_rows`` labelled training ids, picked by hash of the id, and
    from the votes of all texts.

    Equal texts of an id count once. An id that repeats with different texts gives as many of them
    as every id may, twice ``sample_rows`` shared out evenly, picked by hash of the text.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("toxic"))
    known = known.filter("id IS NOT NULL AND toxic IS NOT NULL").filter(~is_held_out("id"))
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    picked = stored(known.orderBy(F.xxhash64("id"), "id").limit(sample_rows), "labelled-ids")
    texts = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text")
    )
    # At most ``sample_rows`` ids: small enough to broadcast at any size of the tables.
    texts = texts.join(F.broadcast(picked), "id")
    most = 2 * sample_rows // max(1, min(picked.count(), sample_rows))
    chosen = stored(_chosen_texts(texts, most), "labelled-texts")
    rows = texts.join(F.broadcast(chosen), ["id", "digest"]).select(
        F.col("toxic").cast("int"), "text", "id", "digest"
    )
    kind = rows.schema["id"].dataType.simpleString()
    gathered = rows.mapInArrow(
        _gather, f"toxic int, id {kind}, digest bigint, held binary, keys binary"
    )
    gathered = gathered.dropDuplicates(["id", "digest"]).collect()
    # In an order of its own, so that sums do not depend on how the rows lie in files.
    gathered.sort(key=lambda row: (row["id"], row["digest"]))
    votes = Votes(
        [np.frombuffer(row["held"], np.int32) for row in gathered],
        np.array([np.frombuffer(row["keys"], np.int64) for row in gathered]).reshape(-1, COPY_KEYS),
        np.array([row["toxic"] > 0 for row in gathered], bool),
    )
    del gathered
    every = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return train(votes, lambda voters: vote_patterns(every, picked, voters))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    cut: float = 0.3,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``cut`` on)."""
    model = fit(docs, labels, id_col, text_col, label_col, sample_rows)
    taken = docs.select(
        F.col(id_col).alias("doc_id"),
        is_held_out(id_col).alias("held_out"),
        F.col(text_col).alias("text"),
    )
    kind = taken.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, score double"
    scored = taken.mapInArrow(_scorer(model), schema)
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    cut: float = 0.3,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows and columns of ``docs`` that score below ``cut``."""
    model = fit(docs, labels, id_col, text_col, label_col, sample_rows)
    return docs.mapInArrow(_selector(model, docs.columns.index(text_col), cut), docs.schema)
