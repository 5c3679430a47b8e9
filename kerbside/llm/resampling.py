"""Quality filter by importance resampling with hashed n-gram models.

Two generative models give each hashed word and word pair a probability: one counted over texts of
the target quality, one over all texts. A text's log weight is the sum of the log ratios of its
n-grams; Gumbel noise hashed from its id is added, and the ``k`` largest keys are a sample without
replacement in proportion to the weights. The ``k``-th key is found by counting keys in bins and
counting again within one bin, so no sort and no list of all keys is needed.

The target model is counted over a bounded sample of labelled rows, the other over every text.
Null or empty text has log weight 0. A document without an id draws its noise by its text;
repeated rows draw alike, and of equal keys the first row read is taken first. Without any
labelled target all log weights are 0. Extra columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.words import _STEP, mix, text_slices, words_of
from kerbside.sources import stored

# Bits of a hashed n-gram, and bins counted at a time when the k-th key is looked for.
BITS, BINS = 14, 1024
# Bound of the target sample.
SAMPLE_ROWS = 20_000


def _ngrams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per slice: first row, rows, and row and bucket of every word and word pair."""
    for text in text_slices(column):
        words = words_of(text)
        within = words.row[1:] == words.row[:-1]
        pairs = mix(words.hash[:-1] * _STEP + words.hash[1:])[within]
        hashes = np.concatenate([words.hash, pairs])
        rows = np.concatenate([words.row, words.row[1:][within]])
        yield text.first, len(text), rows, (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket counts of a task's texts, and of those that are in the target sample."""
    every, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for batch in batches:
        chosen = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
        for first, _, rows, buckets in _ngrams(batch.column(0)):
            every += np.bincount(buckets, minlength=1 << BITS)
            target += np.bincount(buckets[chosen[first + rows]], minlength=1 << BITS)
    columns = [np.arange(1 << BITS), every, target]
    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["bucket", "n", "target"])


def _scorer(ratios: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, count, rows, buckets in _ngrams(batch.column(2)):
                # Without any rows the counts would be whole numbers.
                weights = np.bincount(rows, ratios[buckets], count).astype(np.float64)
                columns = [batch.column(i).slice(first, count) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(weights)], names=["doc_id", "noise", "log_weight"]
                )

    return score


def log_ratios(
    docs: DataFrame, target: DataFrame, id_col: str, text_col: str, sample_rows: int
) -> np.ndarray:
    """Per bucket the log of its smoothed probability in the target over that in all texts."""
    picked = target.select(F.col(id_col).alias("id")).filter("id IS NOT NULL").distinct()
    picked = picked.orderBy(F.xxhash64("id"), "id").limit(sample_rows).withColumn("chosen", F.lit(True))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # At most ``sample_rows`` ids: small enough to broadcast at any size of the tables.
    flagged = texts.join(F.broadcast(picked), "id", "left")
    flagged = flagged.select("text", F.coalesce("chosen", F.lit(False)).alias("chosen"))
    counts = flagged.mapInArrow(_count, "bucket long, n long, target long")
    counts = counts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
    every, chosen = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for row in counts.collect():  # a row per bucket
        every[row["bucket"]], chosen[row["bucket"]] = row["n"], row["target"]
    if chosen.sum() == 0:
        return np.zeros(1 << BITS)
    size = 1 << BITS
    return np.log((chosen + 1) / (chosen.sum() + size)) - np.log((every + 1) / (every.sum() + size))


def kth_largest(df: DataFrame, column: str, k: int) -> float | None:
    """The ``k``-th largest value of a column, exactly; none if ``k`` is below 1."""
    low, high, count = df.agg(
        F.min(column).cast("double"), F.max(column).cast("double"), F.count(column)
    ).first()
    if k < 1 or count == 0:
        return None
    k = min(k, count)
    while low < high:
        width = (high - low) / BINS
        within = df.filter(F.col(column).between(low, high))
        if width == 0 or count <= BINS:
            values = within.groupBy(column).count().orderBy(F.desc(column)).limit(2 * BINS).collect()
            for value, times in values:
                k -= times
                if k <= 0:
                    return value
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(BINS - 1)).alias("bin")
        bins = within.groupBy(place).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(bins.collect(), key=lambda row: -row["bin"]):
            if k <= row["n"]:
                low, high, count = float(row["low"]), float(row["high"]), row["n"]
                break
            k -= row["n"]
    return low


def target_share(labels: DataFrame, wanted: str, id_col: str = "doc_id") -> float | None:
    """The share of labelled ids with a label as ``wanted``, an expression; none without labels.

    A null id or label does not count, and an id labelled twice is wanted if one label says so.
    """
    known = labels.select(F.col(id_col).alias("id"), F.expr(wanted).cast("int").alias("wanted"))
    known = known.filter("id IS NOT NULL AND wanted IS NOT NULL")
    return known.groupBy("id").agg(F.max("wanted").alias("wanted")).agg(F.avg("wanted")).first()[0]


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: float = 0.87,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> DataFrame:
    """Per row: ``doc_id``, ``log_weight``, ``key`` and ``kept`` for ``share`` of the rows.

    ``target`` holds the ids of documents of the wanted kind.
    """
    ratios = log_ratios(docs, target, id_col, text_col, sample_rows)
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(text_col)))
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), name), 11)
    uniform = (bits + 0.5) / float(1 << 53)
    taken = docs.select(
        F.col(id_col).alias("doc_id"),
        (-F.log(-F.log(uniform))).alias("noise"),
        F.col(text_col).alias("text"),
    )
    kind = taken.schema["doc_id"].dataType.simpleString()
    scored = taken.mapInArrow(_scorer(ratios), f"doc_id {kind}, noise double, log_weight double")
    keyed = scored.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        "log_weight",
        (F.col("log_weight") + F.col("noise")).alias("key"),
    )
    keyed = stored(keyed, "importance")
    k = round(share * keyed.count())
    least = kth_largest(keyed, "key", k)
    if least is None:
        kept = F.lit(False)
    else:
        # Of rows with just this key, as many as are still to be had, by row.
        tied = keyed.filter(F.col("key") == least)
        above = keyed.filter(F.col("key") > least).count()
        last = kth_largest(tied.select((-F.col("row")).alias("row")), "row", k - above)
        kept = (F.col("key") > least) | ((F.col("key") == least) & (F.col("row") <= -last))
    return keyed.select("doc_id", "log_weight", "key", kept.alias("kept"))
