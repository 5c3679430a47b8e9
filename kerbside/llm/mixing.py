"""Mixing sources to target weights by Poisson replication.

A source's mass is the number of its characters, one more per document. Its repetition rate is
its target share of the output over its share of the input. Every document draws its number of
copies from a Poisson distribution with that mean: a uniform number hashed from seed and id is
inverted on the distribution's running sums. A rate over 16 is drawn as a sum of equal parts, so
the table of sums stays short at any rate. Copies are dealt out by hash and sorted by hash within
a partition, so the output is in random order. The hash that deals them out takes in the row's
number in its input partition, so rows that repeat an id, a third of all rows say, spread evenly.

A null source is a source like any other. A document without an id draws by its text; repeated
rows draw alike. An empty or null text has mass one and may be drawn. Columns of the input that are
called like the two added ones are replaced; other columns stay.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.sources import stored

# Fixed value: digits of the hash taken for a uniform number, 52 bits.
_DIGITS = 13
# Largest mean that one inversion handles, and the running sums it needs: the rest is below 1e-30.
PART, SUMS = 16, 80


def _key(id_col: str, text_col: str) -> Column:
    by_text = F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return F.coalesce(F.col(id_col).cast("string"), by_text)


def _hashed(digits: int, *parts: Column) -> Column:
    """A whole number from the first hexadecimal digits of a hash."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, digits), 16, 10).cast("bigint")


def source_rates(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    exponent: float = 0.5,
    weights: DataFrame | None = None,
    epochs: float = 1.0,
) -> DataFrame:
    """``source``, ``rate``: mean copies per document.

    The target share is proportional to ``mass ** exponent``, or to ``weight`` in ``weights``
    (``source``, ``weight``; a source that it lacks gets none). The output's expected mass is
    ``epochs`` times the input's.
    """
    size = F.coalesce(F.length(text_col), F.lit(0)) + 1
    mass = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("mass"))
    if weights is None:
        weighted = mass.withColumn("weight", F.pow(F.col("mass").cast("double"), F.lit(exponent)))
    else:
        wanted = weights.groupBy(F.col("source").alias("name")).agg(F.sum("weight").alias("weight"))
        weighted = mass.join(wanted, mass["source"].eqNullSafe(wanted["name"]), "left").select(
            "source", "mass", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)).alias("weight")
        )
    weighted = stored(weighted, "source-mass")
    total = weighted.agg(F.sum("mass").cast("double"), F.sum("weight")).first()
    all_mass, all_weight = total[0] or 0.0, total[1] or 0.0
    share = F.col("weight") / F.lit(all_weight) if all_weight else F.lit(0.0)
    return weighted.select("source", (share * (epochs * all_mass) / F.col("mass")).alias("rate"))


def _with_running_sums(rates: DataFrame) -> DataFrame:
    """Per source the number of parts, and P(count <= k) for k = 0, 1, ... of one part."""
    parts = F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("parts")

    def add(state: Column, k: Column) -> Column:
        term = state["term"] * F.col("mean") / k
        total = state["total"] + term
        sums = F.concat(state["sums"], F.array(total))
        return F.struct(term.alias("term"), total.alias("total"), sums.alias("sums"))

    first = F.exp(-F.col("mean"))
    start = F.struct(first.alias("term"), first.alias("total"), F.array(first).alias("sums"))
    table = F.aggregate(F.sequence(F.lit(1), F.lit(SUMS - 1)), start, add, lambda s: s["sums"])
    return (
        rates.withColumn("parts", parts).withColumn("mean", mean).select("source", "parts", table.alias("sums"))
    )


def replicate(
    docs: DataFrame,
    rates: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: int = 20_240,
) -> DataFrame:
    """The columns of ``docs`` with ``copy_no`` (from 1) and ``shuffle_key``, in random order."""
    table = stored(_with_running_sums(rates), "source-rates").select(
        F.col("source").alias("rate_of"), "parts", "sums"
    )
    names = [name for name in docs.columns if name.lower() not in ("copy_no", "shuffle_key")]
    rows = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in names]).alias("row"),
        F.col(source_col).alias("from_source"),
        _key(id_col, text_col).alias("draw"),
        F.monotonically_increasing_id().alias("number"),
    )

    def drawn(part: Column) -> Column:
        uniform = _hashed(_DIGITS, F.lit(seed), F.col("draw"), part) / F.lit(float(16**_DIGITS))
        return F.size(F.filter("sums", lambda total: total <= uniform))

    copies = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")), F.lit(0), lambda count, part: count + drawn(part)
    )
    # The table has a row per source; whether it is broadcast is decided by its stored size.
    counted = rows.join(table, rows["from_source"].eqNullSafe(table["rate_of"])).select(
        "row", "draw", "number", copies.alias("copies")
    )
    copy = F.transform(
        F.sequence(F.lit(1), F.col("copies")),
        lambda number: F.struct(number.alias("copy_no"), F.xxhash64("draw", number, "number").alias("place")),
    )
    every = counted.filter("copies > 0").select("row", "draw", F.explode(copy).alias("copy"))
    every = every.select("row", "draw", "copy.*")
    order = _hashed(15, F.lit(seed), F.lit("order"), F.col("draw"), F.col("copy_no"))
    return (
        every.withColumn("shuffle_key", order)
        .repartition("place")
        .sortWithinPartitions("shuffle_key", "place")
        .select("row.*", "copy_no", "shuffle_key")
    )


def mix_sources(docs: DataFrame, exponent: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """Documents replicated to shares proportional to ``mass ** exponent``."""
    return replicate(docs, source_rates(docs, exponent=exponent, epochs=epochs))


ORACLE = """
WITH RECURSIVE mass AS (
    SELECT source, CAST(sum(coalesce(length(text), 0) + 1) AS DOUBLE) AS mass
    FROM documents GROUP BY source
), rate AS (
    SELECT source,
           pow(mass, 0.5) / (SELECT sum(pow(mass, 0.5)) FROM mass)
               * (SELECT sum(mass) FROM mass) / mass AS rate
    FROM mass
), part AS (
    SELECT source, CAST(greatest(ceil(rate / 16), 1) AS INT) AS parts,
           rate / greatest(ceil(rate / 16), 1) AS mean
    FROM rate
), sums AS (
    SELECT source, 0 AS k, mean, exp(-mean) AS term, exp(-mean) AS total FROM part
    UNION ALL
    SELECT source, k + 1, mean, term * mean / (k + 1), total + term * mean / (k + 1)
    FROM sums WHERE k < 79
), tables AS (
    SELECT source, list(total) AS totals FROM sums GROUP BY source
), draws AS (
    SELECT d.*, unnest(range(1, parts + 1)) AS part
    FROM documents d JOIN part p ON d.source IS NOT DISTINCT FROM p.source
), counts AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, CAST(sum(len(list_filter(t.totals,
        lambda total: total <= CAST('0x' || substr(md5(concat_ws('|', 20240, d.doc_id, d.part)), 1, 13)
            AS BIGINT) / 4503599627370496.0))) AS BIGINT) AS copies
    FROM draws d JOIN tables t ON d.source IS NOT DISTINCT FROM t.source
    GROUP BY ALL
), numbered AS (
    SELECT * EXCLUDE (copies), CAST(unnest(range(1, copies + 1)) AS INT) AS copy_no FROM counts
)
SELECT *, CAST('0x' || substr(md5(concat_ws('|', 20240, 'order', doc_id, copy_no)), 1, 15) AS BIGINT)
    AS shuffle_key
FROM numbered
"""
