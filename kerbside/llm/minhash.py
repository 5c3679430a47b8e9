"""Near-duplicate documents: banded MinHash, sequential Bayesian tests, exact confirmation.

1. One pass gives each text its number of distinct shingles, a digest of the set and a signature
   of 128 minima, of which 16 bits each are kept. Equal sets form a class with one representative.
2. Representatives that share a band of four minima are candidates. Signatures are compared batch by
   batch; after each batch a pair goes as soon as the posterior probability of a similarity of 0.75
   or more is below the chosen miss probability. Survivors are confirmed on full shingle sets, made
   from the texts again.
3. Every member is compared with the smallest member of all its buckets first, so a group of
   copies, however large, costs a row per member. What links so far join has one label. Only pairs
   of different labels are still looked at: members without their bucket's most frequent label
   against all others, in blocks. A pair of a block is looked at in the first band it shares and
   nowhere else. With more ``rounds``, single leaders without that label are compared first.
4. Where a block has more survivors than four per member, its members' sets go to the block's task
   instead, which gives one confirmed link for any two labels it can join. So no pairs within a
   large group are written, and no link that joins different texts' groups is lost.

Null or empty text has no shingles and is linked with nothing; so is a row with a null id, which
stays as it is. Rows that repeat an id but not the text are placed each by its own text. Very long
texts are worked on whole. Extra columns are ignored.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.components import connected_components
from kerbside.llm.groups import (
    by_leader,
    in_stars,
    likely_rows,
    meeting_pairs,
    meetings,
    met,
    open_buckets,
    shared_buckets,
    star_rows,
)
from kerbside.llm.words import mix, shingles_of, text_slices, words_of
from kerbside.sources import stored

HASHES, BANDS, BATCH = 128, 32, 32
# Members of a star in a task; residents of a bucket that a task holds, and passers that come by.
STAR, BLOCK, PASSERS = 512, 2048, 1 << 16

_seeds = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_XOR = (_seeds[:HASHES] >> np.uint64(32)).astype(np.uint32)
_MULTIPLY = (_seeds[HASHES:] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signatures(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima per row under 128 scramblings of the hashes' upper halves, 16 bits of each."""
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), HASHES), np.uint16)
    for i in range(HASHES):
        value = (upper ^ _XOR[i]) * _MULTIPLY[i]
        value ^= value >> np.uint32(15)
        out[:, i] = np.minimum.reduceat(value * np.uint32(0x2C1B3C6D), starts)
    return out


def distinct_mask(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """Hashes sorted within each row, and which of them are the first of their kind."""
    hashes = hashes.copy()
    for start, end in zip(starts, ends):
        hashes[start:end].sort()
    first = np.ones(len(hashes), bool)
    first[1:] = hashes[1:] != hashes[:-1]
    first[starts] = True
    return hashes, first


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in text_slices(batch.column(1)):
            found = shingles_of(words_of(text))
            rows, starts = found.rows, found.starts
            counts, first_sum, second_sum = (np.zeros(len(text), np.int64) for _ in range(3))
            signed = np.zeros((len(text), BANDS), np.int64)
            if len(rows):
                hashes, first = distinct_mask(found.hash, starts, found.ends())
                counts[rows] = np.add.reduceat(first.astype(np.int64), starts)
                once = np.where(first, mix(hashes), 0).astype(np.uint64)
                first_sum[rows] = np.add.reduceat(once, starts).view(np.int64)
                once = np.where(first, mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), 0)
                second_sum[rows] = np.add.reduceat(once.astype(np.uint64), starts).view(np.int64)
                signed[rows] = signatures(hashes, starts).view(np.int64)
            at = np.arange(len(text) + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(i).slice(text.first, len(text)) for i in (0, 2)],
                    pa.array(counts),
                    pa.array(first_sum),
                    pa.array(second_sum),
                    pa.ListArray.from_arrays(pa.array(at), pa.array(signed.ravel())),
                ],
                names=["doc_id", "version", "n_shingles", "h1", "h2", "bands"],
            )


def _upper_beta(a: int, b: int, x: float) -> float:
    """P(value >= x) under Beta(a, b), whole a and b: a binomial sum."""
    n = a + b - 1
    return sum(math.comb(n, k) * x**k * (1 - x) ** (n - k) for k in range(a))


def fewest_matches(threshold: float, miss: float) -> list[int]:
    """Per batch end, the fewest matches at which a pair is not yet given up."""
    needed = []
    for seen in range(BATCH, HASHES + 1, BATCH):
        matches = 0
        while _upper_beta(matches + 1, seen - matches + 1, threshold) < miss:
            matches += 1
        needed.append(matches)
    return needed


_BUCKET = ["band", "key"]
_GROUP = [*_BUCKET, "block", "part"]


class _Bounds:
    """What may be linked by sizes and signatures, batch after batch."""

    def __init__(self, threshold: float, miss: float):
        self.percent = round(100 * threshold)
        self.needed = fewest_matches(threshold, miss)

    def survivors(self, rows: dict, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        small, large = np.minimum(rows["n"][a], rows["n"][b]), np.maximum(rows["n"][a], rows["n"][b])
        keep = 100 * small >= self.percent * large
        a, b = a[keep], b[keep]
        matches = np.zeros(len(a), np.int64)
        signature = rows["bands"].view(np.uint16)
        for batch, least in enumerate(self.needed):
            part = slice(batch * BATCH, (batch + 1) * BATCH)
            matches += (signature[a, part] == signature[b, part]).sum(1)
            keep = matches >= least
            a, b, matches = a[keep], b[keep], matches[keep]
        return a, b


def shares_enough(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have a similarity of ``percent`` or more."""
    at = np.searchsorted(first, second)
    at[at == len(first)] = 0
    both = int((first[at] == second).sum())
    return 100 * both >= percent * (len(first) + len(second) - both)


class _StarSignatures(_Bounds):
    """Members whose signatures may be linked with their leader's."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, member, leader in by_leader(batches):
            leader, member = self.survivors(rows, leader, member)
            columns = [rows["a"][member], rows["slot"][member], rows["id"][member]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["a", "slot", "b"])


def _star_sets(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, members, leaders in by_leader(batches):
            linked, last, own = [], -1, None
            for member, leader in zip(members, leaders):
                if leader != last:
                    last, own = leader, np.frombuffer(rows["set"][leader], np.uint64)
                if shares_enough(own, np.frombuffer(rows["set"][member], np.uint64), percent):
                    linked.append(member)
            linked = np.array(linked, np.int64)
            columns = [pa.array(rows[name][linked].astype(np.int64)) for name in ("a", "id")]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return confirm


class _BlockSignatures(_Bounds):
    """Surviving pairs of residents and passers; where there are very many, only the group's key."""

    def looked_at(self, rows: dict, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.survivors(rows, a, b)
        # The first band that two signatures share is the one that they are looked at in.
        first = np.argmax(rows["bands"][a] == rows["bands"][b], axis=1) if len(a) else a
        keep = first == rows["band"][a]
        return a[keep], b[keep]

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, a, b, members in meeting_pairs(batches, _BUCKET):
            a, b = self.looked_at(rows, a, b)
            dense = 0 < 4 * members < len(a)
            key = a[:1] if dense else a
            columns = [rows[name][key] for name in _GROUP]
            columns += [np.full(1, -1)] * 2 if dense else [rows["id"][a], rows["id"][b]]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=[*_GROUP, "a", "b"])


class _BlockSets(_BlockSignatures):
    """Confirmed links of dense groups, whose rows carry their sets: one for any two labels that
    no other link of the group has joined."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, joined = None, {}

        def top(label: int) -> int:
            while joined.get(label, label) != label:
                joined[label] = label = joined.get(joined[label], joined[label])
            return label

        for rows, a, b, _ in meeting_pairs(batches, _BUCKET, small=0):
            a, b = self.looked_at(rows, a, b)
            if len(a) == 0:
                continue
            own = tuple(int(rows[name][a[0]]) for name in _GROUP)
            if own != group:
                group, joined = own, {}
            links, sets = [], {}
            for pair in zip(a.tolist(), b.tolist()):
                first, second = (top(int(rows["label"][each])) for each in pair)
                if first != second:
                    for each in pair:
                        if each not in sets:
                            sets[each] = np.frombuffer(rows["set"][each], np.uint64)
                    if shares_enough(*(sets[each] for each in pair), self.percent):
                        joined[max(first, second)] = min(first, second)
                        links.append(pair)
            at = np.array(links, np.int64).reshape(-1, 2)
            columns = [pa.array(rows["id"][at[:, side]]) for side in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in text_slices(batch.column(1)):
            found = shingles_of(words_of(text))
            hashes, first = distinct_mask(found.hash, found.starts, found.ends())
            sets = [
                hashes[start:end][first[start:end]].tobytes()
                for start, end in zip(found.starts, found.ends())
            ]
            ids = batch.column(0).slice(text.first, len(text)).take(pa.array(found.rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sets, pa.binary())], names=["id", "set"])


def _sets(ids: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The shingle sets of some nodes, dealt by node. Few texts but those wanted are shuffled, if any."""
    keys = ["doc_id", "version"]
    wanted = stored(classes.join(ids.distinct(), "id").select(*keys, "id"), "wanted-texts")
    some = likely_rows(texts, wanted, keys).join(wanted, keys).select("id", "text")
    # Rows that repeat a text give its set once each.
    return some.mapInArrow(_shingle_sets, "id long, set binary").dropDuplicates(["id"])


class _Linker:
    """Confirmed links of a table of nodes."""

    def __init__(
        self, nodes: DataFrame, classes: DataFrame, texts: DataFrame, threshold: float, miss: float
    ):
        self.nodes, self.classes, self.texts = nodes, classes, texts
        self.threshold, self.miss = threshold, miss

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of some pairs that are links, stored. Equal ``a`` are one star."""
        percent = round(100 * self.threshold)
        rows = star_rows(stored(in_stars(pairs, STAR), "stars"), self.nodes)
        near = rows.mapInArrow(_StarSignatures(self.threshold, self.miss), "a long, slot int, b long")
        near = stored(near, "surviving-pairs")
        ids = near.select(F.col("a").alias("id")).unionAll(near.select("b"))
        rows = star_rows(near, _sets(ids, self.classes, self.texts))
        return stored(rows.mapInArrow(_star_sets(percent), "a long, b long"), "confirmed-pairs")

    def in_blocks(self, members: DataFrame) -> DataFrame:
        """Links between different labels of open buckets: all sparse ones, a forest of dense groups."""
        rows = stored(meetings(members, _BUCKET, BLOCK, PASSERS), "meetings")
        schema = "band int, key long, block int, part int, a long, b long"
        found = met(rows.join(self.nodes, "id"), _BUCKET).mapInArrow(
            _BlockSignatures(self.threshold, self.miss), schema
        )
        found = stored(found, "surviving-pairs")
        sparse = self.confirmed(found.filter("a >= 0").select("a", "b").distinct())
        if found.filter("a < 0").isEmpty():
            return sparse
        dense = stored(rows.join(found.filter("a < 0").select(*_GROUP), _GROUP, "left_semi"), "dense")
        carried = dense.join(self.nodes, "id").join(_sets(dense.select("id"), self.classes, self.texts), "id")
        forests = met(carried, _BUCKET).mapInArrow(
            _BlockSets(self.threshold, self.miss), "a long, b long"
        )
        return sparse.unionAll(stored(forests, "dense-links"))

    def links(self, rounds: int) -> DataFrame:
        """Links that join all nodes which links join."""
        entries = self.nodes.select("id", F.posexplode("bands").alias("band", "key"))
        buckets = stored(shared_buckets(entries, _BUCKET), "buckets")
        # Nodes that are alone in all their buckets are not looked at again.
        met_nodes = self.nodes.join(buckets.select("id").distinct(), "id", "left_semi")
        self.nodes = stored(met_nodes, "bucket-nodes")
        # Each member's smallest leader first: one pair per member joins most of any group.
        tried = buckets.filter("id != leader").groupBy(F.col("id").alias("b")).agg(F.min("leader").alias("a"))
        tried = stored(tried.select("a", "b"), "first-pairs")
        found = self.confirmed(tried)
        left = buckets.select(*_BUCKET, "id")
        for round_ in range(rounds):
            parts = connected_components(found).withColumnRenamed("node", "id")
            labelled = left.join(parts, "id", "left").select(
                *_BUCKET, "id", F.coalesce("component", "id").alias("label")
            )
            members = stored(open_buckets(labelled, _BUCKET), "open-buckets")
            if members.isEmpty():
                return found
            if round_ == rounds - 1:
                return found.unionAll(self.in_blocks(members))
            # A leader is compared with all of its bucket that has another label, and leaves it.
            others = members.filter("label != leader_label")
            pairs = others.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
            found = stored(found.unionAll(self.confirmed(pairs.join(tried, ["a", "b"], "left_anti"))), "links")
            left = members.filter("id != leader").select(*_BUCKET, "id")
        raise ValueError("rounds is 1 at least")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.75,
    miss: float = 1e-6,
    rounds: int = 1,
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``; besides ``version``, a hash of
    the text, and ``stands_for_group``, which of each group one id and text has.

    ``miss`` is the posterior probability of a link at which a pair of signatures is given up,
    ``rounds`` how often buckets are labelled anew before what is left goes into blocks.
    """
    taken = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.xxhash64(text_col).alias("version"),
    )
    signed = stored(
        taken.select("doc_id", "text", "version").mapInArrow(
            _sign, "doc_id long, version long, n_shingles long, h1 long, h2 long, bands array<bigint>"
        ),
        "signatures",
    )
    linkable = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = linkable.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "version")).alias("least"))
    # A repeated id may stand for several texts, so a class has a number of its own.
    classes = classes.select("h1", "h2", "least.*", F.monotonically_increasing_id().alias("id"))
    classes = stored(classes, "classes")
    nodes = linkable.join(classes, ["h1", "h2", "doc_id", "version"]).select(
        "id", F.col("n_shingles").alias("n"), "bands"
    )
    nodes = stored(nodes.dropDuplicates(["id"]), "nodes")

    linker = _Linker(nodes, classes, taken, threshold, miss)
    parts = connected_components(linker.links(rounds))
    placed = classes.join(parts.withColumnRenamed("node", "id"), "id", "left").select(
        "h1", "h2", "doc_id", "version", F.coalesce("component", "id").alias("component")
    )
    placed = stored(placed, "placed-classes")
    least = placed.groupBy("component").agg(F.min(F.struct("doc_id", "version")).alias("first"))
    members = placed.join(least, "component").select("h1", "h2", "first")
    every = linkable.select("doc_id", "version", "n_shingles", "h1", "h2").join(members, ["h1", "h2"])
    first = (F.col("doc_id") == F.col("first.doc_id")) & (F.col("version") == F.col("first.version"))
    alone = signed.filter("NOT (n_shingles > 0 AND doc_id IS NOT NULL)")
    return every.select(
        "doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"), "version", first.alias("stands_for_group")
    ).unionAll(
        alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "version", F.lit(True))
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.75
) -> DataFrame:
    """The rows and columns of ``docs`` with one row of each group of near-duplicates.

    Of repeated rows one stays; rows without an id all stay.
    """
    near = near_duplicates(docs, id_col, text_col, threshold)
    kept = near.filter("stands_for_group AND doc_id IS NOT NULL").select("doc_id", "version").distinct()
    rows = docs.filter(F.col(id_col).isNotNull()).select(
        F.struct("*").alias("row"),
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.xxhash64(text_col).alias("version"),
    )
    kept = rows.join(stored(kept, "kept"), ["doc_id", "version"]).dropDuplicates(["doc_id", "version"])
    return kept.select("row.*").unionAll(docs.filter(F.col(id_col).isNull()))
