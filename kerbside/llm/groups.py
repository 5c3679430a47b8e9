"""Buckets whose members are compared: leaders first, then what is left of them in blocks.

A member that is compared with its bucket's leader costs a row, whatever the bucket's size. What a
leader has linked has one label afterwards, and only pairs of different labels are still looked at:
the members that lack a bucket's most frequent label stay in blocks, and all others pass by.
"""

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _array(column: pa.Array) -> np.ndarray:
    """A column as an array; lists of equal length as a matrix."""
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        values = column.flatten().to_numpy(zero_copy_only=False)
        return values.reshape(len(column), -1 if len(column) else 0)
    return column.to_numpy(zero_copy_only=False)


def grouped_rows(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], passes: str
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Rows, places of a group's resident rows, and places of those of its passing rows at hand.

    Residents come first in a group and are held; ``passes`` is the column that tells the others."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = {name: _array(batch.column(name)) for name in batch.schema.names}
        rows[passes] = rows[passes].astype(bool)
        if held is not None:
            rows = {name: np.concatenate([held[name], rows[name]]) for name in rows}
        starts = _starts(rows, keys)
        for start, end in zip(starts, np.append(starts[1:], len(rows[passes]))):
            goes = rows[passes][start:end]
            stay = start + np.flatnonzero(~goes)
            yield rows, stay, start + np.flatnonzero(goes)
        held = {name: values[stay] for name, values in rows.items()}


def _starts(rows: dict[str, np.ndarray], keys: Sequence[str]) -> np.ndarray:
    new = np.ones(len(rows[keys[0]]), bool)
    new[1:] = np.any([rows[key][1:] != rows[key][:-1] for key in keys], axis=0)
    return np.flatnonzero(new)


def pairs_within(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within each of some small groups."""
    left, right = [], []
    for size in np.unique(sizes):
        first = starts[sizes == size]
        a, b = np.triu_indices(int(size), 1)
        left.append((first[:, None] + a).ravel())
        right.append((first[:, None] + b).ravel())
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def likely_rows(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], most: int = 29) -> DataFrame:
    """The rows whose ``keys`` are among those of ``wanted``, and few others: what a join is to see of a
    table much larger than its result, so that the rest is not shuffled for it.

    The keys' hashes are bits of bitmaps, 16 for each row of ``wanted`` and 2 ** ``most`` in all, so these
    are broadcast with 64 MB at most. Where ``wanted`` has more rows than there are bits, nearly all pass.
    """
    bits = min(max(15, (16 * wanted.count()).bit_length()), most)
    # From 1 on, where buckets and positions of bitmaps begin.
    place = (F.pmod(F.xxhash64(*keys), F.lit(1 << bits)) + 1).alias("_place")
    maps = wanted.select(place).groupBy(F.bitmap_bucket_number("_place").alias("_bucket"))
    maps = maps.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap"))
    at = F.bitmap_bit_position("_place")
    byte = F.substring("_bitmap", F.shiftright(at, 3).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (at % 8).cast("int")) == 1
    placed = rows.select("*", place).withColumn("_bucket", F.bitmap_bucket_number("_place"))
    return placed.join(F.broadcast(maps), "_bucket").filter(is_set).select(rows.columns)


def shared_buckets(entries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Members of every bucket of two or more, with the smallest of them as ``leader``.

    ``entries`` has a row per bucket (``keys``) and member (``id``).
    """
    shared = entries.groupBy(*keys).agg(F.min("id").alias("leader"), F.count("*").alias("members"))
    return entries.join(shared.filter("members > 1").drop("members"), list(keys))


def open_buckets(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Members (``keys``, ``id``, ``label``) of buckets in which labels differ, with figures of these.

    ``main`` is a bucket's most frequent label, ``rest`` the number of members without it, ``leader`` and
    ``leader_label`` the smallest of those, and ``members`` the number of all.
    """
    sizes = members.groupBy(*keys, "label").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    top = F.max(F.struct("n", "label")).getField("label").alias("main")
    heads = sizes.groupBy(*keys).agg(top, F.count("*").alias("labels"), F.sum("n").alias("members"))
    heads = heads.filter("labels > 1").drop("labels")
    rest = sizes.join(heads, list(keys)).filter("label != main")
    lead = rest.groupBy(*keys, "main", "members").agg(
        F.min(F.struct("least", "label")).alias("lead"), F.sum("n").alias("rest")
    )
    lead = lead.select(
        *keys, "main", "members", "rest",
        F.col("lead.least").alias("leader"), F.col("lead.label").alias("leader_label"),
    )
    return members.join(lead, list(keys))


def in_stars(pairs: DataFrame, size: int) -> DataFrame:
    """Pairs ``a``, ``b`` with a ``slot``, so that ``a`` and ``slot`` have some ``size`` pairs at most."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / size).cast("int").alias("slots"))
    slot = F.pmod(F.xxhash64("b"), F.col("slots")).cast("int").alias("slot")
    return pairs.join(many, "a").select("a", slot, "b")


def star_rows(stars: DataFrame, payload: DataFrame) -> DataFrame:
    """The leader of every star, once per slot, and after it its members, each with its payload."""
    leaders = stars.select("a", "slot", F.col("a").alias("id"), F.lit(True).alias("leads")).distinct()
    every = leaders.unionAll(stars.select("a", "slot", "b", F.lit(False)))
    rows = every.join(payload, "id").select("a", "slot", "id", "leads", *[n for n in payload.columns if n != "id"])
    return rows.repartition("a", "slot").sortWithinPartitions("a", "slot", F.desc("leads"))


def by_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]]:
    """Rows of stars, the members' places among them, and the place of each member's leader."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = {name: _array(batch.column(name)) for name in batch.schema.names}
        if held is not None:
            rows = {name: np.concatenate([held[name], rows[name]]) for name in rows}
        at = np.maximum.accumulate(np.where(rows["leads"], np.arange(len(rows["id"])), -1))
        members = np.flatnonzero(~rows["leads"].astype(bool))
        yield rows, members, at[members]
        held = {name: values[at[-1] : at[-1] + 1] for name, values in rows.items()}


def meetings(members: DataFrame, keys: Sequence[str], residents: int, passers: int) -> DataFrame:
    """Rows of ``open_buckets`` so that any two of a bucket with different labels meet in one task.

    Members without their bucket's main label are ``resident`` in a block of some ``residents`` and pass
    by the blocks after it; members with the main label pass by every block. Passers come in parts
    of some ``passers``. ``keys``, ``block`` and ``part`` make a group.
    """
    blocks, parts = F.ceil(F.col("rest") / residents), F.ceil(F.col("members") / passers)
    sized = members.select(
        *keys, "id", "label", (F.col("label") != F.col("main")).alias("lives"),
        blocks.cast("int").alias("blocks"), parts.cast("int").alias("parts"),
    ).withColumn("own", F.when(F.col("lives"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
    stay = sized.filter("lives").select(
        *keys, F.col("own").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("resident"), "id", "label",
    )
    first = F.coalesce(F.col("own") + 1, F.lit(0))
    go = sized.filter(first < F.col("blocks")).select(
        *keys, F.explode(F.sequence(first, F.col("blocks") - 1)).alias("block"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int").alias("part"),
        F.lit(False).alias("resident"), "id", "label",
    )
    return stay.unionAll(go)


def met(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each group of ``meetings`` whole in one task, residents first."""
    group = [*keys, "block", "part"]
    return rows.repartition(*group).sortWithinPartitions(*group, F.desc("resident"))


def meeting_pairs(
    batches: Iterator[pa.RecordBatch],
    keys: Sequence[str],
    near: Callable[[dict, np.ndarray, np.ndarray], np.ndarray] | None = None,
    small: int = 9,
    pairs: int = 1 << 17,
) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, int]]:
    """Rows, and the places of pairs of different labels that are to be compared there.

    Groups of ``small`` rows at most are done together. Of larger ones the residents are held and the
    passers come by, so many at a time that there are ``pairs`` pairs; ``near`` may thin these out, and
    the last figure is the number of rows that they come from, 0 for small groups.
    """
    group = [*keys, "block", "part"]
    held: dict[str, np.ndarray] | None = None
    # Whether the residents held have been compared with each other.
    settled = False

    def of_many(rows: dict, stay: np.ndarray, go: np.ndarray, own: bool):
        step = max(1, pairs // max(len(stay), 1))
        for at in range(0, len(go), step):
            some = go[at : at + step]
            keep = rows["label"][stay][:, None] != rows["label"][some][None, :]
            if own:
                keep &= stay[:, None] < some[None, :]
            if near is not None and keep.any():
                keep &= near(rows, stay, some)
            a, b = np.nonzero(keep)
            yield rows, stay[a], some[b], len(stay) + len(some)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = {name: _array(batch.column(name)) for name in batch.schema.names}
        rows["resident"] = rows["resident"].astype(bool)
        if held is not None:
            rows = {name: np.concatenate([held[name], rows[name]]) for name in rows}
        starts = _starts(rows, group)
        sizes = np.diff(np.append(starts, len(rows["id"])))
        together = sizes <= small
        together[-1] = False
        together[0] &= not settled
        a, b = pairs_within(starts[together], sizes[together])
        lives = rows["resident"]
        keep = (lives[a] | lives[b]) & (rows["label"][a] != rows["label"][b])
        keep &= ~(lives[a] & lives[b]) | (rows["part"][a] == 0)
        if len(a):
            yield rows, a[keep], b[keep], 0
        for number in np.flatnonzero(~together):
            start, size = starts[number], sizes[number]
            stay = start + np.flatnonzero(lives[start : start + size])
            go = start + np.flatnonzero(~lives[start : start + size])
            done = settled and number == 0
            whole = len(go) > 0 or number < len(starts) - 1
            if whole and not done and rows["part"][start] == 0:
                yield from of_many(rows, stay, stay, True)
            yield from of_many(rows, stay, go, False)
            settled = whole or done
        held = {name: values[stay] for name, values in rows.items()}
        if len(stay) == 0:
            held, settled = None, False
    if held is not None and not settled and held["part"][0] == 0:
        every = np.arange(len(held["id"]))
        yield from of_many(held, every, every, True)
