"""Exact duplicates by a tree-merge of sorted digest runs.

1. Each text becomes its SHA-256 digest, its length in bytes, and the row's id and number. The
   partitions sort these entries, and each cuts its sorted run into blocks.
2. The space of digests is divided into ``parts`` ranges. In binomial rounds the partitions exchange
   parts of their runs: a round settles some bits of the address, most significant first, so a
   partition sends every other one of its circle the range that it is to hold and keeps its own.
   After the last round a partition holds one range, whole.
3. At every level the runs that meet are merged many ways, block by block. Entries of equal digest
   and length become one, with the smallest (or largest) identifier and the sum of their counts.
   Equality is verified on all 256 bits and the length; 64 bits only serve the order.
4. The retained entries are joined with the rows by digest.

A run has at most one entry per text, so of a group of copies, however large, each partition hands
on one entry. Memory is a block for each run that meets in a part, besides the buffer; no range is
sorted or held whole. Runs lie in shuffles or stored tables, so a lost executor repeats its share.

A null text counts as empty; very long texts count by their digest alone. Rows that repeat both id
and text are rows of one group, of which exactly one stays: of equal ids the one with the smallest
row number. A null id gives way to any other; where a group has null ids only, ``keep_id`` is null
and one of its rows stays. Extra columns are ignored; ``one_of_equals`` keeps them. An empty table
gives no rows.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.sources import stored

# Most entries of a block, and entries held before a merge besides one open block a run.
BLOCK, BUFFER = 512, 32_768

_ENTRY = np.dtype(
    [("digest", "S32"), ("key", "u8"), ("size", "i8"), ("id", "i8"), ("row", "i8"), ("count", "i8"), ("known", "i8")]
)
_RUN_SCHEMA = "part int, first binary, entries binary"


def _keys(digests: np.ndarray) -> np.ndarray:
    """The first 64 bits of each digest, as numbers in the order of the digests."""
    return digests.view(">u8").reshape(len(digests), 4)[:, 0].astype(np.uint64)


def _same_text(entries: np.ndarray) -> np.ndarray:
    """Whether each entry has the digest and the length of the one before it."""
    return (entries["digest"][1:] == entries["digest"][:-1]) & (entries["size"][1:] == entries["size"][:-1])


def reduced(entries: np.ndarray, largest: bool) -> np.ndarray:
    """Entries in the order of their digests, one per digest and length, with summed counts."""
    # A stable sort, which merges the sorted stretches that it finds.
    entries = entries[np.argsort(entries["key"], kind="stable")]
    near = entries["key"][1:] == entries["key"][:-1]
    if not near.any():
        return entries
    same = _same_text(entries)
    if (near & ~same).any():
        # Different texts may share 64 bits: then the whole digest and the length give the order.
        entries = entries[np.lexsort((entries["size"], entries["digest"]))]
        same = _same_text(entries)
    first = np.flatnonzero(np.append(True, ~same))
    counts = np.add.reduceat(entries["count"], first)
    group = np.cumsum(np.append(True, ~same)) - 1
    # Of a group known ids come first, then the id asked for, then the first row. ``~`` turns the
    # order round without leaving the range of 64 bits.
    ids = np.where(entries["known"] == 1, entries["id"], 0)
    order = np.lexsort((entries["row"], ~ids if largest else ids, -entries["known"], group))
    entries = entries[order[first]]
    entries["count"] = counts
    return entries


class _Level:
    """Sorted runs in, sorted runs out, cut where the next round's partitions begin.

    ``settled`` is the number of address bits that the runs' parts already have from the digest,
    ``bits`` how many the next round settles, and ``width`` the length of an address.
    """

    def __init__(self, largest: bool, width: int, settled: int, bits: int):
        self.largest, self.width, self.settled, self.bits = largest, width, settled, bits

    def blocks(self, part: int, entries: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
        """Blocks of a stretch of a merged run, each with the part that it goes to next."""
        address = (entries["key"] >> np.uint64(64 - self.width)).astype(np.int64)
        rest = self.width - self.settled - self.bits
        mask = (1 << self.bits) - 1 << rest
        target = (part & ~mask) | (address & mask)
        cuts = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        for start, end in zip(cuts, np.append(cuts[1:], len(entries))):
            for at in range(start, end, BLOCK):
                block = entries[at : min(at + BLOCK, end)]
                yield int(target[at]), block[:1].tobytes()[:32], block.tobytes()

    def merged(self, runs: Iterator[tuple[int, np.ndarray]]) -> Iterator[tuple[int, np.ndarray]]:
        """Blocks by part and first digest -> finished stretches of each part's merged run."""
        part, held, size, left = -1, [], 0, 0
        for own, block in runs:
            if own != part:
                if held:
                    yield part, reduced(np.concatenate(held), self.largest)
                part, held, size, left = own, [], 0, 0
            elif size >= left + BUFFER:
                # What lies before this block's first key can meet nothing that is to come.
                every = reduced(np.concatenate(held), self.largest)
                done = int(np.searchsorted(every["key"], block["key"][0]))
                if done:
                    yield part, every[:done]
                held, size = [every[done:]], len(every) - done
                left = size
            held.append(block)
            size += len(block)
        if held:
            yield part, reduced(np.concatenate(held), self.largest)

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for batch in batches:
            for part, entries in zip(batch.column(0).to_pylist(), batch.column(2)):
                yield part, np.frombuffer(entries.as_buffer(), _ENTRY)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, entries in self.merged(self.read(batches)):
            rows = list(self.blocks(part, entries))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), _RUN_TYPES)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "first", "entries"])


_RUN_TYPES = (pa.int32(), pa.binary(), pa.binary())


class _FirstRuns(_Level):
    """A partition's sorted rows as its run; the partition's number is its first part."""

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                entries = np.zeros(part.num_rows, _ENTRY)
                entries["digest"] = np.array(part.column(1).to_pylist(), "S32")
                entries["key"] = _keys(np.ascontiguousarray(entries["digest"]))
                entries["size"] = part.column(2).to_numpy(zero_copy_only=False)
                entries["known"] = part.column(3).is_valid().to_numpy(zero_copy_only=False)
                entries["id"] = part.column(3).fill_null(0).to_numpy(zero_copy_only=False)
                entries["row"] = part.column(4).to_numpy(zero_copy_only=False)
                entries["count"] = 1
                yield part.column(0)[0].as_py(), entries


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.column(0):
            entries = np.frombuffer(block.as_buffer(), _ENTRY)
            digests = np.ascontiguousarray(entries["digest"]).view("V32")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([digest.tobytes() for digest in digests], pa.binary()),
                    pa.array(entries["size"]),
                    pa.array(entries["id"], mask=entries["known"] == 0),
                    pa.array(entries["row"]),
                    pa.array(entries["count"]),
                ],
                names=["digest", "size", "keep_id", "keep_row", "group_size"],
            )


def rounds(width: int, fan_bits: int) -> list[tuple[int, int]]:
    """(bits settled before, bits settled in it) of each round."""
    return [(done, min(fan_bits, width - done)) for done in range(0, width, fan_bits)]


def merged_runs(hashed: DataFrame, largest: bool, parts: int, fan: int) -> DataFrame:
    """``digest``, ``size``, ``keep_id``, ``keep_row`` and ``group_size`` of every text.

    ``hashed`` is a stored table with ``digest``, ``size``, ``id`` and ``row``. ``parts`` and ``fan``
    are powers of two: the ranges of the digest space, and how many partitions exchange runs in a
    round.
    """
    width = parts.bit_length() - 1
    steps = rounds(width, fan.bit_length() - 1)
    own = F.pmod(F.spark_partition_id(), F.lit(parts)).cast("int").alias("part")
    runs = hashed.select(own, "digest", "size", "id", "row").sortWithinPartitions("digest", "size")
    levels = [(settled, bits) for settled, bits in steps] + [(width, 0)]
    runs = runs.mapInArrow(_FirstRuns(largest, width, *levels[0]), _RUN_SCHEMA)
    for level in levels[1:]:
        met = runs.repartition("part").sortWithinPartitions("part", "first")
        runs = met.mapInArrow(_Level(largest, width, *level), _RUN_SCHEMA)
    return runs.select("entries").mapInArrow(
        _unpacked, "digest binary, size long, keep_id long, keep_row long, group_size long"
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
    part_rows: int = 1 << 14,
    fan: int = 8,
) -> DataFrame:
    """Per row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of each group of equal texts the row with the ``keep`` ("smallest" or "largest") id stays. Texts
    are compared as ``normalise`` makes them, as they are by default. A range of the digest space
    holds some ``part_rows`` rows (there are ``fan`` at least), and ``fan`` partitions, a power of
    two, exchange runs in a round.
    """
    return _placed(_hashed(docs, id_col, text_col, normalise), keep, part_rows, fan).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def _hashed(docs: DataFrame, id_col: str, text_col: str, normalise) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.coalesce(normalise(text), F.lit("")) if normalise else text
    hashed = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(hashed, "digests")


def _placed(hashed: DataFrame, keep: str, part_rows: int, fan: int) -> DataFrame:
    if keep not in ("smallest", "largest") or fan < 2 or fan & (fan - 1):
        raise ValueError("keep is smallest or largest, fan a power of two from 2")
    wanted = -(-hashed.count() // part_rows)
    parts = max(fan, 1 << max(wanted - 1, 0).bit_length())
    groups = stored(merged_runs(hashed, keep == "largest", parts, fan), "merged-digests")
    return hashed.join(groups, ["digest", "size"]).select(
        F.col("id").alias("doc_id"),
        "digest",
        "row",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
    )


def one_of_equals(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The rows and columns of ``docs`` with one row of each group of equal texts.

    The retained ids and digests go back to the rows; of rows equal in id and text one stays.
    """
    answers = exact_duplicates(docs, id_col, text_col, keep, normalise).filter("kept")
    kept = answers.select(F.col("keep_id").alias("_id"), F.unhex("text_sha256").alias("_digest"))
    kept = stored(kept, "kept")
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = F.coalesce(normalise(text), F.lit("")) if normalise else text
    rows = docs.select(
        F.struct("*").alias("_row"),
        F.col(id_col).cast("bigint").alias("_own"),
        F.unhex(F.sha2(text, 256)).alias("_digest"),
    )
    same = (rows["_digest"] == kept["_digest"]) & rows["_own"].eqNullSafe(kept["_id"])
    return rows.join(kept, same).drop(kept["_digest"]).dropDuplicates(["_digest"]).select("_row.*")


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
