"""Substring dedup by content-defined chunks.

A gear hash rolls over the bytes of each text: the sum of a random number per byte, doubled with
every further byte. A place where four of its bits are zero is a candidate for a cut, and a cut if
no other candidate lies within the 15 bytes before it. So cuts depend on some 30 bytes of content
and not on what stands further before, and chunks, 16 to 79 bytes but for a text's last, fall
alike into step again after an insertion. Chunks are deduplicated by digest: the one in the
smallest document, first row of it, first place, is kept, and every other one is a repeat.

Neighbouring chunks that stand in other places too make a passage. Passages of ``least`` bytes or
more count, so that a common short line alone does not. The query and ``without_repeats`` count
every place: in other documents, in other rows of the same id, and in the same row.
``repeated_passages`` by itself counts other documents only, unless ``every_place`` is set; rows
with the same id are one document to it, and a row without an id is one by its text.

Null or empty text has no chunks. Extra columns are ignored; ``without_repeats`` keeps them.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.words import Text, mix, text_slices
from kerbside.sources import stored

# The gear table, the bits of the hash that are looked at, least bytes of a chunk and
# bytes after which text without cuts is cut.
_GEAR = mix(np.arange(1, 257, dtype=np.uint64))
_BITS, _LEAST_CHUNK, _MOST_CHUNK = np.uint64(0xF000), 16, 64


def cuts(text: Text) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every chunk of a slice, in order."""
    rolled = _GEAR[text.data]
    # The looked-at bits depend on 16 bytes: sums over 2, 4, 8 and 16 of them by doubling.
    for width in (1, 2, 4, 8):
        rolled[width:] += rolled[:-width] << np.uint64(width)
    places = np.flatnonzero((rolled & _BITS) == 0) + 1
    # The first 16 bytes of a text see bytes of the text before; there is no cut among them.
    row = np.searchsorted(text.ends, places - 1, "right")
    places = places[places - text.starts[row] >= _LEAST_CHUNK] if len(places) else places
    clear = np.ones(len(places), bool)
    clear[1:] = np.diff(places) >= _LEAST_CHUNK
    filled = text.ends > text.starts
    ends = np.unique(np.concatenate([places[clear], text.ends[filled]]))
    starts = np.unique(np.concatenate([places[clear], text.starts[filled]]))
    starts = starts[starts < len(text.data)]
    # Text without cuts, such as one word over and over, is cut every so many bytes.
    pieces = np.maximum(1, -(-(ends - starts - _LEAST_CHUNK + 1) // _MOST_CHUNK))
    more = np.repeat(starts, pieces)
    first = np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = more + (np.arange(len(more)) - first) * _MOST_CHUNK
    ends = np.append(starts[1:], ends[-1:])
    return starts, ends


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=8).digest()


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text in text_slices(batch.column(3)):
            starts, ends = cuts(text)
            # What is left at the end of a text is too short to be a repeat.
            starts, ends = starts[ends - starts >= _LEAST_CHUNK], ends[ends - starts >= _LEAST_CHUNK]
            if len(starts) == 0:
                continue
            data = text.data.tobytes()
            digests = b"".join(_digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist()))
            row = np.searchsorted(text.ends, starts, "right")
            at = pa.array(row + text.first)
            start, length = starts - text.starts[row], ends - starts
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(digests, np.int64)),
                    *[batch.column(i).take(at) for i in range(3)],
                    pa.array(start),
                    pa.array(length.astype(np.int32)),
                ],
                names=["digest", "doc", "version", "number", "start", "length"],
            )


def _document(id_col: str, text_col: str) -> Column:
    """A number per document: its id, or one made from the text where there is none."""
    return F.coalesce(F.col(id_col).cast("bigint"), F.xxhash64(F.col(text_col)))


def _passages(least: int):
    """Merges a row's repeats: passages, and of them what is not a first occurrence."""

    def runs(chunks: list[tuple[int, int]]) -> list[tuple[int, int]]:
        merged: list[tuple[int, int]] = []
        for start, end in chunks:
            if merged and merged[-1][1] == start:
                merged[-1] = (merged[-1][0], end)
            else:
                merged.append((start, end))
        return merged

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for doc, version, number, chunks in zip(*(column.to_pylist() for column in batch.columns)):
                chunks.sort(key=lambda chunk: chunk["start"])
                spans = runs([(c["start"], c["start"] + c["length"]) for c in chunks])
                spans = [span for span in spans if span[1] - span[0] >= least]
                if not spans:
                    continue
                seen, again, owners, count, i = set(), [], set(), 0, 0
                for chunk in chunks:
                    start, end = chunk["start"], chunk["start"] + chunk["length"]
                    while i < len(spans) and spans[i][1] <= start:
                        i += 1
                    if i == len(spans) or start < spans[i][0]:
                        continue
                    count += 1
                    first = chunk["owner"] == doc and chunk["owner_number"] == number
                    if not first or chunk["digest"] in seen:
                        again.append((start, end))
                        owners.add(chunk["owner"])
                    seen.add(chunk["digest"])
                row = (doc, version, number, count, spans, runs(again), sorted(owners - {doc}))
                for values, value in zip(out, row):
                    values.append(value)
                out[7].append(sum(end - start for start, end in spans))
            span = pa.list_(pa.list_(pa.int64()))
            kinds = [*[pa.int64()] * 4, span, span, pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(out, kinds)],
                names=_PASSAGE_NAMES,
            )

    return merge


_PASSAGE_NAMES = ["doc", "version", "number", "n_chunks", "passages", "repeats", "copies_of", "n_bytes"]
_PASSAGES = (
    "doc long, version long, number long, n_chunks long, passages array<array<bigint>>,"
    " repeats array<array<bigint>>, copies_of array<bigint>, n_bytes long"
)


def _numbered(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Each row's document, version, a number of its own, and further columns."""
    return docs.select(
        _document(id_col, text_col).alias("doc"),
        F.xxhash64(F.col(text_col)).alias("version"),
        F.monotonically_increasing_id().alias("number"),
        *more,
    )


def _repeated(taken: DataFrame, least: int, every_place: bool) -> DataFrame:
    """Passages of rows of ``doc``, ``version``, ``number`` and ``text``."""
    # Stored, for a row's number must be the same in both passes over its chunks.
    chunks = stored(
        taken.filter("text != ''").mapInArrow(
            _chunk,
            "digest long, doc long, version long, number long, start long, length int",
        ),
        "chunks",
    )
    # Document and row number in one decimal: the least is the first row of the smallest document,
    # and decimals, unlike structs, are combined before the shuffle without a sort.
    span = F.lit(1 << 62).cast("decimal(20,0)")
    place = (F.col("doc").cast("decimal(20,0)") * span).cast("decimal(38,0)") + F.col("number").cast("decimal(20,0)")
    held = chunks.select("digest", "doc", place.cast("decimal(38,0)").alias("place")).groupBy("digest")
    held = held.agg(
        F.min("place").alias("first"),
        F.min("doc").alias("owner"),
        F.max("doc").alias("other"),
        F.count("*").alias("n"),
    )
    common = held.filter("n > 1" if every_place else "owner < other")
    number = F.col("first") - (F.col("owner").cast("decimal(20,0)") * span).cast("decimal(38,0)")
    shared = stored(
        common.select("digest", "owner", number.cast("bigint").alias("owner_number")), "shared-chunks"
    )
    if not every_place:
        # Rows with the same id are one document, and equal ones of them one row.
        chunks = chunks.withColumn("number", F.lit(0).cast("bigint"))
        shared = shared.withColumn("owner_number", F.lit(0).cast("bigint"))
    # Two plain tables: a digest that very many documents hold is split by adaptive execution.
    repeats = chunks.join(shared, "digest").select(
        "doc", "version", "number", F.struct("start", "length", "digest", "owner", "owner_number").alias("chunk")
    )
    by_row = repeats.groupBy("doc", "version", "number").agg(F.collect_set("chunk").alias("chunks"))
    return by_row.mapInArrow(_passages(least), _PASSAGES)


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = 96,
    every_place: bool = False,
) -> DataFrame:
    """A row per document that holds a passage of another one, others have none; with
    ``every_place`` a row per row of ``docs`` that holds a passage which stands in another place.

    ``doc`` (its id) and ``version`` (a hash of its text), ``n_chunks`` and ``n_bytes`` of its
    passages, ``passages`` as [start, end) in bytes of UTF-8, ``repeats`` (the parts of them that
    are not the first occurrence), and ``copies_of``: the other documents that hold the first ones.
    """
    taken = _numbered(docs, id_col, text_col, F.col(text_col).alias("text"))
    return _repeated(taken, least, every_place).drop("number")


def _written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda span: F.array_join(span, ":")), ",")


def passage_digest(found: DataFrame) -> DataFrame:
    """Repeated passages with their spans as text."""
    return found.select(
        F.col("doc").alias("doc_id"),
        "n_chunks",
        "n_bytes",
        _written("passages").alias("passages"),
        _written("repeats").alias("repeats"),
        "copies_of",
    )


def _cutter(text_at: int):
    def cut(text: str | None, repeats: list[list[int]] | None) -> str | None:
        if text is None or repeats is None:
            return text
        data, out, at = text.encode(), [], 0
        for start, end in repeats:
            out.append(data[at:start])
            at = end
        return b"".join([*out, data[at:]]).decode("utf-8", "ignore")

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                columns, repeats = part.columns[:-1], part.columns[-1].to_pylist()
                texts = map(cut, columns[text_at].to_pylist(), repeats)
                columns[text_at] = pa.array(list(texts), columns[text_at].type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return without


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 96
) -> DataFrame:
    """The rows and columns of ``docs`` with every repeat cut out of its text."""
    # Stored, for the repeats are joined back by the rows' numbers.
    rows = stored(_numbered(docs, id_col, text_col, F.struct("*").alias("row")), "numbered-rows")
    text = F.col("row").getField(text_col).alias("text")
    found = _repeated(rows.select("doc", "version", "number", text), least, True)
    found = stored(found.filter(F.size("repeats") > 0).select("number", "repeats"), "repeats")
    joined = rows.join(found, "number", "left").select("row.*", "repeats")
    return joined.mapInArrow(_cutter(docs.columns.index(text_col)), docs.schema)
