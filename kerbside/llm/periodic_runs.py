"""Periodic runs of words: suffix trees, longest common extensions, Lyndon roots.

A run is a stretch of consecutive words of smallest period ``q`` (words ``q`` apart are identical)
that no neighbouring word extends, of ``min_length`` words and ``exponent`` periods at least.

1. Where a text can hold a run at all is found first, exactly. In a run of ``length`` words every
   stretch of ``length - q`` words stands twice, ``q`` apart, and ``length - q`` is at least 16 at the
   default settings. So every word of a run lies in a 16-word stretch that the text repeats; what lies
   in none is no part of a run, and a run lies within one unbroken piece of the rest. Equal hashes
   of different stretches only make pieces larger.
2. Ukkonen's suffix trees of a piece and of its reversal give the longest common extension of two
   places to the right and to the left: their lowest common ancestor, by range minima over the
   Euler tour, in constant time.
3. The order of the suffixes gives the longest Lyndon word from every place, once for rising and
   once for falling symbols. Every run has such a word of its period's length as a root. Each of
   these words, two a place, is a candidate, extended to both sides.

A text is worked on whole, by itself, so nothing is shuffled, and a lost executor's texts are done
again. Memory grows with the longest text.

Null or empty text has no words and no runs. Ids may be null or repeat: every row is looked at by
itself. Of equal exponents the run that starts first counts as greatest, then the shorter period;
exponents are compared as fractions. Extra columns are ignored. An empty table gives no rows.
"""

from collections.abc import Iterator
from functools import cmp_to_key
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.suffix_tree import CommonExtension, SuffixTree, ranks
from kerbside.llm.words import _STEP, mix, text_slices, words_of

Run = tuple[int, int, int]


def lyndon_lengths(place: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word from every place: up to the next smaller suffix.

    ``place`` ranks all suffixes, the empty one last in position and first in rank.
    """
    lengths, stack = np.empty(len(place) - 1, np.int64), []
    for at, rank in enumerate(place.tolist()):
        while stack and stack[-1][1] > rank:
            start, _ = stack.pop()
            lengths[start] = at - start
        stack.append((at, rank))
    return lengths


def runs_of(symbols: list[int], min_length: int = 24, exponent: int = 3) -> list[Run]:
    """(start, length, period) of all runs of a sequence of numbers from 0, by start, then period."""
    size = len(symbols)
    if size < max(2, min_length):
        return []
    tree = SuffixTree(symbols)
    suffixes, depths = tree.tour()
    right = CommonExtension(suffixes, depths)
    orders = [right.place, ranks(tree.tour(falling=True)[0])]
    del tree
    left = CommonExtension(*SuffixTree(symbols[::-1]).tour())
    places = np.arange(size)
    found = []
    for order in orders:
        period = lyndon_lengths(order)
        end = places + period
        # Suffix ``size - p`` of the reversal is the text before place ``p``, read backwards.
        start = places - left(size - places, size - end)
        found.append(np.stack([start, period, end + right(places, end) - start], 1))
    runs = np.concatenate(found)
    long = runs[:, 2] >= np.maximum(min_length, exponent * runs[:, 1])
    return [(at, length, period) for at, period, length in np.unique(runs[long], axis=0).tolist()]


def repeated_pieces(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of pieces covered by stretches of ``width`` words that their row repeats."""
    count = len(hashes) - width + 1
    if count < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Hash of a stretch from those of its two halves, and so on; bits of ``width`` from the top.
    run, held, power = hashes.copy(), 1, np.full(1, _STEP)
    for bit in bin(width)[3:]:
        run = run[: len(run) - held] * power + run[held:]
        held, power = 2 * held, power * power
        if bit == "1":
            run = run[:-1] * _STEP + hashes[held:][: len(run) - 1]
            held, power = held + 1, power * _STEP
    inside = np.flatnonzero(rows[:count] == rows[width - 1 :])
    keys = mix(mix(run[inside]) + rows[inside].astype(np.uint64))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(order), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    change = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(change, inside[again], 1)
    np.add.at(change, inside[again] + width, -1)
    covered = np.cumsum(change)[:-1] > 0
    # A piece ends where its row does.
    edge = np.append(True, rows[1:] != rows[:-1])
    start = np.flatnonzero(covered & (edge | ~np.append(False, covered[:-1])))
    end = np.flatnonzero(covered & (np.append(edge[1:], True) | ~np.append(covered[1:], False))) + 1
    return start, end


def looped_order(doc_id: int | None, size: int) -> np.ndarray | None:
    """Which word stands at each place of a document that is made periodic from some word on.

    The rule goes by a checksum of the id: one id in ten. None leaves the words as they are.
    """
    check = 1 if doc_id is None else crc32(str(doc_id).encode())
    if check % 10 or not size:
        return None
    rest = check // 10
    start = rest % size
    period = 1 + (size - start) // (3 + rest % 8)
    order = np.arange(size)
    order[start:] = start + (order[start:] - start) % period
    return order


def _greater(first: Run, second: Run) -> int:
    """Order of runs: the greatest exponent first, as a fraction; then start and period."""
    by_exponent = second[1] * first[2] - first[1] * second[2]
    return by_exponent or first[0] - second[0] or first[2] - second[2]


def _within(words: list[bytes], pieces: list[tuple[int, int]], min_length: int, exponent: int) -> list[Run]:
    found = []
    for start, end in pieces:
        number: dict[bytes, int] = {}
        symbols = [number.setdefault(word, len(number)) for word in words[start:end]]
        found += [(start + at, length, period) for at, length, period in runs_of(symbols, min_length, exponent)]
    return found


def _collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]


def _scanner(min_length: int, exponent: int, loops: bool):
    # The shortest stretch that a run must hold twice: what exceeds one of its periods.
    width = ceil(min_length - min_length / exponent)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for text in text_slices(batch.column(1)):
                split = words_of(text, lower=False)
                bounds = np.searchsorted(split.row, np.arange(len(text) + 1))
                hashes, orders = split.hash.copy(), {}
                if loops:
                    for row in range(len(text)):
                        size = int(bounds[row + 1] - bounds[row])
                        order = looped_order(ids[text.first + row], size)
                        if order is not None:
                            orders[row] = order
                            hashes[bounds[row] : bounds[row + 1]] = split.hash[bounds[row] + order]
                pieces: dict[int, list[tuple[int, int]]] = {}
                for start, end in zip(*repeated_pieces(hashes, split.row, width)):
                    row = int(split.row[start])
                    pieces.setdefault(row, []).append((int(start - bounds[row]), int(end - bounds[row])))
                runs, collapsed = [], []
                for row in range(len(text)):
                    words = text.data[text.starts[row] : text.ends[row]].tobytes().split()
                    if row in orders:
                        words = [words[i] for i in orders[row]]
                    runs.append(_within(words, pieces.get(row, []), min_length, exponent))
                    left = _collapsed(words, runs[-1]) if runs[-1] else words
                    collapsed.append(b" ".join(left).decode("utf-8", "replace"))
                flat = [run for found in runs for run in found]
                inner = pa.StructArray.from_arrays(
                    [pa.array([run[i] for run in flat], pa.int64()) for i in range(3)],
                    names=["start", "length", "period"],
                )
                ends = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
                best = [min(found, key=cmp_to_key(_greater)) if found else None for found in runs]
                best = pa.array(
                    [None if run is None else dict(zip(("start", "length", "period"), run)) for run in best],
                    pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(text.first, len(text)),
                        pa.ListArray.from_arrays(ends, inner),
                        best,
                        pa.array(collapsed, pa.string()),
                    ],
                    names=["doc_id", "runs", "best", "collapsed"],
                )

    return scan


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 24,
    exponent: int = 3,
    loops: bool = False,
) -> DataFrame:
    """Per row: ``doc_id``, ``runs`` by start and period, the greatest as ``best``, and ``collapsed``.

    Words stand between white space of ASCII. ``collapsed`` is the text with one period of each run,
    its words joined by single blanks. ``loops`` makes the text of one id in ten periodic first, by
    ``looped_order``.
    """
    if exponent < 2 or min_length < 2 * exponent:
        raise ValueError("exponent is 2 at least, min_length twice that")
    taken = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    run = "struct<start: bigint, length: bigint, period: bigint>"
    schema = f"doc_id bigint, runs array<{run}>, best {run}, collapsed string"
    return taken.mapInArrow(_scanner(min_length, exponent, loops), schema)


def runs_digest(found: DataFrame) -> DataFrame:
    """Number of runs, the greatest one, and digests of all runs and of the collapsed text."""
    line = F.transform(
        "runs", lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n"))
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
