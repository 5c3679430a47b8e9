"""Personal data: fixed patterns as seeds, and bootstrapped contextual extraction.

Seeds are the spans of four fixed patterns (email, ip, card, phone). The word and the two words
before a seed, and the word and the two words after it, are its lexical patterns, in lower case and
with every digit read as 0, so that "line 12:" and "line 47:" are one. How often each pattern
occurs at all is counted over every text, so a pattern's score is the share of its occurrences that
stand beside a known identifier. Tokens with a digit or an at sign that no fixed pattern covers are
instances without a kind; patterns and instances form a graph, on which Spark passes scores to and
fro for some rounds. The two sides are two views: an instance lends a pattern only what patterns of
the other side have lent it, so no pattern confirms itself. Tokens beside a high-confidence pattern
are added to the spans, with the kind of their best one; the seeds always stay. A token goes on
over groups of digits that single blanks, dots or dashes join, and has five characters at least
and no greatest length; its patterns are read up to the second word, however far that lies.

Null or empty text has no spans. Very long texts are scanned whole. Ids may be null or repeat: every row is scanned by itself. Extra
columns are ignored; ``redact`` keeps them.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.words import _STEP, hash_spans, mix, text_slices, words_of
from kerbside.sources import stored

KINDS = ("email", "ip", "card", "phone")

# The patterns. The lookbehind saves starts that cannot match: a number is taken
# from its first digit or not at all.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){15,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_GAP = re.compile(r"\s")
_EDGE = "\"'`.,;:!?()[]{}<>"

# A group of digits after one blank goes on with the token before it.
_MORE_DIGITS = re.compile(r" [0-9]+(?:[.-][0-9]+)*(?![^\s\"'`.,;:!?()\[\]{}<>])")

# Bits of the filter on pattern hashes, and characters read for a pattern's two words at first.
FILTER_BITS, REACH = 20, 200
# Patterns that a task counts before it hands them on.
HELD_PATTERNS = 1 << 17

# Words of patterns: A-Z in lower case, digits as 0.
_FORM = np.arange(256, dtype=np.uint8)
_FORM[65:91] += 32
_FORM[48:58] = 48
_FORM_BYTES = _FORM.tobytes()

# Fixed value: an unseen identifier has five characters at least.
SHORTEST = 5

_SPAN = "array<struct<kind: int, start: int, end: int>>"
_SLOT = "array<struct<patterns: array<bigint>, instance: string, kind: int, start: int, end: int>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each at sign with the longest local part before it that no earlier match has taken."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        free = max(free, at + 1) if not domain else free
        at = text.find("@", max(free, at + 1))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns: by kind, then start; code points."""
    spans = [(0, start, end) for start, end in _emails(text)]
    if _SIGN.search(text):
        for match in _IP.finditer(text):
            parts = [part.lstrip("0") for part in match.group().split(".")]
            if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
                spans.append((1, *match.span()))
        for match in _CARD.finditer(text):
            digits = match.group().replace(" ", "").replace("-", "")
            if len(digits) <= 19 and _luhn(digits):
                spans.append((2, *match.span()))
        if "+" in text:
            for match in _PHONE.finditer(text):
                if 8 <= sum(map(str.isdigit, match.group())) <= 15:
                    spans.append((3, *match.span()))
    return spans


def _words_before(text: str, start: int) -> list[bytes]:
    """The last two words before a place that follows white space, however far back."""
    if start == 0 or not text[start - 1].isspace():
        return []
    reach = REACH
    while True:
        data = text[max(0, start - reach) : start].encode("utf-8", "replace")
        words = data.split()
        # The first word of a part of the text may be the end of a longer one.
        if start <= reach or len(words) > 2:
            return words[-2:] if data[-1:].isspace() else []
        reach *= 4


def _words_after(text: str, end: int) -> list[bytes]:
    """The first two words after a place, past punctuation at its edge, however far on."""
    while end < len(text) and text[end] in _EDGE:
        end += 1
    reach = REACH
    while True:
        data = text[end : end + reach].encode("utf-8", "replace")
        words = data.split()
        if end + reach >= len(text) or len(words) > 2:
            return words[:2] if data[:1].isspace() else []
        reach *= 4


def _patterns_of(words: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
    """The patterns of one word and of two of a side (0 before, 1 after), from word hashes in order."""
    pairs = words[:-1] * _STEP + words[1:]
    one, two = (mix(hashes + np.uint64(2 * side + i)) for i, hashes in enumerate((words, pairs)))
    return one.view(np.int64), two.view(np.int64)


def _patterns_beside(text: str, start: int, end: int) -> list[int | None]:
    """The patterns of a place: one word and two before it, one word and two after it."""
    found: list[int | None] = []
    for side, words in enumerate((_words_before(text, start), _words_after(text, end))):
        if not words:
            found += [None, None]
            continue
        joined = np.frombuffer(b" ".join(words).translate(_FORM_BYTES), np.uint8)
        ends = np.cumsum([len(word) + 1 for word in words]) - 1
        hashes = hash_spans(joined, ends - [len(word) for word in words], ends)
        one, two = _patterns_of(hashes, side)
        found += [int(one[-1 if side == 0 else 0]), int(two[0]) if len(two) else None]
    return found


def _slots(text: str, spans: list[tuple[int, int, int]]) -> list[tuple]:
    """Seeds and untyped tokens (kind -1) with the patterns beside them."""
    taken = sorted((start, end, kind) for kind, start, end in spans)
    found = [(text[start:end].lower(), kind, start, start, end) for start, end, kind in taken]
    at, i = 0, 0
    while match := _SIGN.search(text, at):
        place = match.start()
        while i < len(taken) and taken[i][1] <= place:
            i += 1
        if i < len(taken) and taken[i][0] <= place:
            at = taken[i][1]
            continue
        start = place
        while start > at and not text[start - 1].isspace():
            start -= 1
        gap = _GAP.search(text, place)
        at = gap.start() if gap else len(text)
        while more := _MORE_DIGITS.match(text, at):
            at = more.end()
        if i < len(taken) and taken[i][0] < at:
            at = taken[i][0]
            continue
        token = text[start:at]
        left = start + len(token) - len(token.lstrip(_EDGE))
        token = token.strip(_EDGE)
        if len(token) >= SHORTEST:
            found.append((token.lower(), -1, start, left, left + len(token)))
    slots = []
    for instance, kind, after, start, end in found:
        patterns = _patterns_beside(text, after, end)
        if any(pattern is not None for pattern in patterns):
            slots.append((patterns, instance, kind, start, end))
    return slots


def _lists(rows: list[list[tuple]], names: list[str], kinds: list) -> pa.Array:
    """An array of lists of structs."""
    flat = [item for row in rows for item in row]
    columns = list(zip(*flat)) if flat else [()] * len(names)
    inner = pa.StructArray.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, kinds)], names=names
    )
    ends = np.cumsum([0, *map(len, rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)


_SPAN_NAMES, _SPAN_KINDS = ["kind", "start", "end"], [pa.int32()] * 3
_SLOT_NAMES = ["patterns", "instance", "kind", "start", "end"]
_SLOT_KINDS = [pa.list_(pa.int64()), pa.string(), *[pa.int32()] * 3]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            texts = [text or "" for text in part.column(2).to_pylist()]
            spans = [base_spans(text) for text in texts]
            slots = [_slots(text, found) for text, found in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[:2],
                    _lists(spans, _SPAN_NAMES, _SPAN_KINDS),
                    _lists(slots, _SLOT_NAMES, _SLOT_KINDS),
                ],
                names=["doc_id", "digest", "base", "slots"],
            )


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A stored row per document: fixed spans, and slots with their patterns."""
    taken = docs.select(
        F.col(id_col).alias("doc_id"), _digest(text_col).alias("digest"), F.col(text_col).alias("text")
    )
    kind = taken.schema["doc_id"].dataType.simpleString()
    found = taken.mapInArrow(_scan, f"doc_id {kind}, digest bigint, base {_SPAN}, slots {_SLOT}")
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "personal")


def _digest(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _counter(words_of_filter: dict[int, int]):
    bits = np.zeros(1 << FILTER_BITS, bool)
    for word, mask in words_of_filter.items():
        bits[[word * 32 + i for i in range(32) if mask >> i & 1]] = True

    def written(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
            names=["pattern", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task adds up its slices and hands on what it holds whenever that is many patterns.
        held: Counter = Counter()
        for batch in batches:
            for text in text_slices(batch.column(0)):
                text.data = _FORM[text.data]
                words = words_of(text, lower=False)
                if len(words.hash) == 0:
                    continue
                adjacent = words.row[1:] == words.row[:-1]
                for side in (0, 1):
                    one, two = _patterns_of(words.hash, side)
                    for seen in (one, two[adjacent]):
                        place = seen.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
                        patterns, counts = np.unique(seen[bits[place]], return_counts=True)
                        for pattern, n in zip(patterns.tolist(), counts.tolist()):
                            held[pattern] += n
                if len(held) >= HELD_PATTERNS:
                    yield written(held)
                    held.clear()
        yield written(held)

    return count


def _occurrences(docs: DataFrame, text_col: str, patterns: DataFrame) -> DataFrame:
    """How often each of some patterns occurs in all texts.

    Tasks pass on only what a filter of 2**20 bits lets through; its 32,768 words are all that
    reaches the driver, however many patterns there are. The join is exact.
    """
    place = F.shiftrightunsigned("pattern", 64 - FILTER_BITS)
    words = patterns.groupBy(F.shiftright(place, 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(pattern, {64 - FILTER_BITS}) & 31 AS INT))")).alias("mask")
    )
    chosen = {row["word"]: row["mask"] for row in words.collect()}
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(
        _counter(chosen), "pattern bigint, n bigint"
    )
    return counted.groupBy("pattern").agg(F.sum("n").alias("n")).join(patterns, "pattern", "left_semi")


def _added(
    scanned: DataFrame,
    docs: DataFrame,
    text_col: str,
    rounds: int,
    confidence: float,
    support: int,
) -> DataFrame:
    """``row`` and ``added``: spans of tokens beside a high-confidence pattern."""
    slots = scanned.select("row", F.explode("slots").alias("slot")).select("row", "slot.*")
    slots = slots.select(
        "row", "instance", "kind", "start", "end", F.posexplode("patterns").alias("place", "pattern")
    ).filter("pattern IS NOT NULL")
    slots = slots.withColumn("side", F.shiftright("place", 1)).drop("place")
    edges = slots.groupBy("pattern", "side", "instance", "kind").agg(F.count("*").alias("n"))
    edges = stored(edges, "pattern-instances")
    seeds = edges.filter("kind >= 0")
    backed = seeds.groupBy("pattern", "kind").agg(F.count("*").alias("instances"))
    patterns = stored(backed.filter(F.col("instances") >= support).select("pattern").distinct(), "patterns")
    total = stored(_occurrences(docs, text_col, patterns), "pattern-counts")
    graph = edges.join(total.withColumnRenamed("n", "total"), "pattern")
    graph = stored(graph, "graph")
    # Belief of an instance in a kind, as patterns of a side are told it: 1 for seeds, else the best
    # score among its patterns of the other side.
    known = graph.filter("kind >= 0").select("instance", F.col("kind").alias("as")).distinct()
    known = known.select("instance", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"), "as")
    known = known.withColumn("belief", F.lit(1.0))
    belief = known
    for _ in range(rounds):
        shares = graph.join(belief, ["instance", "side"]).filter("kind < 0 OR kind = as")
        scores = shares.groupBy("pattern", "as").agg(
            F.least(F.sum(F.col("n") * F.col("belief")) / F.first("total"), F.lit(1.0)).alias("score")
        )
        scores = stored(scores, "pattern-scores")
        lent = graph.filter("kind < 0").join(scores, "pattern").select(
            "instance", (1 - F.col("side")).alias("side"), "as", F.col("score").alias("belief")
        )
        belief = known.unionAll(lent).groupBy("instance", "side", "as").agg(F.max("belief").alias("belief"))
        belief = stored(belief, "beliefs")
    sure = scores.filter(F.col("score") >= confidence)
    new = slots.filter("kind < 0").join(sure, "pattern")
    best = new.groupBy("row", "start", "end").agg(F.max(F.struct("score", -F.col("as"))).alias("best"))
    span = F.struct((-F.col("best").getField("col2")).alias("kind"), "start", "end")
    return best.groupBy("row").agg(F.collect_set(span).alias("added"))


def _listed(spans: str) -> Column:
    """kind:start:end by kind, then start, joined by commas."""
    names = F.array(*[F.lit(name) for name in KINDS])

    def written(span: Column) -> Column:
        return F.concat_ws(":", F.element_at(names, span["kind"] + 1), span["start"], span["end"])

    return F.array_join(F.transform(F.array_sort(spans), written), ",")


def _found(docs: DataFrame, id_col: str, text_col: str, rounds: int, confidence: float, support: int):
    scanned = _scanned(docs, id_col, text_col)
    added = stored(_added(scanned, docs, text_col, rounds, confidence, support), "added-spans")
    return scanned, added


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    confidence: float = 0.5,
    support: int = 3,
) -> DataFrame:
    """Per row: ``doc_id``, the fixed spans ``base`` and all ``spans``, sorted.

    A pattern needs ``support`` different seeds of one kind and, in the end, a score of
    ``confidence``.
    """
    scanned, added = _found(docs, id_col, text_col, rounds, confidence, support)
    every = F.concat("base", F.coalesce("added", F.array().cast(_SPAN)))
    return scanned.join(added, "row", "left").select(
        "doc_id", F.array_sort("base").alias("base"), F.array_sort(every).alias("spans")
    )


def personal_data_digest(found: DataFrame) -> DataFrame:
    """Counts by kind of the fixed spans, their digest, and all spans as text."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{name}") for i, name in enumerate(KINDS)],
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def _mask(text: str, added: list[dict]) -> str:
    """A text with its spans replaced by their kinds; of overlapping ones the first, longest."""
    spans = base_spans(text) + [(span["kind"], span["start"], span["end"]) for span in added or ()]
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*out, text[at:]])


def _masker(text_at: int):
    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                columns, added = part.columns[:-1], part.columns[-1].to_pylist()
                texts = columns[text_at].to_pylist()
                masked = [t if t is None else _mask(t, more) for t, more in zip(texts, added)]
                columns[text_at] = pa.array(masked, columns[text_at].type)
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names[:-1])

    return mask


def redact(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = 3,
    confidence: float = 0.5,
    support: int = 3,
) -> DataFrame:
    """The rows and columns of ``docs`` with every span replaced by its kind in brackets.

    Fixed spans are found again in each text; only texts with added spans have something to join.
    """
    scanned, added = _found(docs, id_col, text_col, rounds, confidence, support)
    some = scanned.join(added, "row").select("doc_id", "digest", "added")
    some = stored(some.dropDuplicates(["doc_id", "digest"]), "added-by-text")
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("key"), _digest(text_col).alias("own")
    )
    same = rows["key"].eqNullSafe(some["doc_id"]) & (rows["own"] == some["digest"])
    joined = rows.join(some, same, "left").select("row.*", "added")
    return joined.mapInArrow(_masker(docs.columns.index(text_col)), docs.schema)
