"""Byte-level BPE with word ends: encoding by a trie over distinct words, and decoding.

The distinct words of a slice of documents go into a trie. A depth-first walk gives each node the
last token of its prefix's encoding: the one token that ends there and forms a stable pair with
the last token of the prefix before it. So a prefix that many words share is worked out once, and
a word's tokens are read off along its path. A pair is stable if merging its symbols by rank gives
back just these two tokens; that is remembered per pair.

The vocabulary (a ``tokenizers`` JSON file of some 50,000 entries) is broadcast; documents stay in
the partitions they come in, so nothing is shuffled. Words already encoded are remembered up to a
fixed number and worked out again beyond it.

Null text counts as empty: no tokens. Ids may be null or repeat, rows stay as they are. Extra
columns are ignored. The file's two special tokens are recognised in the text, as by default.
Where Python's Unicode tables differ from the library's on a letter's case, the library's count.
"""

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex
from tokenizers.normalizers import Lowercase
from tokenizers.pre_tokenizers import Split

# The word pattern and the white space of the vocabulary's file.
_SPACE = r"\p{White_Space}"
_WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+"
_FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_END = "</w>"



@cache
def _unassigned() -> str:
    """A class of the code points that ``regex`` takes for letters or numbers and the Unicode
    tables of ``tokenizers``, which are older, do not. Only those that Python's tables, older
    still, leave unassigned can differ."""
    free = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")
    kind = r"[\p{L}\p{N}]"
    older = Split(Regex(kind), "removed", invert=True).pre_tokenize_str(free)
    newer = set(regex.findall(kind, free)).difference("".join(part for part, _ in older))
    ranges: list[list[int]] = []
    for point in sorted(map(ord, newer)):
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "".join(rf"\U{first:08x}-\U{end:08x}" for first, end in ranges) or r"\U0010ffff"


def _careful_word() -> str:
    """The word pattern with unassigned code points as neither letters nor numbers."""
    free = _unassigned()
    letter, number = rf"[\p{{L}}--[{free}]]", rf"[\p{{N}}--[{free}]]"
    other = rf"(?:[^{_SPACE}\p{{L}}\p{{N}}]|[{free}])"
    return rf"'s|'t|'re|'ve|'m|'ll|'d|{letter}+|{number}|{other}+"


@cache
def _lower_case() -> tuple[dict[int, str], str]:
    """What the library makes of each code point that it lower-cases, and a class of those code
    points on which Python's tables, which are older, say something else."""
    library, table, other = Lowercase(), {}, []
    for character in map(chr, range(0x110000)):
        if not 0xD800 <= ord(character) < 0xE000 and not character.isascii():
            small = library.normalize_str(character)
            if small != character:
                table[ord(character)] = small
            if small != character.lower():
                other.append(character)
    table |= {code: chr(code + 32) for code in range(65, 91)}
    return table, "".join(rf"\U{ord(character):08x}" for character in other) or r"\U0010ffff"


# Characters of text worked on at once, and words and pairs remembered by a worker.
SLICE_CHARS = 500_000
REMEMBERED_WORDS = 160_000
REMEMBERED_PAIRS = 150_000


def _byte_letters() -> dict[str, str]:
    """The letter by which vocabulary files write each byte -> that byte as a character.
    Printable bytes stand for themselves, the others take the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    letters = {chr(byte): chr(byte) for byte in printable}
    return letters | {chr(256 + i): chr(byte) for i, byte in enumerate(others)}


class WordBpe:
    """The vocabulary of one tokenizer file, with the memory of what has been worked out."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        if model["end_of_word_suffix"] != _END or split["pattern"]["Regex"] != _FILE_PATTERN:
            raise ValueError("not a BPE file with word ends and the known word pattern")
        letters = _byte_letters()
        self.token = {i: text for text, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: text for text, i in self.special.items()}
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for text, i in model["vocab"].items():
            ends = text.endswith(_END) and text != _END
            body = text[: -len(_END)] if ends else text
            if all(letter in letters for letter in body):
                (self.final if ends else self.inner)["".join(letters[c] for c in body)] = i
        self.body = {i: (body, False) for body, i in self.inner.items()}
        self.body |= {i: (body, True) for body, i in self.final.items()}
        self.width = {i: len(body) for i, (body, _) in self.body.items()}
        self.longest = max(self.width.values())
        vocab = model["vocab"]
        # (left, right) -> (rank, token), and token -> (rank, left, right).
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            parts = pair.split(" ") if isinstance(pair, str) else pair
            left, right, token = (vocab[text] for text in (*parts, "".join(parts)))
            self.merge[left, right] = (rank, token)
            self.made.setdefault(token, (rank, left, right))
        self.pattern = regex.compile(_WORD)
        self.careful_pattern = regex.compile(_careful_word(), regex.V1)
        self.unassigned = regex.compile(f"[{_unassigned()}]")
        self.small, differing = _lower_case()
        self.differs = regex.compile(f"[{differing}]")
        names = "|".join(map(regex.escape, self.special))
        self.special_pattern = regex.compile(f"({names})") if names else None
        self.stable: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, symbols: list[int]) -> list[int]:
        """Symbols merged pair by pair, lowest rank first, leftmost first."""
        symbols = list(symbols)
        while len(symbols) > 1:
            best = min(
                ((*self.merge[p], at) for at, p in enumerate(zip(symbols, symbols[1:])) if p in self.merge),
                key=lambda found: (found[0], found[2]),
                default=None,
            )
            if best is None:
                break
            symbols[best[2] : best[2] + 2] = [best[1]]
        return symbols

    def symbols(self, token: int) -> list[int]:
        body, ends = self.body[token]
        plain = [self.inner[c] for c in (body[:-1] if ends else body)]
        return [*plain, self.final[body[-1]]] if ends else plain

    def is_stable(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: stand first)."""
        pair = before << 20 | token
        answer = self.stable.get(pair)
        if answer is None:
            if before < 0:
                answer = self.merged(self.symbols(token)) == [token]
            else:
                answer = self.is_stable(-1, token) and self._stays_apart(before, token)
            self.stable[pair] = answer
        return answer

    def _stays_apart(self, left: int, right: int) -> bool:
        """Whether no merge across the border of two tokens comes before those that make them.

        Takes the two apart again from the latest merge back. The pair that then meets at the
        border must not merge before that one; at equal ranks the one further left goes first.
        """
        before = len(self.merge)
        while True:
            across = self.merge.get((left, right))
            if across is not None and across[0] < before:
                return False
            made_left, made_right = self.made.get(left), self.made.get(right)
            if made_left is not None and (made_right is None or made_left[0] > made_right[0]):
                before, left = made_left[0], made_left[2]
            elif made_right is not None:
                before, right = made_right[0] + 1, made_right[1]
            else:
                return True

    def last_token(self, tail: str, last: list[int], tokens: dict[str, int]) -> int:
        """The token that ends at the end of a prefix. ``tail`` is the prefix, or as much of its end as
        the longest token takes; ``last`` holds the states before it."""
        # There is just one, so the order is free: short tokens are the likely ones.
        stable = self.stable
        for size in range(1, len(tail) + 1):
            token = tokens.get(tail[-size:])
            if token is not None:
                answer = stable.get(last[-size] << 20 | token)
                if answer or (answer is None and self.is_stable(last[-size], token)):
                    return token
        raise RuntimeError("a word without an encoding: the vocabulary lacks a byte")

    def encode_words(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """Each word (bytes as characters) with its tokens, by one walk over their trie."""
        root: dict = {}
        for word in words:
            node = root
            for letter in word:
                node = node.setdefault(letter, {})
            node[_END] = word
        # last[d] is the state of the walk's prefix of length d; -1 stands for the empty one.
        last, stack, longest = [-1], [(0, "", root)], self.longest
        while stack:
            depth, tail, node = stack.pop()
            del last[max(depth, 1) :]
            if _END in node and depth:
                at, token, tokens = depth, self.last_token(tail, last, self.final), []
                while True:
                    tokens.append(token)
                    at -= self.width[token]
                    if at == 0:
                        break
                    token = last[at]
                yield node[_END], tokens[::-1]
            if depth and len(node) > (_END in node):
                last.append(self.last_token(tail, last, self.inner))
            if len(tail) >= longest:
                tail = tail[1:]
            stack += [(depth + 1, tail + letter, below) for letter, below in node.items() if letter != _END]

    def lowered(self, text: str) -> str:
        """A text composed and lower-cased letter by letter: a final sigma is one like any other."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        if self.differs.search(text):
            return text.translate(self.small)
        return text.replace("Σ", "σ").lower()

    def words(self, text: str, pattern: regex.Pattern) -> list[str]:
        """The words of a text; a special token is an item of its own."""
        parts = [text]
        if "<|" in text and self.special_pattern is not None:
            parts = self.special_pattern.split(text)
        found: list[str] = []
        for part in parts:
            if part in self.special:
                found.append(part)
            else:
                found += pattern.findall(self.lowered(part))
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        if len(self.stable) > REMEMBERED_PAIRS:
            self.stable.clear()
        known = self.known
        if not known:
            known.update((text, i.to_bytes(4, "little")) for text, i in self.special.items())
        words = [self.words(text, self.pattern) for text in texts]
        new = set().union(*words).difference(known)
        if any(self.unassigned.search(word) for word in new if not word.isascii()):
            words = [self.words(text, self.careful_pattern) for text in texts]
            new = set().union(*words).difference(known)
        as_bytes = {word.encode("utf-8", "surrogatepass").decode("latin-1"): word for word in new}
        for letters, tokens in self.encode_words(list(as_bytes)):
            known[as_bytes[letters]] = b"".join(i.to_bytes(4, "little") for i in tokens)
        return [b"".join(map(known.__getitem__, found)) for found in words]

    def decode(self, ids: bytes) -> str:
        """The text of ids. The file names no decoder: its tokens, joined by spaces."""
        return " ".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


_models: dict[int, WordBpe] = {}


def _model(source) -> WordBpe:
    """The worker's own model of a broadcast vocabulary, kept for its later tasks."""
    if source.id not in _models:
        _models.clear()
        _models[source.id] = WordBpe(source.value)
    return _models[source.id]


class Vocabulary:
    """A tokenizer file read on the driver and sent to every executor once."""

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        WordBpe(text)
        self.shared = _Shared(spark.sparkContext.broadcast(text), hash(text))


class _Shared:
    def __init__(self, broadcast, key: int):
        self.broadcast, self.id = broadcast, key

    @property
    def value(self) -> str:
        return self.broadcast.value


def _slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``most`` characters in all."""
    start = total = 0
    for row, length in enumerate(lengths):
        if total and total + length > most:
            yield start, row - start
            start, total = row, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths) - start


def _encoder(shared: _Shared):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
            for start, count in _slices(lengths, SLICE_CHARS):
                part = batch.slice(start, count)
                ids = model.encode(pc.fill_null(part.column(1), "").to_pylist())
                counts = pa.array([len(each) // 4 for each in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), counts, pa.array(ids, pa.binary())],
                    names=["doc_id", "n_tokens", "ids"],
                )
            pa.default_memory_pool().release_unused()

    return encode


def _decoder(shared: _Shared):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            for start, count in _slices(lengths, 2 * SLICE_CHARS):
                part = batch.slice(start, count)
                texts = [model.decode(ids or b"") for ids in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())],
                    names=[*part.schema.names, "decoded"],
                )

    return decode


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = taken.schema["doc_id"].dataType.simpleString()
    return taken, f"doc_id {kind}, n_tokens long, ids binary"


def encode_documents(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (binary, little-endian unsigned 32-bit)."""
    taken, schema = _texts(docs, id_col, text_col)
    return taken.mapInArrow(_encoder(vocabulary.shared), schema)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of ``encode_documents`` with ``decoded``, the text of their ids."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids binary, decoded string"
    rows = encoded.select("doc_id", "n_tokens", "ids")
    return rows.mapInArrow(_decoder(vocabulary.shared), schema)


def encode_and_decode(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Both in one worker, which then holds the vocabulary once."""
    encode, decode = _encoder(vocabulary.shared), _decoder(vocabulary.shared)
    taken, schema = _texts(docs, id_col, text_col)
    return taken.mapInArrow(lambda batches: decode(encode(batches)), f"{schema}, decoded string")


def token_digests(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: tokens, and the SHA-256 of its ids and of the text decoded from them."""
    return encode_and_decode(docs, vocabulary, id_col, text_col).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"),
    )
