import hashlib
import random

import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from texts import empty, odd
from tokenizers import Tokenizer

from kerbside.llm.bpe import (
    Vocabulary,
    WordBpe,
    decode_documents,
    encode_documents,
    token_digests,
)

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return WordBpe(file.read())


def check(own, library, texts):
    expected = library.encode_batch(texts, add_special_tokens=False)
    for text, ids, want in zip(texts, own.encode(texts), expected):
        assert list(memoryview(ids).cast("I")) == want.ids, text
        assert own.decode(ids) == library.decode(want.ids, skip_special_tokens=False), text


def test_documents_like_the_library(own, library, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(own, library, [row["text"] or "" for row in docs.select("text").collect()])


def test_joined_vocabulary_words(own, library):
    words = [text.replace("</w>", "") for text in library.get_vocab()]
    pick = random.Random(1)
    check(own, library, [a + b for a, b in zip(words, pick.sample(words, len(words)))])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cn")), max_size=60))
def test_any_text(own, library, text):
    check(own, library, [text])


def test_special_cases(own, library):
    texts = ["", " ", "<|endoftext|>a<|startoftext|>", "ΑΣ ΣΑΣ", "I'Ll it's", "é ẛ̣", "a" * 9000]
    check(own, library, texts + ["՘a", "\x1c\x85\xa0x", "12 34٣", "!!??a"])


def test_memory_limits_change_nothing(own, library, monkeypatch):
    from kerbside.llm import bpe

    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 3)
    monkeypatch.setattr(bpe, "REMEMBERED_PAIRS", 3)
    for text in ("the cat sat", "on the mat the", "cat sat on the hat"):
        check(own, library, [text])


def test_frames(spark, library):
    docs, vocabulary = odd(spark), Vocabulary(spark, PATH)
    digests = token_digests(docs, vocabulary)
    assert digests.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = sorted(map(str, digests.collect()))
    expected = []
    for row in docs.select("doc_id", "text").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((row["doc_id"], len(ids), *(hashlib.sha256(x).hexdigest() for x in (packed, text.encode()))))
    rows = spark.createDataFrame(expected, digests.schema)
    assert got == sorted(map(str, rows.collect()))
    back = decode_documents(encode_documents(docs, vocabulary), vocabulary)
    assert back.filter(F.col("decoded").isNull()).count() == 0
    assert token_digests(empty(spark), vocabulary).count() == 0


def test_another_file_is_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        with pytest.raises((ValueError, KeyError)):
            WordBpe(file.read())


def test_every_code_point_is_lower_cased_like_the_library(own, library):
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    points = [c for c in points if not regex.match(r"\p{White_Space}", c)]
    for start in range(0, len(points), 4096):
        text = "a".join(points[start : start + 4096])
        assert own.lowered(text) == library.normalizer.normalize_str(text)


def test_long_words_take_time_in_proportion(own):
    from time import perf_counter

    def seconds(size):
        start = perf_counter()
        ids = own.encode(["ab" * (size // 2) + "x" * size])
        assert ids[0]
        return perf_counter() - start

    seconds(1000)
    assert seconds(160_000) < 12 * max(seconds(20_000), 0.05)
