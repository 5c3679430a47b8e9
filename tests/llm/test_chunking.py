import random

import numpy as np
import pyarrow as pa
import pytest
from texts import empty, frame, invented, odd

from kerbside.llm.chunking import cuts, passage_digest, repeated_passages, without_repeats
from kerbside.llm.words import text_slices


def chunks(text):
    data = text.encode()
    return [
        data[start:end]
        for part in text_slices(pa.array([text]))
        for start, end in zip(*(x.tolist() for x in cuts(part)))
    ]


@pytest.mark.parametrize("text", ["", "x", "ab" * 500, invented(1, 3000), "é" * 300, "\n" * 100])
def test_chunks_join_to_the_text(text):
    assert b"".join(chunks(text)) == text.encode()
    assert all(16 <= len(chunk) < 80 for chunk in chunks(text)[:-1])


def test_texts_of_a_slice_are_cut_apart():
    texts = [invented(i, 40) for i in range(30)] + ["", "a", None]
    whole = []
    for limit in (1, 500, 1 << 20):
        found = []
        for part in text_slices(pa.array(texts), limit):
            found += [part.data[a:b].tobytes() for a, b in zip(*cuts(part))]
        whole.append(found)
    assert whole[0] == whole[1] == whole[2]
    assert whole[0] == [chunk for text in texts if text for chunk in chunks(text)]


def test_an_insertion_moves_few_chunks():
    text = invented(7, 2000)
    before, after = set(chunks(text)), set(chunks(text[:5000] + "inserted words" + text[5000:]))
    assert len(before - after) <= 6


@pytest.fixture(scope="module")
def planted(spark):
    """Passages of 50 to 120 words in two to five documents each, among clean ones."""
    pick, texts, holders, passages = random.Random(3), [], set(), []
    for p in range(40):
        passage = invented(10_000 + p, pick.randrange(50, 120), 10**9)
        passages.append(passage)
        for _ in range(pick.randrange(2, 6)):
            holders.add(len(texts))
            before = invented(len(texts), pick.randrange(0, 60), 10**9)
            texts.append(f"{before} {passage} {invented(10**6 + len(texts), 40, 10**9)}")
    line = "the same short line ends every one of these documents"
    texts += [f"{invented(5000 + i, 80, 10**9)}\n{line}" for i in range(100)]
    return frame(spark, texts), texts, holders, passages


def test_planted_passages_are_found_and_clean_documents_are_not(spark, planted):
    docs, texts, holders, _ = planted
    got = {r["doc_id"]: r for r in passage_digest(repeated_passages(docs)).collect()}
    assert set(got) <= holders
    assert len(got) >= 0.97 * len(holders)
    for i, row in got.items():
        data = texts[i].encode()
        for span in row["passages"].split(","):
            start, end = map(int, span.split(":"))
            inside = data[start:end]
            assert sum(inside in other.encode() for other in texts) > 1


def test_one_occurrence_of_each_passage_is_kept(spark, planted):
    docs, texts, holders, passages = planted
    kept = {r["doc_id"]: r["text"] for r in without_repeats(docs).collect()}
    assert all(kept[i] == texts[i] for i in range(len(texts)) if i not in holders)
    for passage in passages:
        middle = passage[len(passage) // 2 - 20 : len(passage) // 2 + 20]
        assert sum(middle in text for text in kept.values()) <= 2
        assert any(passage in text for text in kept.values())
    sizes = np.array([[len(kept[i]), len(texts[i])] for i in sorted(holders)]).sum(axis=0)
    assert sizes[0] < 0.75 * sizes[1]


def test_copies_and_odd_rows(spark):
    got = {r["doc"]: r for r in repeated_passages(odd(spark)).collect()}
    assert set(got) == {3, 4}
    assert got[3]["repeats"] == [] and got[4]["copies_of"] == [3]
    cut = without_repeats(odd(spark))
    assert cut.columns == odd(spark).columns and cut.count() == 11
    assert [r["text"] for r in cut.collect() if r["doc_id"] == 4] == [""]
    assert repeated_passages(empty(spark)).count() == 0 and without_repeats(empty(spark)).count() == 0


def test_repeats_within_a_document_and_among_rows_of_one_id(spark):
    passage, own = invented(77, 200, 10**9), [invented(900 + i, 60, 10**9) for i in range(9)]
    again = f"{own[0]} {passage} {own[1]} {passage} {own[2]} {passage} {own[3]}"
    texts = [again, own[4], own[4], own[5], own[5], own[6], f"{own[7]} {passage} {own[8]}"]
    docs = frame(spark, texts, ids=[0, 1, 1, None, None, 2, -5])
    found = repeated_passages(docs, every_place=True).collect()
    got = sorted((r["doc"], len(r["repeats"])) for r in found if r["doc"] in (-5, 0, 1))
    assert got == [(-5, 0), (0, 3), (1, 0), (1, 1)]
    assert sorted(len(r["repeats"]) for r in found if r["doc"] not in (-5, 0, 1)) == [0, 1]
    kept = [r["text"] for r in without_repeats(docs).collect()]
    middle = passage[len(passage) // 2 - 20 : len(passage) // 2 + 20]
    assert sum(text.count(middle) for text in kept) == 1
    assert sorted(len(text) < 30 for text in kept) == [False] * 5 + [True] * 2

    alone = without_repeats(docs.filter("doc_id = 0")).first()["text"]
    assert alone.count(middle) == 1 and alone.startswith(f"{own[0]} {passage}")
    more = {r["doc"] for r in repeated_passages(odd(spark), every_place=True).collect()}
    assert more == {3, 4, 6}
