import re

import pytest
from texts import empty, frame, invented, odd

import duckdb
from compare import differences

from kerbside.llm import licenses
from kerbside.llm.licenses import PHRASES, TEMPLATES, candidates, oracle, parse_template, scan_licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_force(text):
    words = WORD.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                starts.append(i)
                labels.add(label)
    first_last = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *first_last, ",".join(sorted(labels))


def base(row):
    return (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"])


def test_base_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = scan_licenses(docs).collect()
    assert {r["doc_id"]: base(r) for r in got} == {i: brute_force(t) for i, t in texts.items()}


def test_hand_made_texts(spark):
    texts = [
        "MIT License mit-license MITLicense mit  license",
        "The Apache\nLicense; version 2.0 and the GNU general PUBLIC license",
        "mit apache license general public",
        "Straße mit license ünder İ license",
        "license mit general general public license",
    ]
    got = {r["doc_id"]: base(r) for r in scan_licenses(frame(spark, texts)).collect()}
    assert got == {i: brute_force(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("number", range(len(TEMPLATES)))
def test_templates_parse(number):
    template = parse_template(*TEMPLATES[number])
    assert template.words and template.mandatory
    with pytest.raises(ValueError):
        parse_template("x", " ".join(f"word{i}" for i in range(64)))


def test_templates_are_found_in_place_and_only_with_their_key_phrases(spark):
    def plain(number):
        return TEMPLATES[number][1].replace("[", "").replace("]", "").upper()

    texts = [f"{invented(i)}\n{plain(i)}. {invented(50 + i)}" for i in range(len(TEMPLATES))]
    texts += ["licensed under software this work is subject to the terms of the public"]
    texts += [plain(0) + " " + plain(7), "cc " + invented(3) + " by nc 4 licensed under"]
    got = {r["doc_id"]: r for r in scan_licenses(frame(spark, texts)).collect()}
    for i, (label, _) in enumerate(TEMPLATES):
        assert label in got[i]["labels"].split(",")
        assert got[i]["score"] == 1.0
    assert [got[i]["labels"] for i in (0, 2, 7, 9, 10)] == ["mit", "apache", "cc-by-nc", "cc-by", "bsd"]
    n = len(TEMPLATES)
    assert (got[n]["labels"], got[n]["score"]) == ("", 0.0)
    assert got[n + 1]["labels"] == "cc-by-nc,mit"
    assert got[n + 2]["labels"] == ""


def test_a_file_of_all_templates_keeps_every_label(spark):
    plain = [text.replace("[", "").replace("]", "") for _, text in TEMPLATES]
    grant = plain[1] + ". licensed under CC BY SA 4"
    # The grant's words are the rarer ones over all files.
    common = ["licensed under cc by sa 4 and by sa cc"] * 5
    stray = " ".join(reversed(" ".join(plain).split()))
    texts = [". ".join(plain), f"{stray}. {plain[8]}", grant, *common]
    got = {r["doc_id"]: r for r in scan_licenses(frame(spark, texts)).collect()}
    assert got[0]["labels"] == ",".join(sorted({label for label, _ in TEMPLATES}))
    assert "cc-by-sa" in got[1]["labels"].split(",")
    assert got[2]["labels"] == "cc-by-sa,mit"


def mixed_files():
    """All templates at once, single ones, parts of them, and words of theirs out of place."""
    plain = [text.replace("[", "").replace("]", "") for _, text in TEMPLATES]
    stray = " ".join(reversed(" ".join(plain).split()))
    texts = [". ".join(plain), f"{stray}. {plain[8]}", plain[1] + ". licensed under CC BY SA 4", *plain]
    texts += [" ".join(text.split()[2:]) for text in plain] + [f"{a} {b}" for a, b in zip(plain, plain[1:])]
    return texts + [" ".join([plain[0], invented(1), plain[0].replace("mit", "x")]), "mit license " * 40, "", None]


def test_matches_sql_on_files_of_many_licences(spark, tmp_path):
    docs = frame(spark, mixed_files())
    docs.write.parquet(f"{tmp_path}/documents")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert differences(scan_licenses(docs), db, oracle()) == []


def test_rare_words_choose_candidates_and_no_labels(spark):
    docs = frame(spark, mixed_files() + [f"licensed under {i}" for i in range(30)] + ["by cc 4 nc"] * 9)
    parsed = [parse_template(*entry) for entry in TEMPLATES]
    files = licenses._files(docs, "doc_id", "text", parsed).cache()
    found, answers = [], []
    for settings in ((1, 1), (2, 2), (3, 2), (63, 1)):
        found.append(candidates(files, parsed, *settings).count())
        answers.append(sorted(map(str, scan_licenses(docs, rarest=settings[0], min_anchors=settings[1]).collect())))
    assert len(set(found)) > 2 and found[-1] == max(found)
    assert all(answer == answers[0] for answer in answers)


def test_key_phrases_outside_the_rarest_words_are_anchors(spark):
    rare = " ".join(f"rare{i}" for i in range(20))
    texts = ["key phrase here", "key phrase here", f"nothing {rare}"]
    got = scan_licenses(frame(spark, texts), templates=[("own", f"{rare} [key phrase here]")])
    assert [r["labels"] for r in got.orderBy("doc_id").collect()] == ["own", "own", ""]


def test_odd_rows(spark):
    got = scan_licenses(odd(spark)).collect()
    assert len(got) == 11
    assert all(r["n_words"] == 0 and r["labels"] == "" for r in got if r["doc_id"] in (0, 1, 2))
    assert scan_licenses(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    result = scan_licenses(frame(spark, ["mit license"]))
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text
