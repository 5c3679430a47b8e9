"""Licence scan with a positional index of rare template words.

Spark expressions only. One pass takes each file's licence words with their positions; how many
files hold each word is counted over all files.

1. The index holds, per template, only the rarest (highest-IDF) words of its mandatory key phrases.
   A file's words are looked up there, and postings are intersected by relative position (file
   position less template position): a template is a candidate at a place where enough of its
   rare words agree.
2. Files with candidates are looked up in the postings of all template words, at their candidates'
   places alone, and a template counts where all its mandatory key phrases stand.

Every place where the key phrases stand has all rare words in it, so the choice of rare words tells
how many candidates are verified and never which labels a file gets.

Null or empty text: no words, no label, score 0. A null id is kept as it is; rows with the same id
stay apart, for each row is scanned by itself. Very long texts are scanned whole. Extra columns are
ignored.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.sources import stored

# Phrases of the base scan and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Licence templates, label and text; words in brackets are mandatory key phrases.
TEMPLATES = [
    ("mit", "released under the [mit license]"),
    (
        "mit",
        "[permission is hereby granted free of charge] to any person [obtaining a copy] of this"
        " software and associated documentation files",
    ),
    ("apache", "licensed under the [apache license version 2]"),
    ("gpl", "this work is licensed under the [gnu general public license]"),
    ("lgpl", "licensed under the [gnu lesser general public license]"),
    ("agpl", "licensed under the [gnu affero general public license]"),
    ("mpl", "subject to the terms of the [mozilla public license]"),
    ("cc-by-nc", "licensed under [cc by nc 4]"),
    ("cc-by-sa", "licensed under [cc by sa 4]"),
    ("cc-by", "licensed under [cc by 4]"),
    (
        "bsd",
        "[redistribution and use in source and binary forms] with or without modification are"
        " [permitted provided that] the following conditions are met",
    ),
    (
        "isc",
        "[permission to use copy modify] and or [distribute this software] for any purpose with"
        " or without fee is hereby granted",
    ),
    (
        "unlicense",
        "this is [free and unencumbered software] released into the [public domain]",
    ),
]

# Words too common in any text to be licence words.
COMMON = set("the this is of to a and or any in with for are that into use".split())

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """Licence words of one template with their positions; bit ``i`` stands for word ``i``."""

    label: str
    words: tuple[tuple[str, int], ...]
    mandatory: int


def parse_template(label: str, text: str) -> Template:
    """A template from its text; at most 63 licence words."""
    words, mandatory, inside, position = [], 0, False, 0
    for token in text.replace("[", " [ ").replace("]", " ] ").split():
        if token in "[]":
            inside = token == "["
            continue
        if token not in COMMON:
            mandatory |= (1 << len(words)) if inside else 0
            words.append((token, position))
        position += 1
    if len(words) > 63:
        raise ValueError(f"template of {label} has more than 63 licence words")
    return Template(label, tuple(words), mandatory)


def licence_words(templates: list[Template]) -> list[str]:
    words = {word for template in templates for word, _ in template.words}
    return sorted(words | {word for phrase in PHRASES for word in phrase.split()})


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.filter(F.split(lower, _BETWEEN_WORDS), lambda word: word != "")


def _hits(words: Column, vocabulary: list[str]) -> Column:
    """Licence words with positions, in the order of the text."""
    pairs = F.transform(words, lambda word, at: F.struct(word.alias("w"), at.alias("p")))
    return F.filter(pairs, lambda pair: pair["w"].isin(vocabulary))


def _phrase_places(phrase: str) -> Column:
    """Where a phrase starts. Its words are licence words, so neighbours in the text are
    neighbours among the hits: one step per hit."""
    words = phrase.split()

    def starts(hit: Column, at: Column) -> Column:
        found = hit["w"] == words[0]
        for step, word in enumerate(words[1:], 1):
            later = F.get(F.col("hits"), at + step)
            found &= F.coalesce((later["w"] == word) & (later["p"] == hit["p"] + step), F.lit(False))
        return found

    return F.transform(F.filter("hits", starts), lambda hit: hit["p"])


def _postings(templates: list[Template], held: list[int] | None = None) -> Column:
    """word -> [(template, position, bit)] as a literal; bounded by the template list. Only words with
    their bit in ``held`` if that is given."""
    by_word: dict[str, list[Column]] = {}
    for number, template in enumerate(templates):
        for i, (word, position) in enumerate(template.words):
            if held is not None and not held[number] >> i & 1:
                continue
            entry = F.struct(
                F.lit(number).alias("t"),
                F.lit(position).alias("q"),
                F.lit(1 << i).cast("long").alias("bit"),
            )
            by_word.setdefault(word, []).append(entry)
    pairs = [part for word, found in by_word.items() for part in (F.lit(word), F.array(*found))]
    return F.create_map(*pairs)


def _files(docs: DataFrame, id_col: str, text_col: str, parsed: list[Template]) -> DataFrame:
    """Every file with the number of its words, and its licence words with their positions."""
    taken = docs.select(F.col(id_col).alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    return taken.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _hits(F.col("words"), licence_words(parsed)).alias("hits"),
    )


def _rare(template: Template, rank: dict[str, int], rarest: int) -> int:
    """Bits of the rarest words of a template's key phrases; of all its words if it has none."""
    places = [i for i in range(len(template.words)) if template.mandatory >> i & 1]
    places = places or list(range(len(template.words)))
    return sum(1 << i for i in sorted(places, key=lambda i: (rank[template.words[i][0]], i))[:rarest])


def _looked_up(hits: DataFrame, postings: Column) -> DataFrame:
    """``row``, template ``t``, place ``at`` and word ``bit`` of every posting of some licence words."""
    posted = hits.select("row", F.col("hit.p").alias("p"), F.explode(F.element_at(postings, F.col("hit.w"))).alias("post"))
    return posted.select("row", "post.t", (F.col("p") - F.col("post.q")).alias("at"), "post.bit")


def candidates(files: DataFrame, parsed: list[Template], rarest: int, min_anchors: int) -> DataFrame:
    """``row``, ``t`` and ``at`` where enough rare words of a template agree on a position."""
    # Files per licence word, over all files: as many rows as the templates have words.
    held = files.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w"))
    files_with = {r["w"]: r["n"] for r in held.groupBy("w").agg(F.count("*").alias("n")).collect()}
    ranked = sorted(licence_words(parsed), key=lambda word: (files_with.get(word, 0), word))
    rank = {word: i for i, word in enumerate(ranked)}
    rare = [_rare(template, rank, rarest) for template in parsed]
    words = sorted({w for t, bits in zip(parsed, rare) for i, (w, _) in enumerate(t.words) if bits >> i & 1})
    hits = files.select("row", F.explode(F.filter("hits", lambda hit: hit["w"].isin(words))).alias("hit"))
    needed = F.element_at(F.array(*[F.lit(min(min_anchors, bits.bit_count())) for bits in rare]), F.col("t") + 1)
    agreed = _looked_up(hits, _postings(parsed, rare)).groupBy("row", "t", "at").agg(F.bit_or("bit").alias("mask"))
    return agreed.filter(F.bit_count("mask") >= needed).select("row", "t", "at")


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: list[tuple[str, str]] | None = None,
    rarest: int = 3,
    min_anchors: int = 2,
) -> DataFrame:
    """Base phrases and licences of every file.

    ``rarest`` is how many highest-IDF words of each template's key phrases are looked up, ``min_anchors`` how
    many of them must agree on one position (all, where there are fewer). ``score`` is the largest
    share of a verified template's licence words found in place, 0.5 at least where a base phrase
    stands.
    """
    parsed = [parse_template(*entry) for entry in (TEMPLATES if templates is None else templates)]
    files = stored(_files(docs, id_col, text_col, parsed), "licence-words")
    chosen = stored(candidates(files, parsed, rarest, min_anchors), "licence-candidates")
    hits = files.join(chosen.select("row").distinct(), "row", "left_semi").select("row", F.explode("hits").alias("hit"))
    votes = (
        _looked_up(hits, _postings(parsed))
        .join(chosen, ["row", "t", "at"], "left_semi")
        .groupBy("row", "t", "at")
        .agg(F.bit_or("bit").alias("mask"))
    )

    def per_template(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("t") + 1)

    mandatory = per_template([t.mandatory for t in parsed]).cast("long")
    share = F.bit_count("mask") / per_template([float(len(t.words)) for t in parsed])
    verified = votes.filter(F.col("mask").bitwiseAND(mandatory) == mandatory).groupBy("row").agg(
        F.collect_set(per_template([t.label for t in parsed])).alias("found"),
        F.max(share).alias("share"),
    )

    places = {label: _phrase_places(phrase) for phrase, label in PHRASES.items()}
    all_places = F.concat(*places.values())
    base = F.array_compact(
        F.array(*[F.when(F.size(at) > 0, F.lit(label)) for label, at in places.items()])
    )
    joined = files.select(
        "row", "doc_id", "n_words", all_places.alias("places"), base.alias("base")
    ).join(verified, "row", "left")
    none = F.array().cast("array<string>")
    every = F.array_union(F.col("base"), F.coalesce("found", none))
    floor = F.when(F.size("base") > 0, 0.5).otherwise(0.0)
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.greatest(floor, F.coalesce("share", F.lit(0.0))).alias("score"),
    )


def _values(rows: list[tuple]) -> str:
    written = (
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v).upper() for v in row) + ")"
        for row in rows
    )
    return ", ".join(written)


def oracle() -> str:
    """The scan in DuckDB's SQL, from the words themselves."""
    parsed = [parse_template(*entry) for entry in TEMPLATES]
    words = [
        (number, template.label, word, position, bool(template.mandatory >> i & 1))
        for number, template in enumerate(parsed)
        for i, (word, position) in enumerate(template.words)
    ]
    phrases = [
        (label, len(phrase.split()), word, step)
        for phrase, label in PHRASES.items()
        for step, word in enumerate(phrase.split())
    ]
    vocabulary = [(word,) for word in licence_words(parsed)]
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH files AS (
    SELECT row_number() OVER () AS file, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{pattern}') AS words
    FROM documents
), listed AS (
    SELECT file, unnest(words) AS word, unnest(range(len(words))) AS p FROM files
), vocabulary(word) AS (VALUES {_values(vocabulary)}),
template(t, label, word, q, needed) AS (VALUES {_values(words)}),
size AS (
    SELECT t, label, count(*) AS words, count(*) FILTER (WHERE needed) AS needed
    FROM template GROUP BY ALL
), phrase(label, words, word, step) AS (VALUES {_values(phrases)}),
hits AS (SELECT * FROM listed WHERE word IN (SELECT word FROM vocabulary)),
votes AS (
    SELECT h.file, t.t, count(DISTINCT q) AS found, count(DISTINCT q) FILTER (WHERE needed) AS needed
    FROM hits h JOIN template t USING (word) GROUP BY h.file, t.t, h.p - t.q
), verified AS (
    SELECT file, label, max(found / words) AS share FROM votes v JOIN size s USING (t)
    WHERE v.needed = s.needed GROUP BY file, label
), places AS (
    SELECT file, label, p - step AS start FROM hits JOIN phrase USING (word)
    GROUP BY file, label, p - step, words HAVING count(DISTINCT step) = words
), base AS (
    SELECT file, count(*) AS n, min(start) AS first_word, max(start) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM places GROUP BY file
), every AS (
    SELECT file, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS share
    FROM (SELECT file, label, 0.5::DOUBLE AS share FROM places
          UNION ALL SELECT file, label, share FROM verified)
    GROUP BY file
)
SELECT doc_id, CAST(len(f.words) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base,
       b.first_word, b.last_word, coalesce(b.labels, '') AS base_labels,
       coalesce(e.labels, '') AS labels, coalesce(e.share, 0.0)::DOUBLE AS score
FROM files f LEFT JOIN base b USING (file) LEFT JOIN every e USING (file)
"""
