"""License scans by a positional rare-token index, in DataFrame functions only.

Each template is a phrase with a label. Document frequencies of the template words, counted over all texts, give the
``RAREST`` words of each phrase with the highest idf: its index words, with their offsets in the phrase. (A text that holds a phrase
holds all its words, so these are also the highest-idf words of the phrase in that text.) A text's index words are looked up; each
place of one yields where the phrase would start, and the starts that all index words of a phrase agree on are the intersection
of its postings by relative position. The words from there are compared with the whole phrase. A
template may need further phrases, its mandatory key phrases, somewhere in the text before its label counts.

Defined cases: a null text is empty and has no words; ties of rarity go to the earlier word of the phrase; equal rows give equal rows;
an empty table gives no rows; extra columns are dropped, so their names cannot clash.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the words: ASCII letters and digits and all that is not ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


#: Index words of a phrase.
RAREST = 2


class Template(NamedTuple):
    phrase: str
    label: str
    base: bool = False
    needs: tuple[str, ...] = ()


#: Base phrases first; the label "" marks a phrase that only others need.
TEMPLATES = (
    Template("under the mit license", "mit", True),
    Template("apache license version 2", "apache-2", True),
    Template("cc by nc", "cc-by-nc", True),
    Template("permission is hereby granted free of charge", "mit", needs=("without warranty of any kind",)),
    Template("without warranty of any kind", ""),
    Template("spdx license identifier mit", "mit"),
    Template("spdx license identifier apache 2 0", "apache-2"),
    Template("www apache org licenses license 2 0", "apache-2"),
    Template("creative commons attribution noncommercial", "cc-by-nc"),
    Template("gnu general public license", "gpl"),
    Template("gnu lesser general public license", "lgpl"),
    Template("mozilla public license", "mpl"),
    Template("redistribution and use in source and binary forms", "bsd", needs=("with or without modification",)),
    Template("with or without modification", ""),
    Template("licensed under the apache license version 2 0", "apache-2", needs=("limitations under the license",)),
    Template("limitations under the license", ""),
    Template("permission to use copy modify and or distribute this software for any purpose", "isc", needs=("the software is provided as is",)),
    Template("the software is provided as is", ""),
    Template("this software is provided as is without any express or implied warranty", "zlib", needs=("this notice may not be removed or altered",)),
    Template("this notice may not be removed or altered", ""),
    Template("this is free and unencumbered software released into the public domain", "unlicense"),
    Template("subject to the terms of the mozilla public license v 2 0", "mpl"),
    Template("it under the terms of the gnu general public license", "gpl"),
    Template("it under the terms of the gnu lesser general public license", "lgpl"),
    Template("gnu affero general public license", "agpl"),
    Template("creative commons zero", "cc0"),
)


def words_of(text: Column) -> Column:
    """The words of a text in their own case."""
    return F.filter(F.split(F.coalesce(text.cast("string"), F.lit("")), SEPARATORS), lambda w: w != "")


def _ascii_lower(w: Column) -> Column:
    return F.translate(w, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_idf(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> dict[str, float]:
    """Inverse document frequency of each template word over all texts; the driver gets one row per such word."""
    vocabulary = sorted({w for t in templates for w in t.phrase.split()})
    # lower() also maps some letters beyond ASCII; that only matters for a frequency
    present = F.array_intersect(F.transform(words_of(F.col("text")), F.lower), F.array(*map(F.lit, vocabulary)))
    rows = docs.select(F.explode(F.array_append(present, F.lit(""))).alias("word")).groupBy("word").count().collect()
    found = {r["word"]: r["count"] for r in rows}
    n = found.pop("", 0)
    return {w: math.log((n + 1) / (found.get(w, 0) + 1)) for w in vocabulary}


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """doc_id, n_words, places (template number and first word of each verified phrase)."""
    idf = word_idf(docs, templates)
    postings = []
    for k, t in enumerate(templates):
        phrase = t.phrase.split()
        postings.append((k, phrase, sorted(range(len(phrase)), key=lambda i: (-idf[phrase[i]], i))[:RAREST]))
    keys = sorted({phrase[i] for _, phrase, at in postings for i in at})
    words = docs.select("doc_id", words_of(F.col("text")).alias("w"))
    # lower() also maps some letters beyond ASCII; the word itself is told exactly
    hit = lambda x, i: F.when(F.lower(x).isin(keys), F.struct(i.alias("at"), _ascii_lower(x).alias("word")))
    words = words.select("doc_id", "w", F.filter(F.transform("w", hit), lambda h: h.isNotNull()).alias("hits"))

    def starts(phrase: list[str], i: int) -> Column:
        return F.transform(F.filter("hits", lambda h: h["word"] == phrase[i]), lambda h: h["at"] - F.lit(i))

    def verified(k: int, phrase: list[str], at: list[int]) -> Column:
        n = len(phrase)
        agreed = starts(phrase, at[0])
        for i in at[1:]:
            agreed = F.array_intersect(agreed, starts(phrase, i))

        def whole(start: Column) -> Column:
            window = F.transform(F.slice("w", F.greatest(start, F.lit(0)) + 1, F.lit(n)), _ascii_lower)
            return (start >= 0) & (start + n <= F.size("w")) & (window == F.array(*map(F.lit, phrase)))

        return F.transform(F.filter(agreed, whole), lambda start: F.struct(F.lit(k).alias("template"), start.alias("start")))

    found = F.concat(*(verified(*p) for p in postings))
    none = F.array().cast("array<struct<template:int,start:int>>")
    return words.select("doc_id", F.size("w").cast("long").alias("n_words"), F.when(F.size("hits") == 0, none).otherwise(found).alias("places"))


def labels(scanned: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """The columns of the digest from the places that scan() found."""
    number = {t.phrase: k for k, t in enumerate(templates)}
    base = [k for k, t in enumerate(templates) if t.base]
    starts = F.transform(F.filter("places", lambda p: p["template"].isin(base)), lambda p: p["start"].cast("long"))
    has = lambda k: F.exists("places", lambda p: p["template"] == k)
    named = lambda only: F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*(F.when(_all([has(k), *(has(number[x]) for x in t.needs)]), F.lit(t.label)) for k, t in enumerate(templates) if t.label and (t.base or not only))), lambda x: x.isNotNull()))), ",")
    empty = F.size("places") == 0
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.when(empty, F.lit("")).otherwise(named(True)).alias("base_labels"),
        F.when(empty, F.lit("")).otherwise(named(False)).alias("labels"),
        F.round(1 - F.pow(F.lit(0.5), F.size("places")), 9).alias("score"),
    )


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES) -> str:
    """The same digest in DuckDB SQL, by comparing every place with every phrase."""
    number = {t.phrase: k for k, t in enumerate(templates)}
    # places are counted out only in texts that hold the phrase as words
    lists = [
        f"CASE WHEN contains(s, ' {t.phrase} ') THEN list_filter(range(len(w)), lambda i: w[i + 1 : i + {len(t.phrase.split())}] = [{', '.join(repr(x) for x in t.phrase.split())}]) ELSE [] END"
        for t in templates
    ]
    cols = ", ".join(f"{x} AS p{k}" for k, x in enumerate(lists))
    base = [k for k, t in enumerate(templates) if t.base]
    places = " || ".join(f"p{k}" for k in base)

    def joined(only: bool) -> str:
        cases = ", ".join(f"CASE WHEN {' AND '.join(f'len(p{n}) > 0' for n in [k, *(number[x] for x in t.needs)])} THEN '{t.label}' END" for k, t in enumerate(templates) if t.label and (t.base or not only))
        return f"array_to_string(list_sort(list_distinct(list_filter([{cases}], lambda x: x IS NOT NULL))), ',')"

    return f"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
j AS (SELECT *, concat(' ', array_to_string(w, ' '), ' ') AS s FROM t), p AS (SELECT doc_id, len(w) AS n_words, {cols} FROM j)
SELECT doc_id, n_words::BIGINT AS n_words, len({places})::BIGINT AS n_base, list_min({places})::BIGINT AS first_word, list_max({places})::BIGINT AS last_word,
  {joined(True)} AS base_labels, {joined(False)} AS labels, round(1 - pow(0.5, {' + '.join(f'len(p{k})' for k in range(len(templates)))}), 9) AS score FROM p"""
