"""Licence scan by a positional rare-token index, with array functions only.

The index holds, for each licence template, its rarest words and their places;
rarity is the inverse document frequency counted over the whole corpus. Of a
template's n rare words, ``need`` must stand at their places, so one of its
n - need + 1 rarest does. Those anchors are the postings: a map from word to
(template, place). A file looks up the anchors it holds, each of their places
gives one place where a posted template would begin, and only those beginnings
are tested for the template's other rare words at their relative positions, so
the work follows the file's own rare words, not the number of templates.
What is left must hold the template's key phrases. Texts are read twice
(counts, scan) and never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, pick

# Phrases every file is searched for, with their labels.
BASE_PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Public licence notices as (label, words, key phrases).
TEMPLATES = [
    ("agpl-3", "gnu affero general public license version 3", ["affero general public license"]),
    ("apache-2", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at",
     ["except in compliance with the license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", ["creative commons attribution 4 0"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license", ["attribution noncommercial"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ["attribution sharealike"]),
    ("gpl-2", "gnu general public license version 2", ["general public license version 2"]),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ["with or without fee is hereby granted"]),
    ("lgpl", "gnu lesser general public license", ["lesser general public license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["under the mit license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
]

RARE_WORDS = 5


@dataclass(frozen=True)
class Posting:
    label: str
    words: list[str]
    phrases: list[str]
    rare: list[tuple[str, int]]

    @property
    def need(self) -> int:
        """How many of the rare words must stand at their places."""
        return min(max(2, math.ceil(0.6 * len(self.rare))), len(self.rare))

    @property
    def anchors(self) -> list[tuple[str, int]]:
        """The rarest words, of which every set of ``need`` rare words holds one."""
        return self.rare[: len(self.rare) - self.need + 1]


def words_of(text: Column) -> Column:
    """Words of ASCII letters, digits and any non-ASCII characters; A-Z lowered, null text has none.

    ``lower`` also folds other letters, which changes no ASCII word but where
    the Kelvin sign or the dotted I occur; those texts take the slower way.
    """
    text = F.coalesce(text, F.lit(""))
    low = F.when(text.contains("K") | text.contains("İ"), lower_ascii(text)).otherwise(F.lower(text))
    return F.array_remove(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def document_frequencies(docs: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Row count, and in how many texts each word of the (small, fixed) vocabulary occurs."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    rows = docs.select(F.array_intersect(known, words_of(F.col("text"))).alias("w"))
    # the empty word counts all rows
    found = rows.select(F.explode(F.concat(F.array(F.lit("")), "w")).alias("w")).groupBy("w").count().collect()
    counts = {r["w"]: r["count"] for r in found}
    return counts.pop("", 0), counts


def rare_index(n: int, df: dict[str, int], templates=TEMPLATES) -> tuple[list[Posting], dict[str, float]]:
    """Each template with its rarest words and their places; and every word's IDF."""
    vocabulary = sorted({w for _, text, _ in templates for w in text.split()})
    idf = {w: math.log((1 + n) / (1 + df.get(w, 0))) for w in vocabulary}
    out = []
    for label, text, phrases in templates:
        words = text.split()
        chosen = sorted(set(words), key=lambda w: (-idf[w], w))[:RARE_WORDS]
        out.append(Posting(label, words, phrases, [(w, words.index(w)) for w in chosen]))
    return out, idf


def _places(phrase: str) -> str:
    """SQL: all starts of the phrase in ``words``; the scan runs only where its words occur."""
    parts = phrase.split()
    here = " and ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(parts))
    occurs = " and ".join(f"array_contains(words, '{w}')" for w in sorted(set(parts), key=lambda w: (len(w), w))[::-1][:2])
    none = "filter(array(0), i -> false)"
    return f"if(size(words) >= {len(parts)} and {occurs}, filter(sequence(0, size(words) - {len(parts)}), i -> {here}), {none})"


def _strings(items: list[str]) -> str:
    return "array(" + ", ".join(f"'{x}'" for x in items) + ")"


def _index_literal(index: list[Posting]) -> str:
    """SQL: the templates, by number."""
    rows = []
    for p in index:
        rare = ", ".join(f"named_struct('w', '{w}', 'p', {at})" for w, at in p.rare)
        rows.append(f"named_struct('label', '{p.label}', 'words', {_strings(p.words)}, 'phrases', {_strings(p.phrases)}, "
                    f"'rare', array({rare}), 'need', {p.need})")
    return "array(" + ", ".join(rows) + ")"


def _postings_literal(index: list[Posting], words: list[str]) -> str:
    """SQL: map from each anchor word to the templates (number, place of the word) it is an anchor of."""
    rows = []
    for word in words:
        at = [(t, place) for t, p in enumerate(index) for w, place in p.anchors if w == word]
        rows.append("array(" + ", ".join(f"named_struct('t', {t}, 'p', {place})" for t, place in at) + ")")
    return f"map_from_arrays({_strings(words)}, array({', '.join(rows)}))"


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts all places of the base phrases, ``first_word`` and
    ``last_word`` are the smallest and largest of their starts. ``labels`` adds
    the templates found; ``score`` is the best share of a found template's words
    standing at their places, 1 where a base phrase occurs, else 0.

    Defined cases: a null text is empty; without a place the two words are null
    and the labels empty strings; null doc_ids are carried; repeated rows are
    judged once each; empty tables give no rows. Other columns are ignored.
    """
    rows = pick(docs, doc_id="long", text="string")
    vocabulary = sorted({w for _, text, _ in TEMPLATES for w in text.split()})
    index, idf = rare_index(*document_frequencies(rows, vocabulary))
    looked_up = sorted({w for p in index for w, _ in p.anchors}, key=lambda w: (-idf[w], w))

    out = rows.select("doc_id", words_of(F.col("text")).alias("words"))
    out = out.select(
        "doc_id", "words", F.expr(f"array_intersect({_strings(looked_up)}, words)").alias("rare"),
        *[F.expr(_places(phrase)).alias(f"at{k}") for k, (phrase, _) in enumerate(BASE_PHRASES)])
    hits = ("if(size(rare) = 0, filter(array(named_struct('w', '', 'i', 0)), x -> false), "
            "filter(transform(words, (w, i) -> named_struct('w', w, 'i', i)), x -> array_contains(rare, x.w)))")
    starts = (f"array_distinct(flatten(transform(hits, h -> transform(element_at({_postings_literal(index, looked_up)}, h.w), "
              "q -> named_struct('t', q.t, 's', h.i - q.p)))))")
    named = f"transform({starts}, x -> named_struct('t', get({_index_literal(index)}, x.t), 's', x.s))"
    agree = f"filter({named}, x -> size(filter(x.t.rare, r -> get(words, x.s + r.p) = r.w)) >= x.t.need)"
    span = "concat(' ', array_join(slice(words, greatest(x.s, 0) + 1, size(x.t.words) + least(x.s, 0)), ' '), ' ')"
    sure = f"filter({agree}, x -> forall(x.t.phrases, f -> contains({span}, concat(' ', f, ' '))))"
    share = "size(filter(transform(x.t.words, (w, k) -> get(words, x.s + k) = w), y -> y)) / size(x.t.words)"
    found = (f"if(size(hits) = 0, cast(array() as array<struct<label:string,score:double>>), "
             f"transform({sure}, x -> named_struct('label', x.t.label, 'score', cast({share} as double))))")
    every = F.concat(*[F.col(f"at{k}") for k in range(len(BASE_PHRASES))])
    base = F.filter(
        F.array(*[F.when(F.size(f"at{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE_PHRASES)]), lambda x: x.isNotNull())
    out = out.withColumn("hits", F.expr(hits)).select(
        "doc_id", F.size("words").cast("long").alias("n_words"), every.alias("places"), base.alias("base"), F.expr(found).alias("found"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return out.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        joined(F.col("base")).alias("base_labels"), joined(F.concat("base", F.col("found.label"))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.col("found.score")), F.lit(0.0))).alias("score"))
