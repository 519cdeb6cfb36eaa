"""License scan with a positional rare-token index (operator 10, native).

Each text is cut into words once and stored as the numbers of its template words
(zero for any other), which is all that later steps read. Document frequencies are
counted over all documents, and the index keeps, for each template, the places of
the ``ANCHORS`` words of its mandatory key phrase with the highest IDF. A file's
words are looked up there; each posting gives the starts of its template (place in
the file minus place in the template, below 0 where the file cuts the beginning),
and the postings of a template are intersected by start. At what is left the key
phrase is verified word by word, and the share of the template's weight that agrees
must reach ``MIN_SHARE``. As a key phrase must stand verbatim, all its rare words agree
wherever it stands, so the intersection loses no place; base phrases are templates whose key
phrase is the whole phrase. All of it is column expressions inside one row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import materialize

from .common import LOWER, UPPER, free_names

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHORS = 3  # postings a template: its key phrase's words of highest IDF, all of which a start must have
MIN_SHARE = 0.6

# Base phrases and their labels.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
#: Label, words of the template, mandatory key phrase.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "free of charge to any person"),
    ("apache-2", "licensed under the apache license version 2 0 the license", "apache license version 2"),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", "cc0 1 0 universal"),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i : i + n] == self.key)


def templates(base=BASE, more=TEMPLATES) -> list[Template]:
    whole = [Template(label, tuple(p.split()), tuple(p.split()), True) for label, p in base]
    return whole + [Template(label, tuple(t.split()), tuple(k.split()), False) for label, t, k in more]


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TOKEN), F.lit(0))


def word_codes(words: Column, vocabulary: list[str]) -> Column:
    """Each word's place in the vocabulary, from 1; 0 for words that no template has."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    code = lambda w: F.when(w.isin(vocabulary), F.array_position(known, w).cast("short")).otherwise(F.lit(0).cast("short"))
    return F.transform(words, code)


def word_weights(stored: DataFrame, codes: str, vocabulary: list[str]) -> dict[str, float]:
    """1 + ln((documents + 1) / (documents with the word + 1)) of each template word, over all documents.

    Code 0, added to every document, counts the documents. At most one row a template word reaches the driver.
    """
    zero = F.array(F.lit(0).cast("short"))
    found = stored.select(F.explode(F.array_union(zero, codes)).alias("code")).groupBy("code").count()
    df = {r["code"]: r["count"] for r in found.collect()}
    return {w: 1 + math.log((df.get(0, 0) + 1) / (df.get(k, 0) + 1)) for k, w in enumerate(vocabulary, 1)}


def rare_postings(t: Template, weight: dict[str, float]) -> list[tuple[str, int]]:
    """The template's entries in the index: its key phrase's words of highest IDF with their places, rarest first."""
    rarest = sorted(set(t.key), key=lambda w: (-weight[w], w))[:ANCHORS]
    return [(w, t.words.index(w, t.key_at)) for w in rarest]


def starts(t: Template, hits: Column, codes: Column, code: dict[str, int], weight: dict[str, float]) -> Column:
    """Starts of the template in a file: those its postings have in common and at which its key phrase stands."""

    def posted(w: str, place: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["code"] == code[w]), lambda h: h["at"] - place)

    common = reduce(F.array_intersect, [posted(w, place) for w, place in rare_postings(t, weight)])
    needed = [(p, code[t.words[p]]) for p in range(t.key_at, t.key_at + len(t.key))]
    return F.filter(common, lambda s: reduce(lambda a, b: a & b, [F.coalesce(F.get(codes, s + p) == c, F.lit(False)) for p, c in needed]))


def shares(t: Template, found: Column, codes: Column, code: dict[str, int], weight: dict[str, float]) -> Column:
    """For each start the share of the template's weight whose words agree, to 6 digits."""
    total = sum(weight[w] for w in t.words)
    agree = lambda s: sum((F.when(F.get(codes, s + p) == code[w], weight[w]).otherwise(0.0) for p, w in enumerate(t.words)), F.lit(0.0))
    return F.transform(found, lambda s: F.round(agree(s) / total, 6))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Places count from word 0; first and last are null without a base phrase.
    Labels are distinct, sorted and comma-joined, empty without any; the score
    is the largest share of a template found, 0 without any. Null and empty texts
    have no words; repeated rows and null ids each give their own row. Texts of any
    length are taken whole. Other columns of ``docs``, whatever their names, play no
    part and are not returned. An empty table gives no rows.
    """
    known = templates()
    vocabulary = sorted({w for t in known for w in t.words})
    code = {w: k for k, w in enumerate(vocabulary, 1)}
    codes, hits = free_names([id_col], "codes", "hits")
    stored = materialize(docs.select(F.col(id_col), word_codes(words_of(F.col(text_col)), vocabulary).alias(codes)), "license-words")
    weight = word_weights(stored, codes, vocabulary)
    none = F.array().cast("array<int>")

    rare = sorted({code[w] for t in known for w, _ in rare_postings(t, weight)})
    listed = F.filter(F.transform(codes, lambda c, i: F.struct(c.alias("code"), i.alias("at"))), lambda h: h["code"].isin(rare))
    any_rare = F.exists(codes, lambda c: c.isin(rare))
    looked_up = stored.withColumn(hits, F.when(any_rare, listed))
    found = [F.when(F.size(hits) > 0, starts(t, F.col(hits), F.col(codes), code, weight)).otherwise(none).alias(f"at{k}") for k, t in enumerate(known)]
    placed = looked_up.select(F.col(id_col).alias("id"), F.col(codes).alias("codes"), *found)
    passed = []
    for k, t in enumerate(known):
        score = F.when(F.size(f"at{k}") > 0, shares(t, F.col(f"at{k}"), F.col("codes"), code, weight)).otherwise(F.array().cast("array<double>"))
        passed.append(F.coalesce(F.array_max(F.filter(score, lambda x: x >= MIN_SHARE)), F.lit(0.0)).alias(f"share{k}"))
    scored = placed.select("id", F.size("codes").cast("long").alias("n_words"), *[f"at{k}" for k in range(len(known))], *passed)

    base = [k for k, t in enumerate(known) if t.base]
    places = F.array(*[F.array_min(f"at{k}") for k in base]), F.array(*[F.array_max(f"at{k}") for k in base])
    joined = lambda ks: F.array_join(F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.col(f"share{k}") > 0, F.lit(known[k].label)) for k in ks]), lambda x: x.isNotNull()))), ",")
    return scored.select(
        F.col("id").alias(id_col),
        "n_words",
        sum((F.size(f"at{k}") for k in base), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(places[0]).cast("long").alias("first_word"),
        F.array_max(places[1]).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(range(len(known))).alias("labels"),
        F.greatest(*[F.col(f"share{k}") for k in range(len(known))]).alias("score"),
    )
