"""Held-out accuracy, mixtures, edge cases."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import langid
from starmart.llm.queries import QUERIES

DOCS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def by_lang(spark):
    docs = spark.read.parquet(f"{DOCS}/documents.parquet").collect()
    return {x: [r["text"] for r in docs if r["lang"] == x and len(r["text"]) > 1500] for x in ("en", "de", "fr", "es")}


def test_held_out_accuracy(spark):
    got = QUERIES["op2_language_mixture"](spark, DOCS)
    truth = spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    held = [r for r in rows if r["held_out"]]
    assert 0.15 < len(held) / len(rows) < 0.25
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_mixture_proportions(spark, by_lang):
    lessons = [(t, x) for x, texts in by_lang.items() for t in texts[5:]]
    model = langid.train(spark.createDataFrame(lessons, "text string, lang string"))
    for a, b in (("en", "fr"), ("de", "es")):
        text = by_lang[a][0][:1000] + " " + by_lang[b][1][:500]
        found = langid.language_of(text, model)
        assert found["languages"][:2] == [a, b] and abs(found["shares"][0] - 2 / 3) < 0.12
        assert langid.language_of(by_lang[a][2], model)["languages"] == [a]


def test_expectation_maximisation_climbs():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(50), 3)
    n = rng.multinomial(20000, 0.7 * p[0] + 0.3 * p[2]).astype(float)
    share, mixed, level = langid.fit(p[[0, 2]], n)
    assert abs(share[0] - 0.7) < 0.03 and np.isclose(level, n @ np.log(share @ p[[0, 2]]))
    assert [k for k, _ in langid.mixture(p, n)] == [0, 2]


def test_long_texts_count_like_short_ones():
    text = "Wörter und Sätze, " * 9000
    used, n = langid.trigrams(text)
    line = b" " + b" ".join(text.lower().encode().translate(langid.LETTERS).split()) + b" "
    assert n.sum() == len(line) - 2 and len(used) == len(langid.trigrams(text[:180])[0])


def test_edge_cases(spark):
    rows = [(1, None, "en", 1), (2, "", "en", 1), (3, "12 34 --", "en", 1), (4, "the cat and the dog", "en", 1), (5, "le chat et le chien", "fr", 1), (6, "the dog", None, 1), (None, "le chat", "fr", 1), (6, "the dog", None, 1), (7, "the cat " * 40000, "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _language int")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    assert [r["language"]["lang"] for r in got[:3]] == ["und"] * 3 and got[5]["language"]["lang"] == "en"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == 6
    assert langid.identify(docs.limit(0)).count() == 0
    blind = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["language"]["lang"] for r in blind} == {"und"}


def plain_counts(text):
    """Trigram numbers of a text, counted one by one without the library's code."""
    low = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in text.lower().encode())
    line = b" " + b" ".join(w for w in low.split(b" ") if w) + b" "
    return Counter(((line[i] << 16 | line[i + 1] << 8 | line[i + 2]) * 2654435761 % 2**32) >> 16 for i in range(len(line) - 2))


def plain_fit(p, n):
    share = [1 / len(p)] * len(p)
    total = sum(n.values())
    for _ in range(20 if len(p) > 1 else 0):
        gains = [0.0] * len(p)
        for t, c in n.items():
            mixed = sum(s * q[t] for s, q in zip(share, p, strict=True))
            for k, q in enumerate(p):
                gains[k] += c * share[k] * q[t] / mixed
        share = [g / total for g in gains]
    return share, sum(c * math.log(sum(s * q[t] for s, q in zip(share, p, strict=True))) for t, c in n.items())


def plain_mixture(model, n):
    """All languages are tried in each step: the one that raises the penalised likelihood most joins."""
    price = 4 * math.log(max(sum(n.values()), 2))
    chosen, level, share = [], -math.inf, []
    while len(chosen) < len(model):
        trials = {x: plain_fit([model[y] for y in [*chosen, x]], n) for x in sorted(model) if x not in chosen}
        best = max(trials, key=lambda x: trials[x][1])
        if chosen and trials[best][1] - price <= level:
            break
        share, level = trials[best]
        chosen.append(best)
    return dict(zip(chosen, share, strict=True))


def test_counts_estimates_and_choice_against_brute_force(spark):
    """Every probability of the model, and languages and proportions of single and mixed texts, from loops over trigrams."""
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").collect()]
    counts = {}
    for i, text, lang in docs:
        if text is not None and lang is not None and zlib.crc32(str(i).encode()) % 5:
            counts.setdefault(lang, Counter()).update(plain_counts(text))
    model = {x: [(c[t] + 0.5) / (sum(c.values()) + 0.5 * 2**16) for t in range(2**16)] for x, c in counts.items()}
    fitted = langid.train(spark.createDataFrame(docs, "doc_id long, text string, lang string").where(~langid.held_out(F.col("doc_id"))))
    assert fitted["langs"] == sorted(model) and np.allclose(fitted["p"], [model[x] for x in fitted["langs"]], rtol=1e-5)

    short = [r for r in docs if r[1] and 20 < len(r[1]) < 3000]
    pairs = [(i, a + "\n" + b, None) for (i, a, x), (_, b, y) in zip(short, short[7:], strict=False) if x != y]
    asked = short[:25] + pairs[:15]
    rows = spark.createDataFrame([(k, t) for k, (_, t, _) in enumerate(asked)], "id long, text string")
    got = {r["id"]: r["l"] for r in rows.withColumn("l", langid.languages(fitted, F.col("text"), spark)).collect()}
    several = 0
    for k, (_, text, _) in enumerate(asked):
        want = plain_mixture(model, plain_counts(text))
        several += len(want) > 1
        found = dict(zip(got[k]["languages"], got[k]["shares"], strict=True))
        assert found.keys() == want.keys() and all(abs(found[x] - want[x]) < 1e-3 for x in want)
        assert abs(want[got[k]["lang"]] - max(want.values())) < 1e-3 and got[k]["score"] == max(found.values())
    assert several > 5
