"""Language ID by multilingual mixture inference (operator 2).

Training counts hashed byte trigrams per language over all learning documents.
A document is a mixture of languages: expectation-maximisation estimates the
proportions from its trigram likelihoods, and languages join the set one by one
as long as the penalised likelihood grows. The predicted language is the one with
the largest proportion, which is also the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names

BUCKETS = 1 << 16  # the model holds this many numbers a language
SMOOTHING = 0.5
STEPS = 20  # of expectation-maximisation
PENALTY = 4.0  # times ln(trigrams) for each further language
PIECE = 1 << 20  # bytes of a text worked on at a time
FOLDS = 5
UNKNOWN = "und"
MIN_SCORE = 0.5  # a document without a language of this share is rejected
LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that are no letters become spaces.
LETTERS = bytes(c if c >= 128 or 65 <= c <= 90 or 97 <= c <= 122 else 32 for c in range(256))


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of the lower-cased words, and how often each occurs."""
    line = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(LETTERS).split()) + b" "
    data = np.frombuffer(line, np.uint8)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)

    def buckets(part: np.ndarray) -> np.ndarray:
        code = part[:-2].astype(np.uint32) << 16 | part[1:-1].astype(np.uint32) << 8 | part[2:]
        return (code * np.uint32(2654435761)) >> np.uint32(16)

    if len(data) <= BUCKETS:
        return np.unique(buckets(data), return_counts=True)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data) - 2, PIECE):
        counts += np.bincount(buckets(data[at : at + PIECE + 2]), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used, counts[used]


def count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts of each language in a partition; one array of ``BUCKETS`` numbers a language is held."""
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            used, n = trigrams(text)
            held.setdefault(lang, np.zeros(BUCKETS, np.int64))[used] += n
    for lang, counts in held.items():
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(counts[used])], ["lang", "bucket", "n"])


def train(examples: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict:
    """Languages in order and their trigram probabilities; ``BUCKETS`` numbers a language reach the driver.

    Rows with a null text or language teach nothing.
    """
    known = examples.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(lang_col, text_col)
    counted = known.mapInArrow(count_trigrams, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = counted.toArrow()
    langs, which = np.unique(np.array(got["lang"].to_pylist(), object).astype(str), return_inverse=True)
    counts = np.full((len(langs), BUCKETS), SMOOTHING)
    counts[which, got["bucket"].to_numpy()] += got["n"].to_numpy()
    return {"langs": [str(x) for x in langs], "p": (counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)}


def fit(p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Proportions, mixed probabilities and log likelihood of the languages in the rows of ``p``."""
    share = np.full(len(p), 1.0 / len(p))
    for _ in range(STEPS if len(p) > 1 else 0):
        share = share * (p @ (n / (share @ p))) / n.sum()
    mixed = share @ p
    return share, mixed, float(n @ np.log(mixed))


def mixture(p: np.ndarray, n: np.ndarray) -> list[tuple[int, float]]:
    """Languages (rows of ``p``) with their proportions, largest first; ties go to the earlier row.

    A language can raise the log likelihood by at most the slope at proportion 0
    (it is concave), so those that cannot pay the penalty are not fitted.
    """
    chosen = [int((np.log(p) @ n).argmax())]
    price = PENALTY * math.log(max(n.sum(), 2))
    share, mixed, level = fit(p[chosen], n)
    while len(chosen) < len(p):
        slope = p @ (n / mixed) - n.sum()
        trials = [(*fit(p[[*chosen, k]], n), k) for k in np.flatnonzero(slope > price).tolist() if k not in chosen]
        best = max(trials, key=lambda t: t[2], default=None)
        if best is None or best[2] - price <= level:
            break
        share, mixed, level = best[:3]
        chosen.append(best[3])
    return sorted(zip(chosen, share.tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def language_of(text: str | None, model: dict) -> dict:
    if text is None or not model["langs"] or not LETTER.search(text):
        return {"lang": UNKNOWN, "score": 0.0, "languages": [], "shares": []}
    used, n = trigrams(text)
    found = mixture(model["p"][:, used].astype(np.float64), n.astype(np.float64))
    names = [model["langs"][k] for k, _ in found]
    shares = [min(max(s, 0.0), 1.0) for _, s in found]
    return {"lang": names[0], "score": shares[0], "languages": names, "shares": shares}


def languages(model: dict, text: Column, spark) -> Column:
    """A struct for each text: lang, score, and all languages found with their shares.

    Null texts, texts without letters and all texts under a model without
    languages are ``und`` with score 0 and no languages.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, languages array<string>, shares array<double>")
    def predict(texts: pa.Array) -> pa.Array:
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("shares", pa.list_(pa.float64()))])
        return pa.array([language_of(t, shared.value) for t in texts.to_pylist()], kind)

    return predict(text)


def held_out(ident: Column) -> Column:
    """Whether the row is kept from learning: crc32 of its id as text divides by 5; a null id is not, but teaches nothing either."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", out: str = "language") -> DataFrame:
    """``docs`` with the struct of ``languages`` in ``out``, learned from the rows not held out."""
    lessons = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    model = train(lessons, text_col, lang_col)
    return docs.withColumn(out, languages(model, F.col(text_col), docs.sparkSession))


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that have no language or none with at least half of the text."""
    (found,) = free_names(docs, "_language")
    marked = identify(docs, out=found)
    return marked.where((F.col(found)["lang"] != UNKNOWN) & (F.col(found)["score"] >= MIN_SCORE)).select(*docs.columns)
