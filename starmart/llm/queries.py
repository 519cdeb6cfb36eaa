"""One query an operator over its whole table, and the SQL that checks it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import balltree, debruijn, decontam, langid, licenses, merkle, mixing, periodic, pieces, sharding, simhash, suffix, warc
from .common import table


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 runs of the curve order; law rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    done = sharding.hilbert_shards(docs)
    return done.select("doc_id", "shard.size", "shard.text_crc32", F.lit("rows").alias("law"), "shard.shard", "shard.slot", F.lit(None).cast("int").alias("grown_shard"), "shard.curve")


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents not held out."""
    done = langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return done.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score", "language.languages", "language.shares")


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives and read back."""
    done = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_debruijn_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows that start in earlier ones."""
    return debruijn.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontam.with_hits(docs, table(spark, sf_dir, "benchmark"), "hits")
    hits = F.col("hits")
    return marked.select(
        "doc_id",
        hits["n_words"].alias("n_words"),
        hits["n_hit"].alias("n_hit"),
        F.size(hits["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hits["items"], ","), 256).alias("items_sha256"),
        decontam.contaminated(hits).alias("contaminated"),
    )


def op6_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 100-byte strings that start earlier."""
    return suffix.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents at source weights 1, 2, 3, repeating."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs)
    return plan.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


def op9_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every 50th vector among all others."""
    return balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of all documents."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@F.arrow_udf(T.StringType())
def with_period(doc_ids: pa.Array, texts: pa.Array) -> pa.Array:
    """Texts whose words from one place on repeat with one period, both taken from the crc32 of the id; null stays null."""
    out = []
    for doc, text in zip(doc_ids.to_pylist(), texts.cast(pa.large_binary()).to_pylist(), strict=True):
        words = (text or b"").split()
        if words:
            g, n = zlib.crc32(str(doc).encode()) // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            text = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
        out.append(text)
    return pa.array(out, pa.binary()).view(pa.string())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document's words, a tenth of the documents made periodic from one place on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tenth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    made = docs.withColumn("text", F.when(tenth, with_period("doc_id", F.when(tenth, F.col("text")))).otherwise(F.col("text")))
    runs = F.col("periodic.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("before"), (-r.period).alias("under"))))
    listed = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return (
        periodic.periodic_runs(made)
        .withColumn("longest", longest)
        .select(
            "doc_id",
            F.size(runs).cast("long").alias("n_runs"),
            (-F.col("longest.before")).alias("start"),
            "longest.length",
            (-F.col("longest.under")).alias("period"),
            F.expr("1000 * longest.length div -longest.under").alias("exponent_milli"),
            F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("periodic.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
            F.col("periodic.n_words").alias("n_words"),
        )
    )


def op12_sentence_pieces(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Every document encoded with the public piece model, or another one, and decoded from its ids."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    found = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model, keep=["doc_id"]).select("doc_id", "pieces.*")
    n = F.size("ids").cast("long")
    counted = found.select(
        "doc_id",
        n.alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.when(n > 0, F.get("ends", n.cast("int") - 1) - F.get("starts", F.lit(0))).otherwise(0).cast("long").alias("span_bytes"),
        "ids",
    )
    decoded = F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    return pieces.decode(counted, model).select("doc_id", "n_tokens", "ids_sha256", decoded, "span_bytes")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, and the root each of them folds to after one leaf in seven is altered."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    seventh = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = F.when(seventh, merkle.leaf(*[F.col(f) + 1 if f == "n_chars" else F.col(f) for f in merkle.FIELDS]))
    proved = merkle.proofs(merkle.build(docs, keep={"doc_id": F.col("doc_id"), "altered": altered}))
    over = merkle.folded(F.coalesce("kept_altered", "digest"), "idx", "n", "tree", "trees", "proof")
    text = lambda c: F.lower(F.hex(c))
    return proved.withColumn("over", over).select(
        F.col("kept_doc_id").alias("doc_id"),
        text("digest").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        F.sha2(text("proof").cast("binary"), 256).alias("proof_sha256"),
        text("over").alias("folded_root"),
        (F.col("over") == F.col("root")).alias("verified"),
    )


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), p AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d)
), m AS (
  SELECT win, min(doc_id) AS first FROM p GROUP BY win
), h AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM p JOIN m USING (win) WHERE first < doc_id
), r AS (
  SELECT x.doc_id, count(h.k) AS n, string_agg(word, ' ' ORDER BY x.k) FILTER (h.k IS NULL) AS kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d) x LEFT JOIN h ON h.doc_id = x.doc_id AND h.k = x.k GROUP BY x.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN r USING (doc_id)
"""

OP5_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS width, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), p AS (
  SELECT doc_id, i, width, array_to_string(list_slice(w, i, i + width - 1), ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT width FROM win) WHERE i + width - 1 <= len(w)
), m AS (
  SELECT doc_id, i, width, item_id FROM p JOIN win USING (width, win)
), hit AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS k FROM m) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, 'null') AS item FROM m) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)
"""

OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id::BIGINT AS query_id, rank::INTEGER AS rank, vec_id::BIGINT AS vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


def op10_sql() -> str:
    """The license scan with word positions as rows: every place of a key phrase, and the weight that agrees around it."""
    rows = []
    for k, t in enumerate(licenses.templates()):
        rows += [f"({k}, '{t.label}', {str(t.base).lower()}, {p}, '{w}', {str(t.key_at <= p < t.key_at + len(t.key)).lower()}, {str(p == t.key_at).lower()})" for p, w in enumerate(t.words)]
    return rf"""
WITH t(k, label, base, p, word, key, head) AS (VALUES {", ".join(rows)}),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), pos AS (
  SELECT doc_id, i, w[i + 1] AS word FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM d) WHERE w[i + 1] IN (SELECT word FROM t)
), idf AS (
  SELECT word, 1 + ln(((SELECT count(*) FROM d) + 1) / (count(DISTINCT doc_id) + 1)) AS weight FROM (SELECT word, doc_id FROM pos UNION ALL SELECT DISTINCT word, NULL FROM t) GROUP BY word
), start AS (
  SELECT doc_id, k, i - p AS s FROM pos JOIN t USING (word) WHERE head
), agree AS (
  SELECT start.doc_id, start.k, s, label, base, count(*) FILTER (key AND pos.word IS NOT NULL) = count(*) FILTER (key) AS fits,
    round(coalesce(sum(weight) FILTER (pos.word IS NOT NULL), 0) / sum(weight), 6) AS share
  FROM start JOIN t USING (k) JOIN idf ON idf.word = t.word
  LEFT JOIN pos ON pos.doc_id = start.doc_id AND pos.i = start.s + t.p AND pos.word = t.word
  GROUP BY start.doc_id, start.k, s, label, base
), g AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (share >= {licenses.MIN_SHARE}) AS labels, max(share) FILTER (share >= {licenses.MIN_SHARE}) AS score
  FROM agree WHERE fits GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score FROM d LEFT JOIN g USING (doc_id)
"""


OP7_SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), p AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS w FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM d)
), k AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS first, min(i) OVER (PARTITION BY w, doc_id) AS own FROM p
), x AS (
  SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true)::INTEGER AS opens FROM k WHERE first < doc_id OR own < i
), r AS (
  SELECT doc_id, n, min(i) AS s, max(i) + 100 AS e FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM x) GROUP BY doc_id, n
), gap AS (
  SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM r
), piece AS (
  SELECT d.doc_id, s, substr(h, 2 * before + 1, 2 * (s - before)) AS t FROM gap JOIN d USING (doc_id)
  UNION ALL
  SELECT d.doc_id, 1000000000000, substr(h, 2 * coalesce(last, 0) + 1) FROM d LEFT JOIN (SELECT doc_id, max(e) AS last FROM r GROUP BY doc_id) USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(t, '' ORDER BY s) AS t FROM piece GROUP BY doc_id
), g AS (
  SELECT doc_id, sum(e - s) AS removed, count(*) AS spans FROM r GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(t)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN g USING (doc_id)
"""

OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS ss, ([1, 2, 3])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::HUGEINT AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, sum(ss) OVER () AS t, sum(w) OVER () AS ws,
    coalesce(sum(3 * ss) OVER below, 0) AS held, coalesce(sum(w) OVER below, 0) AS gone, row_number() OVER (ORDER BY ss::DOUBLE / w, source) AS k
  FROM s WINDOW below AS (ORDER BY ss::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT (t - held)::HUGEINT AS rest, (ws - gone)::HUGEINT AS open FROM o WHERE (t - held) * w <= 3 * ss * (ws - gone) ORDER BY k LIMIT 1
), target AS (
  SELECT source, ss, CASE WHEN 3 * ss * open <= rest * w THEN (3 * ss)::DOUBLE ELSE (rest * w)::DOUBLE / open::DOUBLE END AS target FROM s, level
), r AS (
  SELECT doc_id, size, ss, target, CASE WHEN ss > 0 THEN target / ss::DOUBLE ELSE 0 END AS rate,
    ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS u
  FROM d JOIN target ON d.source IS NOT DISTINCT FROM target.source
)
SELECT doc_id, size, ss::BIGINT AS source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""

def op13_sql() -> str:
    """Trees by recursion over levels, once for the documents of a language and once for the languages."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda n_chars: f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"
    # crc32 by long division: bits of the reversed polynomial, byte by byte, of the decimal doc_id
    return f"""
WITH RECURSIVE crc(doc_id, rest, c) AS (
  SELECT DISTINCT doc_id, doc_id::VARCHAR, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, substr(rest, 2), list_reduce([xor(c, ord(rest[1])::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384)) FROM crc WHERE rest <> ''
), d AS (
  SELECT doc_id, lang, {leaf("n_chars")} AS leaf, CASE WHEN xor(c, 4294967295) % 7 = 0 THEN {leaf("(n_chars + 1)")} END AS altered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM documents LEFT JOIN (SELECT doc_id, c FROM crc WHERE rest = '') USING (doc_id)
), t AS (
  SELECT lang, 0 AS level, idx, n, leaf AS h FROM d
  UNION ALL
  SELECT lang, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM t WHERE n > 1 GROUP BY lang, level, idx // 2, n
), g AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM t WHERE n = 1
), u AS (
  SELECT 0 AS level, idx, n, subroot AS h FROM g
  UNION ALL
  SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM u WHERE n > 1 GROUP BY level, idx // 2, n
), p AS (
  SELECT doc_id, lang, leaf, 0 AS level, idx, n, coalesce(altered, leaf) AS h, '' AS proof FROM d
  UNION ALL
  SELECT doc_id, p.lang, leaf, p.level + 1, p.idx // 2, (p.n + 1) // 2, sha256(CASE WHEN p.idx % 2 = 0 THEN p.h || coalesce(s.h, '') ELSE s.h || p.h END), proof || coalesce(s.h, '')
  FROM p LEFT JOIN t s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = p.level AND s.idx = xor(p.idx, 1) WHERE p.n > 1
), q AS (
  SELECT doc_id, leaf, subroot, 0 AS level, g.idx, g.n, p.h, proof FROM p JOIN g ON p.lang IS NOT DISTINCT FROM g.lang WHERE p.n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, q.level + 1, q.idx // 2, (q.n + 1) // 2, sha256(CASE WHEN q.idx % 2 = 0 THEN q.h || coalesce(s.h, '') ELSE s.h || q.h END), proof || coalesce(s.h, '')
  FROM q LEFT JOIN u s ON s.level = q.level AND s.idx = xor(q.idx, 1) WHERE q.n > 1
)
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, q.h AS folded_root, q.h = u.h AS verified FROM q, u WHERE q.n = 1 AND u.n = 1
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_hilbert_shards, op2_language_mixture, op3_warc_chunks, op4_debruijn_spans, op5_decontaminate, op6_golay_simhash, op7_induced_suffixes, op8_mix_sources, op9_ball_tree_search, op10_license_index, op11_periodic_runs, op12_sentence_pieces, op13_merkle_manifest)
}
ORACLE_SQL: dict[str, str] = {
    "op4_debruijn_spans": OP4_SQL,
    "op5_decontaminate": OP5_SQL,
    "op7_induced_suffixes": OP7_SQL,
    "op8_mix_sources": OP8_SQL,
    "op9_ball_tree_search": OP9_SQL,
    "op10_license_index": op10_sql(),
    "op13_merkle_manifest": op13_sql(),
}
