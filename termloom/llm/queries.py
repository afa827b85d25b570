"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm.bpe import encode_documents
from termloom.llm.codebooks import compress_vectors
from termloom.llm.counting import count_tokens, tokenizer_version
from termloom.llm.divergence import audit_sources
from termloom.llm.language import held_out, identify_languages, learn_languages
from termloom.llm.multiset import as_text, fingerprint_edits, likeness
from termloom.llm.packing import pack_documents
from termloom.llm.personal import BASE_KINDS, PERSONAL_KINDS, find_personal
from termloom.llm.planes import document_checksums, write_token_files
from termloom.llm.secret_scan import KINDS, scan_secrets
from termloom.llm.simhash import near_duplicates
from termloom.llm.substrings import remove_repeats
from termloom.llm.support import ship_package
from termloom.llm.vectors import top_k
from termloom.session import scratch_path, shared_folder

CONTEXT_TOKENS = 4096

TOP_K_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
),
ranked AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

DIVERGENCE_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
tok AS (
    SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
),
kept AS (
    SELECT lang, term, count(*) AS n FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 10
),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cells AS (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
matrix AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * s.v) AS p,
           1 + (1000000000::HUGEINT * (k.n + 2)) // (s.total + 2 * s.v) AS q
    FROM (SELECT DISTINCT lang, source FROM d) g
    JOIN kept k USING (lang) JOIN sizes s USING (lang)
    LEFT JOIN cells c USING (lang, source, term) LEFT JOIN totals t USING (lang, source)
),
found AS (
    SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(x.value, 0)::BIGINT AS value
    FROM (SELECT DISTINCT lang, source FROM d) g
    JOIN (SELECT DISTINCT lang, source FROM d) h ON g.lang = h.lang AND g.source <> h.source
    LEFT JOIN (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM matrix a JOIN matrix b USING (lang, term) GROUP BY ALL
    ) x ON x.lang = g.lang AND x.source = g.source AND x.item = h.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM matrix WHERE n > 0 AND p > q
),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
    FROM found
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer)


def op2_substring_dedup(spark, sf_dir):
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_secret_scan(spark, sf_dir):
    found = scan_secrets(_table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, KINDS))

    def joined(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"]))
        return F.array_join(text, ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    live = F.filter("spans", lambda s: ~s["is_example"])
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size(live).cast("bigint").alias("n_owner_specific"),
    )


def op4_multiset_hash(spark, sf_dir):
    found = fingerprint_edits(_table(spark, sf_dir, "documents"))
    own, changed = F.col("own"), F.col("changed")
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"),
        likeness(own, F.col("following")).alias("near_next"),
    )


def op5_simhash_golay(spark, sf_dir):
    found = near_duplicates(_table(spark, sf_dir, "documents"))
    fingerprint = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op6_tree_bpe(spark, sf_dir):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    encoded = encode_documents(_table(spark, sf_dir, "documents"), tokenizer, decoded=True)
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_kd_tree_top_k(spark, sf_dir):
    return top_k(_table(spark, sf_dir, "embeddings"))


def op8_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = identify_languages(docs, learn_languages(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_token_counts(spark, sf_dir):
    tokenizer = public_tokenizers.path("piece_bpe_32k.model")
    # One folder for all runs; counts of another version of the tokenizer are others.
    cache = f"{shared_folder(spark).rstrip('/')}/token-counts-{tokenizer_version(tokenizer)[:16]}"
    counts = count_tokens(_table(spark, sf_dir, "documents"), tokenizer, cache)
    return counts.withColumn("over_limit", F.col("n_tokens") > CONTEXT_TOKENS)


def op10_bit_plane_files(spark, sf_dir):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), path, tokenizer)
    return document_checksums(spark, path)


def op11_contextual_pii(spark, sf_dir):
    found = find_personal(_table(spark, sf_dir, "documents"))
    kinds = F.array(*map(F.lit, PERSONAL_KINDS))

    def joined(spans):
        text = F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"]))
        return F.array_join(text, ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    base = F.filter("spans", lambda s: s["kind"] < BASE_KINDS)
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{name}") for kind, name in enumerate(PERSONAL_KINDS[:BASE_KINDS])),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op12_walsh_codes(spark, sf_dir):
    return compress_vectors(_table(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark, sf_dir):
    return audit_sources(_table(spark, sf_dir, "documents"))


def llm_queries() -> dict:
    """All queries of this package by name."""
    return {name: run for name, run in globals().items() if name.startswith("op")}


def llm_oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op7_kd_tree_top_k": TOP_K_SQL, "op13_source_divergence": DIVERGENCE_SQL}
