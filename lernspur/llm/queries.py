"""The operators as queries over whole tables, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    centroids, cluster_sql, collocations, decontam, fingerprints, langid, lattice, mixing, ngramjoin, quality, sharding,
    simhash, tokencount, tokenfile, warc,
)

SHARDS = [f"shard-{i:02d}" for i in range(16)]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ngram_jaccard(spark, folder):
    return ngramjoin.ngram_components(_table(spark, folder, "documents"))


def token_binary(spark, folder):
    return tokenfile.token_table(_table(spark, folder, "documents"), tokenfile.default_tokenizer())


def warc_revisits(spark, folder):
    return warc.archive(_table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def shard_lookup(spark, folder):
    documents = _table(spark, folder, "documents").select("doc_id")
    return sharding.place(documents, F.col("doc_id"), sharding.shard_table(spark, SHARDS))


def multiset_fingerprints(spark, folder):
    return fingerprints.edited_fingerprints(_table(spark, folder, "documents"))


def template_decontamination(spark, folder):
    return decontam.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def importance_resampling(spark, folder):
    return quality.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def trie_token_counts(spark, folder):
    return tokencount.token_counts(_table(spark, folder, "documents"), lattice.default_vocabulary())


def language_id(spark, folder):
    return langid.identify(_table(spark, folder, "documents"), lattice.default_vocabulary())


def mixing_schedule(spark, folder):
    return mixing.mix(_table(spark, folder, "documents")).drop("source", "passes")


def incremental_centroids(spark, folder):
    return centroids.cluster_vectors(_table(spark, folder, "embeddings"))


def phrase_collocations(spark, folder):
    return collocations.collocations(_table(spark, folder, "documents"))


def simhash_bitslices(spark, folder):
    return simhash.near_copies(_table(spark, folder, "documents"))


QUERIES = {
    "op1_ngram_jaccard": ngram_jaccard,
    "op2_token_binary": token_binary,
    "op3_warc_revisits": warc_revisits,
    "op4_shard_lookup": shard_lookup,
    "op5_template_decontamination": template_decontamination,
    "op6_multiset_fingerprints": multiset_fingerprints,
    "op7_importance_resampling": importance_resampling,
    "op8_trie_token_counts": trie_token_counts,
    "op9_mixing_schedule": mixing_schedule,
    "op10_language_id": language_id,
    "op11_incremental_centroids": incremental_centroids,
    "op12_phrase_collocations": phrase_collocations,
    "op13_simhash_bitslices": simhash_bitslices,
}

_NAMES = ", ".join(f"'{s}'" for s in SHARDS)
_M = sharding.TABLE_SIZE

ORACLE_SQL_BY_NAME = {
    "op3_warc_revisits": """
        WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                 sha256(coalesce(html, '')) AS payload_digest
          FROM pages),
        f AS (
          SELECT payload_digest, min(page_id) AS first, count(*) AS n
          FROM p WHERE payload_bytes >= 100 GROUP BY 1)
        SELECT p.page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
               CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100""",
    "op4_shard_lookup": f"""
        WITH RECURSIVE s AS (
          SELECT list(name ORDER BY name) AS names,
                 list(CAST('0x' || substr(md5('offset:' || name), 1, 12) AS BIGINT) % {_M} ORDER BY name) AS o,
                 list(CAST('0x' || substr(md5('step:' || name), 1, 12) AS BIGINT) % {_M - 1} + 1 ORDER BY name) AS t
          FROM (SELECT unnest([{_NAMES}]) AS name)),
        fill AS (
          SELECT 0 AS turn, list_transform(range({_M}), lambda x: CAST(-1 AS BIGINT)) AS owner
          UNION ALL
          SELECT turn + 1, list_transform(owner, lambda x, i: CASE WHEN i - 1 = slot THEN turn % {len(SHARDS)} ELSE x END)
          FROM (
            SELECT turn, owner, list_filter(list_transform(range({_M}),
                     lambda j: (o[turn % {len(SHARDS)} + 1] + j * t[turn % {len(SHARDS)} + 1]) % {_M}),
                     lambda c: owner[c + 1] = -1)[1] AS slot
            FROM fill, s WHERE turn < {_M}))
        , last AS (SELECT owner FROM fill WHERE turn = {_M})
        SELECT doc_id, CAST(slot AS INTEGER) AS slot, names[owner[slot + 1] + 1] AS shard
        FROM (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % {_M} AS slot
              FROM documents), last, s""",
    "op9_mixing_schedule": r"""
        WITH RECURSIVE d AS (
          SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                 md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k
          FROM documents),
        src AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS n,
                 [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS w,
                 row_number() OVER (ORDER BY encode(source) NULLS LAST) AS i
          FROM d GROUP BY source),
        level AS (
          SELECT *, 2 * n / w AS ratio,
                 (1.5::DOUBLE * (SELECT sum(n) FROM src)
                  - coalesce(sum(2 * n) OVER (ORDER BY 2 * n / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(w) OVER (ORDER BY 2 * n / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lam
          FROM src),
        cut AS (SELECT min_by(lam, ratio) AS lam FROM level WHERE lam * w < 2 * n),
        t AS (SELECT source, n, least(CAST(2 * n AS DOUBLE), coalesce((SELECT lam FROM cut), 0) * w) AS target
              FROM src),
        line AS (
          SELECT d.*, t.n, t.target, CAST(floor(t.target) AS BIGINT) AS goal,
                 CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS a
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, n AS source_size, target,
               greatest(0, least(a + size, goal) - a) + greatest(0, least(a + size, goal - n) - a) AS taken
        FROM line""",
    "op11_incremental_centroids": cluster_sql.SQL,
    "op12_phrase_collocations": collocations.SQL,
}
