"""Registered queries of the operators, with their production parameters, and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import decontaminate, exact_dedup, filter_audit, langid, license_scan, manifest, pii, quality_rules, sentencepiece_bpe, simhash, suffix_dedup, token_files, warc
from vigil.llm.shared import ship

WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
END_ID = 2


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    found = token_files.token_documents(table(spark, folder, "documents"), vocabulary(WORD_BPE), END_ID)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, folder, "documents"), vocabulary(PIECE_BPE))


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents")).drop("spans")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, folder, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_later_copies(table(spark, folder, "documents"))


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive(table(spark, folder, "pages"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.verified(table(spark, folder, "documents"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents")).drop("pattern")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_files, op2_simhash, op3_decontaminate, op4_sentencepiece, op5_licenses,
        op6_exact_dedup, op7_pii, op8_suffix_dedup, op9_warc, op10_language, op11_manifest, op12_filter_audit, op13_quality_rules,
    )
}

SQL = {
    "op6_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER copies AS keep_id,
               count(*) OVER copies AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW copies AS (PARTITION BY coalesce(text, ''))""",
    # Trees of both kinds are levels of (lot, place, hash); a node's run on a level is the three places around it.
    "op11_manifest": """
        WITH RECURSIVE fields AS (
            SELECT doc_id, source, text,
                   coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') AS head,
                   list_reduce(
                       list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda x: ord(x)::ubigint)),
                       lambda c, b: list_reduce(
                           list_prepend(xor(c, b), list_transform(range(8), lambda i: 0::ubigint)),
                           lambda v, z: xor(v >> 1, 3988292384::ubigint * (v & 1::ubigint)))) & 1 AS low_bit
            FROM documents),
        hashed AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN low_bit = 1 AND text IS NOT NULL
                        THEN sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
                        ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS seen
            FROM fields),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
                   count(*) OVER (PARTITION BY source) AS n
            FROM hashed),
        tree AS (
            SELECT source, 0 AS level, place, n, leaf AS hash FROM leaves
            UNION ALL
            SELECT source, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
            FROM tree WHERE n > 1 GROUP BY source, level, place // 3, n),
        subroots AS (
            SELECT source, hash, row_number() OVER (ORDER BY source IS NOT NULL, encode(source)) - 1 AS place, count(*) OVER () AS n
            FROM tree WHERE n = 1),
        crown AS (
            SELECT 0 AS level, place, n, hash FROM subroots
            UNION ALL
            SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
            FROM crown WHERE n > 1 GROUP BY level, place // 3, n),
        walk AS (
            SELECT doc_id, source, leaf, seen AS node, '' AS proof, place, n, 0 AS level, 0 AS tier, seen FROM leaves
            UNION ALL
            (WITH runs AS (
                SELECT 0 AS tier, source, level, place // 3 AS run, list(hash ORDER BY place) AS hashes FROM tree GROUP BY source, level, place // 3
                UNION ALL
                SELECT 1, NULL, level, place // 3, list(hash ORDER BY place) FROM crown GROUP BY level, place // 3)
             SELECT w.doc_id, w.source, w.leaf,
                    CASE WHEN w.n = 1 THEN w.node ELSE
                         sha256(array_to_string(hashes[:w.place % 3], '') || w.node || array_to_string(hashes[w.place % 3 + 2:], '')) END,
                    CASE WHEN w.n = 1 THEN w.proof ELSE
                         w.proof || array_to_string(hashes[:w.place % 3], '') || array_to_string(hashes[w.place % 3 + 2:], '') END,
                    CASE WHEN w.n = 1 THEN s.place ELSE w.place // 3 END,
                    CASE WHEN w.n = 1 THEN s.n ELSE (w.n + 2) // 3 END,
                    CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END,
                    CASE WHEN w.n = 1 THEN w.tier + 1 ELSE w.tier END,
                    w.seen
             FROM walk w
             JOIN runs r ON r.tier = w.tier AND (w.tier = 1 OR r.source IS NOT DISTINCT FROM w.source) AND r.level = w.level AND r.run = w.place // 3
             JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source
             WHERE w.tier < 2))
        SELECT w.doc_id, w.leaf, s.hash AS subroot, c.hash AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root,
               w.node = c.hash AS verified
        FROM walk w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.source, (SELECT hash FROM crown WHERE n = 1) c
        WHERE w.tier = 2""",
    "op12_filter_audit": r"""
        WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        split AS (
            SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM texts),
        masks AS (
            SELECT doc_id, part,
                   (len(words) < 200)::int + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::int
                   + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::int
                   + 8 * regexp_matches(t, '[#$%&*|]')::int + 16 * coalesce(doc_id > first, false)::int AS mask
            FROM split),
        known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        counts AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
            FROM masks LEFT JOIN known USING (doc_id) GROUP BY part, mask),
        letters AS (SELECT chr(65 + i::int) AS x, (1 << i)::int AS bit FROM range(5) r(i)),
        orders AS (
            SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        steps AS (
            SELECT filter_order, s::int AS step, bits[s] AS bit, coalesce(list_sum(bits[:s - 1]), 0)::int AS before FROM orders, range(1, 6) r(s))
        SELECT part, filter_order, step,
               sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::bigint AS kept,
               sum(CASE WHEN mask & bit != 0 AND mask & before = 0 THEN n ELSE 0 END)::bigint AS removed,
               sum(CASE WHEN mask & bit != 0 AND mask & before != 0 THEN n ELSE 0 END)::bigint AS redundant,
               sum(CASE WHEN mask = bit THEN n ELSE 0 END)::bigint AS unique_fails,
               sum(CASE WHEN mask & bit != 0 AND mask & before = 0 THEN good ELSE 0 END)::bigint AS good_lost,
               sum(CASE WHEN mask & bit != 0 AND mask & before = 0 THEN toxic ELSE 0 END)::bigint AS toxic_lost,
               sum(sum(CASE WHEN mask & bit != 0 AND mask & before = 0 THEN n ELSE 0 END)) OVER (PARTITION BY part, bit)::bigint AS shapley
        FROM counts, steps GROUP BY part, filter_order, step, bit""",
    "op9_warc": """
        SELECT page_id, strlen(payload) AS payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
        FROM (SELECT *, coalesce(strlen(payload) >= 100 AND page_id != first, false) AS again
              FROM (SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages))""",
    # Bytes as two hexadecimal digits each; a window is 100 of them.
    "op8_suffix_dedup": """
        WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        windows AS (
            SELECT r, doc_id, i, substr(x, 2 * i + 1, 100) AS bytes
            FROM (SELECT *, unnest(range(0, length(x) // 2 - 49)) AS i FROM texts)),
        firsts AS (SELECT bytes, min(doc_id) AS first FROM windows GROUP BY bytes HAVING count(*) > 1),
        hits AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM windows JOIN firsts USING (bytes) WHERE first < doc_id),
        numbered AS (
            SELECT *, sum(CASE WHEN before IS NULL OR i - before > 50 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM hits),
        runs AS (SELECT r, run, min(i) AS b, max(i) + 50 AS e FROM numbered GROUP BY r, run),
        gaps AS (SELECT r, b, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS since FROM runs),
        gone AS (
            SELECT r, sum(e - b)::bigint AS n_removed, count(*) AS n_spans, max(e) AS last,
                   string_agg(substr(x, 2 * since + 1, 2 * (b - since)), '' ORDER BY b) AS kept
            FROM gaps JOIN texts USING (r) GROUP BY r)
        SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM texts LEFT JOIN gone USING (r)""",
}
