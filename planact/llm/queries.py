"""One query per operator over its whole test table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planact.llm import (
    chat_format,
    decontamination,
    exact_dedup,
    hamming_search,
    language_id,
    lexical_search,
    merkle_manifest,
    packing,
    secret_scan,
    sentence_spans,
    simhash,
    toxicity,
    warc_bundles,
)

Run = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontamination.contamination(docs, items)
    return found.select("doc_id", "item_id", "windows", "item_windows", "share", "exact")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_bundles.archived(_table(spark, sf_dir, "pages"), min_bytes=0)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")

    def held_out(column: str):
        return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % 5 == 0

    model = toxicity.train(docs, labels, held_out=held_out("id"))
    found = toxicity.scored(docs, model)
    return found.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        "flagged",
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify_documents(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "language", "confidence", "text_language", "declared", "host", "accepted")


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator on pages: text, markup, suffix and host."""
    found = language_id.identify_pages(_table(spark, sf_dir, "pages"))
    return found.select(
        F.col("doc_id").alias("page_id"), "language", "confidence", "text_language", "declared", "host", "accepted"
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.find_secrets(_table(spark, sf_dir, "documents")))


def op8_hamming_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_search.nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(tricky).alias("text"),
    )
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(extra)))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeats(_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents")).drop("key")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    marked = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.col("n_chars").cast("decimal(20, 0)") + 1
    tampered = [*fields[:3], F.when(marked, more).otherwise(F.col("n_chars").cast("decimal(20, 0)")), fields[4]]
    found = merkle_manifest.verified(docs, fields, tampered, "doc_id", "lang")
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"), "folded_root", "verified",
    )


QUERIES: dict[str, Run] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_warc,
        op3_packing,
        op4_toxicity,
        op5_simhash,
        op6_language_id,
        op7_secrets,
        op8_hamming_search,
        op9_chat_format,
        op10_sentence_spans,
        op11_exact_dedup,
        op12_lexical_search,
        op13_merkle_manifest,
        page_languages,
    )
}

_BASE32_DIGEST = """
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
        ((instr('0123456789abcdef', substr(h, CAST(5 * i // 4 + 1 AS BIGINT), 1)) - 1) * 256
         + (instr('0123456789abcdef', substr(h, CAST(5 * i // 4 + 2 AS BIGINT), 1)) - 1) * 16
         + greatest(instr('0123456789abcdef', substr(h || '00', CAST(5 * i // 4 + 3 AS BIGINT), 1)) - 1, 0))
        >> CAST(7 - (5 * i) % 4 AS BIGINT)) & 31 AS BIGINT), 1)), '')
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

# CRC-32 of the decimal doc_id, bit by bit.
_CRC32 = """xor(list_reduce(range(length(CAST(doc_id AS VARCHAR))), lambda c, i: list_reduce(range(8),
    lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END),
    xor(c, ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS BIGINT), 1)))), 4294967295), 4294967295)"""


def _leaf_sql(n_chars: str) -> str:
    def one(field: str) -> str:
        return f"coalesce(octet_length(encode(CAST({field} AS VARCHAR))) || ':' || CAST({field} AS VARCHAR), '-')"

    return "sha256(" + " || ".join(one(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLES: dict[str, str] = {
    "op2_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
        d AS (SELECT page_id, sha1(t) AS h, octet_length(encode(t)) AS payload_bytes FROM p),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM d)
        SELECT page_id, payload_bytes, {_BASE32_DIGEST} AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
        FROM f
    """,
    "op9_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        t AS (
            SELECT *, replace(replace(replace(replace(role, '~', '~0'), '<', '~1'), '#', '~2'), ':', '~3') AS r,
                   CASE WHEN contains(text, '</turn>') OR contains(text, '### ')
                        THEN '~: ' || replace(replace(replace(text, '~', '~0'), '<', '~1'), '#', '~2')
                        ELSE ': ' || text END AS b
            FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('### ' || r || b || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id
    """,
    "op11_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op12_lexical_search": rf"""
        WITH d AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
        s AS (SELECT CAST(count(*) FILTER (len(ws) > 0) AS BIGINT) AS docs, CAST(sum(len(ws)) AS BIGINT) AS total FROM d),
        q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS w FROM benchmark),
        t AS (SELECT doc_id, n, w, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS w FROM d)
              WHERE w IN (SELECT w FROM q) GROUP BY doc_id, n, w),
        f AS (SELECT w, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
              FROM (SELECT w, count(*) AS df FROM t GROUP BY w), s),
        r AS (SELECT item_id, doc_id,
                     CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total)))) AS BIGINT) AS score
              FROM q JOIN t USING (w) JOIN f USING (w), s GROUP BY item_id, doc_id),
        k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                     doc_id, score FROM r WHERE score > 0)
        SELECT * FROM k WHERE rank <= 10
    """,
    "op13_merkle_manifest": f"""
        WITH RECURSIVE f AS (
            SELECT doc_id, lang, {_leaf_sql('CAST(n_chars AS HUGEINT)')} AS leaf,
                   {_leaf_sql(f"CAST(n_chars AS HUGEINT) + CASE WHEN {_CRC32} % 7 = 0 THEN 1 ELSE 0 END")} AS claimed
            FROM documents),
        a AS (
            SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS size,
                   row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
            FROM f),
        lv AS (
            SELECT tree, 0 AS l, idx, leaf AS h, size AS n FROM a
            UNION ALL
            SELECT tree, l + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2
            FROM lv WHERE n > 1 GROUP BY tree, l, idx // 2, n),
        subs AS (SELECT tree, h AS subroot, count(*) OVER () AS trees FROM lv WHERE n = 1),
        tv AS (
            SELECT 0 AS l, tree AS idx, subroot AS h, trees AS n FROM subs
            UNION ALL
            SELECT l + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2
            FROM tv WHERE n > 1 GROUP BY l, idx // 2, n),
        c AS (
            SELECT doc_id, tree, leaf, 0 AS l, idx, size AS n, claimed AS acc, '' AS proof FROM a
            UNION ALL
            SELECT c.doc_id, c.tree, c.leaf, c.l + 1, c.idx // 2, (c.n + 1) // 2,
                   sha256(CASE WHEN s.h IS NULL THEN c.acc WHEN c.idx % 2 = 1 THEN s.h || c.acc ELSE c.acc || s.h END),
                   c.proof || coalesce(s.h, '')
            FROM c LEFT JOIN lv s ON s.tree = c.tree AND s.l = c.l AND s.idx = xor(c.idx, 1) WHERE c.n > 1),
        u AS (
            SELECT c.doc_id, c.leaf, subs.subroot, 0 AS l, c.tree AS idx, subs.trees AS n, c.acc, c.proof
            FROM c JOIN subs ON subs.tree = c.tree WHERE c.n = 1
            UNION ALL
            SELECT u.doc_id, u.leaf, u.subroot, u.l + 1, u.idx // 2, (u.n + 1) // 2,
                   sha256(CASE WHEN s.h IS NULL THEN u.acc WHEN u.idx % 2 = 1 THEN s.h || u.acc ELSE u.acc || s.h END),
                   u.proof || coalesce(s.h, '')
            FROM u LEFT JOIN tv s ON s.l = u.l AND s.idx = xor(u.idx, 1) WHERE u.n > 1)
        SELECT u.doc_id, u.leaf, u.subroot, tv.h AS root, sha256(u.proof) AS proof_sha256, u.acc AS folded_root,
               u.acc = tv.h AS verified
        FROM u, tv WHERE u.n = 1 AND tv.n = 1
    """,
}
