"""The queries opN_<name> that apply the operators to their whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm import align, chat, decontam, digest, langid, lines, lm, merkle, packing, simhash, substring, toxicity, warc
from furrow.llm.common import table
from furrow.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return put


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def packed(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


@query(
    "op10_warc",
    """
    WITH p AS (
        SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
        FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM p JOIN f USING (payload_digest)
    """,
)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    found = warc.read_warc(spark, folder, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op5_line_dedup",
    """
    WITH pg AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
    tot AS (SELECT source, count(*) AS pages FROM pg GROUP BY 1),
    ln AS (
        SELECT source, unnest(list_distinct(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(12) || chr(11))))) AS line
        FROM pg),
    boil AS (
        SELECT ln.source, line FROM ln JOIN tot ON ln.source IS NOT DISTINCT FROM tot.source WHERE line <> ''
        GROUP BY ln.source, line, pages HAVING count(*) >= 5 AND count(*) > CAST(0.02 AS DOUBLE) * pages),
    per AS (SELECT source, list(line) AS drops FROM boil GROUP BY 1),
    d AS (
        SELECT doc_id, text, string_split(text, chr(10)) AS lines,
            list_filter(string_split(text, chr(10)), lambda x: NOT list_contains(coalesce(drops, []), trim(x, ' ' || chr(9) || chr(13) || chr(12) || chr(11)))) AS kept
        FROM documents LEFT JOIN per ON documents.source IS NOT DISTINCT FROM per.source)
    SELECT doc_id, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines) - len(kept), 0) AS BIGINT) AS n_dropped,
        CASE WHEN text IS NOT NULL THEN coalesce(array_to_string(kept, chr(10)), '') END AS text
    FROM d
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.drop_boilerplate(docs, ratio=0.02, min_pages=5).select("doc_id", "n_lines", "n_dropped", "text")


@query(
    "op6_chat_formatting",
    """
    WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos FROM t),
    p AS (SELECT conv_id, pos, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS pre FROM n),
    e AS (SELECT conv_id, max(pos) AS n, arg_max(pre, pos) AS whole FROM p GROUP BY 1),
    inner_ AS (SELECT DISTINCT pre FROM p JOIN e USING (conv_id) WHERE pos < n),
    kept AS (SELECT min(conv_id) AS conv_id FROM e WHERE whole NOT IN (SELECT pre FROM inner_) GROUP BY whole)
    SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
        string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
    FROM n WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY conv_id
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render_chats(table(spark, sf_dir, "conversations"))


@query(
    "op7_benchmark_decontamination",
    r"""
    WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[ \t-\r]+', ' ', 'g')), ' ') AS w FROM documents WHERE text IS NOT NULL),
    ds AS (SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM w),
    v AS (SELECT item_id, string_split(trim(regexp_replace(lower(text), '[ \t-\r]+', ' ', 'g')), ' ') AS w FROM benchmark WHERE text IS NOT NULL),
    bs AS (SELECT item_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s FROM v),
    n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY 1)
    SELECT doc_id, item_id, CAST(n_shingles AS BIGINT) AS n_shingles, CAST(count(*) AS BIGINT) AS n_found, count(*) / n_shingles AS containment
    FROM ds JOIN bs USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= CAST(0.8 AS DOUBLE) * n_shingles - 1e-9
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=5, threshold=0.8)


@query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), width=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op4_document_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return digest.compare_edited(docs, digest.fit_ranks(docs))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


@query("op8_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm.cross_entropy_difference(table(spark, sf_dir, "documents"), good)


@query("op11_language_id")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), size=300)


#: CRC-32 of a decimal id, bit by bit; the tree by levels, and each document's path up to the root.
MERKLE_SQL = """
    WITH RECURSIVE d AS (
        SELECT doc_id, source, lang, n_chars, text, CAST(doc_id AS VARCHAR) AS id,
            xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 2 = 0 AS struck
        FROM documents),
    f AS (
        SELECT doc_id, source, struck,
            concat(coalesce(strlen(id) || ':' || id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS head, text, replace(text, chr(10), '') AS bare
        FROM d),
    l AS (
        SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            CASE WHEN struck THEN sha256(head || coalesce(strlen(bare) || ':' || bare, '-')) END AS shown
        FROM f),
    n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM l),
    t AS (
        SELECT 0 AS level, source, idx, leaf AS node, count(*) OVER (PARTITION BY source) AS width FROM n
        UNION ALL
        SELECT level + 1, source, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (any_value(width) + 2) // 3 FROM t WHERE width > 1 GROUP BY level, source, idx // 3),
    subs AS (SELECT source, level, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS width FROM t WHERE width = 1),
    u AS (
        SELECT 0 AS level, idx, subroot AS node, width FROM subs
        UNION ALL
        SELECT level + 1, idx // 3, sha256(string_agg(node, '' ORDER BY idx)), (any_value(width) + 2) // 3 FROM u WHERE width > 1 GROUP BY level, idx // 3),
    top AS (SELECT node AS root FROM u WHERE width = 1),
    sib AS (
        SELECT a.level, a.source, a.idx, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS lhs,
            coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS rhs
        FROM t a JOIN t b ON a.level = b.level AND a.source IS NOT DISTINCT FROM b.source AND a.idx // 3 = b.idx // 3 WHERE a.width > 1 GROUP BY ALL),
    usib AS (
        SELECT a.level, a.idx, coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS lhs,
            coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS rhs
        FROM u a JOIN u b ON a.level = b.level AND a.idx // 3 = b.idx // 3 WHERE a.width > 1 GROUP BY ALL),
    p AS (
        SELECT n.doc_id, n.leaf, n.source, n.idx AS at, s.subroot,
            coalesce(string_agg(sib.lhs || sib.rhs, '' ORDER BY sib.level), '') AS own, list({'l': sib.lhs, 'r': sib.rhs} ORDER BY sib.level) FILTER (WHERE sib.level IS NOT NULL) AS steps, n.shown, s.idx AS up
        FROM n JOIN subs s ON n.source IS NOT DISTINCT FROM s.source
        LEFT JOIN sib ON n.source IS NOT DISTINCT FROM sib.source AND sib.idx = n.idx // CAST(power(3, sib.level) AS BIGINT)
        GROUP BY ALL),
    q AS (
        SELECT s.source, coalesce(string_agg(usib.lhs || usib.rhs, '' ORDER BY usib.level), '') AS above,
            list({'l': usib.lhs, 'r': usib.rhs} ORDER BY usib.level) FILTER (WHERE usib.level IS NOT NULL) AS steps
        FROM subs s LEFT JOIN usib ON usib.idx = s.idx // CAST(power(3, usib.level) AS BIGINT) GROUP BY s.source),
    z AS (
        SELECT p.doc_id, p.leaf, p.subroot, sha256(p.own || q.above) AS proof_sha256,
            list_reduce(list_prepend({'l': coalesce(p.shown, p.leaf), 'r': ''}, list_concat(coalesce(p.steps, []), coalesce(q.steps, []))),
                lambda a, b: {'l': sha256(b.l || a.l || b.r), 'r': ''}).l AS folded_root
        FROM p JOIN q ON p.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM z, top
"""


@query("op13_merkle_manifest", MERKLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_manifest(table(spark, sf_dir, "documents"))


@query("op12_tokenizer_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return align.align_tokenizers(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
