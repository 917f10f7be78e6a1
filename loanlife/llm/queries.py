"""The registered queries of this package, one per operator, over whole tables.

Operators that keep something (the digest index, the archives, the steps of the
Jaccard join) write to fresh folders under ``spark.checkpoint.dir`` when their
query is built; the folders can go once the result has been read.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlife.llm import (byte_bpe, chat_collapse, exact_dedup, html_gbt, jaccard_join, language_id, manifest, merkle,
                          mixing, pii_crf, secret_ledger, warc, whitening)
from loanlife.llm.common import ship_package, table
from loanlife.session import scratch_path


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    index = exact_dedup.DigestIndex(spark, scratch_path(spark, "digest-index"))
    return index.label(docs, index.append(docs))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_join.grouped(table(spark, sf_dir, "documents")).drop("row")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are those of the base; ``spans`` also has what the field adds."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii_crf.find(docs, pii_crf.fit(pii_crf.labelled_table(spark, docs))).drop("text")

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    counts = [count(kind) for kind in pii_crf.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"))


RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.decode(byte_bpe.encode(docs, RANKS).drop("text"), RANKS)
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out.alias("held_out"))
    dictionaries = language_id.fit(docs.where(~F.col("held_out")))
    return language_id.identify(docs.drop("lang"), dictionaries).drop("text")


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return merkle.follow(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written when the query is built and read once: lengths and digests of responses are those of
    the payloads read, those of revisits, which have none, of their headers."""
    ship_package(spark)
    warc.register(spark)
    path = scratch_path(spark, "warc")
    warc.records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    archive = spark.read.format("warc").load(path).where(F.col("record_type").isin("response", "revisit"))
    return archive.select(
        F.expr("try_cast(substring_index(record_id, ':', -1) as bigint)").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("bigint"), "payload_length").alias("payload_bytes"),
        F.coalesce(warc.base32(F.sha1("payload")), "payload_digest").alias("payload_digest"), "record_type",
        F.expr("try_cast(substring_index(refers_to, ':', -1) as bigint)").alias("refers_to"))


MIX_TEMPERATURE = 2.0   # target share of a source: the square root of its rows
MIX_PERIOD = 1000
MIX_BLOCK = 4           # documents of one block


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its slot; sorted by slot and place they are the mixture."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, period=MIX_PERIOD, temperature=MIX_TEMPERATURE, block_rows=MIX_BLOCK)


def op9_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.collapse(table(spark, sf_dir, "conversations"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    main = html_gbt.extract(pages, html_gbt.fit(html_gbt.labelled_pages(spark)))
    return main.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest is written when the query is built; every row is then proved against it, those
    with an even checksum of their id by the leaf of their text without line breaks."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents").select(*manifest.FIELDS)
    told = [F.col(f) for f in manifest.FIELDS]
    broken = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    without = [F.replace(f, F.lit("\n"), F.lit("")) if name == "text" else f for name, f in zip(manifest.FIELDS, told)]
    claim = F.when(broken, manifest.leaf(without)).otherwise(manifest.leaf(told))
    return manifest.Manifest(docs, scratch_path(spark, "manifest"), claim=claim).audit()


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform is fitted when the query is built."""
    ship_package(spark)
    rows = whitening.lattice(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return whitening.fit(rows, scratch_path(spark, "fit-list")).transform(rows)


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents are scanned into a fresh ledger when the query is built."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secret_ledger.BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    ledger.scan(docs, batch="documents")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*secret_ledger.BASE))
    return ledger.findings(docs).select("doc_id", *[count(kind) for kind in secret_ledger.BASE],
                                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_pii": op3_pii,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_language_id": op5_language_id,
    "op6_merkle": op6_merkle,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_chat_collapse": op9_chat_collapse,
    "op10_html": op10_html,
    "op11_manifest": op11_manifest,
    "op12_whitening": op12_whitening,
    "op13_secrets": op13_secrets,
}

ORACLE = {
    "op1_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM d WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op2_jaccard_join": """
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
            FROM documents),
        s AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN []
                WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - 3),
                                   lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
            FROM w),
        e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
            FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT x, y FROM common JOIN s p ON p.doc_id = x JOIN s q ON q.doc_id = y
            WHERE 100 * n >= 75 * (len(p.shingles) + len(q.shingles) - n)),
        both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
        reached AS (
            SELECT doc_id AS x, doc_id AS y FROM s
            UNION
            SELECT r.x, l.y FROM reached r JOIN both_ways l ON r.y = l.x),
        least AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x)
        SELECT doc_id, len(shingles)::BIGINT AS n_shingles, component_id FROM s JOIN least ON x = doc_id
    """,
    "op7_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
        bits AS (
            SELECT page_id, sha, strlen(html)::BIGINT AS payload_bytes,
                   list_reduce(list_transform(range(1, 41), lambda i: [
                       '0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011',
                       '1100','1101','1110','1111'][strpos('0123456789abcdef', substr(sha, i, 1))]),
                       lambda x, y: x || y) AS b
            FROM p),
        named AS (
            SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY sha) AS first,
                   list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       (16 * substr(b, 5 * i + 1, 1)::INT + 8 * substr(b, 5 * i + 2, 1)::INT
                        + 4 * substr(b, 5 * i + 3, 1)::INT + 2 * substr(b, 5 * i + 4, 1)::INT
                        + substr(b, 5 * i + 5, 1)::INT + 1)::BIGINT, 1)), lambda x, y: x || y) AS payload_digest
            FROM bits)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM named
    """,
    # Prefixes compared as texts; one piece each, as no conversation here has 256 turns.
    "op9_chat_collapse": """
        WITH t AS (
            SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
        said AS (
            SELECT *, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS line FROM t),
        whole AS (
            SELECT conv_id, count(*) AS depth, string_agg(line, '' ORDER BY turn, role, text) AS rendered
            FROM said GROUP BY conv_id),
        inner_prefix AS (
            SELECT DISTINCT a.conv_id, a.turn, string_agg(b.line, '' ORDER BY b.turn, b.role, b.text) AS so_far
            FROM said a JOIN said b ON a.conv_id = b.conv_id AND b.turn <= a.turn
            WHERE a.turn < (SELECT max(turn) FROM said c WHERE c.conv_id = a.conv_id)
            GROUP BY a.conv_id, a.turn),
        once AS (
            SELECT min(conv_id) AS conv_id, depth, count(*) AS copies, rendered FROM whole GROUP BY depth, rendered)
        SELECT conv_id, 0::BIGINT AS part, 0::BIGINT AS piece, depth, copies, depth AS n_turns, rendered
        FROM once WHERE rendered NOT IN (SELECT so_far FROM inner_prefix)
    """,
    # Trees as lists of nodes per level, proofs as lists of steps; the checksum bit by bit.
    "op11_manifest": """
        WITH RECURSIVE d AS (
            SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
                   || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
                   || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   replace(text, chr(10), '') AS cut,
                   list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
                       lambda x, y: list_reduce([xor(x, y), 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % 2 = 1 AS even_checksum
            FROM documents),
        h AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(CASE WHEN even_checksum THEN strlen(cut) || ':' || cut
                                                ELSE strlen(text) || ':' || text END, '-')) AS claim
            FROM d),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM h),
        t AS (
            SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
            UNION ALL
            SELECT source, level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
                       lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM t WHERE len(nodes) > 1),
        s AS (
            SELECT source, level AS height, nodes[1] AS subroot,
                   row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM t WHERE len(nodes) = 1),
        u AS (
            SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM s
            UNION ALL
            SELECT level + 1, list_transform(range(0, (len(nodes) + 2) // 3),
                       lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM u WHERE len(nodes) > 1),
        steps AS (
            SELECT p.source, p.place, t.level AS step, t.nodes, p.place // (3 ** t.level)::BIGINT AS q
            FROM placed p JOIN t ON t.source IS NOT DISTINCT FROM p.source WHERE len(t.nodes) > 1
            UNION ALL
            SELECT p.source, p.place, s.height + u.level, u.nodes, s.place // (3 ** u.level)::BIGINT
            FROM placed p JOIN s ON s.source IS NOT DISTINCT FROM p.source, u WHERE len(u.nodes) > 1),
        sides AS (
            SELECT source, place, list(struct_pack(l := array_to_string(nodes[q - q % 3 + 1:q], ''),
                                                   r := array_to_string(nodes[q + 2:q - q % 3 + 3], '')) ORDER BY step) AS path
            FROM steps GROUP BY source, place),
        whole AS (
            SELECT p.*, subroot, coalesce(path, []) AS path, (SELECT nodes[1] FROM u WHERE len(nodes) = 1) AS root
            FROM placed p JOIN s ON s.source IS NOT DISTINCT FROM p.source
            LEFT JOIN sides x ON x.source IS NOT DISTINCT FROM p.source AND x.place = p.place),
        folded AS (
            SELECT *, sha256(array_to_string(list_transform(path, lambda x: x.l || x.r), '')) AS proof_sha256,
                   list_reduce([struct_pack(l := claim, r := '')] || path,
                               lambda x, y: struct_pack(l := sha256(y.l || x.l || y.r), r := '')).l AS folded_root
            FROM whole)
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
    """,
    # The open patterns, the short matches dropped afterwards; offsets by the pieces between matches.
    "op13_secrets": """
        WITH rules(no, kind, pattern, least) AS (VALUES
            (1, 'assign', '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
            (2, 'access', '(AKIA[A-Z0-9]+)', 20), (3, 'hex', '([0-9a-f]+)', 24),
            (4, 'pem', '(-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----)', 0),
            (5, 'bearer', '([Bb][Ee][Aa][Rr][Ee][Rr] [A-Za-z0-9._~+/-]{20,}=*)', 0)),
        cut AS (
            SELECT doc_id, no, kind, least, regexp_extract_all(text, pattern, 0) AS m, regexp_extract_all(text, pattern, 1) AS g,
                   string_split_regex(text, pattern) AS p
            FROM documents, rules WHERE text IS NOT NULL),
        one AS (
            SELECT doc_id, no, kind, least, unnest(m) AS m, unnest(g) AS g, unnest(p[:len(m)]) AS p, unnest(range(len(m))) AS i
            FROM cut WHERE len(m) > 0),
        found AS (
            SELECT doc_id, no, kind, sum(length(p) + length(m)) OVER (PARTITION BY doc_id, no ORDER BY i) AS stop,
                   length(m) AS n, length(g) >= least AS good
            FROM one),
        told AS (
            SELECT doc_id, count(*) FILTER (no = 1) AS n_assign, count(*) FILTER (no = 2) AS n_access,
                   count(*) FILTER (no = 3) AS n_hex,
                   string_agg(kind || ':' || (stop - n) || ':' || stop, ',' ORDER BY stop - n, no) FILTER (no <= 3) AS base,
                   string_agg(kind || ':' || (stop - n) || ':' || stop, ',' ORDER BY stop - n, no) AS spans
            FROM found WHERE good GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents LEFT JOIN told USING (doc_id)
    """,
}
