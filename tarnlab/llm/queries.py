"""The queries of this subpackage, one for each operator, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, common, jaccard, langid, mixing, mpeg, packing, quality, repair, resampling, sharding, substrings, warc

#: Vocabulary files of public tokenizers; every executor has them.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(common.table(spark, sf_dir, "pages"))
    records = warc.read_archive(spark, archive)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.sha2("record", 256).alias("record_sha256"))


#: With the bytes of each rebuilt record, header lines and all.
OP3_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p),
k AS (SELECT *, n >= 1000 AND page_id <> top AS again, chr(13) || chr(10) AS e, regexp_replace(coalesce(url, ''), '[\x00-\x20\x7f]', '%20', 'g') AS uri,
  md5('page:' || page_id) AS own, md5('page:' || top) AS other FROM q),
h AS (SELECT *, 'HTTP/1.1 200 OK' || e || 'Content-Type: text/html; charset=utf-8' || e || 'Content-Length: ' || n || e || e AS http FROM k),
r AS (SELECT *, 'WARC/1.1' || e || 'WARC-Type: ' || CASE WHEN again THEN 'revisit' ELSE 'response' END || e
  || 'WARC-Record-ID: <urn:uuid:' || regexp_replace(own, '(.{8})(.{4})(.{4})(.{4})(.{12})', '\1-\2-\3-\4-\5') || '>' || e || 'WARC-Date: 2020-01-01T00:00:00Z' || e
  || CASE WHEN uri <> '' THEN 'WARC-Target-URI: ' || uri || e ELSE '' END || 'X-Page-ID: ' || page_id || e
  || 'WARC-Payload-Digest: sha1:' || sha1(html) || e || 'X-Payload-SHA256: ' || sha256(html) || e
  || CASE WHEN again THEN 'WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest' || e
    || 'WARC-Refers-To: <urn:uuid:' || regexp_replace(other, '(.{8})(.{4})(.{4})(.{4})(.{12})', '\1-\2-\3-\4-\5') || '>' || e || 'X-Refers-To-Page-ID: ' || top || e ELSE '' END
  || 'Content-Type: application/http;msgtype=response' || e || 'Content-Length: ' || (strlen(http) + CASE WHEN again THEN 0 ELSE n END) || e || e
  || http || CASE WHEN again THEN '' ELSE html END || e || e AS record FROM h)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN again THEN top END AS refers_to, sha256(record) AS record_sha256
FROM r
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.table(spark, sf_dir, "documents"), WORD_BPE)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `conversations` are one layout, conversation -1 is another."""
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fields = F.struct("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    records = rows.select("conv_id", "turn", F.to_variant_object(fields).alias("record"))
    said = F.lit("<|im_end|><|im_start|>assistant ok")
    messages = F.array(*[F.struct(F.lit(r).alias("role"), said.alias("content")) for r in ("user", "assistant")])
    extra = spark.range(1).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("turn"),
        F.to_variant_object(F.struct(messages.alias("messages"))).alias("record"),
    )
    out = chat.read_back(chat.format_conversations(records.unionByName(extra)))
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.concat_ws("", "loss")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", each), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
made AS (
  SELECT *, '<|im_start|>' || role || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS formatted
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM made GROUP BY conv_id
"""


def op6_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg.digests(mpeg.read(mpeg.store(common.table(spark, sf_dir, "documents"))))


def op7_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup_substrings(common.table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode_documents(common.table(spark, sf_dir, "documents"), BYTE_BPE)
    return bpe.digests(bpe.decode_documents(ids, BYTE_BPE))


def op9_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(common.table(spark, sf_dir, "documents"))


#: A row's shard is that in which the bytes before its key fall.
OP9_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
keyed AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, text,
    CAST('0x' || substr(md5(coalesce(text, '')), 1, 8) AS BIGINT) * 268435456
      + CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 7) AS BIGINT) AS k
  FROM documents),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY k) - sum(size) OVER (PARTITION BY k) AS below, sum(size) OVER () AS total FROM keyed)
SELECT doc_id, CAST(size AS BIGINT) AS size,
  xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) AS text_crc32, 'bytes' AS law,
  CAST(least(15, 16 * below // total) AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY least(15, 16 * below // total) ORDER BY k, doc_id) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM placed, crc_table
"""


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(common.table(spark, sf_dir, "documents"))


#: Links of distinct sets by their common shingles, and all that is reachable by links.
OP10_SQL = r"""
WITH RECURSIVE
w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n, sha256(array_to_string(list_sort(sh), chr(10))) AS k FROM s),
d AS (SELECT k, min(doc_id) AS doc, max(n) AS n FROM n WHERE n > 0 GROUP BY 1),
t AS (SELECT d.k, d.n, unnest(sh) AS t FROM d JOIN s ON s.doc_id = d.doc),
p AS (SELECT a.k AS a, b.k AS b FROM t a JOIN t b ON a.t = b.t AND a.k < b.k AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p UNION ALL SELECT k, k FROM d),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT r.a AS k, min(d.doc) AS component FROM r JOIN d ON d.k = r.b GROUP BY 1)
SELECT doc_id, n AS n_shingles, coalesce(component, doc_id) AS component_id FROM n LEFT JOIN c USING (k)
"""


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(common.table(spark, sf_dir, "documents")).drop("taken_by")


#: Sources above their cap come first in order of size by weight; the document at the threshold is taken if that brings its source nearer.
OP11_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
  substr(md5(concat_ws(':', '0', CAST(doc_id AS VARCHAR), text)), 1, 15) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d GROUP BY 1),
o AS (SELECT *, sum(n) OVER () AS total, coalesce(sum(3 * n) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
  sum(w) OVER (q ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM s WINDOW q AS (ORDER BY n * 1.0 / w, source NULLS LAST)),
f AS (SELECT *, arg_min(CAST(total - capped AS DOUBLE), n * 1.0 / w) FILTER (3 * n * rest >= (total - capped) * w) OVER () AS shared,
  arg_min(rest, n * 1.0 / w) FILTER (3 * n * rest >= (total - capped) * w) OVER () AS among FROM o),
t AS (SELECT source, n, CASE WHEN shared IS NULL OR CAST(3 * n AS DOUBLE) * among < shared * w THEN 3.0 * n ELSE shared * w / among END AS target FROM f),
p AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE CAST(floor(target / n) AS BIGINT) END AS passes FROM t),
r AS (SELECT d.*, p.n, p.target, p.passes, p.target - p.passes * p.n AS need,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, n AS source_size, CAST(target AS DOUBLE) AS target,
  CAST(size * (passes + CASE WHEN need > 0 AND upto - size < need AND 2 * (need - (upto - size)) >= size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    report, _ = repair.repair(repair.damage(common.table(spark, sf_dir, "conversations")))
    return report


#: Row by row: of the ways to each state (nothing yet, system, user, assistant last) the least by cost, then audit.
OP12_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
base AS (SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)]))) % 20 AS f FROM conversations, crc_table),
damaged AS (SELECT g, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role, CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM base),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS k,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, substr(role, 1, 1) AS ini FROM damaged),
faulty AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY k) > 1 THEN 'duplicate' WHEN bare[-1:] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  lag(ini) OVER (PARTITION BY g ORDER BY k) || ini NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
steps AS (
  SELECT g, CAST(0 AS BIGINT) AS k, [{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}] AS s0, CAST([] AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)[]) AS s1, CAST([] AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)[]) AS s2, CAST([] AS STRUCT(c BIGINT, a VARCHAR, o VARCHAR)[]) AS s3
  FROM (SELECT DISTINCT g FROM faulty)
  UNION ALL
  SELECT g, k, d0,
    list_sort(d1 || CASE WHEN free AND ini = 's' THEN list_transform(s0, lambda x: {'c': x.c + late, 'a': x.a || 'K', 'o': x.o || chr(10) || role || ':' || text}) ELSE [] END)[1:1],
    list_sort(d2 || CASE WHEN free THEN list_transform(s0 || s1 || s3, lambda x: {'c': x.c + late + eu, 'a': x.a || lu, 'o': x.o || chr(10) || ru || ':' || text})
      || list_transform(s2, lambda x: {'c': x.c + late + eu + 5, 'a': x.a || 'I' || lu, 'o': x.o || chr(10) || 'assistant:' || chr(10) || ru || ':' || text}) ELSE [] END)[1:1],
    list_sort(d3 || CASE WHEN free THEN list_transform(s2, lambda x: {'c': x.c + late + ea, 'a': x.a || la, 'o': x.o || chr(10) || ra || ':' || text})
      || list_transform(s0 || s1 || s3, lambda x: {'c': x.c + late + ea + 5, 'a': x.a || 'I' || la, 'o': x.o || chr(10) || 'user:' || chr(10) || ra || ':' || text}) ELSE [] END)[1:1]
  FROM (
    SELECT s.g, f.k, f.role, f.text, f.ini, s.s0, s.s1, s.s2, s.s3, f.fault NOT IN ('blank', 'duplicate') AS free, CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END AS late,
      CASE f.ini WHEN 'u' THEN 0 ELSE 1 END AS eu, CASE f.ini WHEN 'u' THEN 'K' ELSE 'R' END AS lu, CASE f.ini WHEN 'u' THEN f.role ELSE 'user' END AS ru,
      CASE f.ini WHEN 'a' THEN 0 ELSE 1 END AS ea, CASE f.ini WHEN 'a' THEN 'K' ELSE 'R' END AS la, CASE f.ini WHEN 'a' THEN f.role ELSE 'assistant' END AS ra,
      list_transform(s.s0, lambda x: {'c': x.c + 2, 'a': x.a || 'D', 'o': x.o}) AS d0, list_transform(s.s1, lambda x: {'c': x.c + 2, 'a': x.a || 'D', 'o': x.o}) AS d1,
      list_transform(s.s2, lambda x: {'c': x.c + 2, 'a': x.a || 'D', 'o': x.o}) AS d2, list_transform(s.s3, lambda x: {'c': x.c + 2, 'a': x.a || 'D', 'o': x.o}) AS d3
    FROM steps s JOIN faulty f ON f.g = s.g AND f.k = s.k + 1)),
ends AS (SELECT g, list_sort(s0 || s3 || list_transform(s2, lambda x: {'c': x.c + 5, 'a': x.a || 'I', 'o': x.o || chr(10) || 'assistant:'})
  || list_transform(s1, lambda x: {'c': x.c + 10, 'a': x.a || 'II', 'o': x.o || chr(10) || 'user:' || chr(10) || 'assistant:'}))[1] AS best FROM steps QUALIFY k = max(k) OVER (PARTITION BY g)),
counted AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal FROM faulty GROUP BY g)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.o, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, g FROM base) b LEFT JOIN counted USING (g) LEFT JOIN ends USING (g)
"""


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


#: The checksum of every different feature's bytes.
OP13_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
w AS (SELECT doc_id, row_number() OVER () AS r, true AS raw, text FROM documents UNION ALL SELECT NULL, -row_number() OVER (), false, text FROM benchmark),
ws AS (SELECT doc_id, r, raw, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM w),
g AS (SELECT r, raw, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS gram FROM ws),
b AS (SELECT gram, xor(4294967295, list_reduce(
    list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(gram)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
    lambda c, x: xor(c >> 8, crc[1 + (xor(c, x) & 255)]))) % 10000 AS bucket FROM (SELECT DISTINCT gram FROM g), crc_table),
n AS (SELECT r, raw, bucket FROM g JOIN b USING (gram)),
c AS (SELECT bucket, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM n GROUP BY 1),
gain AS (SELECT bucket, floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)) / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS gain FROM c),
weight AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM n JOIN gain USING (bucket) WHERE raw GROUP BY 1),
scored AS (SELECT doc_id, len(ws) AS words, CAST(greatest(2 * len(ws) - 1, 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM ws LEFT JOIN weight USING (r) WHERE raw),
placed AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) FILTER (words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM placed
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_quality_rules": op2_quality_rules,
        "op3_warc": op3_warc,
        "op4_packing": op4_packing,
        "op5_chat_format": op5_chat_format,
        "op6_mpeg_audio": op6_mpeg_audio,
        "op7_chunk_dedup": op7_chunk_dedup,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_histogram_shards": op9_histogram_shards,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_source_mix": op11_source_mix,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_importance_resampling": op13_importance_resampling,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": OP3_SQL, "op5_chat_format": OP5_SQL, "op9_histogram_shards": OP9_SQL, "op10_jaccard_join": OP10_SQL, "op11_source_mix": OP11_SQL, "op12_conversation_repair": OP12_SQL, "op13_importance_resampling": OP13_SQL}
