"""Registered queries of the corpus operators, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from provlake.llm import bpe, conversations, decontaminate, jaccard, language, licenses, resampling, sentencepieces, sharding, substring, toxicity, vectors, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_substring(spark: SparkSession, folder: str) -> DataFrame:
    return substring.repeated_passages(_table(spark, folder, "documents"))


def op4_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.predict_documents(_table(spark, folder, "documents"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxic_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_documents(_table(spark, folder, "documents"))


def op8_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, folder, "embeddings"))


def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_table(spark, folder, "pages"))


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.prefix_trie(_table(spark, folder, "conversations"))


def op12_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepieces.encode_documents(_table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


_WORDS_1 = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

SQL_1 = rf"""
WITH d AS (SELECT doc_id, {_WORDS_1} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_1} AS w FROM benchmark),
i AS (SELECT item_id, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p, w FROM b WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM i),
ks AS (SELECT DISTINCT k FROM iw),
dp AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k),
dw AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s FROM dp),
h AS MATERIALIZED (SELECT doc_id, item_id, k, p FROM dw JOIN iw USING (k, s)),
n_hit AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM h) GROUP BY doc_id),
n_items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit.n, 0)::BIGINT AS n_hit, coalesce(n_items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN n_hit USING (doc_id) LEFT JOIN n_items USING (doc_id)
"""

SQL_7 = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM p),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, (SELECT min(b) FROM r WHERE r.a = d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

SQL_10 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS raw FROM pages),
h AS (SELECT page_id, octet_length(raw) AS n, sha1(raw) AS hex FROM p),
f AS (SELECT hex, min(page_id) AS first,
             array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + list_sum(list_transform(range(5), lambda j:
                 (((strpos('0123456789abcdef', hex[1 + (i * 5 + j) // 4]) - 1) >> (3 - (i * 5 + j) % 4)) & 1) << (4 - j)))::INT]), '') AS digest
      FROM h GROUP BY hex)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM h JOIN f USING (hex)
"""

#: CRC-32 in SQL: the byte table, and the checksum of a list of bytes.
_CRC_TABLE = "SELECT list(v ORDER BY n) AS tab FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, 3988292384 * (a & 1))) AS v FROM range(256) r(n))"
_CRC = "xor(list_reduce(list_concat([4294967295::BIGINT], {bytes}), lambda a, b: xor(a >> 8, tab[1 + (xor(a, b) & 255)])), 4294967295::BIGINT)"

SQL_11 = f"""
WITH crc AS MATERIALIZED ({_CRC_TABLE}),
t AS MATERIALIZED (SELECT conv_id, r, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(r)::VARCHAR || ':' || r || x)) AS p
      FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)),
c AS MATERIALIZED (SELECT conv_id, {_CRC.format(bytes="list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
b AS (SELECT c.conv_id, p AS d, r, x FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 5 AND p <= h),
k AS (SELECT c.conv_id, h, count(d) AS k FROM c LEFT JOIN b ON b.conv_id = c.conv_id GROUP BY ALL),
s AS (SELECT * FROM b UNION ALL SELECT t.conv_id, k + p - h, r, x FROM t JOIN k USING (conv_id) WHERE p > h),
g AS (SELECT conv_id, d, strlen(x) AS bytes, md5(string_agg(strlen(r)::VARCHAR || ':' || r || strlen(x)::VARCHAR || ':' || x, '') OVER (PARTITION BY conv_id ORDER BY d)) AS node FROM s),
m AS MATERIALIZED (SELECT conv_id, d, bytes, node, coalesce(lag(node) OVER w, '') AS parent, lead(d) OVER w IS NULL AS ends FROM g WINDOW w AS (PARTITION BY conv_id ORDER BY d)
      UNION ALL SELECT conv_id, 0, 0, '', NULL, conv_id NOT IN (SELECT conv_id FROM g) FROM c),
n AS MATERIALIZED (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(parent) AS parent, max(bytes) AS bytes,
             coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ids FROM m GROUP BY node, d),
ch AS (SELECT parent AS node, count(*) AS n FROM n WHERE d > 0 GROUP BY parent),
u AS (SELECT m.node, sum((q.n_convs - 1) * q.bytes) AS saved, count(*) FILTER (WHERE ch.n IS NULL) AS leaves
      FROM n q LEFT JOIN ch ON ch.node = q.node JOIN m ON m.conv_id = q.conv_id AND m.d <= q.d GROUP BY m.node)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(n.ids) AS ends_sha256
FROM n LEFT JOIN n up ON up.node = n.parent LEFT JOIN ch ON ch.node = n.node JOIN u ON u.node = n.node
"""

_GRAMS = "SELECT {id} AS id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM {table}"

SQL_12 = rf"""
WITH crc AS MATERIALIZED ({_CRC_TABLE}),
d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id, {_WORDS_1} AS w FROM documents),
b AS (SELECT {_WORDS_1} AS w FROM benchmark),
fd AS MATERIALIZED ({_GRAMS.format(id="id", table="d")}),
fb AS MATERIALIZED ({_GRAMS.format(id="0", table="b")}),
h AS MATERIALIZED (SELECT f, {_CRC.format(bytes="list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT)")} % 10000 AS bucket
      FROM (SELECT f FROM fd UNION SELECT f FROM fb), crc),
sb AS (SELECT bucket, count(*) AS s FROM fd JOIN h USING (f) GROUP BY bucket),
tb AS (SELECT bucket, count(*) AS t FROM fb JOIN h USING (f) GROUP BY bucket),
g AS MATERIALIZED (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT count(*) FROM fd) + 10000))::DOUBLE / ((s + 1) * ((SELECT count(*) FROM fb) + 10000))::DOUBLE))::BIGINT AS gain
      FROM sb LEFT JOIN tb USING (bucket)),
wt AS (SELECT id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM fd JOIN h USING (f) JOIN g USING (bucket) GROUP BY id),
sc AS (SELECT id, doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
       FROM d LEFT JOIN wt USING (id)),
r AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM sc WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 25 * count(*) // 100 FROM sc WHERE words >= 20) THEN rank END AS rank FROM sc LEFT JOIN r USING (id)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_bpe": op2_bpe,
    "op3_substring": op3_substring,
    "op4_shards": op4_shards,
    "op5_language": op5_language,
    "op6_toxicity": op6_toxicity,
    "op7_jaccard": op7_jaccard,
    "op8_vectors": op8_vectors,
    "op9_licenses": op9_licenses,
    "op10_warc": op10_warc,
    "op11_conversations": op11_conversations,
    "op12_resampling": op12_resampling,
    "op13_sentencepiece": op13_sentencepiece,
}
SQL: dict[str, str] = {"op1_decontaminate": SQL_1, "op7_jaccard": SQL_7, "op10_warc": SQL_10, "op11_conversations": SQL_11, "op12_resampling": SQL_12}
