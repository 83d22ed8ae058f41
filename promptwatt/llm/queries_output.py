"""Registered queries of fill-in-middle (11), sharding (12) and search (13), and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import fill_middle, ranked_search, sharding
from .common import table


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (SELECT *, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_rows(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _crc_step() -> str:
    """The checksum of x's next byte: a sum over its bits, each with the value that
    the checksum's polynomial gives a single bit."""
    x = "xor(acc, x) & 255"
    bit = lambda k: zlib.crc32(bytes([1 << k])) ^ zlib.crc32(b"\0")
    out = "acc >> 8"
    for k in range(8):
        out = f"xor({out}, (({x}) >> {k} & 1) * {bit(k)})"
    return out


OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 8 AS BIGINT) AS size,
    xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT), lambda acc, x: {_crc_step()}, 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM documents),
jump AS (
  SELECT doc_id, 0::BIGINT AS b, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16))::UBIGINT::HUGEINT AS k FROM (SELECT DISTINCT doc_id FROM documents)
  UNION ALL
  SELECT doc_id, CAST(floor((b + 1) * (2147483648.0::DOUBLE / (((k * {sharding.MULTIPLIER} + 1) % 18446744073709551616) // 8589934592 + 1)::DOUBLE)) AS BIGINT), (k * {sharding.MULTIPLIER} + 1) % 18446744073709551616
  FROM jump WHERE b < 25),
s AS (SELECT doc_id, CAST(max(b) FILTER (b < 24) AS INTEGER) AS shard, CAST(max(b) FILTER (b < 25) AS INTEGER) AS grown_shard FROM jump GROUP BY doc_id)
SELECT d.doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY ('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || '/' || size || '/' || text_crc32), 1, 15))::BIGINT, d.doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  grown_shard
FROM d JOIN s ON d.doc_id IS NOT DISTINCT FROM s.doc_id
"""


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH t AS (
  SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)),
f AS (SELECT r, doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
l AS (SELECT r, sum(tf)::BIGINT AS n FROM f GROUP BY r),
g AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM l),
df AS (SELECT term, count(*) AS df FROM f GROUP BY term),
q AS (
  SELECT item_id, i, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))),
qt AS (SELECT item_id, i, term, count(*) AS times FROM q GROUP BY ALL),
s AS (
  SELECT i, item_id, r, doc_id, CAST(sum(times * CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT)
      * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nd) // nt)))) AS BIGINT) AS score
  FROM qt JOIN f USING (term) JOIN df USING (term) JOIN l USING (r), g GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

QUERIES = {"op11_fill_in_middle": (op11_fill_in_middle, OP11_SQL), "op12_sharding": (op12_sharding, OP12_SQL), "op13_ranked_search": (op13_ranked_search, OP13_SQL)}
