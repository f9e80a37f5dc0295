"""DuckDB SQL of the registered queries, written apart from the Spark code."""

from __future__ import annotations

from penprint.llm.quality_rules import STOP_WORDS

_WORD = r"[^\x20\x09-\x0D]+"
_STOPS = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

OP6_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents
), tri AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM tri) WHERE c >= 2
), repeated AS (
  SELECT rid, count(*) AS n FROM (
    SELECT rid, i FROM twice UNION SELECT rid, i + 1 FROM twice UNION SELECT rid, i + 2 FROM twice
  ) GROUP BY rid
), line AS (
  SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), m AS (
  SELECT d.rid, doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS n_stop,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs, coalesce(n_lines, 0) AS n_lines,
         greatest(len(w), 1)::DOUBLE AS n
  FROM d LEFT JOIN repeated USING (rid) LEFT JOIN lines USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n BETWEEN 2 AND 12 AND n_symbols / n <= 0.1 AND n_bangs / n <= 0.1
         AND n_stop / n >= 0.03 AND n_dup_lines / greatest(n_lines, 1)::DOUBLE <= 0.4 AS kept
FROM b
"""

OP4_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, md5(coalesce(text, '')) AS digest,
         len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size
  FROM documents
), k AS (
  SELECT *, ('0x' || md5('0:' || coalesce(doc_id::VARCHAR, chr(0)) || ':' || digest)[1:15])::BIGINT AS key FROM d
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source
), w AS (
  SELECT *, (rank - 1) % 3 + 1 AS weight, 3 * source_size AS cap, sum(source_size) OVER () AS words FROM s
), l AS (
  SELECT *, (words - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS own
  FROM w
), v AS (
  SELECT *, (SELECT min_by(own, cap / weight) FROM l WHERE own * weight <= cap) AS level FROM l
), t AS (
  SELECT source, source_size, rank, least(cap::DOUBLE, level * weight) AS target,
         greatest(1, words // {1 << 20})::BIGINT AS block, words FROM v
), seats AS (
  SELECT rank, row_number() OVER (ORDER BY target / (2 * a + 1) DESC, rank) AS nth, words // block AS house
  FROM (SELECT *, unnest(range(0, (target / block)::BIGINT + 3)) AS a FROM t)
), q AS (
  SELECT rank, count(*) AS given FROM seats WHERE nth <= house GROUP BY rank
), b AS (
  SELECT t.*, ceil(source_size / block)::BIGINT AS nb,
         least(coalesce(given, 0), 3 * greatest(ceil(source_size / block)::BIGINT, 1)) AS quota
  FROM t LEFT JOIN q USING (rank)
), c AS (
  SELECT *, quota // greatest(nb, 1) AS passes, quota % greatest(nb, 1) AS more,
         ('0x' || md5('0:arc:' || coalesce(source, chr(0)))[1:15])::BIGINT % greatest(nb, 1) AS start,
         greatest(nb, 1) * block AS line_end
  FROM b
), p AS (
  SELECT k.*, c.source_size, c.target, c.passes, c.line_end, c.start * c.block AS a, (c.start + c.more) * c.block AS z,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.digest
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM k JOIN c ON k.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, size, source_size, target,
       (size * passes + greatest(0, least(pos + size, least(z, line_end)) - greatest(pos, a))
        + greatest(0, least(pos + size, greatest(0, z - line_end)) - pos))::BIGINT AS taken
FROM p
"""

#: CTEs crc_table and crc(rid, crc): CRC-32 of the UTF-8 bytes of ``bytes(rid, b)``, by the polynomial's table.
_CRC = """
crc_step(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_step WHERE k < 8
), crc_table AS (
  SELECT list(c ORDER BY i) AS tab FROM crc_step WHERE k = 8
), crc AS (
  SELECT rid, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295) AS crc
  FROM bytes, crc_table
)"""

OP9_SQL = f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size, coalesce(text, '') AS text,
         ('0x' || md5('0' || coalesce(':' || doc_id, ''))[1:15])::BIGINT AS key
  FROM documents
), c AS (
  SELECT *, sum(size) OVER () AS total,
         sum(size) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM d
), s AS (
  SELECT *, (24 * before // total)::INT AS shard FROM c
), hexed AS (
  SELECT rid, hex(encode(text)) AS h FROM d
), bytes AS (
  SELECT rid, list_transform(range(0, length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT) AS b FROM hexed
), {_CRC}
SELECT doc_id, size, crc.crc AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY key) - 1 AS slot, NULL::INT AS grown_shard
FROM s JOIN crc USING (rid)
"""

OP8_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h FROM pages
), f AS (
  SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS hex, min(page_id) OVER (PARTITION BY h) AS first FROM p
), b AS (
  SELECT *, list_reduce(list_transform(range(0, 40), lambda i: lpad(bin(('0x' || hex[i + 1])::INT), 4, '0')), lambda x, y: x || y) AS bits
  FROM f
)
SELECT page_id, payload_bytes,
       list_reduce(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[
         (16 * bits[5 * i + 1]::INT + 8 * bits[5 * i + 2]::INT + 4 * bits[5 * i + 3]::INT + 2 * bits[5 * i + 4]::INT
          + bits[5 * i + 5]::INT) + 1]), lambda x, y: x || y) AS payload_digest,
       CASE WHEN page_id IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

_ITEM_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP7_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_ITEM_WORDS} AS w FROM documents
), i AS (
  SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark) WHERE len(w) > 0
), iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM i)
), dw AS (
  SELECT rid, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), h AS (
  SELECT rid, p, dw.n, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n
), c AS (
  SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS x FROM h) GROUP BY rid
), it AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM h) GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN it USING (rid)
"""

OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       first_value(rid) OVER w = rid AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t ORDER BY n_chars DESC, doc_id NULLS LAST, rid)
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS w FROM documents
), s AS (
  SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0
), m AS (
  SELECT rid, doc_id, 50 + (50 * len(w)::BIGINT * docs) // words AS m FROM d, s WHERE len(w) > 0
), i AS (
  SELECT iid, item_id, unnest(list_distinct(w)) AS t
  FROM (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS w FROM benchmark)
), tf AS (
  SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY rid, t
), w AS (
  SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s
), scored AS (
  SELECT iid, item_id, rid, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM i JOIN tf USING (t) JOIN w USING (t) JOIN m USING (rid) GROUP BY iid, item_id, rid, doc_id
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM (
  SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0
) WHERE rank <= 50
"""
