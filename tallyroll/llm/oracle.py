"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), said AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned,
    length(regexp_replace(replace(role, '\', '\\'), '(<)(\|)|(<)(/?s>)|(\[)(/?INST\])|(<)(</?SYS>>)', '\1\3\5\7\\\2\4\6\8', 'g'))
    + length(regexp_replace(replace(text, '\', '\\'), '(<)(\|)|(<)(/?s>)|(\[)(/?INST\])|(<)(</?SYS>>)', '\1\3\5\7\\\2\4\6\8', 'g'))
    + length('<|turn|><|part|><|end|>') AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
  sha256(string_agg(learned, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id
"""

OP7 = r"""
WITH polynomial AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
), bytes AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT)) AS b
  FROM documents
), sums AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, polynomial
), scores AS (
  SELECT doc_id, s AS shard,
    -1 / ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '/' || s), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) AS score
  FROM (SELECT DISTINCT doc_id FROM documents), range(41) r(s)
), best AS (
  SELECT doc_id, arg_max(shard, score) FILTER (shard < 40) AS shard, arg_max(shard, score) AS grown_shard
  FROM scores GROUP BY doc_id
), placed AS (
  SELECT sums.*, best.shard, best.grown_shard,
    CAST('0x' || substr(md5('part/' || coalesce(CAST(sums.doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) % 4096 AS part
  FROM sums JOIN best ON sums.doc_id IS NOT DISTINCT FROM best.doc_id
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32, size) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM placed
"""

OP9 = r"""
WITH vectors AS (
  SELECT row_number() OVER () AS no, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.no, q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.no <> c.no WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP10 = r"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), named AS (
  SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
      ((CAST('0x' || substr(h, CAST(i // 8 * 10 + 1 AS BIGINT), 10) AS BIGINT) >> CAST(35 - i % 8 * 5 AS INTEGER)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest
  FROM hashed
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM named
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM firsts
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]', chr(10), 'g'), chr(10))) AS piece
  FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^ \x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists WHERE len(w) > 0), range(1, 5) r(k)
  WHERE i + k - 1 <= len(w)
), counts AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), sizes AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 30
), inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer
  FROM candidates, range(2, 4) s(m), range(1, 4) p(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), stays AS (
  SELECT c.* FROM candidates c LEFT JOIN inside i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.f
), cuts AS (
  SELECT s.lang, s.phrase, s.f AS a, h AS cut, array_to_string(w[1:h], ' ') AS head, array_to_string(w[h + 1:k], ' ') AS tail
  FROM stays s, range(1, 4) r(h) WHERE h < k
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
), best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS no FROM scored
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best WHERE no = 1
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes ON sizes.lang = ranked.lang WHERE rank <= 2000
"""

OP12 = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS place
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source
), weighed AS (
  SELECT source, s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM sums
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY s * (6 // w), source NULLS LAST) AS no FROM weighed
), bounds AS (
  SELECT *, (SELECT sum(s) FROM ordered) - coalesce(sum(3 * s) OVER (ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER (ORDER BY no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight
  FROM ordered
), level AS (
  SELECT arg_min(rest, no) AS rest, arg_min(weight, no) AS weight, min(no) AS no FROM bounds WHERE 3 * s * weight >= w * rest
), aims AS (
  SELECT source, s, w, CASE WHEN b.no < l.no THEN 3 * s / 1 ELSE w * l.rest / l.weight END AS target,
    CASE WHEN b.no < l.no THEN 3 * s ELSE (2 * w * l.rest + l.weight) // (2 * l.weight) END AS quota
  FROM bounds b, level l
), ran AS (
  SELECT d.*, a.s, a.target, a.quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, s AS source_size, CAST(target AS DOUBLE) AS target,
  CAST(CASE WHEN s = 0 THEN 0 ELSE size * (quota // s + CASE WHEN 2 * before + size <= 2 * (quota % s) THEN 1 ELSE 0 END) END AS BIGINT) AS taken
FROM ran
"""

ORACLE = {"op2_chat": OP2, "op7_shards": OP7, "op9_topk": OP9, "op10_warc": OP10, "op11_phrases": OP11, "op12_mixing": OP12}
