"""DuckDB SQL for the queries of this subpackage that SQL can express.

Near copies, mixing (its order is by Spark's hash), learned scores, page text and leaks have none;
tests hold these against brute force or held-out labels.
"""

from __future__ import annotations

_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), placed AS (
  SELECT *,
    6 + 6 + 7 + length(replace(replace(replace(replace(role, '\', '\\'), '<turn>', '<\turn>'), '<says>', '<\says>'), '</turn>', '<\/turn>'))
      + length(replace(replace(replace(replace(text, '\', '\\'), '<turn>', '<\turn>'), '<says>', '<\says>'), '</turn>', '<\/turn>')) AS size,
    row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place) AS chars FROM placed
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) FILTER (role = 'assistant' OR place = n) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""

_URLS = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
  FROM pages
), rules(rule_host, rule_path, says) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(says, length(rule_host || rule_path)) AS says
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)
"""

# crc32 byte by byte, from the table of its polynomial; fixed value 3988292384.
_CRC_TABLE = """
poly AS (
  SELECT list(entry ORDER BY n) AS entries FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)),
      lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS entry
    FROM range(256) AS numbers(n))
)
"""


def _crc32(blob: str) -> str:
    """The SQL of the crc32 of a blob, next to ``poly``."""
    place = "list_prepend(4294967295, list_transform(range(octet_length({0})), lambda i: CAST('0x' || substr(hex({0}), 2 * i + 1, 2) AS BIGINT)))"
    step = "lambda c, b: xor(c >> 8, entries[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({place.format(blob)}, {step}), 4294967295)"


_IMPORTANCE = f"""
WITH {_CRC_TABLE}, texts AS (
  SELECT 0 AS side, doc_id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT side, doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
  FROM texts
), tallied AS (
  SELECT side, doc_id, word, count(*) AS n FROM words GROUP BY ALL
), buckets AS (
  SELECT word, {_crc32("encode(word)")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM tallied), poly
), totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
  FROM tallied JOIN buckets USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM totals) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM totals) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM totals
), weights AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight
  FROM tallied JOIN buckets USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln(
      (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT)::DOUBLE + 0.5) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM documents LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN n_features >= 20 AND place <= able * 10 // 100 THEN place END AS rank
FROM placed
"""

_COPIES = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_TRIE = f"""
WITH {_CRC_TABLE}, ids AS (
  SELECT conv_id, CAST({_crc32("encode(CAST(conv_id AS VARCHAR))")} % 6 AS BIGINT) AS h
  FROM (SELECT DISTINCT conv_id FROM conversations), poly
), placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS name, length(coalesce(text, '')) AS chars
  FROM conversations
), rebuilt AS (
  SELECT ids.conv_id, place, name, chars FROM ids JOIN placed ON placed.conv_id = ids.conv_id - ids.conv_id % 100
  WHERE place <= h
  UNION ALL SELECT ids.conv_id, place, name, chars FROM ids JOIN placed USING (conv_id) WHERE place > h
), paths AS (
  SELECT conv_id, chars, row_number() OVER w AS depth, string_agg(name, '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place)
  UNION ALL SELECT conv_id, 0, 0, '' FROM ids
), nodes AS (
  SELECT path, depth, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs FROM paths GROUP BY ALL
), childs AS (
  SELECT left(path, CAST(64 * (depth - 1) AS BIGINT)) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), whole AS (
  SELECT nodes.*, coalesce(childs.n, 0) AS n_children FROM nodes LEFT JOIN childs USING (path)
), below AS (
  SELECT left(path, CAST(64 * up AS BIGINT)) AS path, count(*) FILTER (n_children = 0) AS n_leaves,
    CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM whole) GROUP BY ALL
), finals AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS digest
  FROM (SELECT conv_id, max(path) AS path FROM paths GROUP BY conv_id) GROUP BY path
)
SELECT whole.conv_id, whole.depth, above.conv_id AS parent_conv_id, whole.n_convs, whole.n_children, n_leaves,
  saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM whole JOIN below USING (path) LEFT JOIN finals USING (path)
LEFT JOIN nodes AS above ON whole.depth > 0 AND above.path = left(whole.path, CAST(64 * (whole.depth - 1) AS BIGINT))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_chat": _CHAT,
        "op10_url_rules": _URLS,
        "op11_importance": _IMPORTANCE,
        "op12_exact_copies": _COPIES,
        "op13_prefix_trie": _TRIE,
    }
