"""DuckDB twins of the registered queries that SQL can express, written from the contracts."""

from __future__ import annotations


OP7 = r"""
WITH rows_ AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM rows_ WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id)
"""


#: The formatted length: 20 characters of marks for each turn, and one more for each backslash and control string.
OP3 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 20 + length(role) + length(text)
    + len(regexp_extract_all(role, '\\|</?s>|\[/?INST\]')) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

#: All pairs that share a shingle, exact Jaccard, then reachability.
OP4 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN [array_to_string(w[i:i+4], ' ') FOR i IN range(1, len(w) - 3)]
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)
), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION
  SELECT reach.doc_id, b FROM reach JOIN both_ways ON r = a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(r) AS component_id, d.doc_id = min(r) AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


OP5 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words)
), again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows JOIN again USING (s)),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


#: Masks of documents, all orders, and sums over the cells of a part for each order and step.
OP11 = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
known AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
      + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
      + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(d.doc_id > first, false)::INT AS m,
    coalesce(good, false)::INT AS good, coalesce(bad, false)::INT AS bad
  FROM texts d JOIN firsts USING (t) LEFT JOIN known k ON k.doc_id = d.doc_id
), cells AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM masks GROUP BY ALL),
orders AS (
  SELECT '' AS o, 0 AS used
  UNION ALL
  SELECT o || chr(65 + i), used | (1 << i) FROM orders, (SELECT unnest(range(5))::INT AS i) WHERE used & (1 << i) = 0
), steps AS (
  SELECT o, k, 1 << (ascii(substr(o, k, 1)) - 65) AS bit,
    list_sum([1 << (ascii(substr(o, j, 1)) - 65) FOR j IN range(1, k)]) AS earlier
  FROM (SELECT o, unnest(range(1, 6))::INT AS k FROM orders WHERE length(o) = 5)
), counted AS (
  SELECT part, o, k, bit,
    coalesce(sum(n) FILTER (m & (coalesce(earlier, 0)::INT | bit) = 0), 0) AS kept,
    coalesce(sum(n) FILTER (m & bit <> 0 AND m & coalesce(earlier, 0)::INT = 0), 0) AS removed,
    coalesce(sum(n) FILTER (m & bit <> 0 AND m & coalesce(earlier, 0)::INT <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (m = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (m & bit <> 0 AND m & coalesce(earlier, 0)::INT = 0), 0) AS good_lost,
    coalesce(sum(bad) FILTER (m & bit <> 0 AND m & coalesce(earlier, 0)::INT = 0), 0) AS toxic_lost
  FROM steps, cells GROUP BY ALL
)
SELECT part, o AS filter_order, k AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counted
"""

#: All runs of words of the documents as long as some window, equal to a window.
OP12 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i+9], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0)
), runs AS (
  SELECT doc_id, i, n, array_to_string(w[i:i+n-1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT DISTINCT n FROM windows))
), found AS (SELECT * FROM runs SEMI JOIN windows USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found JOIN windows USING (n, s)) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_format": OP3,
        "op4_chosen_path": OP4,
        "op5_seed_extend": OP5,
        "op7_stream_dedup": OP7,
        "op11_filter_audit": OP11,
        "op12_prefix_join": OP12,
    }
