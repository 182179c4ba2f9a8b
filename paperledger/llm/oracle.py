"""DuckDB SQL for the operators that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op5_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), own AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST(CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS DOUBLE) AS weight,
         CAST(3 * source_size AS DOUBLE) AS cap FROM own
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0.0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0.0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM levels
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(s.doc_id AS VARCHAR), '~')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM sized s JOIN shares t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM rated"""

ORACLE["op2_chat_formatting"] = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, len(regexp_replace(text, '(\\*)(\[/?INST\]|</?s>|<</?(?:SYS|ROLE)>>|<<TEXT>>)', '\1\1\\\2', 'g'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
      ELSE 29 + len(regexp_replace(role, '(\\*)(\[/?INST\]|</?s>|<</?(?:SYS|ROLE)>>|<<TEXT>>)', '\1\1\\\2', 'g')) END AS chars
  FROM rows_
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM marked
), whole AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS turns,
         coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(chars) + count(*) - 1 AS formatted_chars, string_agg(role, ',' ORDER BY place) AS roles, bool_and(role IN ('user', 'assistant', 'system')) AS known,
         len(first(text ORDER BY place)) AS first_chars, len(last(text ORDER BY place)) AS last_chars
  FROM ordered GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(len(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars,
       CASE WHEN roles = 'user,assistant' AND first_chars % 2 = 0 THEN 'prompt_completion' WHEN roles = 'user,assistant' THEN 'instruction'
            WHEN roles = 'system,user,assistant' THEN 'system_instruction' WHEN known AND n_turns % 2 = 1 THEN 'from_value'
            WHEN first_chars < last_chars THEN 'dialogue' ELSE 'messages' END AS layout
FROM whole"""

ORACLE["op4_warc"] = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), firsts AS (
  SELECT html, min(page_id) AS first FROM payloads GROUP BY html
)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(h, 1 + 5 * CAST(floor(i / 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31), 1)), '') AS payload_digest,
       CASE WHEN p.page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN p.page_id > first THEN first END AS refers_to, 'ok' AS status
FROM payloads p JOIN firsts f ON f.html = p.html"""

ORACLE["op9_jaccard_join"] = r"""
WITH RECURSIVE lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM lowered
), sizes AS (
  SELECT d.doc_id, count(s) AS n FROM documents d LEFT JOIN shingles s ON s.doc_id = d.doc_id GROUP BY d.doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON b.s = a.s AND b.doc_id > a.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 80 * (p.n + q.n - c)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n"""

ORACLE["op11_hard_negatives"] = r"""
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM whole a JOIN whole b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER ranked AS INTEGER) AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW ranked AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER ranked <= 3"""
