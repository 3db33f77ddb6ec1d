"""DuckDB SQL for the queries of this part that SQL can express."""

SQL: dict[str, str] = {}

SQL["op2_decontamination"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + 10], ' ') AS win
  FROM item_words, unnest(range(greatest(len(w) - 9, 1))) AS r(i) WHERE len(w) > 0),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS win
  FROM doc_words, sizes, unnest(range(greatest(len(w) - n + 1, 0))) AS t(i)),
found AS (SELECT d.r, d.i, d.n, t.item_id FROM doc_windows d JOIN item_windows t ON d.n = t.n AND d.win = t.win),
hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(n)) AS u(k) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

SQL["op9_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, bool_or(regexp_matches(role, '</?s>|\[/?INST\]') OR regexp_matches(text, '</?s>|\[/?INST\]') OR contains(role, chr(10))) OVER (PARTITION BY conv_id) AS escaped
  FROM rows),
shown AS (
  SELECT *, CASE WHEN escaped THEN replace(replace(replace(replace(replace(text, '\', '\b'), '</s>', '\e'), '<s>', '\s'), '[INST]', '\i'), '[/INST]', '\j') ELSE text END AS body,
    CASE WHEN escaped THEN replace(replace(replace(replace(replace(replace(role, '\', '\b'), '</s>', '\e'), '<s>', '\s'), '[INST]', '\i'), '[/INST]', '\j'), chr(10), '\n') ELSE role END AS head
  FROM marked)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(body) + length(head) + 8) + max(CASE WHEN escaped THEN 9 ELSE 7 END) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""

SQL["op8_quality"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT r, i, w[i + 1 : i + 3] AS g FROM docs, unnest(range(greatest(len(w) - 2, 0))) AS t(i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(range(3)) AS t(k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
per_line AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, length(regexp_replace(text, '[^\p{Nd}]', '', 'g')) AS n_digits
  FROM docs LEFT JOIN repeated USING (r) LEFT JOIN per_line USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > word_chars OR (n_lines > 3 AND 2 * n_dup_lines > n_lines)
    OR 2 * n_digits > word_chars OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM judged
"""

SQL["op3_suffix_dedup"] = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (
  SELECT r, doc_id, c, substr(h, 512 * c + 1, 610) AS k FROM docs, unnest(range((length(h) // 2 + 255) // 256)) AS t(c)),
windows AS (
  SELECT r, doc_id, 256 * c + q AS p, md5_number(substr(k, 2 * q + 1, 100)) AS s
  FROM chunks, unnest(range(least(256, greatest(length(k) // 2 - 49, 0)))) AS u(q)),
later AS (
  SELECT r, p FROM (SELECT r, p, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM windows)
  WHERE doc_id > least),
marked AS (SELECT r, p, p - lag(p) OVER (PARTITION BY r ORDER BY p) AS gap FROM later),
grouped AS (SELECT r, p, sum(CASE WHEN gap <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS g FROM marked),
spans AS (SELECT r, g, min(p) AS a, max(p) + 50 AS b FROM grouped GROUP BY r, g),
sized AS (SELECT r, CAST(sum(b - a) AS BIGINT) AS n_removed, CAST(count(*) AS BIGINT) AS n_spans FROM spans GROUP BY r),
ends AS (
  SELECT r, b AS k, coalesce(lead(a) OVER (PARTITION BY r ORDER BY a), 1000000000) AS e FROM spans
  UNION ALL SELECT r, 0, min(a) FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, 2 * k + 1, 2 * (e - k)), '' ORDER BY k) AS h FROM ends JOIN docs USING (r) GROUP BY r)
SELECT doc_id, CAST(length(docs.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, docs.h))) AS kept_sha256
FROM docs LEFT JOIN sized USING (r) LEFT JOIN kept USING (r)
"""

SQL["op1_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT r, md5_number(array_to_string(w[i + 1 : i + 4], ' ')) AS g
  FROM words, unnest(range(greatest(len(w) - 3, 1))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.r < b.r GROUP BY 1, 2),
linked AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS MATERIALIZED (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reached AS (SELECT r AS a, r AS b FROM sizes UNION SELECT reached.a, edges.b FROM reached JOIN edges ON reached.b = edges.a),
least AS (SELECT reached.a AS r, min(doc_id) AS component_id FROM reached JOIN words ON words.r = reached.b GROUP BY 1)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM words LEFT JOIN sizes USING (r) LEFT JOIN least USING (r)
"""

SQL["op11_mixing"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM docs GROUP BY source),
weighed AS (SELECT *, 2 * source_size AS cap, [5, 2, 1][1 + (rank - 1) % 3] AS weight, 1.5::DOUBLE * (SELECT sum(size) FROM docs) AS budget FROM sources),
-- In order of room by weight, a source is full if its share of what the fuller ones leave is above its room.
filled AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) > cap AS is_full FROM weighed),
goals AS (
  SELECT *, CASE WHEN is_full THEN cap::DOUBLE
    ELSE (budget - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) * weight / sum(weight) FILTER (NOT is_full) OVER () END AS target FROM filled),
served AS (
  SELECT d.*, g.rank, g.source_size, g.target, g.budget, sum(d.size) OVER (PARTITION BY g.rank ORDER BY d.key, d.r) AS served
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source),
entries AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(served + epoch * source_size AS DOUBLE) / target ELSE 0 END AS finish
  FROM served, unnest([0, 1]) AS e(epoch)),
mixed AS (SELECT *, sum(size) OVER (ORDER BY finish, rank, epoch, key, r) AS total FROM entries)
SELECT doc_id, CAST(any_value(size) AS BIGINT) AS size, CAST(any_value(source_size) AS BIGINT) AS source_size,
  any_value(target) AS target, CAST(coalesce(sum(size) FILTER (total <= budget), 0) AS BIGINT) AS taken
FROM mixed GROUP BY r, doc_id
"""

SQL["op12_conversation_repair"] = r"""
WITH RECURSIVE crc(bytes) AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n))),
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ascii(ch) AS BIGINT)),
      lambda c, b: xor(c >> 8, bytes[1 + (xor(c, b) & 255)]), 4294967295), 4294967295) % 20 AS fate
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM fated, unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE fate <> 0),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
numbered AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM damaged d JOIN convs v ON d.conv_id IS NOT DISTINCT FROM v.conv_id),
marked AS (
  SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY c, role, text ORDER BY i) AS seen,
    coalesce(lag(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY i) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM numbered),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM marked),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faulty GROUP BY c),
-- States: 0 nothing yet, 1 after the system turn, 2 after the user's, 3 after the assistant's.
ins(state, now, cost, edits, told) AS (VALUES
  (0, 0, 0, '', ''), (0, 2, 3, 'I', 'u'), (0, 3, 6, 'II', 'ua'), (1, 1, 0, '', ''), (1, 2, 3, 'I', 'u'), (1, 3, 6, 'II', 'ua'),
  (2, 2, 0, '', ''), (2, 3, 3, 'I', 'a'), (2, 2, 6, 'II', 'au'), (3, 3, 0, '', ''), (3, 2, 3, 'I', 'u'), (3, 3, 6, 'II', 'ua')),
kept(state, initial, after) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
options AS (
  SELECT f.c, f.i, n.state, n.now AS after, n.cost + 4 AS cost, n.edits || 'D' AS edits, n.told, NULL AS line FROM faulty f, ins n
  UNION ALL
  SELECT f.c, f.i, n.state, CASE WHEN n.now = 2 THEN 3 ELSE 2 END, n.cost + 3 + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, n.edits || 'R', n.told,
    CASE WHEN n.now = 2 THEN 'assistant:' ELSE 'user:' END || text FROM faulty f, ins n WHERE fault NOT IN ('blank', 'duplicate')
  UNION ALL
  SELECT f.c, f.i, n.state, k.after, n.cost + CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, n.edits || 'K', n.told, role || ':' || text
  FROM faulty f, ins n JOIN kept k ON k.state = n.now WHERE k.initial = f.initial AND fault NOT IN ('blank', 'duplicate')),
step(c, i, state, best) AS (
  SELECT c, CAST(0 AS BIGINT), 0, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} FROM convs
  UNION ALL
  SELECT s.c, o.i, o.after, min({'cost': s.best.cost + o.cost, 'audit': s.best.audit || o.edits,
    'lines': s.best.lines || list_transform(string_split(o.told, ''), lambda t: CASE t WHEN 'u' THEN 'user:' ELSE 'assistant:' END)[1:length(o.told)] || CASE WHEN o.line IS NULL THEN [] ELSE [o.line] END})
  FROM step s JOIN options o ON o.c = s.c AND o.i = s.i + 1 AND o.state = s.state GROUP BY s.c, o.i, o.after),
ends(state, cost, edits, told) AS (VALUES (0, 0, '', CAST([] AS VARCHAR[])), (1, 6, 'II', ['user:', 'assistant:']), (2, 3, 'I', ['assistant:']), (3, 0, '', [])),
finished AS (
  SELECT s.c, min({'cost': s.best.cost + e.cost, 'audit': s.best.audit || e.edits, 'lines': s.best.lines || e.told}) AS best
  FROM step s JOIN ends e USING (state) WHERE s.i = coalesce((SELECT max(i) FROM numbered n WHERE n.c = s.c), 0) GROUP BY s.c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.cost AS BIGINT) AS cost,
  best.audit AS audit, sha256(array_to_string(best.lines, chr(10))) AS repaired_sha256
FROM convs JOIN finished USING (c) LEFT JOIN counts USING (c)
"""
