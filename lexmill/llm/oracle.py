"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from lexmill.llm import licenses

SQL: dict[str, str] = {}
#: Of the queries beside those of the operators.
VARIANTS: dict[str, str] = {}

SQL["op10_mixing"] = r"""
WITH RECURSIVE sizes AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS name,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), per AS (
  SELECT name, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY any_value(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sizes GROUP BY name
), level(step, share) AS (
  SELECT 0, 1.5::DOUBLE * sum(source_size)::DOUBLE / sum(weight) FROM per
  UNION ALL
  SELECT step + 1, (SELECT (1.5::DOUBLE * sum(p.source_size)::DOUBLE - coalesce(sum(2.0::DOUBLE * p.source_size) FILTER (2.0::DOUBLE * p.source_size < p.weight * share), 0.0))
    / sum(p.weight) FILTER (2.0::DOUBLE * p.source_size >= p.weight * share) FROM per p)
  FROM level WHERE step < (SELECT count(*) FROM per)
), targets AS (
  SELECT name, source_size, least(2.0::DOUBLE * source_size, weight * (SELECT max_by(share, step) FROM level)) AS target FROM per
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size * 16777216)::BIGINT ELSE 0 END AS units,
    ('0x' || substr(md5('10:' || name), 1, 6))::BIGINT AS first_at
  FROM targets
), upto AS (
  SELECT *, sum(units) OVER (PARTITION BY name ORDER BY size, md5('10:' || coalesce(doc_id::VARCHAR, '')), doc_id ROWS UNBOUNDED PRECEDING)::BIGINT + first_at AS total
  FROM sizes JOIN rates USING (name)
)
SELECT doc_id, size, source_size, target, ((total >> 24) - ((total - units) >> 24)) * size AS taken FROM upto
"""

SQL["op5_substring"] = r"""
WITH words AS (
  SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS word
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
), windows AS (
  SELECT doc_id, p, string_agg(word, ' ') OVER ahead AS run, count(*) OVER ahead AS n
  FROM words WINDOW ahead AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), later AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY run ORDER BY doc_id, p) AS k FROM windows WHERE n = 20) WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS p FROM later
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(w.n, 0)::BIGINT AS n_words, coalesce(g.n, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d
LEFT JOIN (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id) w USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
LEFT JOIN kept USING (doc_id)
"""

SQL["op12_lines"] = r"""
WITH rows AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT rid, doc_id, line, pos, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM rows)
), common AS (
  SELECT key, max(doc_id) AS last FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT rid, doc_id, line, pos, coalesce(doc_id < last, false) AS gone FROM lines LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid, doc_id
"""

_QUOTES = r"""
WITH RECURSIVE CONVERSATIONS messages AS (
  SELECT conv_id, coalesce('=' || conv_id::VARCHAR, 'null') AS conv, turn, role, regexp_replace(coalesce(text, ''), '\r\n?', chr(10), 'g') AS text
  FROM turns
), lines AS (
  SELECT conv, turn, role, text, pos, regexp_replace(raw, '^[ \t]*((?:>[ \t]*)+)', '') AS line,
    length(regexp_replace(regexp_extract(raw, '^[ \t]*((?:>[ \t]*)+)', 1), '[^>]', '', 'g')) AS level
  FROM (SELECT *, unnest(l) AS raw, generate_subscripts(l, 1) AS pos
    FROM (SELECT DISTINCT conv, turn, role, text, string_split(text, chr(10)) AS l FROM messages))
), runs AS (
  SELECT *, sum((level IS DISTINCT FROM before)::INT) OVER (PARTITION BY conv, turn, role, text ORDER BY pos) AS run
  FROM (SELECT *, lag(level) OVER (PARTITION BY conv, turn, role, text ORDER BY pos) AS before FROM lines)
), passages AS (
  SELECT conv, turn, role, text, run, level, string_agg(line, chr(10) ORDER BY pos) AS lines,
    trim(regexp_replace(lower(string_agg(line, ' ' ORDER BY pos)), '\s+', ' ', 'g')) AS passage
  FROM runs GROUP BY conv, turn, role, text, run, level HAVING level > 0 AND passage <> ''
), own AS (
  SELECT m.*, CASE WHEN coalesce(l.quoted, false) THEN regexp_replace(coalesce(l.plain, ''), '^\s+|\s+$', '', 'g') ELSE m.text END AS content
  FROM messages m LEFT JOIN (
    SELECT conv, turn, role, text, bool_or(level > 0) AS quoted, string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0) AS plain
    FROM lines GROUP BY ALL) l
  ON m.conv = l.conv AND m.turn IS NOT DISTINCT FROM l.turn AND m.role IS NOT DISTINCT FROM l.role AND m.text = l.text
), parts AS (
  SELECT DISTINCT conv, turn, trim(regexp_replace(lower(part), '\s+', ' ', 'g')) AS part
  FROM (SELECT conv, turn, unnest([content] || regexp_split_to_array(content, '\n[ \t]*\n') || string_split(content, chr(10))) AS part FROM own WHERE turn IS NOT NULL)
), originals AS (
  SELECT conv, part AS passage, min(turn) AS original FROM parts GROUP BY 1, 2
), whole AS (
  SELECT p.*, CASE WHEN original < turn THEN original END AS origin
  FROM passages p LEFT JOIN originals USING (conv, passage) WHERE turn IS NOT NULL
), quoted AS (
  SELECT * FROM (
    SELECT conv, turn, role, text, run, p, generate_subscripts(l, 1) AS at, trim(regexp_replace(lower(paragraph), '\s+', ' ', 'g')) AS around,
      trim(regexp_replace(lower(unnest(l)), '\s+', ' ', 'g')) AS line
    FROM (SELECT *, string_split(paragraph, chr(10)) AS l FROM (
      SELECT *, unnest(ps) AS paragraph, generate_subscripts(ps, 1) AS p
      FROM (SELECT *, regexp_split_to_array(lines, '\n[ \t]*\n') AS ps FROM whole WHERE origin IS NULL)))
  ) WHERE line <> ''
), held AS (
  SELECT conv, turn, role, text, run, original, sum(length(line)) AS held FROM (
    SELECT DISTINCT q.*, h.turn AS original FROM quoted q JOIN parts h ON h.conv = q.conv AND h.turn < q.turn AND h.part IN (q.line, q.around)
  ) GROUP BY ALL
), partly AS (
  SELECT conv, turn, role, text, run, arg_min(original, (-held, original)) AS partly
  FROM held JOIN (SELECT conv, turn, role, text, run, sum(length(line)) AS total FROM quoted GROUP BY ALL) USING (conv, turn, role, text, run)
  WHERE 2 * held > total GROUP BY ALL
), cut AS (
  SELECT *, regexp_replace(passage, '(?: ?(?:\.\.\.|…|\[\.\.\.\]|\[…\]))+$', '') AS passed
  FROM whole LEFT JOIN partly USING (conv, turn, role, text, run)
), broken AS (
  SELECT c.conv, c.passed, min(o.turn) AS broken
  FROM (SELECT DISTINCT conv, passed FROM cut WHERE origin IS NULL AND partly IS NULL AND len(string_split(passed, ' ')) > 3) c
  JOIN own o ON o.conv = c.conv AND o.turn IS NOT NULL AND contains(' ' || trim(regexp_replace(lower(o.content), '\s+', ' ', 'g')), ' ' || c.passed)
  GROUP BY ALL
), found AS (
  SELECT c.* EXCLUDE (origin), coalesce(origin, partly, CASE WHEN broken < turn THEN broken END) AS origin FROM cut c LEFT JOIN broken USING (conv, passed)
), replies AS (
  SELECT conv, turn, role, text, count(*) AS n_quotes, count(origin) AS n_linked,
    arg_min(origin, (level, -origin)) FILTER (origin IS NOT NULL) AS reply_to
  FROM found GROUP BY ALL
), parents AS (
  SELECT conv, turn, max(reply_to) AS reply_to FROM replies WHERE reply_to IS NOT NULL GROUP BY conv, turn
), chain(conv, turn, thread, depth) AS (
  SELECT conv, turn, reply_to, 1::BIGINT FROM parents
  UNION ALL
  SELECT c.conv, c.turn, p.reply_to, depth + 1 FROM chain c JOIN parents p ON p.conv = c.conv AND p.turn = c.thread
), roots AS (
  SELECT conv, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM chain GROUP BY conv, turn
), placed AS (
  SELECT o.conv_id, o.conv, o.turn, o.role, o.content, coalesce(r.n_quotes, 0) AS n_quotes, coalesce(r.n_linked, 0) AS n_linked,
    r.reply_to, coalesce(t.thread, o.turn) AS thread, coalesce(t.depth, 0) AS depth
  FROM own o
  LEFT JOIN replies r ON o.conv = r.conv AND o.turn = r.turn AND o.role IS NOT DISTINCT FROM r.role AND o.text = r.text
  LEFT JOIN roots t ON o.conv = t.conv AND o.turn = t.turn
)
SELECT conv_id, turn, role, content, n_quotes, n_linked, reply_to, thread, depth,
  row_number() OVER (PARTITION BY conv ORDER BY thread NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, content) - 1 AS position
FROM placed
"""


SQL["op6_quotes"] = _QUOTES.replace("CONVERSATIONS", "turns AS (FROM conversations),")
#: A turn in three quotes the one before: whole, or the middle of its words, which breaks off.
VARIANTS["op6_quotes_replies"] = _QUOTES.replace("CONVERSATIONS", """before AS (
  SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS last FROM conversations
), asked AS (
  SELECT *, string_split(regexp_replace(trim(last), '\\s+', ' ', 'g'), ' ') AS w FROM before
), turns AS (
  SELECT * REPLACE (CASE WHEN last IS NULL OR text IS NULL OR turn % 3 = 0 THEN text
    WHEN turn % 3 = 1 THEN regexp_replace('> ' || last, '\\r\\n?|\\n', chr(10) || '> ', 'g') || chr(10) || text
    ELSE '> ' || array_to_string(w[1 + len(w) // 4 : len(w) - len(w) // 4], ' ') || ' ...' || chr(10) || text END AS text)
  FROM asked
),""")


def _licences() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    rows = ", ".join(f"({k}, {quoted(t.licence)}, {str(t.body).lower()}, {quoted(t.text)})" for k, t in enumerate(licenses.templates()))
    least, term = licenses.COSINE, licenses.TERM
    return rf"""
WITH files AS (
  SELECT doc_id, CASE WHEN doc_id IS NOT NULL THEN concat_ws('/', source, lang, doc_id::VARCHAR) END AS path, text FROM documents
), named AS (
  SELECT path, regexp_replace(text, '\r\n?', chr(10), 'g') AS text FROM files WHERE path IS NOT NULL
), templates(template, licence, body, words) AS (VALUES {rows}
), counted AS (
  SELECT template, licence, body, term, count(*) AS tf
  FROM (SELECT template, licence, body, unnest(regexp_extract_all(lower(words), '{term}')) AS term FROM templates) GROUP BY ALL
), idfs AS (
  SELECT term, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) + 1 AS idf FROM counted GROUP BY term
), held AS (
  SELECT template, licence, body, term, (1 + ln(tf)) * idf / sqrt(sum(((1 + ln(tf)) * idf) ** 2) OVER (PARTITION BY template)) AS weight,
    regexp_matches(term, '{licenses.NUMBER}')::INT AS number
  FROM counted JOIN idfs USING (term)
), numbers AS (
  SELECT template, sum(number) AS numbers FROM held GROUP BY template
), units AS (
  SELECT path, unit, false AS whole, min(pos) AS pos FROM (
    SELECT path, unnest(l) AS unit, generate_subscripts(l, 1) AS pos FROM (SELECT path, string_split(text, chr(10)) AS l FROM named)
    UNION ALL
    SELECT path, unnest(l) AS unit, 1000000000 + generate_subscripts(l, 1) AS pos FROM (SELECT path, regexp_split_to_array(text, '{licenses.PARAGRAPHS}') AS l FROM named)
    UNION ALL
    SELECT path, unnest(l) AS unit, 2000000000 + generate_subscripts(l, 1) AS pos FROM (SELECT path, regexp_split_to_array(text, '{licenses.BLOCKS}') AS l FROM named)
  ) GROUP BY path, unit
  UNION ALL
  SELECT path, text, true, 4000000000 FROM named WHERE text IS NOT NULL
), terms AS (
  SELECT path, pos, whole, term, count(*) AS tf FROM (SELECT path, pos, whole, unnest(regexp_extract_all(lower(unit), '{term}')) AS term FROM units) GROUP BY ALL
), weighed AS (
  SELECT path, pos, whole, term, tf, (1 + ln(tf)) * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1) AS x FROM terms LEFT JOIN idfs USING (term)
), norms AS (
  SELECT path, pos, sqrt(sum(x * x)) AS norm, sum(tf) AS n FROM weighed GROUP BY path, pos
), dots AS (
  SELECT path, pos, template, licence, sum(x * weight) AS dot, sum(number) AS has FROM weighed JOIN held USING (term) WHERE body OR NOT whole GROUP BY ALL
), close AS (
  SELECT path, pos, licence, n, round(dot / norm, 6) AS cosine
  FROM dots JOIN numbers USING (template) JOIN norms USING (path, pos) WHERE has = numbers AND round(dot / norm, 6) >= {least!r}
), own AS (
  SELECT u.path, arg_min(licence, (-cosine, pos, licence)) AS licence, max(cosine) AS cosine, round(least(1.0::DOUBLE, max(n)::DOUBLE / any_value(s.size)), 6) AS share
  FROM close u JOIN (SELECT path, len(regexp_extract_all(lower(text), '{term}')) AS size FROM named) s USING (path) GROUP BY u.path
), direct AS (
  SELECT path, licence, CASE WHEN share >= {licenses.MOSTLY!r} OR regexp_matches(path, '{licenses.FILE_NAMES}') THEN 'file' ELSE 'header' END AS how, cosine FROM own
), folders AS (
  SELECT regexp_replace(path, '/?[^/]*$', '') AS folder, arg_min(licence, (-cosine, path)) AS licence FROM direct WHERE how = 'file' GROUP BY 1
), above AS (
  SELECT path, n, array_to_string(string_split(path, '/')[1:n], '/') AS folder
  FROM (SELECT path, unnest(range(0, len(string_split(path, '/')))) AS n FROM named WHERE path NOT IN (SELECT path FROM own))
), heirs AS (
  SELECT path, arg_max(licence, n) AS licence, arg_max(folder, n) AS folder FROM above JOIN folders USING (folder) GROUP BY path
)
SELECT f.doc_id, f.path, coalesce(d.licence, h.licence) AS licence,
  CASE WHEN d.path IS NOT NULL THEN d.how WHEN h.path IS NOT NULL THEN 'inherited' END AS how, d.cosine, h.folder
FROM files f LEFT JOIN direct d USING (path) LEFT JOIN heirs h USING (path)
"""


SQL["op8_licenses"] = _licences()
