"""DuckDB twins of the corpus queries. They read only the tables, none of the operators' code."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS place
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sized GROUP BY source
), ordered AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_size,
    sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest_weight
  FROM sources
), judged AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) * rest_weight <= CAST(weight AS DOUBLE) * (total - before_size) AS full_ FROM ordered
), rest AS (
  SELECT max(total) - coalesce(sum(3 * source_size) FILTER (full_), 0) AS words, sum(weight) FILTER (NOT full_) AS weights FROM judged
), planned AS (
  SELECT source, source_size,
    CASE WHEN full_ THEN CAST(3 * source_size AS DOUBLE) ELSE weight * CAST(words AS DOUBLE) / weights END AS target
  FROM judged, rest
), budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS rounds FROM planned
), groups AS (
  SELECT source, place, sum(size) AS size,
    sum(sum(size)) OVER (PARTITION BY source ORDER BY place) AS upto
  FROM sized GROUP BY source, place
), taken AS (
  SELECT g.source, g.place, 2 * (g.upto - g.size) + g.size <= 2 * (b.target - b.rounds * b.source_size) AS extra
  FROM groups g JOIN budgets b ON g.source IS NOT DISTINCT FROM b.source
)
SELECT s.doc_id, s.size, b.source_size, b.target,
  CAST(s.size * (b.rounds + CAST(t.extra AND b.target > b.rounds * b.source_size AS INT)) AS BIGINT) AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
JOIN taken t ON s.source IS NOT DISTINCT FROM t.source AND s.place = t.place
"""

LICENSES = r"""
WITH templates(id, label, text) AS (VALUES
  (1, 'mit', 'released under the mit license'),
  (2, 'mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction'),
  (3, 'apache-2', 'licensed under the apache license version 2 0'),
  (4, 'apache-2', 'you may not use this file except in compliance with the license you may obtain a copy of the license at'),
  (5, 'gpl-3', 'this work is licensed under the gnu general public license version 3'),
  (6, 'cc-by-nc', 'licensed under cc by nc 4 0'),
  (7, 'cc-by-sa', 'licensed under cc by sa 4 0'),
  (8, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
  (9, 'mpl-2', 'this source code form is subject to the terms of the mozilla public license v 2 0')
), tokens AS (
  SELECT id, label, token, count(*) OVER (PARTITION BY id) AS t,
    CASE WHEN n <= 8 THEN 8 WHEN n <= 16 THEN 16 ELSE 32 END AS step
  FROM (SELECT DISTINCT id, label, len(string_split(text, ' ')) AS n, unnest(string_split(text, ' ')) AS token FROM templates)
), docs AS (
  SELECT row_number() OVER () AS row_, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), words AS (
  SELECT row_, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS pos FROM docs
), phrases(label, parts) AS (VALUES
  ('mit', ['under', 'the', 'mit', 'license']), ('apache-2', ['apache', 'license', 'version', '2']), ('cc-by-nc', ['cc', 'by', 'nc'])
), base AS (
  SELECT w.row_, w.pos, p.label FROM words w JOIN phrases p ON w.word = p.parts[1]
  JOIN docs d ON d.row_ = w.row_ WHERE d.words[w.pos + 1 : w.pos + len(p.parts)] = p.parts
), base_by AS (
  SELECT row_, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels FROM base GROUP BY row_
), placed AS (
  SELECT w.row_, t.id, t.label, t.t, t.token, unnest(CASE WHEN w.pos < t.step THEN [0] ELSE [w.pos // t.step, w.pos // t.step - 1] END) AS block
  FROM words w JOIN tokens t ON w.word = t.token
), blocks AS (
  SELECT row_, id, label, block, count(DISTINCT token) / CAST(any_value(t) AS DOUBLE) AS containment
  FROM placed GROUP BY row_, id, label, block HAVING count(DISTINCT token) >= ceil(any_value(t) * 0.9 - 1e-9)
), found AS (
  SELECT row_, list(DISTINCT label) AS labels, max(containment) AS best, count(*) AS n FROM blocks GROUP BY row_
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
  CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
  CASE WHEN b.n > 0 THEN 1.0::DOUBLE ELSE coalesce(f.best, 0.0::DOUBLE) END AS score,
  CAST(coalesce(f.n, 0) AS BIGINT) AS n_blocks
FROM docs d LEFT JOIN base_by b USING (row_) LEFT JOIN found f USING (row_)
"""

LINES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), cut AS (
  SELECT row_, doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS no FROM docs
), lines AS (
  SELECT row_, doc_id, no, regexp_extract_all(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM cut WHERE regexp_matches(part, '[^\x20\x09-\x0D]')
), uniq AS (
  SELECT words, len(words) AS n, min({'d': doc_id, 'l': no}) AS first_ FROM lines GROUP BY words
), cuts AS (
  SELECT words, n, first_, unnest(range(n)) AS i FROM uniq WHERE n >= 10
), variants AS (
  SELECT words, n, first_, i, list_concat(words[1 : i], words[i + 2 : n]) AS rest FROM cuts
), changed AS (
  SELECT v.words, min(o.first_) AS other FROM variants v
  JOIN (SELECT rest, i, min(first_) AS first_ FROM variants GROUP BY rest, i) o ON v.rest = o.rest AND v.i = o.i
  WHERE o.first_ < v.first_ GROUP BY v.words
), shorter AS (
  SELECT v.words, min(u.first_) AS other FROM variants v JOIN uniq u ON v.rest = u.words AND u.n >= 10
  WHERE u.first_ < v.first_ GROUP BY v.words
), longer AS (
  SELECT u.words, min(v.first_) AS other FROM variants v JOIN uniq u ON v.rest = u.words AND u.n >= 10
  WHERE v.first_ < u.first_ GROUP BY u.words
), near_ AS (
  SELECT DISTINCT words FROM (SELECT words FROM changed UNION ALL SELECT words FROM shorter UNION ALL SELECT words FROM longer)
), judged AS (
  SELECT l.row_, l.no, {'d': l.doc_id, 'l': l.no} <> u.first_ AS exact, nr.words IS NOT NULL AS close
  FROM lines l JOIN uniq u ON l.words = u.words LEFT JOIN near_ nr ON l.words = nr.words
), by_doc AS (
  SELECT row_, count(*) AS n, count(*) FILTER (exact) AS n_exact, count(*) FILTER (NOT exact AND close) AS n_near,
    coalesce(array_to_string(list_sort(list(no) FILTER (exact OR close)), ','), '') AS removed
  FROM judged GROUP BY row_
)
SELECT d.doc_id, CAST(coalesce(b.n, 0) AS BIGINT) AS n_lines, CAST(coalesce(b.n_exact, 0) AS BIGINT) AS n_exact,
  CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near, coalesce(b.removed, '') AS removed
FROM docs d LEFT JOIN by_doc b USING (row_)
"""

COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i : i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM worded, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT lang, k, phrase, a, c, array_to_string(w[1 : c], ' ') AS first_part, array_to_string(w[c + 1 :], ' ') AS rest
  FROM candidates, (VALUES (1), (2)) places(c) WHERE c < k
), scored AS (
  SELECT cuts.*, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts JOIN counted l ON l.lang = cuts.lang AND l.phrase = first_part JOIN counted r ON r.lang = cuts.lang AND r.phrase = rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3
  ) GROUP BY ALL
), kept AS (
  SELECT best.* FROM best LEFT JOIN longer USING (lang, phrase) WHERE longer.a IS NULL OR 100 * longer.a < 50 * best.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

CONVERSATIONS = r"""
WITH numbered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({'r': role, 't': text} ORDER BY pos) AS turns, c - c % 5 AS base,
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten([[ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR ch IN string_split(CAST(c AS VARCHAR), '')])),
      lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384::BIGINT * (x & 1)) END)) % 9 AS h
  FROM numbered GROUP BY c
), paths AS (
  SELECT own.c, list_concat(coalesce(base.turns, [])[1 : own.h], own.turns[own.h + 1 :]) AS path
  FROM own LEFT JOIN own base ON base.c = own.base
), steps AS (
  SELECT c, d, len(path) = d AS ends, path[1 : d] AS prefix FROM (SELECT c, path, unnest(range(0, len(path) + 1)) AS d FROM paths)
), nodes AS (
  SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM steps GROUP BY prefix, d
), children AS (
  SELECT prefix[1 : d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL
), weighed AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children,
    CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(prefix[d].t)) END AS saved
  FROM nodes LEFT JOIN children USING (prefix)
), above AS (
  SELECT prefix[1 : e] AS prefix, CAST(sum(saved) AS BIGINT) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM weighed) GROUP BY 1
)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, above.n_leaves, above.saved_tokens, w.ends_sha256
FROM weighed w JOIN above USING (prefix) LEFT JOIN nodes p ON w.d > 0 AND p.prefix = w.prefix[1 : w.d - 1]
"""

SUBSTRINGS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT row_, i, sha256(array_to_string(words[i : i + 34], ' ')) AS h
  FROM (SELECT row_, words, unnest(range(1, len(words) - 33)) AS i FROM docs)
), gone AS (
  SELECT DISTINCT row_, unnest(range(i, i + 35)) AS place
  FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), kept AS (
  SELECT row_, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM (SELECT row_, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs) ANTI JOIN gone USING (row_, place)
  GROUP BY row_
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_)
"""
