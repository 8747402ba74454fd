"""Comparison SQL (DuckDB) of the corpus operators that SQL can express, written from their definitions."""

# fixed values, repeated here so that a wrong list in the operator does not pass
_TEMPLATES = """
    ('apache', 'licensed under the apache license version 2 0'),
    ('apache', 'unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind'),
    ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
    ('cc-by', 'licensed under cc by 4 0'),
    ('cc-by-nc', 'licensed under cc by nc 4 0'),
    ('cc-by-nc-sa', 'licensed under cc by nc sa 4 0'),
    ('cc-by-sa', 'licensed under cc by sa 4 0'),
    ('cc-by', 'licensed under a creative commons attribution 4 0 international license'),
    ('gpl', 'licensed under the gnu general public license version 3'),
    ('gpl', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation'),
    ('isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted'),
    ('mit', 'released under the mit license'),
    ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
    ('mpl', 'this source code form is subject to the terms of the mozilla public license v 2 0')
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LICENSES = f"""
WITH templates AS (
  SELECT label, list_distinct(string_split(words, ' ')) AS t FROM (VALUES {_TEMPLATES}) v(label, words)
), needs AS (
  SELECT label, t, CAST(greatest(1, ceil(round(0.9 * len(t), 9))) AS BIGINT) AS need FROM templates
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), placed AS (
  SELECT r, doc_id, w,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'mit' AND w[i + 2] = 'license') AS mit,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'apache' AND w[i + 2] = 'license') AS apache,
    list_filter(range(len(w)), lambda i: w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license') AS gpl
  FROM docs
), blocks AS (
  SELECT r, b, list_distinct(w[b * 32 + 1 : b * 32 + 64]) AS s
  FROM (SELECT r, w, unnest(range(CAST(greatest(1, ceil((len(w) - 64) / 32.0) + 1) AS BIGINT))) AS b FROM docs WHERE len(w) > 0)
), found AS (
  SELECT r, label, len(list_intersect(s, t)) / len(t) AS containment
  FROM blocks CROSS JOIN needs WHERE len(s) >= need AND len(list_intersect(s, t)) >= need
), per_doc AS (
  SELECT r, list(DISTINCT label) AS labels, max(containment) AS best, count(*) AS n_spans FROM found GROUP BY r
), based AS (
  SELECT *, list_concat(list_concat(mit, apache), gpl) AS places,
    list_filter(['apache', 'gpl', 'mit'], lambda x: CASE x WHEN 'mit' THEN len(mit) WHEN 'gpl' THEN len(gpl) ELSE len(apache) END > 0) AS base
  FROM placed
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base,
  list_min(places) AS first_word, list_max(places) AS last_word, array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM based LEFT JOIN per_doc USING (r)
"""


def _sketch(text: str) -> str:
    words = f"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
    return f"""(SELECT list_sort(list_distinct(list_filter(
      list_transform(range(CASE WHEN len(v.w) = 0 THEN 0 ELSE greatest(1, len(v.w) - 4) END),
        lambda i: md5(array_to_string(v.w[i + 1 : i + 5], ' '))[1:16]), lambda h: h < '4'))) FROM (SELECT {words} AS w) v)"""


def _likeness(a: str, b: str, same: str) -> str:
    union = f"len({a}) + len({b}) - len(list_intersect({a}, {b}))"
    return f"CASE WHEN {union} = 0 THEN CASE WHEN {same} THEN 1.0 ELSE 0.0 END::DOUBLE ELSE (len(list_intersect({a}, {b})) / ({union}))::DOUBLE END"


SKETCHES = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents
), pairs AS (
  SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text FROM docs
), edited AS (
  SELECT *, concat(substring(text, 1, n_chars - n_chars // 3), substring(next_text, 1, n_chars // 3)) AS edited FROM pairs
), sketched AS (
  SELECT *, {_sketch('text')} AS s, {_sketch('edited')} AS e, {_sketch('next_text')} AS n FROM edited
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(s, '') AS fingerprint, array_to_string(e, '') AS edited_fingerprint,
  {_likeness('s', 'e', 'text = edited')} AS near_edited, {_likeness('s', 'n', 'text = next_text')} AS near_next
FROM sketched
"""



NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(list_transform(range(CASE WHEN len(w) = 0 THEN 0 ELSE greatest(1, len(w) - 4) END),
    lambda i: array_to_string(w[i + 1 : i + 5], ' '))) AS s FROM docs
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM docs UNION SELECT r.doc_id, l.v FROM reached r JOIN links l ON r.other = l.u
), best AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN best USING (doc_id)
"""


def _escaped(text: str) -> str:
    controls = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
    out = f"replace({text}, '\\', '\\\\')"
    for c in controls:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


CHATS = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|im_start|>' || {_escaped('role')} || chr(10) || {_escaped('text')} || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


LINES = """
WITH lines AS (
  SELECT doc_id, i, l, translate(trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)
), owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT lines.*, owner IS NOT NULL AND owner <> doc_id AS dropped FROM lines LEFT JOIN owners USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# crc32 of a text, byte by byte: the lookup table of the reversed polynomial, then one step for each byte
_CRC_TABLE = """
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b)
  FROM range(256) t(b)
"""

VARIANTS = f"""
WITH RECURSIVE crc AS MATERIALIZED (SELECT ({_CRC_TABLE}) AS steps), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
  ) GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(
    list_prepend(4294967295, list_transform(string_split(regexp_replace(hex(encode(concat(doc_id, ':', run))), '(..)', '\\1 ', 'g'), ' ')[:-2], lambda x: CAST('0x' || x AS BIGINT))),
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM runs, crc
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), pieces AS (
  -- words within one edit share a half: one of the two halves is untouched
  SELECT word, n, unnest([
    'a' || substring(word, 1, length(word) // 2), 'a' || substring(word, 1, (length(word) + 1) // 2), 'a' || substring(word, 1, greatest(length(word) - 1, 0) // 2),
    'z' || right(word, length(word) // 2), 'z' || right(word, (length(word) + 1) // 2), 'z' || right(word, greatest(length(word) - 1, 0) // 2)]) AS piece FROM words
), near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM pieces a JOIN pieces b ON a.piece = b.piece AND a.word <> b.word
    AND abs(length(a.word) - length(b.word)) <= 1
  WHERE CASE WHEN length(a.word) = length(b.word)
    THEN len(list_filter(range(length(a.word)), lambda i: substring(a.word, i + 1, 1) <> substring(b.word, i + 1, 1))) = 1
    ELSE len(list_filter(range(greatest(length(a.word), length(b.word))), lambda i:
      CASE WHEN length(a.word) > length(b.word) THEN substring(a.word, 1, i) || substring(a.word, i + 2) = b.word
        ELSE substring(b.word, 1, i) || substring(b.word, i + 2) = a.word END)) > 0 END
), best AS (
  SELECT word, n, count(*) AS n_near, min_by(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word, n
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root FROM formed UNION ALL SELECT f.word, formed.form FROM followed f JOIN formed ON formed.word = f.root WHERE formed.form IS NOT NULL
), ends AS (
  SELECT f.word, f.root FROM followed f JOIN formed ON formed.word = f.root WHERE formed.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

SEARCH = r"""
WITH terms AS (
  SELECT doc_id, n, unnest(w) AS term FROM (
    SELECT doc_id, w, len(w) AS n FROM (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents))
), counted AS (
  SELECT doc_id, n, term, count(*) AS tf FROM terms GROUP BY doc_id, n, term
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM (SELECT DISTINCT doc_id, n FROM terms)
), asked AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), totals
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weights USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def statements() -> dict[str, str]:
    return {
        "op1_minmax_dedup": NEAR_DUPLICATES, "op2_license_join": LICENSES, "op9_chat_events": CHATS, "op10_scaled_sketch": SKETCHES,
        "op11_cuckoo_lines": LINES, "op12_trie_variants": VARIANTS, "op13_best_positions": SEARCH,
    }
