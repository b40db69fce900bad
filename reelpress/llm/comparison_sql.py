"""SQL statements of the queries' results, for the comparison engine."""

ORACLE: dict[str, str] = {}

ORACLE["op1_url_filter"] = """
WITH rules(r_host, r_path, r_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0
                         THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest),
hits AS (
    SELECT page_id, arg_max(r_host || r_path, length(r_host || r_path)) AS rule,
           arg_max(r_verdict, length(r_host || r_path)) AS verdict
    FROM parts JOIN rules
      ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN hits USING (page_id)
"""

ORACLE["op4_line_dedup"] = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
shared AS (
    SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
    SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.first_id AS gone
    FROM keyed k LEFT JOIN shared s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op8_exact_dedup"] = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE["op7_quality_rules"] = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
solid AS (
    SELECT doc_id, line, regexp_replace(line, '[\x20\x09-\x0D]', '', 'g') AS solid,
           len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
    FROM lines),
failing AS (
    SELECT doc_id, length(solid) AS size,
           words > 0 AND (
               len(regexp_extract_all(solid, '[#*$%&|<>{}\[\]\\^~=_@+/]')) > 0.1 * length(solid)
            OR 2 * len(regexp_extract_all(line || ' ', '[!?][\x20\x09-\x0D]')) > words
            OR words >= 5 AND regexp_matches(line, '\p{Lu}') AND NOT regexp_matches(line, '\p{Ll}')
            OR len(regexp_extract_all(solid, '[|»«•·›‹]')) >= 3
               AND 3 * len(regexp_extract_all(solid, '[|»«•·›‹]')) >= words
            OR regexp_matches(lower(line), 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|uses cookies|use of cookies|accept cookies|enable javascript|javascript is disabled|lorem ipsum|click here to|sign up for our newsletter|powered by')
           ) AS fails
    FROM solid),
losses AS (
    SELECT doc_id, coalesce(sum(size) FILTER (fails), 0) AS lost, sum(size) AS size
    FROM failing GROUP BY doc_id),
repeats AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM solid WHERE words > 0 GROUP BY doc_id),
word_lists AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
windows AS (
    SELECT doc_id, p, w[p : p + 4] AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM word_lists)),
again AS (
    SELECT doc_id, p FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT q) AS n
    FROM (SELECT doc_id, unnest(range(p, p + 5)) AS q FROM again) GROUP BY doc_id),
base AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
           length(array_to_string(w, '')) AS word_chars,
           CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words
    FROM docs d JOIN word_lists USING (doc_id) LEFT JOIN repeats USING (doc_id)
    LEFT JOIN covered c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 2 * lost <= size AS kept
FROM base JOIN losses USING (doc_id)
"""

ORACLE["op9_chat_quotation_linking"] = r"""
WITH RECURSIVE messages AS (
    SELECT row_number() OVER () AS rid, conv_id, turn, role,
           string_split(coalesce(text, ''), chr(10)) AS parts
    FROM conversations),
lines AS (
    SELECT rid, conv_id, turn, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
    FROM messages),
parsed AS (
    SELECT rid, conv_id, turn, pos, line,
           length(regexp_replace(regexp_extract(line, '^[ \t]*(?:>[ \t]*)+'), '[^>]', '', 'g'))
             AS level,
           translate(trim(regexp_replace(regexp_replace(line, '^[ \t]*(?:>[ \t]*)+', ''),
                                         '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines),
islands AS (
    SELECT *, pos - row_number() OVER (PARTITION BY rid, level ORDER BY pos) AS island FROM parsed),
passages AS (
    SELECT rid, conv_id, turn, level, trim(regexp_replace(
               string_agg(key, ' ' ORDER BY pos), ' +', ' ', 'g'), ' ') AS text
    FROM islands GROUP BY rid, conv_id, turn, level, island),
split AS (
    SELECT *, string_split(text, ' ') AS w, greatest(len(string_split(text, ' ')) - 4, 1) AS n
    FROM passages),
units AS (
    SELECT conv_id, turn, level, 'passage' AS kind, text AS key, n AS weight FROM split
    UNION ALL SELECT conv_id, turn, level, 'part', key, 1 FROM parsed
    UNION ALL SELECT conv_id, turn, level, 'part',
           unnest(string_split(regexp_replace(text, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))), 1 FROM split
    UNION ALL SELECT conv_id, turn, level, 'part',
           unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, n + 1)]), 1 FROM split),
telling AS (
    SELECT conv_id, turn, level, kind, key, max(weight) AS weight
    FROM units
    WHERE regexp_matches(key, '[\p{L}\p{N}]') AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL),
own_units AS (SELECT DISTINCT conv_id, kind, key, turn FROM telling WHERE level = 0),
holders AS (
    SELECT *, count(*) OVER (PARTITION BY conv_id, kind, key) > 8 AS stock,
           row_number() OVER (PARTITION BY conv_id, kind, key ORDER BY turn) AS nth
    FROM own_units),
found AS (
    SELECT t.conv_id, t.turn, t.level, h.turn AS first,
           sum(CASE WHEN stock THEN 0 ELSE weight END) AS told, count(*) FILTER (stock) AS stock
    FROM telling t JOIN holders h ON t.conv_id = h.conv_id AND t.kind = h.kind AND t.key = h.key
    WHERE t.level > 0 AND h.turn < t.turn AND (nth = 1 OR NOT stock)
    GROUP BY t.conv_id, t.turn, t.level, h.turn),
parents AS (
    SELECT conv_id, turn, first AS parent FROM found
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn
                               ORDER BY level, told DESC, stock DESC, first DESC) = 1),
climbs(conv_id, turn, upto, hops) AS (
    SELECT conv_id, turn, parent, CAST(1 AS BIGINT) FROM parents
    UNION ALL
    SELECT c.conv_id, c.turn, p.parent, c.hops + 1
    FROM climbs c JOIN parents p ON c.conv_id = p.conv_id AND c.upto = p.turn),
roots AS (
    SELECT conv_id, turn, arg_max(upto, hops) AS root, max(hops) AS hops
    FROM climbs GROUP BY conv_id, turn),
own AS (
    SELECT rid, count(*) FILTER (level > 0) AS n_quoted_lines,
           trim(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (level = 0), ''),
                ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS own_text
    FROM parsed GROUP BY rid)
SELECT m.conv_id, m.turn, m.role, p.parent AS parent_turn,
       coalesce(r.root, m.turn) AS thread_turn, coalesce(r.hops, 0) AS reply_depth,
       o.n_quoted_lines, sha256(o.own_text) AS own_sha256,
       sha256('<|' || coalesce(m.role, 'user') || '|>' || chr(10) || o.own_text || chr(10))
         AS formatted_sha256
FROM messages m JOIN own o ON m.rid = o.rid
LEFT JOIN parents p ON m.conv_id = p.conv_id AND m.turn = p.turn
LEFT JOIN roots r ON m.conv_id = r.conv_id AND m.turn = r.turn
"""

_DRAWN = "CAST('0x' || substr(md5(concat(conv_id, ':', {turn})), 1, 8) AS BIGINT)"
_WRAPPED = """array_to_string(
    ['{marks}' || array_to_string({words}[12 * i + 1:12 * i + 12], ' ') for i in range(0, (len({words}) + 11) // 12)],
    chr(10))"""

ORACLE["parents_of_quoting_replies"] = f"""
WITH drawn AS (
    SELECT *, CASE WHEN turn > 0 THEN {_DRAWN.format(turn="turn")} % turn END AS true_parent
    FROM conversations),
texts AS (
    SELECT conv_id, turn, true_parent, coalesce(text, '') AS said,
           string_split(trim(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' '), ' ') AS w
    FROM drawn),
above AS (
    SELECT d.*, p.said, p.w, p.w[len(p.w) // 2 + 1:] AS half, g.w AS gw
    FROM drawn d LEFT JOIN texts p ON p.conv_id = d.conv_id AND p.turn = d.true_parent
    LEFT JOIN texts g ON g.conv_id = p.conv_id AND g.turn = p.true_parent),
replies AS (
    SELECT conv_id, turn, role, true_parent, concat_ws(chr(10),
        {_WRAPPED.format(words="gw", marks="> > ")},
        CASE turn % 3 WHEN 0 THEN '> ' || replace(said, chr(10), chr(10) || '> ')
                      WHEN 1 THEN {_WRAPPED.format(words="w", marks="> ")}
                      ELSE {_WRAPPED.format(words="half", marks="> ")} END,
        coalesce(text, '')) AS text
    FROM above)
SELECT r.conv_id, r.turn, r.true_parent, l.parent_turn, l.thread_turn, l.reply_depth
FROM ({ORACLE["op9_chat_quotation_linking"].replace("FROM conversations", "FROM replies")}) l
JOIN replies r ON r.conv_id = l.conv_id AND r.turn = l.turn
"""

ORACLE["op13_phrase_collocations"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
pieces AS (
    SELECT d, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece,
           generate_subscripts(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]'), 1) AS p
    FROM docs),
lists AS (SELECT d, lang, p, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT d, lang, p, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM lists),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
runs AS (
    SELECT lang, w AS w1, lead(w, 1) OVER here AS w2, lead(w, 2) OVER here AS w3,
           lead(w, 3) OVER here AS w4, lead(w, 4) OVER here AS w5
    FROM words WINDOW here AS (PARTITION BY d, p ORDER BY i)),
phrases AS (
    SELECT lang, w1 AS phrase, 1 AS m FROM runs
    UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM runs WHERE w2 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM runs WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4 FROM runs
        WHERE w4 IS NOT NULL
    UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5, 5 FROM runs
        WHERE w5 IS NOT NULL),
counts AS (
    SELECT lang, phrase, m, count(*) AS f FROM phrases GROUP BY lang, phrase, m
    HAVING count(*) >= 100),
candidates AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1),
held AS (
    SELECT DISTINCT s.lang, s.phrase
    FROM candidates s JOIN candidates l ON s.lang = l.lang AND l.m > s.m
        AND contains(' ' || l.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * l.a >= 100 * s.a),
cuts AS (
    SELECT lang, phrase, m, a, w, unnest(range(1, m)) AS k
    FROM candidates ANTI JOIN held USING (lang, phrase)),
scored AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
           CAST((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.m], ' ')
    JOIN totals t ON t.lang = c.lang),
lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM lowest
QUALIFY rank <= 2000
"""
