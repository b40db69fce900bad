"""Pieces of comparison SQL that several queries share."""

from __future__ import annotations

from reelpress.functions import html as H
from reelpress.functions import text as X
from reelpress.plans.tables import KEYWORDS, LEXICON


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(name: str, columns: str, rows) -> str:
    """A literal table as a common table expression."""
    def cell(v):
        return quoted(v) if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def replace_all(expr: str, pattern: str, by: str) -> str:
    return f"regexp_replace({expr}, {quoted(pattern)}, {quoted(by)}, 'g')"


def clean(expr: str, phrases=X.SITE_PHRASES) -> str:
    out = f"coalesce({expr}, '')"
    out = replace_all(out, X.WHITESPACE_RUN, " ")
    out = replace_all(out, X.DISALLOWED, "")
    out = replace_all(out, r"\.{2,}", ".")
    out = replace_all(out, r",{2,}", ",")
    for phrase in phrases:
        out = replace_all(out, f"(?i){phrase}", "")
    return f"trim({out}, ' ')"


def decoded(expr: str) -> str:
    for entity, plain in X.ENTITIES:
        expr = replace_all(expr, f"&{entity};?", plain)
    return expr


def plain_text(expr: str) -> str:
    for pattern in (H.SCRIPTS, H.COMMENTS, H.TAGS):
        expr = replace_all(expr, pattern, "")
    return replace_all(decoded(expr), H.OUTER_SPACE, "")


def first_group(expr: str, pattern: str) -> str:
    return f"regexp_extract({expr}, {quoted(pattern)}, 1)"


def page_title(html: str = "html") -> str:
    heading = plain_text(first_group(html, H.FIRST_HEADING))
    title = plain_text(first_group(html, H.PAGE_TITLE))
    return f"coalesce(nullif({heading}, ''), nullif({title}, ''), {quoted(H.NO_TITLE)})"


#: page_id, url, title, content of every page
READ_PAGES = f"""bodies AS (
    SELECT page_id, url, {page_title()} AS title,
           {plain_text(first_group(replace_all("html", H.SCRIPTS, ""), H.FIRST_ARTICLE))} AS body
    FROM pages),
read_pages AS (
    SELECT page_id, url, title,
           CASE WHEN length(body) > {H.MIN_BODY} THEN body ELSE {quoted(H.NO_CONTENT)} END
           AS content
    FROM bodies)"""

KEYWORD_TABLE = values("keywords", "keyword", [(word,) for word in KEYWORDS])

#: (seq, p, s, n): sums of hits in thousandths per article
LEXICON_HITS = f"""{values("lexicon", "word, p, s", LEXICON)},
tokens AS (
    SELECT seq, unnest(string_split_regex(lower(concat(title, ' ', content)), '[^\\p{{L}}]+'))
           AS word
    FROM articles),
hits AS (SELECT seq, CAST(sum(p) AS BIGINT) AS p, CAST(sum(s) AS BIGINT) AS s, count(*) AS n
         FROM tokens JOIN lexicon USING (word) GROUP BY seq)"""


def thousandths(total: str, count: str) -> str:
    """``total / count`` rounded half up to a whole number, both being whole numbers."""
    return f"(sign({total}) * ((2 * abs({total}) + {count}) // (2 * {count})))"


#: (seq, keyword, source, score) with the score in thousandths
SCORED = f"""{LEXICON_HITS},
scored AS (
    SELECT a.seq, a.keyword, a.source,
           CASE WHEN n IS NULL THEN 500 ELSE (p + 1000 * n + n) // (2 * n) END AS score,
           CASE WHEN n IS NULL THEN 0 ELSE {thousandths("p", "n")} / 1000.0 END AS polarity,
           CASE WHEN n IS NULL THEN 0 ELSE {thousandths("s", "n")} / 1000.0 END AS subjectivity
    FROM articles a LEFT JOIN hits USING (seq))"""


def bit_positions(item: str, bits: int, hashes: int) -> str:
    """Array of bit positions of an item."""
    def one(index: int) -> str:
        digest = f"md5(concat({item}, '{index}'))"
        value = "CAST(0 AS BIGINT)"
        for start in (1, 9, 17, 25):
            piece = f"CAST(concat('0x', substring({digest}, {start}, 8)) AS BIGINT)"
            value = f"(({value} * 4294967296 + {piece}) % {bits})"
        return value

    return "[" + ", ".join(one(index) for index in range(hashes)) + "]"
