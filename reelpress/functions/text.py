"""Column functions for text. All of them stay inside Catalyst (no Python workers)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: cleaning rules -------------------------------------------------------
#: phrases deleted from article text, in any letter case
SITE_PHRASES = ["Share this article", "Follow us on", "Subscribe to"]
#: runs of whitespace as Unicode defines it (Java's ``\s`` alone is ASCII)
WHITESPACE_RUN = r"[\s\x1c-\x1f\x0b\x{85}\x{a0}\p{Z}]+"
#: everything that is not a letter, digit, underscore, space or basic punctuation
DISALLOWED = r"[^\p{L}\p{N}_\s.,!?;:\-()]"
#: named entities and the text they stand for; ``amp`` last, so nothing is decoded twice
ENTITIES = [
    ("nbsp", "\u00a0"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"),
    ("amp", "&"),
]
# -----------------------------------------------------------------------------------------


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` for costly expressions that later steps read more than once.

    A filter on an ordinary computed column is pushed below its projection, which evaluates
    the expression again. Predicates do not pass a generator, so the values are produced
    once per row and reused.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns]
    made = F.struct(*(expr.alias(name) for name, expr in columns.items()))
    return df.select(*kept, F.inline(F.array(made)))


def decode_entities(text: Column) -> Column:
    """Resolves the entities above, which HTML also allows without their semicolon."""
    for entity, plain in ENTITIES:
        text = F.regexp_replace(text, f"&{entity};?", plain)
    return text


def clean_text(
    text: Column, phrases: Iterable[str] = SITE_PHRASES, decode: bool = False
) -> Column:
    """Normalised article text; NULL becomes ``''``.

    Whitespace runs become one space, characters other than letters, digits, ``_`` and
    ``. , ! ? ; : - ( )`` go, repeated periods and commas collapse, site phrases go. Spaces
    that deletions bring together are left as they are. Entities lose their ``&`` like any
    other text unless ``decode`` resolves them first.
    """
    out = F.coalesce(text, F.lit(""))
    if decode:
        out = decode_entities(out)
    out = F.regexp_replace(out, WHITESPACE_RUN, " ")
    out = F.regexp_replace(out, DISALLOWED, "")
    out = F.regexp_replace(out, r"([.,])\1+", "$1")
    for phrase in phrases:
        out = F.regexp_replace(out, f"(?iu){phrase}", "")
    return F.trim(out)


def content_hash(title: Column, content: Column, lower: bool = False) -> Column:
    """MD5 of title followed by content; a missing part counts as empty."""
    title, content = F.coalesce(title, F.lit("")), F.coalesce(content, F.lit(""))
    if lower:
        title, content = F.lower(title), F.lower(content)
    return F.md5(F.concat(title, content))


def hash_or(given: Column, title: Column, content: Column) -> Column:
    """The hash an article arrived with, else the hash of its lower-cased cleaned text."""
    return F.coalesce(F.nullif(given, F.lit("")), content_hash(title, content, lower=True))


def matches_keyword(columns: Sequence[Column], keyword: Column | str) -> Column:
    """True where any of the columns contains the keyword, whatever the letter case."""
    needle = F.lower(F.lit(keyword) if isinstance(keyword, str) else keyword)
    found = F.lit(False)
    for column in columns:
        found = found | F.contains(F.lower(F.coalesce(column, F.lit(""))), needle)
    return found


def matching_keywords(lowered: Sequence[Column], keywords: Sequence[str]) -> Column:
    """Array of those keywords found in any of the lower-cased columns, in the given order.

    One pass over each row with the keyword list as a literal: no join, no shuffle.
    """
    words = F.array(
        *(F.struct(F.lit(w).alias("word"), F.lower(F.lit(w)).alias("needle")) for w in keywords)
    )

    def found(entry: Column) -> Column:
        hit = F.lit(False)
        for column in lowered:
            hit = hit | F.contains(column, entry["needle"])
        return hit

    return F.transform(F.filter(words, found), lambda entry: entry["word"])


def first_text(*candidates: Column) -> Column:
    """First candidate that is neither NULL nor empty, else ``''``."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in candidates), F.lit(""))


def preview_text(text: Column, limit: int = 2000) -> Column:
    """The text, cut to ``limit`` characters plus an ellipsis where it is longer."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)


def sample_text(title: Column, content: Column, limit: int = 150) -> Column:
    """The first ``limit`` characters of the title, topped up from the content."""
    joined = F.concat(F.coalesce(title, F.lit("")), F.coalesce(content, F.lit("")))
    return F.substring(joined, 1, limit)


def scoring_text(title: Column, content: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


def slug(name: Column) -> Column:
    return F.lower(F.replace(name, F.lit(" "), F.lit("_")))


def key_stamp(ts: Column, millis: bool = False) -> Column:
    """``yyyyMMdd_HHmmss``, with ``_SSS`` appended on request."""
    return F.date_format(ts, "yyyyMMdd_HHmmss_SSS" if millis else "yyyyMMdd_HHmmss")


def content_key(keyword: Column, digest: Column, ts: Column) -> Column:
    """Object key of one article's content, kept as a column of the stage table."""
    return F.concat(
        F.lit("article_content/"), keyword, F.lit("/"), digest, F.lit("_"), key_stamp(ts),
        F.lit(".json"),
    )


def quote_keyword(text: Column) -> Column:
    """Percent-encoding for a URL query: space as ``%20``, ``/`` and ``~`` kept."""
    out = F.url_encode(text)
    for encoded, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(encoded), F.lit(wanted))
    return out


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; 0 where there is no whole."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def default_if_missing(column: Column, default) -> Column:
    return F.coalesce(column, F.lit(default))


def key_stage(key: Column) -> Column:
    """Stage an object key belongs to: its first path segment."""
    return F.split_part(key, F.lit("/"), F.lit(1))
