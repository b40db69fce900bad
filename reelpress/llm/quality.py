"""Quality rules, line first: failing lines go, then documents that lose too much of their text.

Every line is judged by itself:

* punctuation: symbols are more than ``MAX_SYMBOLS`` of its characters other than white space, or
  more than half of its words carry an exclamation or question mark;
* shouting: at least ``MIN_SHOUT`` words and capital letters but no small ones;
* navigation: at least three separators (``|``, guillemets, bullets) and one per three words;
* boilerplate: one of the phrases below.

A document is rejected if it has fewer than ``MIN_WORDS`` words, if too many of its words lie in
repeated five-word windows, or if failing lines hold more than ``MAX_LOST`` of its word characters.

Everything is an expression of one row: no shuffle, and documents spread as the input does. The
windows are compared by 64-bit hashes of their words; a document without equal hashes, which a
hash set tells in linear time, needs no more, the others sort them.

Defined results: a null or empty text has no words, fails and has an empty clean text; repeated
rows are judged alike; an empty table gives an empty result; input columns named like a
result column are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.llm.common import BLANKS, text_of, without

MIN_WORDS = 10
WINDOW = 5
#: Words in repeated windows, per hundred words, that a document may have.
MAX_REPEATED = 20
MAX_SYMBOLS = 0.1
MIN_SHOUT = 5
MAX_LOST = 0.5

SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
ODD_SYMBOLS = r"[#*$%&|<>{}\[\]\\^~=_@+/]"
MARKED_WORD = r"[!?](?=[\x20\x09-\x0D]|$)"
SEPARATORS = "[|»«•·›‹]"
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "use of cookies",
    "accept cookies",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "click here to",
    "sign up for our newsletter",
    "powered by",
)
RESULT = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "lost_share", "clean_text", "kept",
)


def split_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT, -1))


def count_of(text: Column, pattern: str) -> Column:
    """How many characters match a class."""
    return F.regexp_count(text, F.lit(pattern))


def line_fails(line: Column, words: Column) -> Column:
    """Whether a line of these words fails; phrases are looked for by ``has_phrase``."""
    size, solid = F.size(words), F.length(F.array_join(words, ""))
    symbols = count_of(line, ODD_SYMBOLS)
    separators = count_of(line, SEPARATORS)
    noisy = (symbols > MAX_SYMBOLS * solid) | (2 * count_of(line, MARKED_WORD) > size)
    shouting = (size >= MIN_SHOUT) & line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}")
    navigation = (separators >= 3) & (3 * separators >= size)
    return (size > 0) & (noisy | shouting | navigation)


def has_phrase(text: Column) -> Column:
    """Whether a text, already in small letters, holds one of the boilerplate phrases."""
    return reduce(or_, [F.contains(text, F.lit(phrase)) for phrase in BOILERPLATE])


def _window_hashes(window: int = WINDOW) -> Column:
    """Hashes of all windows, from the words' hashes ``__wh``."""
    return F.when(F.size("__wh") < window, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.size("__wh") - window),
            lambda i: F.xxhash64(*[F.get("__wh", i + k) for k in range(window)]),
        )
    )


def apply_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics, the clean text, the share lost and the verdict."""
    plain = docs.withColumn("__text", text_of(text))
    parsed = F.transform(
        F.split("__text", "\n", -1),
        lambda s: F.struct(s.alias("line"), split_words(s).alias("words")),
    )
    own = F.transform(F.filter("__lines", lambda x: F.size(x["words"]) > 0), lambda x: x["line"])
    # phrases are rare: only in a document that has one are its lines searched
    good = F.filter(
        "__lines",
        lambda x: ~(
            line_fails(x["line"], x["words"])
            | F.when(F.col("__phrase"), has_phrase(F.lower(x["line"]))).otherwise(F.lit(False))
        ),
    )
    staged = (
        plain.withColumns({"__lines": parsed, "__small": F.lower("__text")})
        .withColumns(
            {
                "__words": F.flatten(F.transform("__lines", lambda x: x["words"])),
                "__own": own,
                "__phrase": has_phrase(F.col("__small")),
            }
        )
        .withColumns(
            {
                "__n": F.size("__words").cast("long"),
                "__chars": F.length(F.array_join("__words", "")).cast("long"),
                "__wh": F.transform("__words", lambda w: F.xxhash64(w)),
                "__good": good,
                "__dup": (F.size("__own") - F.size(F.array_distinct("__own"))).cast("long"),
            }
        )
        .withColumns(
            {
                "__win": _window_hashes(),
                "__clean": F.array_join(F.transform("__good", lambda x: x["line"]), "\n"),
                "__left": F.aggregate(
                    "__good", F.lit(0), lambda a, x: a + F.length(F.array_join(x["words"], ""))
                ),
            }
        )
        .drop("__words", "__lines", "__wh", "__own", "__good", "__small", "__phrase")
        .withColumn("__again", F.size(F.array_distinct("__win")) < F.size("__win"))
        .withColumn(
            "__placed",
            F.when(
                F.col("__again"),
                F.sort_array(
                    F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                ),
            ),
        )
        .withColumn("__at", _repeated_places())
        .withColumn("__rep", F.coalesce(_union_length("__at"), F.lit(0)).cast("long"))
        .drop("__win", "__again", "__placed", "__at")
        .withColumn("__sym", count_of(F.col("__text"), SYMBOLS).cast("long"))
        .withColumn(
            "__lost",
            F.when(F.col("__chars") > 0, 1 - F.col("__left") / F.col("__chars")).otherwise(F.lit(0.0)),
        )
        .withColumn(
            "__base",
            (F.col("__n") < MIN_WORDS) | (100 * F.col("__rep") > MAX_REPEATED * F.col("__n")),
        )
        .withColumn("__kept", ~F.col("__base") & (F.col("__lost") <= MAX_LOST))
    )
    made = dict(
        zip(
            ("__n", "__chars", "__sym", "__dup", "__rep", "__base", "__lost", "__clean", "__kept"),
            RESULT,
            strict=True,
        )
    )
    return without(staged.drop("__left", "__text"), *RESULT).withColumnsRenamed(made)


def _repeated_places() -> Column:
    """Ascending places of the windows whose hash is also another's; from sorted ``__placed``."""
    at = lambda j: F.get("__placed", j)["h"]
    found = F.transform(
        "__placed",
        lambda x, j: F.when(
            (F.when(j > 0, at(j - 1)) == x["h"]) | (at(j + 1) == x["h"]), x["i"]
        ),
    )
    return F.sort_array(F.array_compact(found))


def _union_length(places: str, window: int = WINDOW) -> Column:
    """Words in the union of windows at ascending places."""
    steps = F.transform(
        places,
        lambda p, j: F.when(j == 0, F.lit(window)).otherwise(
            F.least(F.lit(window), p - F.get(places, j - 1))
        ),
    )
    return F.aggregate(steps, F.lit(0), lambda a, s: a + s)
