"""From HTML pages to links and article rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.functions import html as H
from reelpress.functions import text as X

def parse_pages(
    pages: DataFrame,
    html: str = "html",
    marks: Sequence[str] = tuple(H.ARTICLE_MARKS),
) -> DataFrame:
    """Adds ``title``, ``content`` and ``links`` (array) and drops the HTML column.

    All three are read from one outline of the page, in the row. A null page is an empty one.
    """
    return _with_parts(
        pages, html, title=H.title_of, content=H.article_of, links=lambda page: H.links_of(page, marks)
    )


def read_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title and content of every page."""
    return _with_parts(pages, html, title=H.title_of, content=H.article_of)


def _with_parts(pages: DataFrame, html: str, **parts: Callable[[Column], Column]) -> DataFrame:
    kept = [f"`{name}`" for name in pages.columns if name not in (html, *parts)]
    read = F.array(H.page_parts(F.col(f"`{html}`"), **parts))
    return pages.select(*kept, F.inline(read))


def extract_links(
    pages: DataFrame,
    base: str,
    marks: Sequence[str] = tuple(H.ARTICLE_MARKS),
    html: str = "html",
    links: Column | None = None,
) -> DataFrame:
    """One row per article URL of a page with its ``position``, first occurrence only.

    Marked links come first, then those in the elements that list articles. ``links`` may name
    the link column of ``parse_pages``; otherwise they are read from ``html``.
    """
    others = [name for name in pages.columns if name not in (html, "links")]
    if links is None:
        pages = _with_parts(pages.select(*others, html), html, links=lambda page: H.links_of(page, marks))
        links = F.col("links")
    return pages.select(
        *others, F.posexplode(H.article_urls(links, base, marks)).alias("position", "link")
    )


def explode_keywords(
    df: DataFrame, columns: Sequence[str], keywords: Sequence[str], out: str = "keyword"
) -> DataFrame:
    """One row per keyword found in any of the columns; rows without a match go.

    The columns are lower-cased once per row, not once per keyword.
    """
    lowered = {f"_lower_{name}": F.lower(F.coalesce(name, F.lit(""))) for name in columns}
    once = X.compute_once(df, **lowered)
    found = X.matching_keywords([F.col(name) for name in lowered], keywords)
    return once.withColumn(out, F.explode(found)).drop(*lowered)


def grams(text: Column, q: int = 3) -> Column:
    """All distinct substrings of one to ``q`` characters, in linear work."""
    # the text's characters once, as a variable that every place can look into
    def pieces(chars: Column) -> Column:
        def of(n: int) -> Column:
            def at(_: Column, i: Column) -> Column:
                whole = F.concat(*[F.get(chars, i + k) for k in range(n)])
                return F.when(i + n <= F.size(chars), whole)

            return F.transform(chars, at)

        made = F.flatten(F.array(*map(of, range(1, q + 1))))
        return F.array_distinct(F.filter(made, lambda g: g.isNotNull()))

    chars = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "", -1))
    return F.get(F.transform(F.array(F.filter(chars, lambda c: c != "")), pieces), F.lit(0))


def text_grams(text: Column, lengths: Column, q: int = 3) -> Column:
    """``grams`` of the lengths in use, found by a pattern that looks ahead at every place of the text.

    Next to a character outside the basic plane it may find some that are none; these are only looked for in vain.
    """
    def of(n: int) -> Column:
        found = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
        return F.when(F.array_contains(lengths, n), found).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of, range(1, q + 1)))


#: characters of the grams that keywords are filed under: most keywords are not longer, so what meets is mostly held
GRAM = 6
#: words of 64 bits of the sketch of a keyword table's grams
SKETCH_WORDS = 8192


def _bit(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(64 * SKETCH_WORDS))


def _sketch(df: DataFrame, column: str) -> Column:
    """One array with a bit set for every value of the column, as a value of the query; its size is fixed."""
    words = df.groupBy(F.shiftright(_bit(F.col(column)), 6).alias("id")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(`{column}`), {64 * SKETCH_WORDS}L) & 63L AS INT))")).alias("bits")
    )
    every = df.sparkSession.range(0, SKETCH_WORDS, 1, 1).join(words, "id", "left")
    entry = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    return every.agg(F.sort_array(F.collect_list(entry)).alias("s")).select(F.col("s.bits")).scalar()


def _in_sketch(value: Column, sketch: Column) -> Column:
    """False for values that are surely not in the sketch."""
    bit = _bit(value)
    return F.getbit(F.get(sketch, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1


def match_keywords(
    df: DataFrame,
    columns: Sequence[str],
    keywords: DataFrame,
    out: str = "keyword",
    q: int = GRAM,
    rarity_share: float = 0.05,
    once: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per row of ``df`` and keyword of a *table* found in any of the columns.

    ``once`` names columns to be added, computed for a row before it is repeated for each of its keywords.

    An inverted index of character grams: each keyword is filed under one of its grams of ``q`` characters,
    the rarest in a share of the texts (that choice changes the work, not the result); a shorter one
    under itself. Texts send those of their distinct grams that have their bit set in a sketch of the
    ``SKETCH_WORDS`` * 64 bits of all grams in use, with a hash, and what meets there is looked for exactly
    in the rows of that hash. There is no limit to the keywords and no row is compared with all of them. Case is ignored; null and empty keywords and rows without a match go; repeated keywords
    count once.
    """
    lowered = {f"_lower_{name}": F.lower(F.coalesce(name, F.lit(""))) for name in columns}
    keyed = X.compute_once(df, **lowered).withColumn("_texts", F.xxhash64(*lowered))
    words = (
        keywords.select(F.col(out).alias("_word"))
        .filter("_word != ''")
        .distinct()
        .withColumn("_needle", F.lower("_word"))
    )
    lengths = words.agg(F.collect_set(F.least(F.length("_needle"), F.lit(q)))).scalar()
    held = F.explode(F.array_distinct(F.concat(*[text_grams(F.col(c), lengths, q) for c in lowered])))
    # by other columns than the texts, where there are any: rows left out are not lower-cased or parsed
    drawn_by = [F.col(f"`{c}`") for c in df.columns if c not in columns] or [F.col("_texts")]
    sampled = F.pmod(F.xxhash64(*drawn_by), F.lit(1000)) < F.lit(int(1000 * rarity_share))
    common = keyed.filter(sampled).select(held.alias("_gram")).groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    longest = F.least(F.length("_needle"), F.lit(q))
    filed = (
        words.select("_word", "_needle", F.explode(grams(F.col("_needle"), q)).alias("_gram"))
        .filter(F.length("_gram") == longest)
        .join(common, "_gram", "left")
        .groupBy("_word", "_needle")
        .agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    )
    sent = keyed.select("_texts", held.alias("_gram")).filter(_in_sketch(F.col("_gram"), _sketch(filed, "_gram")))
    # dealt once: what makes pairs distinct and brings them to their texts
    met = sent.join(filed.select("_gram", "_word"), "_gram").select("_texts", "_word").repartition("_texts").distinct()
    met = met.withColumn("_needle", F.lower("_word"))
    holds = F.lit(False)
    for column in lowered:
        holds = holds | F.contains(column, F.col("_needle"))
    rows = X.compute_once(keyed, **once) if once else keyed
    return rows.join(met, "_texts").filter(holds).withColumn(out, F.col("_word")).drop(
        *lowered, "_texts", "_word", "_needle"
    )


def explode_stock_keywords(
    df: DataFrame,
    columns: Sequence[str],
    stocks: DataFrame,
    out: str = "keyword",
    once: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per stock and keyword of it found in any of the columns, with ``stock_name``.

    ``stocks`` has ``name`` and ``keywords``, any number of them; ``once`` as in ``match_keywords``.
    """
    pairs = stocks.select(
        F.col("name").alias("stock_name"), F.explode("keywords").alias(out)
    ).filter(F.col(out) != "").distinct()
    return match_keywords(df, columns, pairs, out, once=once).join(pairs, out)


def stock_articles(
    parsed: DataFrame, stocks: DataFrame, source: Column, run_time: Column
) -> DataFrame:
    """Raw article rows for the article flow: every parsed page once per stock keyword it is about."""
    digest = X.content_hash(F.col("title"), F.col("content"))
    hits = explode_stock_keywords(parsed, ["title", "content"], stocks, once={"content_hash": digest})
    return _article_rows(hits, source, run_time, "stock_name")


def extract_articles(
    parsed: DataFrame, keywords: Sequence[str], source: Column, run_time: Column
) -> DataFrame:
    """Raw article rows: every parsed page once per keyword it is about.

    Expects ``url``, ``title`` and ``content``. The full text stays in ``full_content``;
    ``content`` is its preview.
    """
    hits = explode_keywords(parsed, ["title", "content"], keywords)
    hits = X.compute_once(hits, content_hash=X.content_hash(F.col("title"), F.col("content")))
    return _article_rows(hits, source, run_time)


def _article_rows(hits: DataFrame, source: Column, run_time: Column, *more: str) -> DataFrame:
    return hits.select(
        *more,
        source.alias("source"),
        "keyword",
        "title",
        X.preview_text(F.col("content")).alias("content"),
        F.col("content").alias("full_content"),
        "url",
        "content_hash",
        X.content_key(F.col("keyword"), F.col("content_hash"), run_time).alias(
            "s3_raw_content_path"
        ),
        F.date_format(run_time, "yyyy-MM-dd'T'HH:mm:ss").alias("extraction_timestamp"),
    )


def posts_matching(feed: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """URLs of the feed's posts that mention a keyword in title or excerpt."""
    posts = feed.select(F.posexplode("posts").alias("position", "post")).select(
        "position", "post.*"
    )
    return explode_keywords(posts, ["title", "excerpt"], keywords).select(
        "keyword", "position", F.coalesce("url", F.lit("")).alias("url")
    )
