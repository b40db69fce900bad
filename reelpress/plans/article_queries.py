"""Article queries: cleaning, deduplication, pages, keywords, sentiment, sketches."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelpress.functions import html as H
from reelpress.functions import scoring as C
from reelpress.functions import sketch as K
from reelpress.functions import text as X
from reelpress.operators import dedup as D
from reelpress.operators import pages as P
from reelpress.operators import sentiment as S
from reelpress.operators import sketch as B
from reelpress.plans import article_flow as A
from reelpress.plans import article_job as J
from reelpress.plans import comparison_sql as Q
from reelpress.plans.registry import query
from reelpress.plans.tables import KEYWORDS, LEXICON, LINK_MARKS, MODIFIERS, PAGE_BASE, Tables

RUN_TIME = "2024-02-01 06:30:00"


def _run_time():
    return F.lit(RUN_TIME).cast("timestamp")


def _with_hash(articles):
    return articles.withColumn(
        "content_hash", X.content_hash(F.col("title"), F.col("content"))
    )


# ---- cleaning and hashing ----------------------------------------------------------------


@query("I1", f"SELECT seq, md5({Q.clean('content')}) AS digest FROM articles")
def cleaned_text_digests(t: Tables):
    return t.articles.select("seq", F.md5(X.clean_text(F.col("content"))).alias("digest"))


@query(
    "I2",
    f"SELECT seq, md5({Q.clean('content', [])}) AS digest FROM articles",
)
def cleaned_text_digests_keeping_phrases(t: Tables):
    cleaned = X.clean_text(F.col("content"), phrases=[])
    return t.articles.select("seq", F.md5(cleaned).alias("digest"))


@query(
    "I3 I4 I5",
    """SELECT seq, md5(concat(title, content)) AS raw_hash,
              md5(concat(lower(title), lower(content))) AS folded_hash,
              CAST(length(title) AS INT) AS title_length,
              CAST(length(content) AS INT) AS content_length
       FROM articles""",
)
def article_hashes(t: Tables):
    title, content = F.col("title"), F.col("content")
    return t.articles.select(
        "seq",
        X.content_hash(title, content).alias("raw_hash"),
        X.content_hash(title, content, lower=True).alias("folded_hash"),
        F.length(title).alias("title_length"),
        F.length(content).alias("content_length"),
    )


_PREPARED = f"""cleaned AS (
    SELECT seq, keyword, source, {Q.clean("title")} AS title, {Q.clean("content")} AS content
    FROM articles),
prepared AS (
    SELECT seq, keyword, source, title, content,
           md5(concat(lower(title), lower(content))) AS content_hash,
           CAST(length(content) AS INT) AS content_length,
           CAST(length(title) AS INT) AS title_length
    FROM cleaned WHERE length(content) >= {A.MIN_CONTENT})"""
_PREPARED_COLUMNS = ["seq", "keyword", "source", "content_hash", "content_length", "title_length"]


@query(
    "I1 I4 I5 C6 C12",
    f"WITH {_PREPARED} SELECT {', '.join(_PREPARED_COLUMNS)} FROM prepared",
)
def prepared_articles(t: Tables):
    return A.prepare_articles(t.articles).select(*_PREPARED_COLUMNS)


@query(
    "F2 E16 H2 I1 C6",
    f"""WITH {_PREPARED}
        SELECT {', '.join(_PREPARED_COLUMNS)}
        FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY seq) AS r
              FROM prepared) p WHERE r = 1""",
)
def unique_articles(t: Tables):
    return A.process_batch(A.prepare_articles(t.articles)).select(*_PREPARED_COLUMNS)


@query(
    "D6 F2 H3 C19",
    """SELECT seq, content_hash
       FROM (SELECT seq, md5(concat(title, content)) AS content_hash,
                    row_number() OVER (PARTITION BY md5(concat(title, content)) ORDER BY seq) AS r
             FROM articles) a
       WHERE r = 1 AND content_hash NOT IN (SELECT content_hash FROM delivered)""",
)
def articles_not_delivered_before(t: Tables):
    seen = D.known_keys(t.delivered, keys=["content_hash"])
    batch = _with_hash(t.articles).select("seq", "content_hash")
    return D.new_items(batch, seen, ["content_hash"], ["seq"])


@query("E16", "SELECT DISTINCT md5(concat(title, content)) AS content_hash FROM articles")
def distinct_content_hashes(t: Tables):
    return D.distinct_rows(_with_hash(t.articles), ["content_hash"])


@query(
    "D7 C12",
    """SELECT a.seq, length(coalesce(nullif(d.text, ''), a.title)) AS n
       FROM articles a LEFT JOIN (SELECT doc_id, text FROM documents JOIN labels USING (doc_id)) d
       ON a.seq = d.doc_id""",
)
def articles_with_attached_content(t: Tables):
    # only labelled documents have their full content stored
    path = F.concat(F.lit("article_content/"), F.col("doc_id").cast("string"))
    contents = t.documents.join(t.labels, "doc_id", "left_semi").select(
        path.alias("path"), F.lit(None).cast("string").alias("title"), F.col("text").alias("content")
    )
    raw = t.articles.select(
        "seq",
        "title",
        F.concat(F.lit("article_content/"), F.col("seq").cast("string")).alias(
            "s3_raw_content_path"
        ),
    )
    joined = A.attach_content(raw, contents)
    best = X.first_text(F.col("full_content"), F.col("title"))
    return joined.select("seq", F.length(best).cast("bigint").alias("n"))


@query(
    "F3",
    """SELECT seq, url FROM (
         SELECT seq, url, row_number() OVER (PARTITION BY url ORDER BY seq) AS r
         FROM (SELECT page_id AS seq, split_part(split_part(url, '?', 1), '/', 3) AS url
               FROM pages) p WHERE url <> '') q WHERE r = 1""",
)
def first_page_per_host(t: Tables):
    host = F.split_part(F.split_part("url", F.lit("?"), F.lit(1)), F.lit("/"), F.lit(3))
    pages = t.pages.select(F.col("page_id").alias("seq"), host.alias("url"))
    return D.first_per_key(pages, ["url"], ["seq"], keep_missing=False)


@query(
    "F5",
    """SELECT seq, source, keyword, url FROM (
         SELECT *, row_number() OVER (PARTITION BY source, keyword ORDER BY seq) AS r
         FROM articles) a WHERE r <= 2""",
)
def first_urls_per_source_and_keyword(t: Tables):
    urls = t.articles.select("seq", "source", "keyword", "url")
    return D.cap_per_key(urls, ["source", "keyword"], ["seq"], 2)


@query(
    "C13 C14",
    """SELECT seq, substring(concat(title, content), 1, 150) AS sample_content,
              md5(CASE WHEN length(content) > 2000 THEN concat(substring(content, 1, 2000), '...')
                       ELSE content END) AS preview_digest
       FROM articles""",
)
def article_samples_and_previews(t: Tables):
    return t.articles.select(
        "seq",
        X.sample_text(F.col("title"), F.col("content")).alias("sample_content"),
        F.md5(X.preview_text(F.col("content"))).alias("preview_digest"),
    )


@query(
    "B4 I10 I12 I7",
    f"""SELECT seq, concat('article_content/', keyword, '/', md5(concat(title, content)),
                           '_20240201_063000.json') AS content_key,
               concat(replace(lower(title), ' ', '_'), '_filtered_urls.json') AS slug_key,
               replace(url_encode(title), '%2F', '/') AS quoted_title
        FROM articles""",
)
def article_object_keys(t: Tables):
    keyed = _with_hash(t.articles)
    return keyed.select(
        "seq",
        X.content_key(F.col("keyword"), F.col("content_hash"), _run_time()).alias("content_key"),
        F.concat(X.slug(F.col("title")), F.lit("_filtered_urls.json")).alias("slug_key"),
        X.quote_keyword(F.col("title")).alias("quoted_title"),
    )


# ---- URLs and sketches -------------------------------------------------------------------


@query(
    "D5 F2",
    """SELECT seq, a.keyword AS stock_name, a.url FROM articles a
       WHERE NOT EXISTS (SELECT 1 FROM delivered d
                         WHERE d.stock_name = a.keyword AND d.url = a.url)""",
)
def urls_not_tracked(t: Tables):
    urls = t.articles.select("seq", F.col("keyword").alias("stock_name"), "url")
    return D.new_items(urls, t.delivered, ["stock_name", "url"], ["seq"])


_ITEM_KEY = "concat(stock_name, ':', url)"
_HASHES = K.hash_count()
_BITS = f"""spots AS (
    SELECT stock_name, unnest({Q.bit_positions(_ITEM_KEY, K.SKETCH_BITS, _HASHES)}) AS position
    FROM delivered),
bits AS (SELECT DISTINCT stock_name, position FROM spots)"""


def _item_key():
    return F.concat(F.col("stock_name"), F.lit(":"), F.col("url"))


@query("L1 L2 L3", f"WITH {_BITS} SELECT stock_name, position FROM bits")
def sketch_bit_positions(t: Tables):
    return B.bit_positions(t.delivered, "stock_name", _item_key())


@query(
    "L3 L6",
    f"WITH {_BITS} SELECT stock_name, count(*) AS n_bits FROM bits GROUP BY stock_name",
)
def sketch_fill(t: Tables):
    whole = B.build_sketch(t.delivered, "stock_name", _item_key())
    return B.set_bits(B.merge_sketches(whole, whole, "stock_name"), "stock_name")


_PROBED = f"""{_BITS},
urls AS (SELECT seq, keyword AS stock_name, url FROM articles),
probes AS (SELECT seq, stock_name,
                  unnest({Q.bit_positions(_ITEM_KEY, K.SKETCH_BITS, _HASHES)}) AS position
           FROM urls),
probed AS (SELECT p.seq, count(b.position) = count(*) AS seen
           FROM probes p LEFT JOIN bits b
             ON b.stock_name = p.stock_name AND b.position = p.position
           GROUP BY p.seq)"""


@query("L4", f"WITH {_PROBED} SELECT seq, seen FROM probed")
def sketch_membership(t: Tables):
    urls = t.articles.select("seq", F.col("keyword").alias("stock_name"), "url")
    sketch = B.build_sketch(t.delivered, "stock_name", _item_key())
    return B.might_contain(urls, sketch, "stock_name", _item_key()).select("seq", "seen")


@query(
    "L5 L6 D5 F2",
    """SELECT seq, stock_name, url FROM (
         SELECT seq, a.keyword AS stock_name, a.url,
                row_number() OVER (PARTITION BY a.keyword, a.url ORDER BY seq) AS r
         FROM articles a) u
       WHERE r = 1 AND NOT EXISTS (SELECT 1 FROM delivered d
                                   WHERE d.stock_name = u.stock_name AND d.url = u.url)""",
)
def urls_unseen_by_table_and_sketch(t: Tables):
    urls = t.articles.select("seq", F.col("keyword").alias("stock_name"), "url")
    bits = B.sketch_bits(t.delivered)
    sketch = B.build_sketch(t.delivered, "stock_name", _item_key(), bits)
    return B.unseen_urls(urls, t.delivered, sketch, order=["seq"], bits=bits)


# ---- pages -------------------------------------------------------------------------------


@query("J1 A14", f"SELECT page_id, {Q.page_title()} AS title FROM pages")
def page_titles(t: Tables):
    return t.pages.select("page_id", H.page_title(F.col("html")).alias("title"))


@query(
    "J2",
    f"""WITH {Q.READ_PAGES}
        SELECT page_id, md5(content) AS digest, CAST(length(content) AS INT) AS n
        FROM read_pages""",
)
def page_article_digests(t: Tables):
    return P.read_pages(t.pages).select(
        "page_id", F.md5("content").alias("digest"), F.length("content").alias("n")
    )


@query(
    "J1 J2",
    f"""WITH {Q.READ_PAGES}
        SELECT page_id, title, md5(content) AS digest, CAST(length(content) AS INT) AS n
        FROM read_pages""",
)
def parsed_page_digests(t: Tables):
    return P.parse_pages(t.pages).select(
        "page_id", "title", F.md5("content").alias("digest"), F.length("content").alias("n")
    )


_LINKS = f"""{Q.values("marks", "rank, mark", enumerate(LINK_MARKS))},
hrefs AS (SELECT page_id, regexp_extract_all(html, {Q.quoted(H.HREF)}, 1) AS found FROM pages),
links AS (SELECT page_id, {Q.decoded("unnest(found)")} AS link,
                 generate_subscripts(found, 1) AS spot FROM hrefs),
urls AS (SELECT page_id, rank, spot,
                CASE WHEN starts_with(link, '/') THEN concat('{PAGE_BASE}', link)
                     WHEN NOT starts_with(link, 'http') THEN concat('{PAGE_BASE}/', link)
                     ELSE link END AS link
         FROM links JOIN marks ON contains(link, mark)
         WHERE link <> '' AND NOT starts_with(link, '#')),
firsts AS (SELECT page_id, link, rank, spot,
                  row_number() OVER (PARTITION BY page_id, link ORDER BY rank, spot) AS r
           FROM urls
           WHERE EXISTS (SELECT 1 FROM marks WHERE contains(lower(link), mark))),
page_links AS (SELECT page_id, link, CAST(row_number() OVER (PARTITION BY page_id
                                          ORDER BY rank, spot) - 1 AS INT) AS position
               FROM firsts WHERE r = 1)"""


@query("J3 C9 C10 I6 H2", f"WITH {_LINKS} SELECT page_id, position, link FROM page_links")
def page_links(t: Tables):
    return P.extract_links(t.pages, PAGE_BASE, LINK_MARKS).select("page_id", "position", "link")


@query("J3", f"WITH {_LINKS} SELECT page_id, position, link FROM page_links")
def parsed_page_links(t: Tables):
    parsed = P.parse_pages(t.pages, marks=LINK_MARKS)
    return P.extract_links(parsed, PAGE_BASE, LINK_MARKS, links=F.col("links")).select(
        "page_id", "position", "link"
    )


@query(
    "J5",
    f"""WITH {_LINKS}
        SELECT page_id, link, 'links' AS origin FROM page_links
        UNION ALL
        SELECT page_id, url, 'page' FROM pages
        WHERE page_id NOT IN (SELECT page_id FROM page_links)""",
)
def page_links_or_page(t: Tables):
    links = P.extract_links(t.pages, PAGE_BASE, LINK_MARKS).select(
        "page_id", "link", F.lit("links").alias("origin")
    )
    backup = t.pages.select("page_id", F.col("url").alias("link"), F.lit("page").alias("origin"))
    return D.with_fallback(links, backup, ["page_id"])


@query(
    "J4 D10 C5 I3 C14 B4",
    f"""WITH {Q.READ_PAGES}, {Q.KEYWORD_TABLE}
        SELECT 'pages' AS source, keyword, title, url,
               md5(CASE WHEN length(content) > 2000
                        THEN concat(substring(content, 1, 2000), '...') ELSE content END)
               AS content_digest,
               md5(concat(title, content)) AS content_hash,
               concat('article_content/', keyword, '/', md5(concat(title, content)),
                      '_20240201_063000.json') AS s3_raw_content_path,
               '2024-02-01T06:30:00' AS extraction_timestamp
        FROM read_pages JOIN keywords
          ON contains(lower(title), lower(keyword)) OR contains(lower(content), lower(keyword))""",
)
def page_article_records(t: Tables):
    records = P.extract_articles(
        P.read_pages(t.pages), KEYWORDS, F.lit("pages"), _run_time()
    )
    return records.withColumn("content_digest", F.md5("content")).drop("content", "full_content")


# ---- keywords ----------------------------------------------------------------------------


@query(
    "D10 C5",
    f"""WITH {Q.KEYWORD_TABLE}
        SELECT seq, k.keyword AS found FROM articles a JOIN keywords k
          ON contains(lower(a.title), lower(k.keyword))
          OR contains(lower(a.content), lower(k.keyword))""",
)
def article_keyword_matches(t: Tables):
    hits = P.explode_keywords(t.articles, ["title", "content"], KEYWORDS, out="found")
    return hits.select("seq", "found")


@query(
    "A13 C5",
    f"""WITH {Q.KEYWORD_TABLE}
        SELECT conv_id, keyword, concat('https://talk.example/', CAST(conv_id AS STRING), '/',
                                        CAST(turn AS STRING)) AS url
        FROM conversations JOIN keywords
          ON contains(lower(role), lower(keyword)) OR contains(lower(text), lower(keyword))""",
)
def feed_posts_by_keyword(t: Tables):
    # each turn plays a feed document of one post
    post = F.struct(
        F.col("turn"),
        F.col("role").alias("title"),
        F.col("text").alias("excerpt"),
        F.concat(F.lit("https://talk.example/"), "conv_id", F.lit("/"), "turn").alias("url"),
    )
    posts = P.posts_matching(t.conversations.select(F.array(post).alias("posts")), KEYWORDS)
    return posts.select(
        F.split_part("url", F.lit("/"), F.lit(4)).cast("bigint").alias("conv_id"), "keyword", "url"
    )


#: the words of the benchmark texts play a large keyword table
_WORD_TABLE = """words AS (
    SELECT DISTINCT unnest(string_split_regex(text, '[^\\p{L}]+')) AS keyword FROM benchmark),
    held AS (SELECT keyword, lower(keyword) AS needle FROM words WHERE keyword <> '')"""


def _word_table(t: Tables):
    return t.benchmark.select(F.explode(F.split("text", r"[^\p{L}]+")).alias("keyword"))


@query(
    "D10 C5",
    f"""WITH {_WORD_TABLE}
        SELECT page_id, keyword FROM pages JOIN held
          ON contains(lower(url), needle) OR contains(lower(html), needle)""",
)
def keyword_index_matches(t: Tables):
    hits = P.match_keywords(t.pages, ["url", "html"], _word_table(t))
    return hits.select("page_id", "keyword")


@query(
    "D10 J4 A15",
    f"""WITH {Q.READ_PAGES}, {_WORD_TABLE},
        stocks AS (SELECT DISTINCT 'stock ' || substring(needle, 1, 1) AS stock_name, keyword, needle
                   FROM held WHERE length(keyword) > 3)
        SELECT stock_name, keyword, url, title, md5(concat(title, content)) AS content_hash
        FROM read_pages JOIN stocks
          ON contains(lower(title), needle) OR contains(lower(content), needle)""",
)
def page_articles_by_stock(t: Tables):
    letter = F.substring(F.lower("keyword"), 1, 1)
    stocks = (
        _word_table(t)
        .filter(F.length("keyword") > 3)
        .groupBy(F.concat(F.lit("stock "), letter).alias("name"))
        .agg(F.collect_set("keyword").alias("keywords"))
    )
    rows = P.stock_articles(P.read_pages(t.pages), stocks, F.lit("pages"), _run_time())
    return rows.select("stock_name", "keyword", "url", "title", "content_hash")


# ---- sentiment ---------------------------------------------------------------------------


@query(
    "K1 I11",
    f"""WITH {Q.SCORED}
        SELECT seq, CAST(polarity AS DOUBLE) AS polarity,
               CAST(subjectivity AS DOUBLE) AS subjectivity FROM scored""",
)
def article_polarity(t: Tables):
    text = X.scoring_text(F.col("title"), F.col("content"))
    scored = S.lexicon_sentiment(t.articles, "seq", text, t.lexicon())
    return scored.select("seq", "polarity", "subjectivity")


@query(
    "K1 I11",
    f"""WITH {Q.values("lexicon", "word, p, s", LEXICON)}, {Q.values("modifiers", "word, f", MODIFIERS)},
        parts AS (SELECT seq, string_split_regex(lower(concat(title, ' ', content)), '[^\\p{{L}}]+') AS words
                  FROM articles),
        tokens AS (SELECT seq, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM parts),
        hits AS (SELECT seq, pos, p FROM tokens JOIN lexicon USING (word)),
        mods AS (SELECT seq, pos, CAST(f AS DOUBLE) AS f FROM tokens JOIN modifiers USING (word)),
        valued AS (SELECT h.seq, h.pos, any_value(p) * 1000.0 * coalesce(product(f), 1.0) AS v
                   FROM hits h LEFT JOIN mods m
                     ON m.seq = h.seq AND m.pos BETWEEN h.pos - {S.MODIFIER_WINDOW} AND h.pos - 1
                   GROUP BY h.seq, h.pos)
        SELECT seq, CAST(coalesce(sum(v), 0) AS DOUBLE) AS total, count(v) AS hits
        FROM articles LEFT JOIN valued USING (seq) GROUP BY seq""",
)
def contextual_polarity(t: Tables):
    text = X.scoring_text(F.col("title"), F.col("content"))
    lexicon = t.lexicon().select("word", "polarity").join(t.modifiers(), "word", "full")
    return S.contextual_sentiment(t.articles, "seq", text, lexicon).select("seq", "total", "hits")


@query(
    "K2 I8 I9 C11",
    f"""WITH {Q.SCORED}
        SELECT CAST(a.seq AS STRING) AS article_id, a.keyword, a.source, title, url,
               CAST(score / 1000.0 AS DOUBLE) AS mock_sentiment_score,
               CAST(polarity AS DOUBLE) AS polarity,
               CAST(subjectivity AS DOUBLE) AS subjectivity,
               CAST(length(content) AS INT) AS content_length
        FROM scored JOIN articles a USING (seq)""",
)
def article_sentiment_records(t: Tables):
    articles = t.articles.withColumns(
        {"article": F.col("seq").cast("string"), "content_length": F.length("content")}
    )
    records = S.sentiment_records(articles, t.lexicon(), _run_time(), id="article")
    return records.select(
        "article_id", "keyword", "source", "title", "url", "mock_sentiment_score",
        "textblob_sentiment.polarity", "textblob_sentiment.subjectivity", "content_length",
    )


@query(
    "E8",
    f"""WITH {Q.SCORED},
        by_keyword AS (SELECT keyword, CAST(sum(score) AS BIGINT) AS total, count(*) AS n,
                              min(score) AS low, max(score) AS high FROM scored GROUP BY keyword)
        SELECT keyword, CAST({Q.thousandths("total", "n")} / 1000.0 AS DOUBLE) AS average_score,
               CAST(low / 1000.0 AS DOUBLE) AS min_score,
               CAST(high / 1000.0 AS DOUBLE) AS max_score, n AS article_count
        FROM by_keyword""",
)
def sentiment_by_keyword(t: Tables):
    records = _score_records(t)
    return S.sentiment_by_key(records).drop("scores", "last_updated")


@query(
    "E8",
    f"""WITH {Q.SCORED}
        SELECT keyword, CAST(score / 1000.0 AS DOUBLE) AS score, count(*) AS n
        FROM scored GROUP BY 1, 2""",
)
def score_distribution_by_keyword(t: Tables):
    return S.score_distribution(_score_records(t)).withColumn(
        "score", F.col("score").cast("double")
    )


def _score_records(t: Tables):
    return S.sentiment_records(t.articles, t.lexicon(), _run_time(), id="seq")


@query(
    "I8",
    f"""WITH {Q.LEXICON_HITS},
        drawn AS (SELECT seq, CAST(concat('0x', substring(md5(concat(CAST(seq AS STRING), 'r1')),
                                                          1, 8)) AS BIGINT) AS d FROM articles)
        SELECT seq, round(greatest(0, least(1, (CASE WHEN n IS NULL THEN 0 ELSE p / (1000.0 * n) END + 1) / 2
                     + (d / 4294967296.0 * 2 - 1) * 0.1)), 3) AS score
        FROM drawn LEFT JOIN hits USING (seq)""",
)
def noisy_article_scores(t: Tables):
    text = X.scoring_text(F.col("title"), F.col("content"))
    scored = S.lexicon_sentiment(t.articles, "seq", text, t.lexicon())
    noise = C.keyed_noise(F.col("seq").cast("string"), "r1")
    return scored.select("seq", C.scale_score(F.col("mean_polarity"), noise).alias("score"))


@query(
    "K3",
    """SELECT seq, CAST(0 AS DOUBLE) AS sentiment_score, 'neutral' AS sentiment_label,
              CAST(0.5 AS DOUBLE) AS confidence FROM articles""",
)
def placeholder_scores(t: Tables):
    return S.placeholder_sentiment(t.articles).select(
        "seq", "sentiment_score", "sentiment_label", "confidence"
    )


# ---- the whole flow ----------------------------------------------------------------------

_FLOW = f"""unseen AS (
    SELECT a.* FROM articles a
    WHERE NOT EXISTS (SELECT 1 FROM delivered d
                      WHERE d.stock_name = a.keyword AND d.url = a.url)),
{_PREPARED.replace("FROM articles", "FROM unseen").replace("keyword, source", "keyword, source, url")},
fresh AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY seq) AS r
                   FROM prepared) p WHERE r = 1)"""
_FLOW_SCORED = f"{_FLOW}, {Q.SCORED.replace('FROM articles', 'FROM fresh')}"


def _flow(t: Tables) -> J.ArticleTables:
    """A run over all articles, with the labelled ones' URLs already tracked."""
    tables = J.ArticleTables.empty(t.spark)
    tracked = t.delivered.select("stock_name", "url", _run_time().alias("processed_at"))
    raw = t.articles.withColumn("stock_name", F.col("keyword"))
    return J.run_articles(
        raw, tables._replace(tracking=tracked), t.lexicon(), _run_time(), F.to_date(_run_time())
    )


@query(
    "B5 D5 D6 F2 I1 C6",
    f"""WITH {_FLOW}
        SELECT content_hash AS article_hash, keyword, source, url, md5(title) AS title_digest,
               content_length FROM fresh""",
)
def flow_articles(t: Tables):
    return _flow(t).articles.select(
        "article_hash", "keyword", "source", "url", F.md5("title").alias("title_digest"),
        "content_length",
    )


@query(
    "B6 K2 I8",
    f"""WITH {_FLOW_SCORED}
        SELECT content_hash AS article_hash, scored.keyword,
               CAST(score / 1000.0 AS DOUBLE) AS mock_sentiment_score,
               CAST(scored.polarity AS DOUBLE) AS textblob_polarity,
               CAST(scored.subjectivity AS DOUBLE) AS textblob_subjectivity
        FROM scored JOIN fresh USING (seq)""",
)
def flow_scores(t: Tables):
    scores = ("mock_sentiment_score", "textblob_polarity", "textblob_subjectivity")
    return _flow(t).scores.select(
        "article_hash", "keyword", *(F.col(name).cast("double").alias(name) for name in scores)
    )


@query(
    "B7 E8",
    f"""WITH {_FLOW_SCORED},
        by_keyword AS (SELECT keyword, CAST(sum(score) AS BIGINT) AS total, count(*) AS n,
                              min(score) AS low, max(score) AS high FROM scored GROUP BY keyword)
        SELECT keyword, DATE '2024-02-01' AS date,
               CAST({Q.thousandths("total", "n")} / 1000.0 AS DOUBLE) AS average_score,
               CAST(low / 1000.0 AS DOUBLE) AS min_score,
               CAST(high / 1000.0 AS DOUBLE) AS max_score, CAST(n AS INT) AS article_count
        FROM by_keyword""",
)
def flow_aggregates(t: Tables):
    scores = ("average_score", "min_score", "max_score")
    return _flow(t).aggregates.select(
        "keyword", "date", *(F.col(name).cast("double").alias(name) for name in scores),
        "article_count",
    )


@query(
    "B10 D5",
    """SELECT stock_name, url FROM delivered UNION SELECT keyword, url FROM articles""",
)
def flow_tracking(t: Tables):
    return _flow(t).tracking.select("stock_name", "url")
