"""Queries on sources, result tables, runs, reports, quality checks and increments."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from reelpress import schemas
from reelpress.functions import text as X
from reelpress.operators import dedup as D
from reelpress.operators import factors as ALS
from reelpress.operators import merge as M
from reelpress.operators import quality as Q
from reelpress.operators import reports as R
from reelpress.operators import runs as W
from reelpress.operators import sentiment as S
from reelpress.plans import comparison_sql as SQL
from reelpress.plans.article_queries import _PREPARED
from reelpress.plans.ratings_queries import top_genres_by_segment
from reelpress.plans.registry import CATALOG, query
from reelpress.plans.tables import ROLES, Tables
from reelpress.session import shared_folder
from reelpress.sinks import files as SINKS
from reelpress.sources import delimited as DL
from reelpress.sources import dimensions as DIM
from reelpress.sources import files as FILES
from reelpress.streaming import incremental as INC

RUN_TIME = "2024-01-30 12:00:00"
ORDERS_NOW = "2001-08-01 00:00:00"


def _scratch(t: Tables, purpose: str) -> str:
    """A folder of this call's own, where every executor can read and write."""
    return f"{shared_folder(t.spark)}/{purpose}-{uuid.uuid4().hex}"


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---- sources and sinks -------------------------------------------------------------------


@query("A1 A8 B2", "SELECT CAST(user_id AS INT) AS user_id, age, occupation FROM users")
def users_from_delimited_file(t: Tables):
    path = _scratch(t, "users")
    lines = t.users.select("user_id", "age", F.lit("U"), "occupation", F.lit("00000"))
    lines.write.csv(path, sep=DL.USERS_SEPARATOR)
    return DL.read_users(t.spark, path).select("user_id", "age", "occupation")


@query(
    "A2",
    """SELECT CAST(user_id AS INT) AS user_id, CAST(movie_id AS INT) AS movie_id, rating,
              count(*) AS n FROM ratings GROUP BY ALL""",
)
def ratings_from_delimited_file(t: Tables):
    path = _scratch(t, "ratings")
    t.ratings.withColumn("timestamp", F.lit(0)).write.csv(path, sep=DL.RATINGS_SEPARATOR)
    read = DL.read_ratings(t.spark, path)
    return read.groupBy("user_id", "movie_id", "rating").agg(F.count(F.lit(1)).alias("n"))


@query(
    "A3 A4",
    f"""SELECT CAST(movie_id AS INT) AS movie_id, concat(title, ' Café') AS title,
               {', '.join(schemas.GENRE_FLAGS)} FROM items""",
)
def items_from_latin1_file(t: Tables):
    path = _scratch(t, "items")
    lines = t.items.select(
        "movie_id", F.concat("title", F.lit(" Café")), F.lit("01-Jan-1995"),
        F.lit(None).cast("string"), F.lit("http://example.com/"), *schemas.GENRE_FLAGS,
    )
    lines.write.csv(path, sep=DL.ITEMS_SEPARATOR, encoding=DL.LATIN1)
    read = DL.read_items(t.spark, path)
    return read.select("movie_id", "title", *schemas.GENRE_FLAGS)


@query(
    "A5 A6 B3 I13",
    "SELECT url, source, keyword, md5(concat(title, content)) AS digest FROM articles",
)
def articles_from_json_files(t: Tables):
    path = _scratch(t, "articles")
    SINKS.write_json(
        t.articles.select("title", "content", "url", "source", "keyword"), path
    )
    # a path that does not exist costs none of the others
    paths = [f"{path}/not-there", path]
    read = FILES.read_json(t.spark, paths, schemas.ARTICLE_CONTENT, lines=True)
    return read.filter("_corrupt_record IS NULL").select(
        "url", "source", "keyword", X.content_hash(F.col("title"), F.col("content")).alias("digest")
    )


@query(
    "A7 A16 B1 B4",
    "SELECT seq, url, keyword AS stock_name FROM articles WHERE keyword = 'fr'",
)
def one_stock_of_a_stage(t: Tables):
    root = _scratch(t, "stages")
    urls = t.articles.select("seq", "url", F.col("keyword").alias("stock_name"))
    for run in ("20240201_063000", "20240202_063000"):
        SINKS.write_stage(urls, root, "urls", run, ["stock_name"])
    read = FILES.read_stage(t.spark, root, "urls", "fr", run="20240202_063000")
    return read.select("seq", "url", "stock_name")


@query(
    "A9",
    """SELECT keyword, count(*) AS n FROM articles
       WHERE source = 'src3' OR length(content) > 1000 GROUP BY keyword""",
)
def parameterised_sql(t: Tables):
    return FILES.run_sql(
        t.spark,
        """SELECT keyword, count(*) AS n FROM {articles}
           WHERE source = :source OR length(content) > :least GROUP BY keyword""",
        {"articles": t.articles},
        {"source": "src3", "least": 1000},
    )


@query(
    "A10 A11 D7",
    """SELECT 'documents.parquet' AS key, count(*) AS n FROM documents
       UNION ALL SELECT 'events.parquet', count(*) FROM events
       UNION ALL SELECT 'orders.parquet', count(*) FROM orders""",
)
def rows_per_data_file(t: Tables):
    counted = [
        df.groupBy(FILES.file_key(t.folder).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        for df in (t.documents, t.events, t.orders)
    ]
    # only files that the inventory lists
    listed = FILES.file_inventory(t.spark, t.folder, "*.parquet").select("key")
    rows = counted[0].unionByName(counted[1]).unionByName(counted[2])
    return rows.join(listed, "key", "left_semi")


@query("H4 A12", "SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def documents_without_label(t: Tables):
    return FILES.missing_inputs(t.documents, t.labels, "doc_id")


@query("A15 C17", "SELECT s_name AS name FROM supplier WHERE s_acctbal > 0")
def enabled_sources(t: Tables):
    sources = t.supplier.select(
        F.col("s_name").alias("name"), (F.col("s_acctbal") > 0).alias("enabled")
    )
    return DIM.enabled(sources).select("name")


_SOURCE_NAMES = ["first", "second"]


@query(
    "D8",
    """SELECT c_name AS stock_name, source_name
       FROM customer CROSS JOIN (VALUES ('first'), ('second')) AS s(source_name)""",
)
def stock_source_combinations(t: Tables):
    stocks = t.customer.select(F.col("c_name").alias("name"))
    return DIM.stock_source_combinations(stocks, _SOURCE_NAMES)


@query(
    "D9 H1",
    """SELECT c_name AS stock_name, unnest([c_mktsegment, c_name]) AS keyword, source_name
       FROM customer CROSS JOIN (VALUES ('first'), ('second')) AS s(source_name)""",
)
def keyword_source_combinations(t: Tables):
    stocks = t.customer.select(
        F.col("c_name").alias("name"), F.array("c_mktsegment", "c_name").alias("keywords")
    )
    return DIM.keyword_source_combinations(stocks, _SOURCE_NAMES)


@query(
    "I13 I14",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
              CAST(floor(value) AS BIGINT) AS whole FROM events""",
)
def event_properties(t: Tables):
    return t.events.select(
        "event_id",
        F.from_json("props", "k INT").getField("k").alias("k"),
        F.floor("value").alias("whole"),
    )


# ---- result tables -----------------------------------------------------------------------


@query(
    "B5",
    """SELECT stock_name, url, 'old' AS origin FROM delivered
       UNION ALL
       SELECT keyword, url, 'new' FROM articles a
       WHERE NOT EXISTS (SELECT 1 FROM delivered d
                         WHERE d.stock_name = a.keyword AND d.url = a.url)""",
)
def url_tracking_after_insert(t: Tables):
    existing = t.delivered.select("stock_name", "url", F.lit("old").alias("origin"))
    new = t.articles.select(
        "seq", F.col("keyword").alias("stock_name"), "url", F.lit("new").alias("origin")
    )
    return M.insert_ignore(existing, new, ["stock_name", "url"], ["seq"])


@query(
    "B10",
    """SELECT DISTINCT stock_name, url FROM (
         SELECT stock_name, url FROM delivered UNION ALL
         SELECT keyword, url FROM articles WHERE length(content) >= 50) u""",
)
def url_tracking_after_run(t: Tables):
    tracked = t.delivered.select("stock_name", "url", _ntz(RUN_TIME).alias("processed_at"))
    extracted = t.articles.filter(F.length("content") >= 50).select(
        F.col("keyword").alias("stock_name"), "url"
    )
    return M.mark_processed(tracked, extracted, _ntz(RUN_TIME)).select("stock_name", "url")


@query(
    "B6 H1",
    """SELECT status, count(*) AS n FROM (
         SELECT status FROM aggregates WHERE status = 'F'
         UNION ALL SELECT status FROM aggregates) u GROUP BY status""",
)
def scores_after_append(t: Tables):
    rows = t.aggregates.select("seq", "status")
    appended = M.append(rows.filter("status = 'F'"), rows)
    return appended.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# final orders are the table so far; all others arrive, repeats per key included
_EXISTING = """existing AS (
    SELECT keyword, date, average_score, article_count, seq AS created FROM (
        SELECT *, row_number() OVER (PARTITION BY keyword, date ORDER BY seq) AS r
        FROM aggregates WHERE status = 'F') e WHERE r = 1),
fresh AS (
    SELECT keyword, date, average_score, article_count, seq AS created FROM (
        SELECT *, row_number() OVER (PARTITION BY keyword, date ORDER BY seq DESC) AS r
        FROM aggregates WHERE status <> 'F') n WHERE r = 1)"""


@query(
    "B7",
    f"""WITH {_EXISTING}
        SELECT coalesce(f.keyword, e.keyword) AS keyword,
               CAST(coalesce(f.date, e.date) AS VARCHAR) AS date,
               CAST(coalesce(f.average_score, e.average_score) AS DOUBLE) AS average_score,
               coalesce(f.article_count, e.article_count) AS article_count,
               coalesce(e.created, f.created) AS created
        FROM existing e FULL JOIN fresh f ON e.keyword = f.keyword AND e.date = f.date""",
)
def aggregates_after_upsert(t: Tables):
    rows = t.aggregates.withColumn("created", F.col("seq"))
    key = ["keyword", "date"]
    existing = D.first_per_key(rows.filter("status = 'F'"), key, ["seq"])
    merged = M.upsert(existing, rows.filter("status <> 'F'"), key, ["seq"], keep=["created"])
    return merged.select(
        "keyword",
        F.col("date").cast("string").alias("date"),
        F.col("average_score").cast("double").alias("average_score"),
        "article_count",
        "created",
    )


@query(
    "B8",
    """SELECT run_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_time,
              strftime(max(CASE WHEN state <> 'RUNNING' THEN ts END), '%Y-%m-%d %H:%M:%S')
              AS end_time,
              arg_max(state, ts) AS status,
              arg_max(task_id, ts) FILTER (WHERE state = 'failed') AS last_failure
       FROM tasks GROUP BY run_id""",
)
def run_log(t: Tables):
    events = t.tasks.select(
        "run_id",
        F.col("ts").alias("event_time"),
        F.col("state").alias("status"),
        F.when(F.col("state") == "failed", F.col("task_id")).alias("last_failure"),
    )
    log = M.run_log(events)
    return log.withColumns(
        {
            name: F.date_format(name, "yyyy-MM-dd HH:mm:ss")
            for name in ("start_time", "end_time")
        }
    )


@query(
    "B9 C19",
    f"""SELECT seq, keyword FROM aggregates
        WHERE NOT (keyword IN ('1-URGENT', '5-LOW')
                   AND date >= TIMESTAMP '{ORDERS_NOW}' - INTERVAL 7 DAYS)""",
)
def rows_after_cleanup(t: Tables):
    doomed = M.recent_with_keyword(["1-URGENT", "5-LOW"], _ntz(ORDERS_NOW), created="created_at")
    rows = t.aggregates.withColumn("created_at", F.col("date").cast("timestamp_ntz"))
    return M.retain(rows, doomed).select("seq", "keyword")


# ---- runs --------------------------------------------------------------------------------


@query(
    "E13 I15",
    """SELECT run_id, successful_tasks, failed_tasks, total_tasks,
              round(100.0 * successful_tasks / total_tasks, 6) AS success_rate,
              CASE WHEN failed_tasks = 0 THEN 'success'
                   WHEN successful_tasks > 0 THEN 'partial_success' ELSE 'failed' END AS status
       FROM (SELECT run_id, count(*) FILTER (WHERE state = 'success') AS successful_tasks,
                    count(*) FILTER (WHERE state <> 'success') AS failed_tasks,
                    count(*) AS total_tasks FROM tasks GROUP BY run_id) c""",
)
def run_outcomes(t: Tables):
    outcomes = W.run_outcomes(t.tasks)
    return outcomes.withColumn("success_rate", F.round("success_rate", 6))


@query("E13", "SELECT run_id, task_id FROM tasks WHERE state = 'failed'")
def failed_tasks(t: Tables):
    return W.failed_tasks(t.tasks)


@query(
    "D15 I16",
    f"""SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_success,
               TIMESTAMP '{RUN_TIME}' - max(ts) <= INTERVAL 1 HOUR AS is_fresh
        FROM tasks WHERE state = 'success' GROUP BY user_id""",
)
def latest_success(t: Tables):
    latest = W.latest_success(t.tasks, _ntz(RUN_TIME), key="user_id")
    return latest.withColumn(
        "last_success", F.date_format("last_success", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "D15",
    """SELECT p.event_id, strftime(max(s.ts), '%Y-%m-%d %H:%M:%S') AS upstream
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') s
         ON s.user_id = p.user_id AND s.ts <= p.ts AND p.ts - s.ts <= INTERVAL 12 HOURS
       GROUP BY p.event_id""",
)
def nearest_upstream_success(t: Tables):
    runs = t.events.filter("event_type = 'purchase'")
    upstream = t.events.filter("event_type = 'view'")
    found = W.nearest_success(runs, upstream, "user_id", "event_id", max_age_hours=12)
    return found.select(
        "event_id", F.date_format("upstream_ts", "yyyy-MM-dd HH:mm:ss").alias("upstream")
    )


@query(
    "E14",
    """SELECT count(*) AS original, count(*) FILTER (WHERE length(content) >= 50) AS long_enough,
              count(*) FILTER (WHERE length(content) > 2000) AS previewed,
              count(*) FILTER (WHERE seq IN (SELECT doc_id FROM labels)) AS delivered_before
       FROM articles""",
)
def stage_counters(t: Tables):
    known = t.labels.select(F.col("doc_id").alias("seq"), F.lit(True).alias("known"))
    articles = t.articles.join(known, "seq", "left")
    return W.stage_counters(
        articles,
        {
            "original": F.lit(True),
            "long_enough": F.length("content") >= 50,
            "previewed": F.length("content") > 2000,
            "delivered_before": F.col("known"),
        },
    )


@query(
    "E14",
    """SELECT run_id, count(*) AS total, count(*) FILTER (WHERE state = 'success') AS extracted,
              count(*) FILTER (WHERE state = 'failed') AS failed FROM tasks GROUP BY run_id""",
)
def stage_counters_by_run(t: Tables):
    state = F.col("state")
    return W.stage_counters_by(
        t.tasks,
        ["run_id"],
        {"total": F.lit(True), "extracted": state == "success", "failed": state == "failed"},
    )


@query(
    "E12 D13",
    """SELECT count(*) AS total_entities, count(r.o_custkey) AS processed_entities,
              CAST(coalesce(sum(total_articles), 0) AS BIGINT) AS total_articles,
              CAST(coalesce(sum(persisted), 0) AS BIGINT) AS persisted
       FROM customer LEFT JOIN (
         SELECT o_custkey, count(*) AS total_articles,
                count(*) FILTER (WHERE o_orderstatus = 'F') AS persisted
         FROM orders GROUP BY o_custkey) r ON c_custkey = o_custkey""",
)
def rollup_over_entities(t: Tables):
    entities, results = _entities_and_results(t)
    return W.rollup_entities(entities, results, "stock", ["total_articles", "persisted"])


@query(
    "D13",
    """SELECT c_custkey AS stock, coalesce(total_articles, 0) AS total_articles,
              coalesce(persisted, 0) AS persisted, o_custkey IS NOT NULL AS has_result
       FROM customer LEFT JOIN (
         SELECT o_custkey, count(*) AS total_articles,
                count(*) FILTER (WHERE o_orderstatus = 'F') AS persisted
         FROM orders GROUP BY o_custkey) r ON c_custkey = o_custkey""",
)
def entities_with_results(t: Tables):
    entities, results = _entities_and_results(t)
    return W.entities_with_results(entities, results, "stock", ["total_articles", "persisted"])


def _entities_and_results(t: Tables):
    entities = t.customer.select(F.col("c_custkey").alias("stock"))
    results = t.orders.select(
        F.col("o_custkey").alias("stock"),
        F.lit(1).alias("total_articles"),
        (F.col("o_orderstatus") == "F").cast("int").alias("persisted"),
    )
    return entities, results


@query(
    "E18 Q4",
    """SELECT source, count(*) AS processed_count,
              count(*) FILTER (WHERE known) AS path_count,
              count(*) FILTER (WHERE NOT known) AS missing_path_count,
              arg_min(url, seq) FILTER (WHERE known) AS first_path
       FROM (SELECT *, seq IN (SELECT doc_id FROM labels) AS known FROM articles) a
       GROUP BY source""",
)
def batch_manifests(t: Tables):
    return W.batch_manifest(_articles_with_path(t), "source", "path", "seq")


@query(
    "E18",
    "SELECT source, url AS path FROM articles WHERE seq IN (SELECT doc_id FROM labels)",
)
def batch_content_paths(t: Tables):
    return W.batch_paths(_articles_with_path(t), "source", "path")


def _articles_with_path(t: Tables):
    known = t.labels.select(F.col("doc_id").alias("seq"), F.lit(True).alias("known"))
    joined = t.articles.join(known, "seq", "left")
    return joined.withColumn("path", F.when(F.col("known"), F.col("url")))


# ---- reports -----------------------------------------------------------------------------


@query(
    "E9",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}"
        for name in ("documents", "pages", "events", "orders")
    ),
)
def table_counts(t: Tables):
    names = ("documents", "pages", "events", "orders")
    return R.table_counts({name: getattr(t, name) for name in names})


@query("E10", "SELECT keyword, count(*) AS n FROM articles GROUP BY keyword")
def articles_per_keyword(t: Tables):
    return R.count_by(t.articles, "keyword")


@query("E10", "SELECT source, count(*) AS n FROM articles GROUP BY source")
def articles_per_source(t: Tables):
    return R.count_by(t.articles, "source")


@query("E11", "SELECT stock_name, count(*) AS n FROM delivered GROUP BY stock_name")
def tracked_urls_per_stock(t: Tables):
    return R.count_by(t.delivered, "stock_name")


@query(
    "E15",
    """SELECT count(*) FILTER (WHERE movie_id IN (SELECT movie_id FROM ratings)) AS present,
              count(*) AS required FROM items""",
)
def presence_totals(t: Tables):
    required = t.items.select("movie_id")
    return R.presence_totals(R.presence_summary(required, t.ratings, "movie_id"))


@query(
    "G4",
    """SELECT seq, keyword, CAST(date AS VARCHAR) AS date FROM aggregates
       ORDER BY aggregates.date DESC, seq LIMIT 3""",
)
def latest_rows(t: Tables):
    latest = R.latest_rows(t.aggregates, "date", "seq")
    return latest.select("seq", "keyword", F.col("date").cast("string").alias("date"))


@query(
    "D14",
    """SELECT seq, keyword, CAST(average_score AS DOUBLE) AS average_score FROM aggregates
       WHERE date = (SELECT max(date) FROM aggregates)""",
)
def latest_aggregates(t: Tables):
    latest = R.latest_by_max(t.aggregates, "date")
    return latest.select("seq", "keyword", F.col("average_score").cast("double").alias("average_score"))


@query("G6", "SELECT seq, url FROM articles ORDER BY seq LIMIT 15")
def head_of_articles(t: Tables):
    return R.head(t.articles.select("seq", "url"), ["seq"], 15)


@query(
    "F4",
    f"""WITH ranked AS ({CATALOG["top_genres_by_segment"].sql}),
        numbered AS (SELECT *, dense_rank() OVER (ORDER BY age_group, occupation) AS g,
                            row_number() OVER (PARTITION BY age_group, occupation
                                               ORDER BY rank, genre) AS r FROM ranked)
        SELECT age_group, occupation, genre, rank FROM numbered WHERE g <= 3 AND r <= 3""",
)
def preview_of_top_genres(t: Tables):
    heads = R.head_per_group(
        top_genres_by_segment(t), ["age_group", "occupation"], ["rank", "genre"]
    )
    return heads.select("age_group", "occupation", "genre", "rank")


@query(
    "C18 G5",
    """SELECT source AS stage, count(*) AS n,
              max(concat(source, '/', keyword, '/', CAST(seq AS STRING))) AS latest_key
       FROM articles GROUP BY source""",
)
def objects_by_stage(t: Tables):
    key = F.concat("source", F.lit("/"), "keyword", F.lit("/"), F.col("seq").cast("string"))
    return R.objects_by_stage(t.articles.select(key.alias("key")))


@query(
    "E17 E9 E10 D14",
    """SELECT 'total' AS section, 'articles' AS key, CAST(count(*) AS VARCHAR) AS value
       FROM articles
       UNION ALL SELECT 'total', 'sentiment_scores', CAST(count(*) AS VARCHAR) FROM articles
       UNION ALL SELECT 'total', 'aggregate_scores', CAST(count(*) AS VARCHAR) FROM aggregates
       UNION ALL SELECT 'keyword_distribution', keyword, CAST(count(*) AS VARCHAR)
                 FROM articles GROUP BY keyword
       UNION ALL SELECT 'source_distribution', source, CAST(count(*) AS VARCHAR)
                 FROM articles GROUP BY source
       UNION ALL SELECT 'latest_score', keyword, CAST(average_score AS VARCHAR)
                 FROM aggregates WHERE date = (SELECT max(date) FROM aggregates)
       UNION ALL SELECT 'latest_article_count', keyword, CAST(article_count AS VARCHAR)
                 FROM aggregates WHERE date = (SELECT max(date) FROM aggregates)""",
)
def corpus_report(t: Tables):
    return R.corpus_report(t.articles, t.articles, t.aggregates)


# ---- quality checks ----------------------------------------------------------------------


@query(
    "Q1",
    """SELECT 'toxic' AS column_name, count(*) FILTER (WHERE toxic IS NULL) AS violations
       FROM documents LEFT JOIN labels USING (doc_id)
       UNION ALL
       SELECT 'text', count(*) FILTER (WHERE text IS NULL) FROM documents""",
)
def required_values(t: Tables):
    return Q.check_not_null(t.documents.join(t.labels, "doc_id", "left"), ["toxic", "text"])


@query(
    "Q2",
    """SELECT keyword, CAST(date AS VARCHAR) AS date, count(*) AS n FROM aggregates
       GROUP BY keyword, aggregates.date HAVING count(*) > 1""",
)
def repeated_keys(t: Tables):
    repeats = Q.check_unique(t.aggregates, ["keyword", "date"])
    return repeats.withColumn("date", F.col("date").cast("string"))


@query(
    "Q3 D16",
    """SELECT doc_id, count(*) AS n FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
)
def references_without_target(t: Tables):
    return Q.check_foreign_key(t.documents, "doc_id", t.labels, "doc_id")


@query(
    "Q4",
    """SELECT 'path' AS column_name, count(*) AS violations FROM articles
       WHERE seq NOT IN (SELECT doc_id FROM labels)""",
)
def missing_paths(t: Tables):
    return Q.check_not_blank(_articles_with_path(t), ["path"])


@query(
    "B12 Q1 Q2 Q3",
    """SELECT 'not_null article_hash' AS check_name, 0 AS violations
       UNION ALL SELECT 'not_null keyword', 0
       UNION ALL SELECT 'not_null source', 0
       UNION ALL SELECT 'not_null mock_sentiment_score', 0
       UNION ALL SELECT 'references articles', count(DISTINCT seq) FROM articles
                 WHERE seq NOT IN (SELECT doc_id FROM labels)""",
)
def declared_checks_of_scores(t: Tables):
    articles = t.labels.select(F.col("doc_id").cast("string").alias("article_hash"))
    scores = t.articles.select(
        F.col("seq").cast("string").alias("article_hash"), "keyword", "source",
        F.lit(0.5).alias("mock_sentiment_score"),
    )
    return Q.check_table(scores, schemas.SENTIMENT_SCORES_TABLE, {"articles": articles})


# ---- increments and factor model ---------------------------------------------------------


def _article_stream(t: Tables):
    # a glob, because a streamed path may not be a single file
    stream = INC.read_new_files(t.spark, f"{t.folder}/documents*.parquet", t.documents.schema)
    return stream.selectExpr(*ROLES["articles"][2])


@query(
    "S1 D6 F2 I1",
    f"""WITH {_PREPARED}
        SELECT seq, content_hash FROM (
            SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY seq) AS r
            FROM prepared) p WHERE r = 1""",
)
def incremental_articles(t: Tables):
    folder = _scratch(t, "incremental")
    INC.run_incremental(_article_stream(t), f"{folder}/out", f"{folder}/checkpoint")
    return t.spark.read.parquet(f"{folder}/out/articles").select("seq", "content_hash")


@query("S2", "SELECT DISTINCT user_id, event_type FROM events")
def deduplicated_event_stream(t: Tables):
    folder = _scratch(t, "stream")
    stream = INC.read_new_files(t.spark, f"{t.folder}/events*.parquet", t.events.schema)
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    unique = INC.dedup_stream(stream, ["user_id", "event_type"], "ts", "40 days")
    (
        unique.select("user_id", "event_type")
        .writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return t.spark.read.schema("user_id BIGINT, event_type STRING").parquet(f"{folder}/out")


@query(
    "M3",
    """WITH cells AS (SELECT DISTINCT user_id AS u, movie_id AS i FROM ratings),
       pairs AS (SELECT a.i, b.i AS j, count(*) AS k FROM cells a JOIN cells b ON a.u = b.u
                 WHERE a.i <> b.i GROUP BY a.i, b.i HAVING count(*) >= 3)
       SELECT i AS movie_id, j AS similar_movie_id, k AS cooccurrence_count FROM pairs""",
)
def factor_co_rated_items(t: Tables):
    # every cosine passes a bound below -1: what is left is which pairs are compared at all
    factors = ALS.item_factors(t.ratings, rank=8, iterations=5)
    return ALS.factor_similarity(t.ratings, factors, -1.1, 3).drop("similarity_score")


@query("M3")
def factor_similar_items(t: Tables):
    factors = ALS.item_factors(t.ratings, rank=8, iterations=5)
    return ALS.factor_similarity(t.ratings, factors, 0.9, 3)


@query(
    "C11 E8",
    f"""WITH {SQL.SCORED},
        by_source AS (SELECT source AS keyword, CAST(sum(score) AS BIGINT) AS total,
                             count(*) AS n FROM scored GROUP BY source)
        SELECT keyword, CAST({SQL.thousandths("total", "n")} / 1000.0 AS DOUBLE)
               AS average_score, n AS article_count FROM by_source""",
)
def sentiment_by_source(t: Tables):
    records = S.sentiment_records(t.articles, t.lexicon(), F.lit(None).cast("timestamp"), id="seq")
    by_source = S.sentiment_by_key(records, key="source")
    return by_source.select(F.col("source").alias("keyword"), "average_score", "article_count")
