"""Declared schemas of every input and result table, with their keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---- fixed values: genre flags in file order -------------------------------------------
GENRE_FLAGS = [
    "unknown", "action", "adventure", "animation", "children", "comedy", "crime",
    "documentary", "drama", "fantasy", "film_noir", "horror", "musical", "mystery",
    "romance", "sci_fi", "thriller", "war", "western",
]
# ---------------------------------------------------------------------------------------
#: flags that name a genre ("unknown" does not)
GENRES = GENRE_FLAGS[1:]

_TYPES = {
    "INT": T.IntegerType(), "BIGINT": T.LongType(), "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType(),
    "SCORE": T.DecimalType(5, 3), "STRINGS": T.ArrayType(T.StringType()),
}


def columns(text: str) -> T.StructType:
    """Schema from ``"name TYPE, ..."``; works without a running session."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])



USERS = columns(
    "user_id INT, age INT, gender STRING, occupation STRING, zip_code STRING"
)
RATINGS = columns("user_id INT, movie_id INT, rating INT, timestamp BIGINT")
ITEMS_NARROW = columns(
    "movie_id INT, title STRING, release_date STRING, video_release_date STRING, imdb_url STRING"
)
ITEMS = T.StructType(
    ITEMS_NARROW.fields + [T.StructField(name, T.IntegerType()) for name in GENRE_FLAGS]
)
ITEMS_NUMBERED_FLAGS = T.StructType(
    ITEMS_NARROW.fields
    + [T.StructField(f"genre_{i}", T.IntegerType()) for i in range(len(GENRE_FLAGS))]
)

ARTICLE_CONTENT = columns(
    "title STRING, content STRING, url STRING, source STRING, keyword STRING,"
    " extraction_timestamp STRING"
)
RAW_ARTICLE = columns(
    "source STRING, keyword STRING, title STRING, content STRING, url STRING,"
    " content_hash STRING, s3_raw_content_path STRING, extraction_timestamp STRING"
)
RAW_BATCH = T.StructType(
    [
        T.StructField("articles", T.ArrayType(RAW_ARTICLE)),
        T.StructField("s3_content_paths", T.ArrayType(T.StringType())),
        T.StructField("extraction_timestamp", T.StringType()),
    ]
)
POST = columns(
    "id STRING, slug STRING, title STRING, excerpt STRING, url STRING, updated_at STRING,"
    " visibility STRING"
)
POSTS_FEED = T.StructType([T.StructField("posts", T.ArrayType(POST))])
URL_COLLECTION = columns(
    "url STRING, stock_name STRING, keyword STRING, source_name STRING,"
    " collection_timestamp STRING"
)
STOCKS = columns("name STRING, keywords STRINGS, priority STRING")
SOURCES = columns(
    "name STRING, base_url STRING, list_maker_class STRING, enabled BOOLEAN,"
    " rate_limit INT, max_articles_per_stock INT"
)
PAGES = columns("page_id BIGINT, url STRING, html STRING")


@dataclass(frozen=True)
class TableSpec:
    """A result table: its schema, the key that must be unique, and how it is laid out.

    ``partition_by`` takes the place of the lookup indexes a row store would carry: readers
    that filter on those columns touch only the matching directories.
    """

    name: str
    schema: T.StructType
    required: tuple[str, ...]
    unique_key: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()


ARTICLES_TABLE = TableSpec(
    "articles",
    columns(
        "article_hash STRING, keyword STRING, source STRING, title STRING, url STRING,"
        " content_length INT, s3_raw_content_path STRING, s3_processed_content_path STRING,"
        " sample_content STRING, extraction_timestamp TIMESTAMP,"
        " processing_timestamp TIMESTAMP, created_at TIMESTAMP"
    ),
    required=("article_hash", "keyword", "source", "title"),
    unique_key=("article_hash",),
)
SENTIMENT_SCORES_TABLE = TableSpec(
    "sentiment_scores",
    columns(
        "article_hash STRING, keyword STRING, source STRING,"
        " mock_sentiment_score SCORE, textblob_polarity SCORE,"
        " textblob_subjectivity SCORE, analysis_timestamp TIMESTAMP,"
        " created_at TIMESTAMP"
    ),
    required=("article_hash", "keyword", "source", "mock_sentiment_score"),
    references={"article_hash": ("articles", "article_hash")},
)
AGGREGATE_SCORES_TABLE = TableSpec(
    "aggregate_scores",
    columns(
        "keyword STRING, date DATE, average_score SCORE, min_score SCORE,"
        " max_score SCORE, article_count INT, s3_sentiment_data_path STRING,"
        " created_at TIMESTAMP"
    ),
    required=("keyword", "date", "average_score", "min_score", "max_score", "article_count"),
    unique_key=("keyword", "date"),
    partition_by=("date",),
)
PIPELINE_RUNS_TABLE = TableSpec(
    "pipeline_runs",
    columns(
        "run_id STRING, start_time TIMESTAMP, end_time TIMESTAMP, status STRING,"
        " s3_raw_data_path STRING, s3_processed_data_path STRING,"
        " s3_sentiment_data_path STRING, articles_extracted INT, articles_processed INT,"
        " articles_analyzed INT, created_at TIMESTAMP"
    ),
    required=("run_id", "start_time", "status"),
    unique_key=("run_id",),
)
URL_TRACKING_TABLE = TableSpec(
    "url_tracking",
    columns("stock_name STRING, url STRING, processed_at TIMESTAMP"),
    required=("stock_name", "url"),
    unique_key=("stock_name", "url"),
)

RESULT_TABLES = {
    spec.name: spec
    for spec in (
        ARTICLES_TABLE,
        SENTIMENT_SCORES_TABLE,
        AGGREGATE_SCORES_TABLE,
        PIPELINE_RUNS_TABLE,
        URL_TRACKING_TABLE,
    )
}
