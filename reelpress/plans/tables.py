"""The driver's generic tables in the roles this library works on.

``Tables(spark, folder)`` gives each role as a DataFrame; ``role_sql`` states the same roles as
SQL, for the comparison queries.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpress.schemas import GENRE_FLAGS

# ---- fixed values: which column value sets which flag on the stand-in items --------------
FLAG_RULES = {
    "unknown": "p_type = 'SMALL'",
    "action": "p_type = 'PROMO'",
    "adventure": "p_name LIKE '%gear'",
    "animation": "p_name LIKE '%ring'",
    "children": "p_name LIKE '%widget'",
    "comedy": "p_type = 'ECONOMY'",
    "crime": "p_name LIKE '%bolt'",
    "documentary": "p_name LIKE '%gizmo'",
    "drama": "p_type = 'STANDARD'",
    "fantasy": "p_name LIKE '%plate'",
    "film_noir": "p_size = 13",
    "horror": "p_size = 49",
    "romance": "p_type = 'MEDIUM'",
    "sci_fi": "p_size = 42",
    "thriller": "p_type = 'LARGE'",
    "war": "p_size = 7",
}
#: a small lexicon of frequent words: (word, polarity, subjectivity) in thousandths
LEXICON = [
    ("and", 100, 150), ("avec", 250, 300), ("de", -50, 120), ("der", 75, 250),
    ("el", 325, 500), ("en", -175, 225), ("for", 450, 600), ("ist", 600, 700),
    ("la", 125, 400), ("les", -300, 350), ("nicht", -800, 900), ("of", -25, 100),
    ("on", 50, 75), ("pas", -650, 800), ("por", 200, 450), ("que", -100, 325),
    ("re", -400, 550), ("the", 35, 50), ("to", 15, 25), ("und", 225, 275),
    ("was", -225, 175), ("with", 525, 650),
]
#: words that stand for negations and intensifiers: (word, factor)
MODIFIERS = [("nicht", -0.5), ("pas", -0.5), ("no", -0.5), ("le", 1.5), ("in", 1.5), ("los", 1.5)]
#: words that stand for the keywords of the entities being followed
KEYWORDS = ["nicht", "que la", "The", "elle", "erblest"]
#: parts of a link that mark an article on the stand-in pages
LINK_MARKS = ["/the", "/de", "/und", "/la"]
PAGE_BASE = "https://pages.example"
# ------------------------------------------------------------------------------------------


_FLAG_COLUMNS = [
    f"CAST(CASE WHEN {FLAG_RULES.get(flag, '1 = 0')} THEN 1 ELSE 0 END AS INT) AS {flag}"
    for flag in GENRE_FLAGS
]

#: role -> (source tables, join condition, columns); the expressions mean the same in Spark
#: and in the comparison engine
ROLES: dict[str, tuple[list[str], str | None, list[str]]] = {
    "users": (
        ["customer"],
        None,
        [
            "c_custkey AS user_id",
            "CAST(c_custkey % 60 AS INT) + 10 AS age",
            "c_mktsegment AS occupation",
        ],
    ),
    "ratings": (
        ["lineitem", "orders"],
        "l_orderkey = o_orderkey",
        [
            "o_custkey AS user_id",
            "l_partkey AS movie_id",
            "CAST(l_quantity AS INT) % 5 + 1 AS rating",
        ],
    ),
    "items": (["part"], None, ["p_partkey AS movie_id", "p_name AS title", *_FLAG_COLUMNS]),
    # the first 80 characters serve as title, the language as keyword
    "articles": (
        ["documents"],
        None,
        [
            "doc_id AS seq",
            "substring(text, 1, 80) AS title",
            "text AS content",
            "concat('https://', source, '.example/', lang, '/', CAST(doc_id AS STRING)) AS url",
            "source",
            "lang AS keyword",
        ],
    ),
    # labelled documents stand for what earlier runs have delivered
    "delivered": (
        ["documents", "labels"],
        "documents.doc_id = labels.doc_id",
        [
            "documents.doc_id AS seq",
            "lang AS stock_name",
            "concat('https://', source, '.example/', lang, '/',"
            " CAST(documents.doc_id AS STRING)) AS url",
            "md5(concat(substring(text, 1, 80), text)) AS content_hash",
        ],
    ),
    "aggregates": (
        ["orders"],
        None,
        [
            "o_orderkey AS seq",
            "o_orderpriority AS keyword",
            "CAST(o_orderdate AS DATE) AS date",
            "CAST((o_orderkey % 1000) / 1000.0 AS DECIMAL(5,3)) AS average_score",
            "CAST(o_custkey AS INT) AS article_count",
            "o_orderstatus AS status",
        ],
    ),
    # one run per user and day, one task per event
    "tasks": (
        ["events"],
        None,
        [
            "concat('run_', CAST(user_id AS STRING), '_', CAST(CAST(ts AS DATE) AS STRING))"
            " AS run_id",
            "user_id",
            "event_id AS task_id",
            "ts",
            "CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS state",
        ],
    ),
}

SOURCE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def role_sql(name: str) -> str:
    tables, condition, columns = ROLES[name]
    source = tables[0] if condition is None else f"{tables[0]} JOIN {tables[1]} ON {condition}"
    return f"SELECT {', '.join(columns)} FROM {source}"


class Tables:
    """Tables of one data folder, read lazily; attribute access gives a raw table or a role."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def lexicon(self) -> DataFrame:
        words, polarity, subjectivity = zip(*LEXICON)
        # an Arrow table becomes a local relation of known size, which Spark may broadcast
        return self.spark.createDataFrame(
            pa.table(
                {
                    "word": pa.array(words),
                    "polarity": pa.array([p / 1000 for p in polarity]),
                    "subjectivity": pa.array([s / 1000 for s in subjectivity]),
                }
            )
        )

    def modifiers(self) -> DataFrame:
        words, factors = zip(*MODIFIERS)
        return self.spark.createDataFrame(pa.table({"word": pa.array(words), "factor": pa.array(factors)}))

    def __getattr__(self, name: str) -> DataFrame:
        if name in ROLES:
            tables, condition, columns = ROLES[name]
            df = getattr(self, tables[0])
            if condition is not None:
                right = getattr(self, tables[1]).alias(tables[1])
                df = df.alias(tables[0]).join(right, F.expr(condition))
            return df.selectExpr(*columns)
        if name in SOURCE_TABLES:
            return self.spark.read.parquet(self.path(name))
        raise AttributeError(name)
