"""Lexicon sentiment per article, and its aggregates per keyword.

Words are looked up in a lexicon *table* (word, polarity, subjectivity); an article's value is
the mean over its hits. Sums are taken over whole numbers, so means do not depend on the order
in which partial sums meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.functions import scoring as C
from reelpress.functions import text as X

#: lexicon values are summed as whole millionths
_UNIT = 1_000_000
#: tokens after a modifier that it works on
MODIFIER_WINDOW = 3


def score_texts(df: DataFrame, text: str, lexicon: DataFrame) -> DataFrame:
    """``df``, without its column ``text``, with polarity, subjectivity, mean_polarity and hits.

    Rows are scored by themselves: it does not matter whether they have ids or repeat. Give
    the needed columns only, for they go along with the tokens. Tokens are matched and summed
    up where their row was read: with a lexicon that Spark broadcasts one row per row of
    ``df`` is shuffled. With a larger one the tokens are; a frequent word has one row on the
    lexicon's side, so its partition can be split. Rows without a hit get 0.
    """
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}]+")
    known = lexicon.filter(F.col("word") != "").select(
        F.col("word").alias("_word"),
        F.round(F.col("polarity") * _UNIT).cast("bigint").alias("_p"),
        F.round(F.col("subjectivity") * _UNIT).cast("bigint").alias("_s"),
    )
    columns = [F.col(f"`{name}`") for name in df.columns if name != text]
    tokens = df.withColumn("_row", F.monotonically_increasing_id()).select(
        *columns, "_row", F.explode(words).alias("_word")
    )

    def mean(total: str) -> Column:
        exact = F.col(total).cast("decimal(20,0)") / F.col("hits") / F.lit(_UNIT)
        return F.when(F.col("hits") > 0, exact).otherwise(0).cast("decimal(18,12)")

    return (
        tokens.join(known, "_word", "left")
        .groupBy("_row", *columns)
        .agg(F.sum("_p").alias("_p"), F.sum("_s").alias("_s"), F.count("_p").alias("hits"))
        .select(*columns, mean("_p").alias("mean_polarity"), mean("_s").alias("_mean"), "hits")
        .select(
            *columns,
            F.round("mean_polarity", C.DIGITS).cast("double").alias("polarity"),
            F.round("_mean", C.DIGITS).cast("double").alias("subjectivity"),
            "mean_polarity",
            "hits",
        )
    )


def lexicon_sentiment(df: DataFrame, id: str, text: Column, lexicon: DataFrame) -> DataFrame:
    """``(id, polarity, subjectivity, mean_polarity, hits)`` for every row."""
    return score_texts(df.select(F.col(id), text.alias("_text")), "_text", lexicon)


def contextual_sentiment(
    df: DataFrame, id: str, text: Column, lexicon: DataFrame, window: int = MODIFIER_WINDOW
) -> DataFrame:
    """``(id, total, hits, polarity)``: every hit's value times the factors of the modifiers close before it.

    A lexicon row is a value (``polarity``), a modifier (``factor``: below zero for a negation, above one for an
    intensifier), or both. A modifier works on the hits among the ``window`` tokens after it. ``total`` is in
    millionths; ``polarity`` is the mean, cut to -1 and 1, and 0 without a hit.

    Only id, a hash of the text, position and word of a token are shuffled. A row's hits and modifiers are sorted by
    position and folded with the modifiers still in reach as state, so the work is linear in them. Rows
    that share id and text are one row; a null text has no hit; lexicon words are unique.
    """
    said = F.coalesce(text, F.lit(""))
    tokens = df.select(
        F.col(id).alias("id"), F.xxhash64(said).alias("_h"),
        F.posexplode(F.split(F.lower(said), r"[^\p{L}]+")).alias("pos", "_word"),
    )
    known = lexicon.filter(F.col("word") != "").select(
        F.col("word").alias("_word"),
        F.round(F.col("polarity") * _UNIT).cast("double").alias("p"),
        F.col("factor").cast("double").alias("f"),
        F.lit(True).alias("_known"),
    )
    marks = (
        tokens.join(known, "_word", "left")
        .groupBy("id", "_h")
        .agg(F.sort_array(F.collect_set(F.when(F.col("_known"), F.struct("pos", "p", "f")))).alias("marks"))
    )
    start = F.struct(
        F.lit(0.0).alias("total"), F.lit(0).cast("bigint").alias("hits"),
        F.array().cast("array<struct<pos:int,f:double>>").alias("open"),
    )

    def step(state: Column, mark: Column) -> Column:
        reach = F.filter(state["open"], lambda m: m["pos"] >= mark["pos"] - window)
        factor = F.aggregate(reach, F.lit(1.0), lambda product, m: product * m["f"])
        mine = F.array(F.struct(mark["pos"].alias("pos"), mark["f"].alias("f")))
        return F.struct(
            (state["total"] + F.coalesce(mark["p"] * factor, F.lit(0.0))).alias("total"),
            (state["hits"] + mark["p"].isNotNull().cast("bigint")).alias("hits"),
            F.when(mark["f"].isNull(), reach).otherwise(F.concat(reach, mine)).alias("open"),
        )

    mean = F.coalesce(F.try_divide(F.col("r.total"), F.col("r.hits")) / _UNIT, F.lit(0.0))
    return marks.select("id", F.aggregate("marks", start, step).alias("r")).select(
        F.col("id").alias(id), "r.total", "r.hits", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), mean)).alias("polarity")
    )


def sentiment_records(
    articles: DataFrame,
    lexicon: DataFrame,
    run_time: Column,
    id: str = "content_hash",
    noise_seed: str | None = None,
) -> DataFrame:
    """One scored record per article, missing fields replaced by their defaults.

    Every article is scored by its own text, with or without an id; articles without one draw
    the noise of the id ``unknown``, which their record bears.
    """
    noise = C.keyed_noise(F.col("article_id"), noise_seed) if noise_seed else 0.0

    def given(name: str, default=None) -> Column:
        if name not in articles.columns:
            return F.lit(default)
        return F.coalesce(name, F.lit(default)) if default is not None else F.col(name)

    meta = {
        "keyword": given("keyword", "unknown"),
        "source": given("source", "unknown"),
        "title": given("title", ""),
        "url": given("url", ""),
    } | {
        name: given(name).cast("string")
        for name in (
            "s3_raw_content_path",
            "s3_processed_content_path",
            "s3_raw_data_path",
            "s3_processed_data_path",
        )
    }
    named = articles.select(
        F.coalesce(F.col(id).cast("string"), F.lit("unknown")).alias("article_id"),
        *[column.alias(name) for name, column in meta.items()],
        given("content_length", 0).alias("content_length"),
        X.scoring_text(F.col("title"), F.col("content")).alias("_text"),
    )
    return score_texts(named, "_text", lexicon).select(
        "article_id",
        *meta,
        F.coalesce(
            C.scale_score(F.col("mean_polarity"), noise), F.lit(C.NEUTRAL_SCORE)
        ).alias("mock_sentiment_score"),
        F.struct("polarity", "subjectivity").alias("textblob_sentiment"),
        run_time.alias("analysis_timestamp"),
        "content_length",
    )


def placeholder_sentiment(articles: DataFrame) -> DataFrame:
    """Constant neutral scores, for runs without a lexicon."""
    return articles.withColumns(
        {
            "sentiment_score": F.lit(0.0),
            "sentiment_label": C.sentiment_label(F.lit(0.0)),
            "confidence": F.lit(C.NEUTRAL_SCORE),
        }
    )


def score_distribution(
    scores: DataFrame, key: str = "keyword", score: str = "mock_sentiment_score"
) -> DataFrame:
    """``(key, score, n)``: how often each score, to 3 digits, occurs per key."""
    value = F.coalesce(F.col(score), F.lit(C.NEUTRAL_SCORE)).cast("decimal(5,3)")
    name = F.coalesce(F.col(key), F.lit("unknown"))
    return scores.groupBy(name.alias(key), value.alias("score")).agg(
        F.count(F.lit(1)).alias("n")
    )


def sentiment_by_key(
    scores: DataFrame,
    key: str = "keyword",
    score: str = "mock_sentiment_score",
    last_updated: Column | None = None,
) -> DataFrame:
    """Mean, range and count per key, plus all scores as sorted ``(score, n)`` pairs.

    The scores are kept as value and frequency: a key has at most 1001 different scores
    between 0 and 1, however many articles it has.
    """
    pairs = F.sort_array(F.collect_list(F.struct("score", "n")))
    total = F.sum("n")
    return (
        score_distribution(scores, key, score)
        .groupBy(key)
        .agg(
            F.round(F.try_divide(F.sum(F.col("score") * F.col("n")), total), C.DIGITS)
            .cast("double")
            .alias("average_score"),
            F.min("score").cast("double").alias("min_score"),
            F.max("score").cast("double").alias("max_score"),
            total.alias("article_count"),
            pairs.alias("scores"),
        )
        .withColumn("last_updated", last_updated if last_updated is not None else F.lit(None))
    )
