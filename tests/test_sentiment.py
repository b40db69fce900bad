import pytest
from pyspark.sql import functions as F

from reelpress.functions import scoring as C
from reelpress.operators import sentiment as S
from reelpress.plans import article_flow as A
from reelpress.operators import quality as Q
from reelpress import schemas


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame(
        [("good", 0.7, 0.6), ("bad", -0.7, 0.667), ("très", 1.0, 1.0), ("meh", 0.0005, 0.5)],
        "word string, polarity double, subjectivity double",
    )


def test_lexicon(spark, lexicon):
    df = spark.createDataFrame(
        [(1, "Good, good; BAD!"), (2, "nothing here"), (3, None), (4, "très"), (5, "meh"), (6, "")],
        "id int, t string",
    )
    got = {
        r.id: (r.polarity, r.subjectivity, r.hits)
        for r in S.lexicon_sentiment(df, "id", F.col("t"), lexicon).collect()
    }
    assert got == {
        1: (0.233, 0.622, 3), 2: (0.0, 0.0, 0), 3: (0.0, 0.0, 0), 4: (1.0, 1.0, 1),
        5: (0.001, 0.5, 1), 6: (0.0, 0.0, 0),
    }


@pytest.mark.parametrize(
    "polarity, noise, score", [(-1, 0, 0.0), (0, 0, 0.5), (1, 0, 1.0), (1, 0.1, 1.0), (-1, -0.1, 0.0), (0.001, 0, 0.501)]
)
def test_scale(spark, polarity, noise, score):
    assert spark.range(1).select(C.scale_score(F.lit(polarity), noise)).first()[0] == score


def test_keyed_noise_is_repeatable_and_bounded(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    draw = [r[0] for r in df.select(C.keyed_noise(F.col("k"), "s")).collect()]
    assert draw == [r[0] for r in df.select(C.keyed_noise(F.col("k"), "s")).collect()]
    assert all(-0.1 <= float(x) < 0.1 for x in draw) and len(set(draw)) > 490


def test_scores_need_no_id(spark, lexicon):
    rows = [("h", "good good"), (None, "good good"), (None, "bad"), ("h", "bad"), ("h", "good good"), ("e", None)]
    df = spark.createDataFrame(rows, "content_hash string, content string").withColumn("title", F.lit(""))
    for threshold in ("10m", "-1"):  # the lexicon broadcast, and as if it were too large for that
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = S.sentiment_records(df, lexicon, F.lit(None).cast("timestamp")).collect()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert sorted((r.article_id, r.mock_sentiment_score) for r in got) == [
            ("e", 0.5), ("h", 0.15), ("h", 0.85), ("h", 0.85), ("unknown", 0.15), ("unknown", 0.85),
        ]
    noisy = S.sentiment_records(df, lexicon, F.lit(None).cast("timestamp"), noise_seed="s").collect()
    assert all(abs(r.mock_sentiment_score - (r.textblob_sentiment.polarity + 1) / 2) < 0.101 for r in noisy)


def test_no_score_from_nothing(spark):
    row = spark.range(1).select(
        C.scale_score(F.lit(None).cast("double")), C.scale_score(F.lit(0.5), F.lit(None).cast("decimal(18,12)"))
    ).first()
    assert tuple(row) == (None, None)


def test_by_key(spark):
    scores = spark.createDataFrame(
        [("k", 0.1), ("k", 0.2), ("k", 0.2), ("k", None), (None, 0.9)],
        "keyword string, mock_sentiment_score double",
    )
    got = {r.keyword: r for r in S.sentiment_by_key(scores).collect()}
    k = got["k"]
    assert (k.average_score, k.min_score, k.max_score, k.article_count) == (0.25, 0.1, 0.5, 4)
    assert [(float(s), n) for s, n in k.scores] == [(0.1, 1), (0.2, 2), (0.5, 1)]
    assert got["unknown"].average_score == 0.9


def test_labels(spark):
    df = spark.createDataFrame([(0.2,), (-0.1,), (0.0,)], "s double")
    assert [r[0] for r in df.select(C.sentiment_label(F.col("s"))).collect()] == [
        "positive", "negative", "neutral",
    ]


def test_records_to_result_tables(spark, lexicon):
    articles = spark.createDataFrame(
        [("h1", "k", "s", "good", "text", "u", 4), ("h2", None, None, None, "bad", None, None)],
        "content_hash string, keyword string, source string, title string, content string,"
        " url string, content_length int",
    )
    now = F.lit("2024-02-01 06:30:00").cast("timestamp")
    records = S.sentiment_records(articles, lexicon, now)
    got = {r.article_id: r for r in records.collect()}
    assert got["h1"].mock_sentiment_score == 0.85 and got["h2"].mock_sentiment_score == 0.15
    assert (got["h2"].keyword, got["h2"].title, got["h2"].content_length) == ("unknown", "", 0)
    rows, scores = A.article_rows(records, now), A.score_rows(records, now)
    assert rows.columns == schemas.ARTICLES_TABLE.schema.fieldNames()
    assert scores.dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.SENTIMENT_SCORES_TABLE.schema
    ]
    aggregated = A.aggregate_rows(
        S.sentiment_by_key(records), F.to_date(now), F.lit("path"), now
    )
    assert [(n, t) for n, t in aggregated.dtypes] == [
        (f.name, f.dataType.simpleString()) for f in schemas.AGGREGATE_SCORES_TABLE.schema
    ]
    checks = Q.check_table(scores, schemas.SENTIMENT_SCORES_TABLE, {"articles": rows})
    assert all(r.violations == 0 for r in checks.collect())


def test_context_of_hits(spark):
    lexicon = spark.createDataFrame(
        [("good", 0.5, None), ("bad", -0.5, None), ("not", None, -0.5), ("very", None, 1.5), ("hardly", -0.25, -0.5)],
        "word string, polarity double, factor double",
    )
    texts = {
        1: "good", 2: "not good", 3: "not very good", 4: "Not a b c good", 5: "not a b good bad", 6: "hardly bad",
        7: None, 8: "", 9: "very very very good", 10: "good, not", 11: "x " * 50_000 + "not good",
    }
    df = spark.createDataFrame([*texts.items(), (1, "good"), (1, "bad")], "id long, text string")
    got = sorted((r.id, r.total / 1e6, r.hits, r.polarity) for r in S.contextual_sentiment(df, "id", F.col("text"), lexicon).collect())
    assert [g[:3] for g in got] == [
        (1, -0.5, 1), (1, 0.5, 1), (2, -0.25, 1), (3, -0.375, 1), (4, 0.5, 1), (5, -0.75, 2), (6, 0.0, 2), (7, 0.0, 0),
        (8, 0.0, 0), (9, 1.6875, 1), (10, 0.5, 1), (11, -0.25, 1),
    ]
    assert {g[0]: g[3] for g in got}[9] == 1.0 and {g[0]: g[3] for g in got}[7] == 0.0
    assert S.contextual_sentiment(df.where("false"), "id", F.col("text"), lexicon).count() == 0
