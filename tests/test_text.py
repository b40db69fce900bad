import hashlib
import re
import unicodedata
import urllib.parse

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reelpress.functions import text as X
from reelpress.plans import article_flow as A

EDGES = {
    "a&nbsp;b &amp; c": "anbsp;b amp; c",
    "a & b": "a  b",
    "a...b,,c": "a.b,c",
    "SHARE this Article now": "now",
    "x y z\x1cw\x85v": "x y z w v",
    "é ² ½ Ⅷ 中文 _": "é ² ½ Ⅷ 中文 _",
    "é \U0001f600 a‍b": "e  ab",
    "Follow us on Subscribe to": "",
    "  (a-b); c: d! e? ": "(a-b); c: d! e?",
    "": "",
    None: "",
}


def evaluate(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.o for r in df.select("i", column.alias("o")).orderBy("i").collect()]


def test_clean_edges(spark):
    got = evaluate(spark, list(EDGES), X.clean_text(F.col("t")))
    assert got == list(EDGES.values())


def restated(text):
    # the cleaning rules over again, with Python's own Unicode classes
    if not text:
        return ""
    text = " ".join(re.split(r"\s+", text))
    text = "".join(c for c in text if re.match(r"[\w\s.,!?;:()-]", c))
    text = re.sub(r"([.,])\1*", r"\1", text)
    for phrase in X.SITE_PHRASES:
        text = re.sub(phrase, "", text, flags=re.I)
    return text.strip()


# characters that Java's Unicode tables know as well as Python's
known = st.characters(exclude_categories=["Cs"]).filter(
    lambda c: unicodedata.ucd_3_2_0.category(c) == unicodedata.category(c) != "Cn"
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(known, max_size=60), max_size=40))
def test_clean_property(spark, values):
    values = [v.replace("\x00", "") for v in values]
    if values:
        got = evaluate(spark, values, X.clean_text(F.col("t")))
        assert got == [restated(v) for v in values]


def test_decode_option(spark):
    got = evaluate(spark, ["a&nbsp;b &amp;lt; c"], X.clean_text(F.col("t"), decode=True))
    assert got == ["a b lt; c"]


def test_hashes(spark):
    df = spark.createDataFrame([("Ünï", "C")], "a string, b string")
    row = df.select(
        X.content_hash(F.col("a"), F.col("b")).alias("raw"),
        X.content_hash(F.col("a"), F.col("b"), lower=True).alias("low"),
        X.hash_or(F.lit(""), F.col("a"), F.col("b")).alias("own"),
        X.hash_or(F.lit("given"), F.col("a"), F.col("b")).alias("given"),
    ).first()
    assert row.raw == hashlib.md5("ÜnïC".encode()).hexdigest()
    assert row.low == row.own == hashlib.md5("ünïc".encode()).hexdigest()
    assert row.given == "given"


def test_quote_keyword(spark):
    words = ["Tata Motors/é", "a*b~c", "x&y=z+1", "plain"]
    assert evaluate(spark, words, X.quote_keyword(F.col("t"))) == [
        urllib.parse.quote(w) for w in words
    ]


@pytest.mark.parametrize("length, expected", [(2000, 2000), (2001, 2003)])
def test_preview(spark, length, expected):
    assert evaluate(spark, ["x" * length], F.length(X.preview_text(F.col("t")))) == [expected]


@pytest.mark.parametrize("length", [149, 150, 151])
def test_sample(spark, length):
    got = evaluate(spark, ["t" * length], X.sample_text(F.col("t"), F.lit("c" * 10)))
    assert got == [("t" * length + "c" * 10)[:150]]


def test_small_functions(spark):
    df = spark.range(1)
    row = df.select(
        X.first_text(F.lit(""), F.lit(None).cast("string"), F.lit("x")).alias("a"),
        X.first_text(F.lit("")).alias("b"),
        X.percent(F.lit(1), F.lit(4)).alias("c"),
        X.percent(F.lit(0), F.lit(0)).alias("d"),
        X.slug(F.lit("Tata Motors")).alias("e"),
        X.key_stage(F.lit("raw_data/x/y.json")).alias("f"),
        X.key_stamp(F.lit("2024-02-01 06:30:00.123").cast("timestamp"), millis=True).alias("g"),
        X.matches_keyword([F.lit("Abc"), F.lit(None).cast("string")], "bC").alias("h"),
        X.default_if_missing(F.lit(None).cast("string"), "unknown").alias("i"),
    ).first()
    assert row.asDict() == {
        "a": "x", "b": "", "c": 25.0, "d": 0.0, "e": "tata_motors", "f": "raw_data",
        "g": "20240201_063000_123", "h": True, "i": "unknown",
    }


def test_prepare_articles(spark):
    raw = spark.createDataFrame(
        [
            ("k", "T", "short", "p1", None, "x" * 49 + "  y"),
            ("k", "T", "short", "p2", "h", None),
            ("k", "T", "y" * 50, "p3", "", ""),
            ("k", "T", "z" * 49, "p4", "", None),
        ],
        "keyword string, title string, content string, s3_raw_content_path string,"
        " content_hash string, full_content string",
    )
    got = {r.s3_raw_content_path: r for r in A.prepare_articles(raw).collect()}
    assert set(got) == {"p1", "p3"}
    assert got["p1"].content == "x" * 49 + " y" and got["p1"].content_length == 51
    assert got["p3"].content_hash == hashlib.md5(("t" + "y" * 50).encode()).hexdigest()


def test_attach_content(spark):
    raw = spark.createDataFrame(
        [("a", "p1"), ("b", "p2"), ("c", None), ("d", "")], "title string, s3_raw_content_path string"
    )
    contents = spark.createDataFrame([("p1", "full", "body")], "path string, title string, content string")
    got = {r.title: r.full_content for r in A.attach_content(raw, contents).collect()}
    assert got == {"a": "body", "b": None}
