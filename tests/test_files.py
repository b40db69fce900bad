import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from reelpress import schemas
from reelpress.plans import article_flow as A
from reelpress.plans import ratings_jobs as J
from reelpress.sinks import files as W
from reelpress.sources import delimited as D
from reelpress.sources import dimensions as DIM
from reelpress.sources import files as S
from reelpress.session import build_session, object_store_conf, shared_folder, use_checkpoints


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path)


ITEM = "{}|{}|01-Jan-1995||http://x/|{}\n"


@pytest.fixture
def ratings_folder(tmp_path):
    put(tmp_path / "u.user", "1|24|M|writer|85711\n2|53|F|other|94043\n3|45|F|writer|1\n")
    put(tmp_path / "u.data", "".join(f"{u}\t{i}\t{(u + i) % 5 + 1}\t88125\n"
                                       for u in (1, 2, 3) for i in (1, 2)))
    flags = "|".join("1" if n in (5, 14) else "0" for n in range(19))
    text = ITEM.format(1, "Café (1995)", flags) + ITEM.format(2, "Plain", "|".join("0" * 19))
    put(tmp_path / "u.item", text, "latin-1")
    return str(tmp_path)


def test_delimited(spark, ratings_folder):
    inputs = J.RatingsInputs(spark, ratings_folder)
    assert inputs.users.count() == 3 and inputs.ratings.count() == 6
    item = inputs.items.filter("movie_id = 1").first()
    assert (item.title, item.video_release_date, item.comedy, item.romance) == (
        "Café (1995)", None, 1, 1,
    )
    narrow = D.read_items_narrow(spark, f"{ratings_folder}/u.item")
    assert narrow.columns == schemas.ITEMS_NARROW.fieldNames() and narrow.count() == 2
    numbered = D.read_items(spark, f"{ratings_folder}/u.item", schemas.ITEMS_NUMBERED_FLAGS)
    assert numbered.filter("genre_5 = 1").count() == 1
    short = D.read_delimited(spark, f"{ratings_folder}/u.item", schemas.ITEMS_NARROW, "|")
    assert short.count() == 2


def test_ratings_reports(spark, ratings_folder, tmp_path):
    out = str(tmp_path / "out")
    J.run_reports(spark, ratings_folder, out, title="Plain", min_similarity=-1.0, min_cooccurrence=2)
    means = {r.occupation: r.mean_age for r in spark.read.parquet(f"{out}/mean_age_by_occupation").collect()}
    assert means == {"other": 53.0, "writer": 34.5}
    assert spark.read.parquet(f"{out}/top_rated_items").count() == 0
    assert spark.read.option("header", True).csv(f"{out}/top_genres_csv").columns == [
        "age_group", "occupation", "genre", "avg_rating", "rating_count", "rank",
    ]
    assert spark.read.parquet(f"{out}/similar_items").count() == 2
    assert spark.read.parquet(f"{out}/similar_to_title").first().title == "Café (1995)"
    assert J.top_genres(J.RatingsInputs(spark, ratings_folder), every_genre=True).count() == 0


def test_json_sources(spark, tmp_path):
    root = tmp_path / "store"
    article = {"title": "Ünï", "content": "c", "url": "u", "source": "s", "keyword": "k"}
    put(root / "article_content/Tata Motors/h+1.json", json.dumps(article, ensure_ascii=False))
    put(root / "article_content/k/bad.json", "{not json")
    contents = S.read_article_contents(spark, str(root)).collect()
    assert [(r.path, r.title) for r in contents] == [("article_content/Tata Motors/h+1.json", "Ünï")]
    batch = {"articles": [{"title": "a", "url": "1"}, {"title": "b"}], "s3_content_paths": ["p"]}
    path = put(tmp_path / "batch.json", json.dumps(batch, indent=1))
    assert [(r.position, r.title, r.url) for r in S.read_raw_batch(spark, path).collect()] == [
        (0, "a", "1"), (1, "b", None),
    ]
    feed = put(tmp_path / "feed.json", json.dumps({"posts": [{"title": "t", "excerpt": "e"}]}))
    assert S.read_posts_feed(spark, feed).first().posts[0].title == "t"
    assert S.read_json(spark, str(tmp_path / "none.json"), schemas.ARTICLE_CONTENT).count() == 0
    assert S.read_article_contents(spark, str(tmp_path / "none")).count() == 0
    assert S.read_parquet(spark, str(tmp_path / "none"), schemas.PAGES).count() == 0
    put(tmp_path / "html/a.html", "<h1>é</h1>")
    assert S.read_pages(spark, str(tmp_path / "html")).first().html == "<h1>é</h1>"


def test_missing_and_unreadable_inputs(spark, tmp_path):
    article = {"title": "t", "content": "c"}
    first = put(tmp_path / "data/raw_data/x y.json", json.dumps(article))
    put(tmp_path / "data/more/data/z.json", json.dumps(article))
    put(tmp_path / "data/bad.json", "{not json")
    absent = str(tmp_path / "absent.json")
    paths = [absent, first, str(tmp_path / "gone")]
    assert S.read_json(spark, paths, schemas.ARTICLE_CONTENT).filter("title = 't'").count() == 1
    assert S.read_json(spark, [absent], schemas.ARTICLE_CONTENT).count() == 0
    df, missing = S.read_present(paths, spark.read.text)
    assert df.count() == 1 and sorted(missing) == sorted([absent, str(tmp_path / "gone")])
    for root in (str(tmp_path / "data"), f"file://{tmp_path}/data/"):
        contents = S.read_article_contents(spark, root)
        assert contents.count() == 2
        assert {r.path for r in contents.select("path").collect()} == {"raw_data/x y.json", "more/data/z.json"}
        assert [r.path for r in S.unreadable_documents(spark, root).collect()] == ["bad.json"]
        keys = {r.key for r in S.file_inventory(spark, root).collect()}
        assert keys == {"raw_data/x y.json", "more/data/z.json", "bad.json"}
    raw = spark.createDataFrame([("raw_data/x y.json",), ("none",)], "s3_raw_content_path string")
    joined = A.attach_content(raw, S.read_article_contents(spark, str(tmp_path / "data")))
    assert {(r.s3_raw_content_path, r.full_content) for r in joined.collect()} == {
        ("raw_data/x y.json", "c"), ("none", None),
    }


def test_one_run_of_a_stage(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, stock_name string")
    for run in ("20240101_000000", "20240102_000000"):
        W.write_stage(df, str(tmp_path), "urls", run, ["stock_name"])
    one = S.read_stage(spark, str(tmp_path), "urls", run="20240102_000000")
    assert sorted(r.n for r in one.collect()) == [1, 2]
    assert [r.n for r in S.read_stage(spark, str(tmp_path), "urls", "a", "20240102_000000").collect()] == [1]
    assert S.read_stage(spark, str(tmp_path), "urls").groupBy("run_ts").count().count() == 2


def test_inventory(spark, tmp_path):
    put(tmp_path / "in/ml/u.user", "x")
    put(tmp_path / "in/ml/u.data", "")
    inventory = S.file_inventory(spark, str(tmp_path / "in"))
    # an empty file counts as absent
    assert {(r.key, r.length) for r in inventory.collect()} == {("ml/u.user", 1)}
    assert S.under_prefix(inventory, "ml/u.u").count() == 1
    assert S.object_size(inventory, "ml/u.user").first().length == 1
    assert S.object_size(inventory, "other").isEmpty()
    S.require_inputs(spark, inventory, ["ml/u.user"])
    with pytest.raises(FileNotFoundError, match="ml/u.data, ml/u.item"):
        S.require_inputs(spark, inventory, ["ml/u.user", "ml/u.data", "ml/u.item"])
    assert "Content" not in inventory._jdf.queryExecution().executedPlan().toString()


def test_sql(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    got = S.run_sql(spark, "SELECT k FROM {t} WHERE v > :least", {"t": df}, {"least": 1})
    assert [r.k for r in got.collect()] == ["b"]
    assert S.run_sql(spark, "SELECT k FROM {t} WHERE v > 9", {"t": df}).columns == ["k"]
    df.createOrReplaceTempView("some_view")
    assert spark.catalog.tableExists("some_view") and not spark.catalog.tableExists("no_such_view")


def test_dimensions(spark):
    stocks = S.rows(spark, [("A", ["a", "aa"], "high"), ("B", ["b"], "low")], schemas.STOCKS)
    sources = S.rows(
        spark, [("S1", "u", "C", True, 1, 5), ("S2", "u", "C", False, 1, 5)], schemas.SOURCES
    )
    assert [r.name for r in DIM.enabled(sources).collect()] == ["S1"]
    assert DIM.by_name(stocks, "B").first().keywords == ["b"]
    assert DIM.by_name(stocks, "none").isEmpty()
    assert DIM.stock_source_combinations(stocks, ["S1", "S3"]).count() == 4
    assert DIM.keyword_source_combinations(stocks, ["S1", "S3"]).count() == 6
    assert S.rows(spark, [], schemas.STOCKS).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("é", 1, "a"), (None, 2, "b")], "t string, n int, p string")
    W.write_json(df, f"{tmp_path}/json")
    text = "".join(p.read_text("utf-8") for p in (tmp_path / "json").glob("part-*"))
    assert '"é"' in text and '"t":null' in text
    W.write_csv(df, f"{tmp_path}/csv")
    assert spark.read.option("header", True).csv(f"{tmp_path}/csv").count() == 2
    path = W.write_stage(df, str(tmp_path), "stage", "r1", ["p"])
    W.write_stage(df, str(tmp_path), "stage", "r1", ["p"])
    assert spark.read.parquet(path).count() == 2
    W.append_parquet(df, path, ["p"])
    assert spark.read.parquet(path).count() == 4
    W.replace_partitions(df.filter("p = 'a'").withColumn("n", F.lit(9)), path, ["p"])
    assert sorted((r.p, r.n) for r in spark.read.parquet(path).collect()) == [("a", 9), ("b", 2), ("b", 2)]


def test_snapshots(spark, tmp_path):
    base = f"{tmp_path}/table"
    schema = "t string, n int"
    assert W.read_snapshot(spark, base, schema).count() == 0
    for version in (1, 2, 10):
        before = W.read_snapshot(spark, base, schema)
        W.write_snapshot(before.union(spark.createDataFrame([("x", version)], schema)), base, version)
    assert W.read_snapshot(spark, base, schema).count() == 3
    assert W.read_snapshot(spark, base, schema, before=10).count() == 2
    (tmp_path / "table/snapshot=0000000010/_SUCCESS").unlink()  # as after a failed write
    assert W.read_snapshot(spark, base, schema).count() == 2
    assert W.drop_snapshots(spark, base, keep=1) == 1
    assert len(W.snapshots(spark, base)) == 1


def test_session(spark):
    assert build_session().conf.get("spark.sql.adaptive.enabled") == "true"
    conf = object_store_conf("http://store:9000", use_tls=False, credentials_provider="P")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert not any("secret" in key for key in conf)
    folder = shared_folder(spark)
    assert folder == (spark.conf.get("spark.checkpoint.dir", None) or folder)
    use_checkpoints(spark)
    assert spark.range(3).checkpoint().count() == 3


@pytest.mark.parametrize(
    ("conf", "folder"),
    [
        ({"spark.master": "yarn", "spark.sql.warehouse.dir": "file:/home/driver/spark-warehouse"}, None),
        ({"spark.master": "yarn", "spark.sql.warehouse.dir": "spark-warehouse"}, None),
        ({"spark.master": "yarn", "spark.sql.warehouse.dir": "s3a://b/w/"}, "s3a://b/w/_shared"),
        ({"spark.master": "local[2]", "spark.sql.warehouse.dir": "file:/tmp/w"}, "file:/tmp/w/_shared"),
        ({"spark.master": "yarn", "spark.checkpoint.dir": "/mnt/shared/"}, "/mnt/shared"),
    ],
)
def test_a_cluster_needs_a_folder_that_executors_share(conf, folder):
    session = SimpleNamespace(conf=conf)
    if folder is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session)
    else:
        assert shared_folder(session) == folder
