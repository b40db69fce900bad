import hashlib

import pytest
from pyspark.sql import functions as F

from reelpress.functions.sketch import hash_count, positions
from reelpress.operators import dedup as D
from reelpress.operators import sketch as B


def seqs(df):
    return sorted(r.seq for r in df.collect())


def test_first_per_key_keeps_missing_keys(spark):
    rows = [(1, "a"), (2, None), (3, "a"), (4, ""), (5, None), (6, "b"), (7, "")]
    df = spark.createDataFrame(rows, "seq int, h string")
    first = D.first_per_key(df, ["h"], ["seq"])
    assert seqs(first) == [1, 2, 4, 5, 6, 7]
    assert seqs(D.first_per_key(first, ["h"], ["seq"])) == seqs(first)
    assert seqs(D.first_per_key(df, ["h"], ["seq"], keep_missing=False)) == [1, 6]
    assert seqs(D.first_per_key(df, ["h"], ["seq"], last=True)) == [2, 3, 4, 5, 6, 7]
    assert seqs(D.first_per_key(df, ["h"], ["seq"], blank=False)) == [1, 2, 4, 5, 6]


def test_new_items_and_fallback(spark):
    batch = spark.createDataFrame(
        [(1, "a"), (2, "b"), (3, "b"), (4, None), (5, None), (6, "c")], "seq int, h string"
    )
    seen = spark.createDataFrame([("a",), ("a",), (None,)], "h string")
    assert seqs(D.new_items(batch, seen, ["h"], ["seq"])) == [2, 4, 5, 6]
    known = D.known_keys(seen, batch.select("h"), keys=["h"])
    assert sorted(r.h for r in known.filter("h is not null").collect()) == ["a", "b", "c"]
    backup = spark.createDataFrame([(9, "a"), (10, "z")], "seq int, h string")
    assert seqs(D.with_fallback(batch.filter("h = 'a'"), backup, ["h"])) == [1, 10]


def test_same_url_stays_available_to_other_stocks(spark):
    urls = [f"https://news.example/{i}" for i in (1, 2, 3)]
    df = spark.createDataFrame(
        [(s, u) for s in ("stock a", "stock b") for u in urls], "stock_name string, url string"
    )
    tracked = df.filter("false")
    sketch = B.build_sketch(tracked, "stock_name", F.concat("stock_name", F.lit(":"), "url"))
    for fresh in (B.unseen_urls(df, tracked), B.unseen_urls(df, tracked, sketch)):
        assert {r.stock_name: r["count"] for r in fresh.groupBy("stock_name").count().collect()} == {
            "stock a": 3, "stock b": 3,
        }
    done = df.filter("stock_name = 'stock a'")
    assert {r.stock_name for r in B.unseen_urls(df, done).collect()} == {"stock b"}


def python_positions(item, bits, hashes):
    return [
        int(hashlib.md5(f"{item}{i}".encode()).hexdigest(), 16) % bits for i in range(hashes)
    ]


def test_hash_count():
    assert hash_count(10000, 0.01) == 6
    assert hash_count(2, 1e-9) == 2
    assert hash_count(100, 0.9) == 1


@pytest.mark.parametrize("bits", [10000, 7, 32768, 1_000_003])
def test_positions(spark, bits):
    items = [f"s:{i}é" for i in range(50)]
    df = spark.createDataFrame([(i,) for i in items], "item string")
    got = df.select("item", positions(F.col("item"), bits, 5).alias("p")).collect()
    assert all(list(r.p) == python_positions(r.item, bits, 5) for r in got)


@pytest.mark.parametrize("bits", [300, 10000, 100_000])
def test_membership(spark, bits):
    rows = [(f"g{i % 3}", f"u{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, u string")
    added = df.filter("cast(substr(u, 2) as int) < 60")
    sketch = B.build_sketch(added, "g", F.col("u"), bits)
    sketch = B.merge_sketches(sketch, sketch, "g")
    got = {
        (r.g, r.u): r.seen
        for r in B.might_contain(df, sketch, "g", F.col("u"), bits=bits).collect()
    }
    bitset = {}
    for g, u in rows[:60]:
        bitset.setdefault(g, set()).update(python_positions(u, bits, hash_count(bits)))
    assert got == {
        (g, u): set(python_positions(u, bits, hash_count(bits))) <= bitset[g] for g, u in rows
    }
    assert {r.g: r.n_bits for r in B.set_bits(sketch, "g").collect()} == {
        g: len(s) for g, s in bitset.items()
    }
    stranger = spark.createDataFrame([("other", "u1")], "g string, u string")
    assert not B.might_contain(stranger, sketch, "g", F.col("u"), bits=bits).first().seen


@pytest.mark.parametrize("bits", [1, 50, 10_000])
def test_a_full_sketch_loses_no_url(spark, bits):
    urls = [(i, f"g{i % 2}", f"u{i // 2 % 150}") for i in range(600)] + [(900, None, "u1"), (901, "g0", None)]
    df = spark.createDataFrame(urls, "seq int, stock_name string, url string")
    tracked = df.filter("seq < 100 AND seq % 3 = 0").select("stock_name", "url")
    sketch = B.build_sketch(tracked, "stock_name", F.concat("stock_name", F.lit(":"), "url"), bits)
    got = B.unseen_urls(df, tracked, sketch, order=["seq"], bits=bits)
    exact = B.unseen_urls(df, tracked, order=["seq"])
    assert seqs(got) == seqs(exact)
    done = {(r.stock_name, r.url) for r in tracked.collect()}
    firsts = {}
    for seq, group, url in urls:
        firsts.setdefault((group, url), seq)
    assert seqs(got) == sorted(v for k, v in firsts.items() if k not in done)


def test_sketch_size_follows_its_items(spark):
    df = spark.range(20_000).selectExpr("'g' AS g", "concat('u', id) AS u")
    added = df.filter("id < 10000")
    bits = B.sketch_bits(added)
    sketch = B.build_sketch(added, "g", F.col("u"), bits)
    probed = B.might_contain(df, sketch, "g", F.col("u"), bits=bits)
    assert probed.filter("seen").count() < 10_000 + 300
    assert probed.filter("NOT seen").join(added, "u").count() == 0
