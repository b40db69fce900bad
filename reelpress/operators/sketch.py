"""Approximate membership as a table: one bitmap row per group and 32768 bits.

The sketch is an ordinary DataFrame ``(group, bucket, bitmap)``. Building it is a partial
aggregate of fixed-size bitmaps, merging two is the same aggregate again, and probing joins
each bit position with its bitmap, whatever the sketch's size.

``bits`` is a number, or a column such as ``sketch_bits`` gives, for sketches that grow with
what they hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.functions.sketch import SKETCH_BITS, SKETCH_ERROR, positions, sized_bits
from reelpress.operators.dedup import drop_seen, first_per_key

#: bits of one bitmap row, as Spark's bitmap functions lay them out
BUCKET_BITS = 32768


def bit_positions(
    items: DataFrame, group: str, item: Column, bits: int | Column = SKETCH_BITS, hashes: int | None = None
) -> DataFrame:
    """Distinct set bits, one row each."""
    return items.select(
        group, F.explode(positions(item, bits, hashes)).alias("position")
    ).distinct()


def build_sketch(
    items: DataFrame, group: str, item: Column, bits: int | Column = SKETCH_BITS, hashes: int | None = None
) -> DataFrame:
    """The sketch of the items. Repeated bits go map-side, before bitmaps are put together."""
    # Spark numbers bitmap positions from 1
    spot = F.col("position") + 1
    return (
        bit_positions(items, group, item, bits, hashes)
        .groupBy(group, F.bitmap_bucket_number(spot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bitmap"))
    )


def merge_sketches(first: DataFrame, second: DataFrame, group: str) -> DataFrame:
    return (
        first.unionByName(second)
        .groupBy(group, "bucket")
        .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    )


def set_bits(sketch: DataFrame, group: str) -> DataFrame:
    """Number of set bits per group."""
    return sketch.groupBy(group).agg(F.sum(F.bitmap_count("bitmap")).alias("n_bits"))


def _bit_is_set(bitmap: Column, spot: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(spot, 3) + 1, 1)), 16, 10)
    return F.getbit(byte.cast("bigint"), F.pmod(spot, F.lit(8)).cast("int")) == 1


def might_contain(
    items: DataFrame,
    sketch: DataFrame,
    group: str,
    item: Column,
    out: str = "seen",
    bits: int | Column = SKETCH_BITS,
    hashes: int | None = None,
) -> DataFrame:
    """Adds ``out``: False only if the item was certainly never added to its group."""
    named = items.withColumn("_item", item)
    probes = (
        named.select(group, "_item", F.explode(positions(F.col("_item"), bits, hashes)).alias("p"))
        .distinct()
        .withColumn("bucket", F.bitmap_bucket_number(F.col("p") + 1))
    )
    spot = F.pmod(F.col("p"), F.lit(BUCKET_BITS)).cast("int")
    is_set = F.coalesce(_bit_is_set(F.col("bitmap"), spot), F.lit(False))
    found = (
        probes.join(sketch.select(group, "bucket", "bitmap"), [group, "bucket"], "left")
        .groupBy(group, "_item")
        .agg(F.bool_and(is_set).alias(out))
    )
    return named.join(found, [group, "_item"], "left").select(
        *items.columns, F.coalesce(out, F.lit(False)).alias(out)
    )


def sketch_bits(tracked: DataFrame, error: float = SKETCH_ERROR) -> Column:
    """Bits of a sketch that can hold all rows of ``tracked``, counted within the query."""
    counted = tracked.agg(F.count(F.lit(1)).alias("n"))
    return counted.select(sized_bits(F.col("n"), error)).scalar()


def unseen_urls(
    urls: DataFrame,
    tracked: DataFrame,
    sketch: DataFrame | None = None,
    group: str = "stock_name",
    url: str = "url",
    order: Sequence[str] | None = None,
    bits: int | Column = SKETCH_BITS,
) -> DataFrame:
    """URLs not tracked for their group, each once per group.

    The first in ``order`` stays of URLs that repeat within ``urls``. A sketch of ``tracked``,
    of as many ``bits``, saves the exact lookup for URLs it has certainly not seen; all others
    are looked up, so a full sketch costs time but never a URL. Rows without group or URL
    cannot be compared and all stay.
    """
    first = first_per_key(urls, [group, url], order or [group, url], blank=False)
    if sketch is None:
        return drop_seen(first, tracked, [group, url])
    key = F.concat(F.col(group), F.lit(":"), F.col(url))
    probed = might_contain(first, sketch, group, key, "_seen", bits)
    perhaps = drop_seen(probed.filter("_seen"), tracked, [group, url])
    return probed.filter(~F.col("_seen")).unionByName(perhaps).drop("_seen")
