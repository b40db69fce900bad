"""Line dedup: lines that several documents share stay only in the first of them.

A line's key is the line without white space at both ends and with A-Z lower-cased. Keys of at
least ``min_length`` code points that at least ``min_docs`` different documents hold lose all
their lines, except in the smallest doc_id that holds them. What stays is joined in its order.

Only hashes (128 bits) of lines are shuffled. The count per hash is combined in every map
task first, so a line that all documents share sends one row per task; the join that follows
has one row per hash on its other side, so its hot hashes can be split. Dropped positions of
a document are taken out of its list of positions in one linear pass.

Defined results: a null or empty text is one empty line, which is never dropped; a document
that loses all lines has an empty text; rows with the same doc_id count as one document and are
cut alike; null ids count as one document that comes after all others; an empty table gives an
empty result; input columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpress.llm.common import BLANKS, lower_ascii, text_of, without
from reelpress.session import use_checkpoints

RESULT = ("kept_text", "n_lines", "n_dropped")


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_length: int = 10,
    min_docs: int = 2,
) -> DataFrame:
    """``docs`` with kept_text, n_lines (before) and n_dropped."""
    if min_docs < 2:
        raise ValueError("min_docs is at least 2")
    use_checkpoints(docs.sparkSession)
    lines = F.split(text_of(text), "\n", -1)
    # two rows with one id but different texts keep apart
    row_key = {"__id": F.col(doc_id), "__th": F.xxhash64(text_of(text))}
    held = (
        docs.select(
            *[column.alias(name) for name, column in row_key.items()],
            F.posexplode(F.transform(lines, lambda s: lower_ascii(F.btrim(s, F.lit(BLANKS))))).alias(
                "pos", "key"
            ),
        )
        .where(F.length("key") >= min_length)
        .select(
            "__id", "__th", "pos",
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
        )
    )
    # written out, so that the join below has an exchange on either side and can split hot hashes
    shared = _shared(held, min_docs).checkpoint()
    drops = (
        held.join(shared, ["h1", "h2"])
        .where(~F.col("__id").eqNullSafe(F.col("first_id")))
        .groupBy("__id", "__th")
        .agg(F.collect_set("pos").alias("drops"))
        .withColumnsRenamed({"__id": "d_id", "__th": "d_th"})
    )
    keyed = docs.withColumns(row_key)
    joined = keyed.join(
        drops,
        F.col("__id").eqNullSafe(F.col("d_id")) & (F.col("__th") == F.col("d_th")),
        "left",
    )
    dropped = F.coalesce("drops", F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), dropped)
    result = joined.withColumn("__lines", lines).withColumns(
        {
            "__kept": F.when(F.size(dropped) == 0, text_of(text)).otherwise(
                F.array_join(F.transform(stay, lambda i: F.col("__lines")[i]), "\n")
            ),
            "__n": F.size("__lines").cast("long"),
            "__gone": F.size(dropped).cast("long"),
        }
    )
    names = dict(zip(("__kept", "__n", "__gone"), RESULT, strict=True))
    return without(
        result.drop("__id", "__th", "d_id", "d_th", "drops", "__lines"), *RESULT
    ).withColumnsRenamed(names)


def _shared(held: DataFrame, min_docs: int) -> DataFrame:
    """Hash and smallest id of every line that enough documents hold."""
    shared = (
        held.groupBy("h1", "h2")
        .agg(
            F.min("__id").alias("first_id"),
            F.max("__id").alias("last_id"),
            F.max(F.col("__id").isNull()).alias("some_null"),
        )
        .where(
            (F.col("first_id") != F.col("last_id"))
            | (F.col("first_id").isNotNull() & F.col("some_null"))
        )
        .select("h1", "h2", "first_id")
    )
    if min_docs == 2:  # two different ids, or an id and a null: nothing is left to count
        return shared
    counted = (
        held.join(shared.select("h1", "h2"), ["h1", "h2"])
        .groupBy("h1", "h2", "__id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("one").alias("n"))
        .where(F.col("n") >= min_docs)
    )
    return shared.join(counted.select("h1", "h2"), ["h1", "h2"])
