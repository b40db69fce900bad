"""The corpus pipeline: documents to packed windows, in stages over whole tables.

Each stage takes (spark, docs, folder) and returns the columns of ``documents`` for what it keeps,
the last one the pieces of windows. Between stages the rows are written as Parquet to the folder that
all executors share and read again, so a lost executor costs no more than the running stage.

* quality rules: documents that fail go, failing lines of the others go from their texts;
* language ID: documents without a language go: null, no letter, or so far from every learned language's
  codeword that ``language_id`` says they do not fit; a missing label is filled with the predicted language. If no label was
  learned from, every text with a letter stays and null labels stay null;
* line dedup: repeated lines go, except in the smallest doc_id; a document that loses all its
  text goes, since nothing is left of it to pack;
* near-dedup: the smallest doc_id stays of each group that SimHash fingerprints over three-word shingles join
  by links of at most three bits;
* packing: what is left, in windows of 1024 ids.

``n_chars`` follows the text. Rows that share a doc_id go through the first three stages alike;
near-dedup keeps one row of each group, whatever the ids: null ids come last, and of equal ids the one whose
text has the smallest hash stays. Extra
columns ride along, whatever their names; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpress.functions.text import compute_once
from reelpress.llm import language_id, line_dedup, packing, quality, simhash
from reelpress.session import shared_folder

#: Trained models and XXH64 have no SQL form; a test compares the rows with brute force.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> DataFrame:
    """Id, text and label, with the whole row beside them under one name."""
    return docs.select(F.struct("*").alias("row"), "doc_id", "text", "lang")


def _rows(
    carried: DataFrame, docs: DataFrame, text: str | None = None, label: str | None = None
) -> DataFrame:
    """The rows again, with another text or label if one is named."""
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns}
    if label:
        columns["lang"] = F.col(label)
    if text:
        columns["text"] = F.col(text)
        if "n_chars" in columns:
            columns["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return carried.select(*[column.alias(name) for name, column in columns.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality.apply_rules(_carried(docs)).select("row", "kept", "clean_text")
    once = compute_once(judged, kept=F.col("kept"), clean_text=F.col("clean_text"))
    return _rows(once.where("kept"), docs, "clean_text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = language_id.identify(_carried(docs)).select("row", "lang", "lang_pred", "fits")
    kept = compute_once(told, fits=F.col("fits"), lang_pred=F.col("lang_pred")).where("fits")
    label = F.coalesce("lang", F.nullif(F.col("lang_pred"), F.lit(language_id.UNKNOWN)))
    return _rows(kept.withColumn("lang", label), docs, label="lang")


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.dedup_lines(_carried(docs)).select("row", "n_dropped", "kept_text")
    once = compute_once(cut, n_dropped=F.col("n_dropped"), kept_text=F.col("kept_text"))
    return _rows(once.where("n_dropped = 0 OR kept_text != ''"), docs, "kept_text")


def _text_key() -> list[Column]:
    """128 bits that tell texts apart; null and empty are the same."""
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("__h1"), F.xxhash64(F.lit(1), text).alias("__h2")]


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.near_components(docs, carry=_text_key())
    # null ids come last; equal ids, and null ones, are told apart by their text
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__h1", "__h2")).alias("one")
    stay = found.groupBy("root").agg(least).select(
        F.col("one.doc_id").alias("stay_id"), F.col("one.__h1").alias("stay1"), F.col("one.__h2").alias("stay2")
    )
    # a plain column holds the row, so names in it cannot clash
    dealt = docs.select(F.struct("*").alias("row"), "doc_id", *_text_key()).repartition("doc_id", "__h1", "__h2")
    same = F.col("doc_id").eqNullSafe(F.col("stay_id")) & F.expr("__h1 = stay1 AND __h2 = stay2")
    return _rows(dealt.join(stay, same, "left_semi").dropDuplicates(["doc_id", "__h1", "__h2"]), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("line dedup", repeated_lines),
    ("near-dedup", near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
