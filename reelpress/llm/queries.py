"""The registered query of each operator, with its comparison SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpress.llm import (
    byte_bpe,
    chat,
    collocations,
    exact_dedup,
    language_id,
    line_dedup,
    packing,
    quality,
    simhash,
    spelling,
    token_output,
    toxicity,
    url_filter,
)
from reelpress.llm.comparison_sql import ORACLE

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

__all__ = ["ORACLE", "QUERIES"]

URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sha256(column: str):
    return F.sha2(F.col(column), 256)


@query
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query
def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs).select("doc_id", "ids")
    return byte_bpe.decode(encoded).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"),
    )


@query
def op3_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", sha256("kept_text").alias("kept_sha256")
    )


@query
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


@query
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "ambiguous"
    )


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return exact_dedup.mark_duplicates(docs, keep="largest")


@query
def op9_chat_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    linked = chat.link_quotes(table(spark, folder, "conversations"))
    return chat.in_reply_order(linked).select(
        "conv_id", "turn", "role", "parent_turn", "thread_turn", "reply_depth", "n_quoted_lines",
        sha256("own_text").alias("own_sha256"), sha256("formatted").alias("formatted_sha256"),
    )


def quoting_replies(messages: DataFrame) -> DataFrame:
    """Every turn as a reply to an earlier one drawn by hash, its ``true_parent``, which it quotes as it stands, wrapped
    anew, or by its second half; what the parent answers is quoted one level deeper."""
    drawn = F.conv(F.substring(F.md5(F.concat_ws(":", "conv_id", "turn")), 1, 8), 16, 10).cast("long")
    known = messages.withColumn("true_parent", F.when(F.col("turn") > 0, drawn % F.col("turn")))
    plain = F.btrim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    texts = known.select("conv_id", "turn", "true_parent", F.coalesce("text", F.lit("")).alias("said"), F.split(plain, " ", -1).alias("w"))
    parent = texts.select(
        F.col("conv_id").alias("p_conv"), F.col("turn").alias("p_turn"), F.col("true_parent").alias("p_parent"), "said", "w"
    )
    above = texts.select(F.col("conv_id").alias("g_conv"), F.col("turn").alias("g_turn"), F.col("w").alias("gw"))

    def wrapped(words: Column, marks: str) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(12)), lambda i: i <= F.size(words))
        lines = F.transform(starts, lambda i: F.concat(F.lit(marks), F.array_join(F.slice(words, i, 12), " ")))
        return F.array_join(lines, "\n")

    half = F.slice("w", F.floor(F.size("w") / 2).cast("int") + 1, F.size("w"))
    quote = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("> "), F.replace("said", F.lit("\n"), F.lit("\n> "))))
        .when(F.col("turn") % 3 == 1, wrapped(F.col("w"), "> "))
        .otherwise(wrapped(half, "> "))
    )
    return (
        known.join(parent, F.expr("conv_id = p_conv AND true_parent = p_turn"), "left")
        .join(above, F.expr("p_conv = g_conv AND p_parent = g_turn"), "left")
        .select(
            "conv_id", "turn", "role", "true_parent",
            F.concat_ws("\n", wrapped(F.col("gw"), "> > "), quote, F.coalesce("text", F.lit(""))).alias("text"),
        )
    )


@query
def parents_of_quoting_replies(spark: SparkSession, folder: str) -> DataFrame:
    """The given conversations hold no quotes: replies that quote are derived from them, their parents known."""
    linked = chat.link_quotes(quoting_replies(table(spark, folder, "conversations")))
    return linked.select("conv_id", "turn", "true_parent", "parent_turn", "thread_turn", "reply_depth")


@query
def op10_token_output(spark: SparkSession, folder: str) -> DataFrame:
    packed = token_output.packed_rows(table(spark, folder, "documents"))
    return packed.select(
        "sequence_id", "n_tokens", "doc_ids", "starts", "cu_seqlens",
        F.crc32("ids").alias("ids_crc32"), F.crc32("positions").alias("positions_crc32"),
    )


@query
def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return toxicity.toxicity(docs, labels).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted"
    )


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, folder, "documents"))


@query
def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("text", "lang")
    return collocations.mine_collocations(docs)
