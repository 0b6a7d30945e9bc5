"""The registered queries of this folder, each over a whole table, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewatt.llm import (
    ballkmeans,
    crosstok,
    decontaminate,
    htmltext,
    mixing,
    multiindex,
    oracle,
    partenum,
    pii,
    quotes,
    sharding,
    topk,
    toxicity,
    urlfilter,
)
from sievewatt.llm.common import table

# Fixed values: (host, path, verdict).
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.scaled(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, F.col("vec_id") % 50 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("id").alias("doc_id"),
        (toxicity.crc_part(F.col("id")) == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "terms",
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents"))
    counts = [pii.number_of("base", k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = quotes.conversations(table(spark, sf_dir, "conversations"))
    return told.select(F.col("conv").alias("conv_id"), "turn", "role", "parent", "root", "place", "text", "formatted")


def quoted_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotation linking over messages of which two in three quote the one before, as the table itself holds no quotes."""
    told = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    before = told.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("text").alias("before"))
    quote = F.concat(F.lit("> "), F.replace("before", F.lit("\n"), F.lit("\n> ")), F.lit("\n"), F.coalesce("text", F.lit("")))
    plain = F.col("before").isNull() | (F.col("turn") % 3 == 0)
    answers = told.join(before, ["conv_id", "turn"], "left").withColumn("text", F.when(plain, F.col("text")).otherwise(quote))
    linked = quotes.conversations(answers)
    return linked.select(F.col("conv").alias("conv_id"), "turn", "role", "parent", "root", "place", "text", "formatted")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = partenum.join(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("class_id").alias("component_id"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    texts = htmltext.extract(pages, htmltext.train(pages))
    return texts.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstok.link_counts(table(spark, sf_dir, "documents"))


def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = ballkmeans.compress(ballkmeans.scaled(table(spark, sf_dir, "embeddings")))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(multiindex.usable(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_topk,
        op2_toxicity,
        op3_mixing,
        op4_url_filter,
        op5_sharding,
        op6_decontamination,
        op7_pii,
        op8_chat_formatting,
        quoted_conversations,
        op9_ngram_jaccard_join,
        op10_html_extraction,
        op11_cross_tokenizer_alignment,
        op12_vector_code_compression,
        op13_nearest_neighbours,
    )
}

ORACLE: dict[str, str] = oracle.SQL
