"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.llm import (
    anchor_codes,
    bpe,
    chat,
    curriculum,
    exact_dedup,
    lexical,
    ngram_join,
    projections,
    quality,
    shards,
    site_lines,
    surrogates,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return surrogates.anonymise(docs, key="a key that the owner of the data keeps")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = vocabulary()
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return digests(bpe.encode(docs, path, back=True), "doc_id")


def digests(coded: DataFrame, *keep: str) -> DataFrame:
    """Number of ids, and digests of the ids in decimal and of the decoded text."""
    return coded.select(
        *keep,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_site_lines(spark: SparkSession, sf: str) -> DataFrame:
    return site_lines.drop_lines(table(spark, sf, "pages"))


def op4_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    rule = ngram_join.Rule(words=4, percent=85)
    return ngram_join.link(table(spark, sf, "documents"), rule).select("doc_id", "n_shingles", "component_id")


def op5_chat(spark: SparkSession, sf: str) -> DataFrame:
    conversations = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], conversations.schema)
    chats = chat.format_chats(conversations.unionByName(added))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    spans = F.transform(
        "loss", lambda s: chat.unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["stop"] - s["start"]))
    )
    chats = chats.withColumn("learned", F.array_join(spans, ""))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    learned = quality.fit(docs, table(spark, sf, "labels"))
    scored = quality.score(docs, *learned)
    return scored.select(
        "doc_id",
        (~quality.for_learning()).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op7_curriculum(spark: SparkSession, sf: str) -> DataFrame:
    rows = curriculum.ordered(table(spark, sf, "documents"))
    starts = F.round(F.get("positions", F.lit(0)), 6).alias("starts")
    places = F.array_join(F.col("places").cast("array<string>"), ",").alias("places")
    return rows.select("doc_id", "size", "source_size", "target", "taken", starts, places)


def op8_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.mark(table(spark, sf, "documents"))


def op9_projections(spark: SparkSession, sf: str) -> DataFrame:
    return projections.near_duplicates(table(spark, sf, "embeddings"))


def op10_shards(spark: SparkSession, sf: str) -> DataFrame:
    rows = shards.shard(table(spark, sf, "documents"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        (~toxicity.for_learning()).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op12_nra_search(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op13_anchor_codes(spark: SparkSession, sf: str) -> DataFrame:
    return anchor_codes.compress(table(spark, sf, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_surrogates": op1_surrogates,
    "op2_bpe": op2_bpe,
    "op3_site_lines": op3_site_lines,
    "op4_ngram_join": op4_ngram_join,
    "op5_chat": op5_chat,
    "op6_quality": op6_quality,
    "op7_curriculum": op7_curriculum,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_projections": op9_projections,
    "op10_shards": op10_shards,
    "op11_toxicity": op11_toxicity,
    "op12_nra_search": op12_nra_search,
    "op13_anchor_codes": op13_anchor_codes,
}
