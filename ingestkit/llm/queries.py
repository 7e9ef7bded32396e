"""The registered queries: each applies one operator, with its production
parameters, to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingestkit.llm import (caps, chat, decontam, exact, langid, lmscore, merkle, minhash, mixing, repeats, sharding,
                           tokencount, trie)
from ingestkit.llm.oracles import ORACLE  # noqa: F401
from ingestkit.workloads.common import table


TOKENIZER = "byte_bpe_50k.json"


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents labelled as of good quality."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    scored = lmscore.cross_entropy_difference(table(spark, sf_dir, "documents"), good)
    # nine decimals: sums of logarithms differ in the last bits by their order
    return scored.select("doc_id", "n_tokens", *[F.round(c, 9).alias(c) for c in ("loss_target", "loss_background", "score")])


def op2_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(table(spark, sf_dir, "embeddings"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train_on(documents)
    held = langid.held_out("doc_id").alias("held_out")
    return langid.identify(documents.select("doc_id", held, "text"), model).drop("text")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(mixing.plan_mix(table(spark, sf_dir, "documents")))


def op7_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = turns.unionByName(probe).withColumn("parts", chat.text_part(F.col("text")))
    return chat.read_back(chat.format_conversations(turns))


def op8_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_digest(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.overlap_digest(decontam.find_overlaps(documents, table(spark, sf_dir, "benchmark")))


def op10_shard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampering: where 5 divides the checksum of the id, the text's A-Z are lower-cased."""
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.tamper_report(table(spark, sf_dir, "documents"), F.when(struck, merkle.lower_ascii(F.col("text"))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = trie.prefix_trie(*trie.branch(trie.turn_rows(table(spark, sf_dir, "conversations"))))
    return nodes.drop("name", "token")


def op13_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_lm_scores": op1_lm_scores,
    "op2_cap_filters": op2_cap_filters,
    "op3_minhash": op3_minhash,
    "op4_count_tokens": op4_count_tokens,
    "op5_languages": op5_languages,
    "op6_mix_sources": op6_mix_sources,
    "op7_format_chat": op7_format_chat,
    "op8_remove_repeats": op8_remove_repeats,
    "op9_decontaminate": op9_decontaminate,
    "op10_shard_tree": op10_shard_tree,
    "op11_merkle": op11_merkle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_exact": op13_exact,
}
