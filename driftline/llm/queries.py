"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, collocations, conversation_trie, decontamination, jaccard_join, min_max, packing, permutation_index, quality, sharding, token_output, token_rollup, toxicity
from .common import fold, plain, shared_dir, stage, table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _scored(scores: DataFrame, held_out) -> DataFrame:
    return scores.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return _scored(toxicity.score(docs, lexicon), held_out)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 3) == 1
    space = quality.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return _scored(quality.score(docs, space), held_out)


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.digest(decontamination.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, capacity=1024)


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


#: Bytes of a shard.
SHARD = 1 << 20


def op8_extendible_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), SHARD)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    template = chat_format.Template()
    talks = chat_format.probe(table(spark, sf_dir, "conversations"))
    return chat_format.digest(chat_format.read(chat_format.render(chat_format.segments(talks, template)), template))


def op10_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads every document, delivers that batch again, then revises every count by its end id and deletes documents labelled toxic."""
    version = "byte_bpe_50k"
    counted = stage(token_rollup.counts(table(spark, sf_dir, "documents"), tokenizer_path()), "counts")
    labels = plain(table(spark, sf_dir, "labels"), "doc_id", "toxic")
    rollup = token_rollup.Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}")
    for _ in range(2):
        rollup.commit("load", token_rollup.inserts(counted, version))
    ended = counted.withColumn("n_tokens", F.col("n_tokens") + 1)
    gone = ended.join(labels.where("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    rollup.commit("ends", token_rollup.revisions(counted, version, F.col("tokens_after") + 1))
    rollup.commit("takedown", token_rollup.deletes(gone, version))
    return rollup.totals()


def op11_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return min_max.near_copies(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that begin with the first turns of another, as many as the id's crc32 says."""
    own = stage(conversation_trie.turns(table(spark, sf_dir, "conversations")), "turns")
    return conversation_trie.nodes(conversation_trie.rebuilt(own, F.col("conv_id") - F.col("conv_id") % 5, fold(F.col("conv_id"), 9)))


#: Occurrences of a phrase at least, and phrases listed of each language.
LEAST, TOP = 30, 2000


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"), LEAST, TOP)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_toxicity, op2_quality, op3_token_output, op4_decontamination, op5_best_fit_packing, op6_jaccard_join, op7_permutation_index, op8_extendible_hashing, op9_chat_format, op10_token_rollup, op11_min_max, op12_conversation_trie, op13_collocations, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_jaccard_join": min_max.sql(3, 90, 100, kept=False),
        "op8_extendible_hashing": sharding.sql(SHARD),
        "op9_chat_format": chat_format.sql(chat_format.Template()),
        "op11_min_max": min_max.sql(3, 85, 100, kept=True),
        "op12_conversation_trie": conversation_trie.sql(),
        "op13_collocations": collocations.sql(LEAST, TOP),
    }
