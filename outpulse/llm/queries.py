"""Every operator of this package as a query over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outpulse.llm import ann, chat, decontam, licenses, lm, merkle, mixing, near, quality, repeats, secrets, shards, trie
from outpulse.llm.registry import QUERIES, SQL, query, table  # noqa: F401

__all__ = ["QUERIES", "SQL"]


@query("op9_substring_dedup")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    kept = repeats.remove_repeats(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return near.near_groups(table(spark, sf, "documents")).drop("rid", "keeper")


@query("op3_preference_pairs", chat.PAIRS_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return chat.preference_pairs(chat.swapped_replies(table(spark, sf, "conversations")))


@query(
    "op4_mix_sources",
    "WITH " + mixing.MIX_SQL.format(docs="documents", seed="mix")
    + " SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed",
)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op2_secret_scan")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf, "documents")))


@query("op10_license_scan")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.digest(licenses.scan(table(spark, sf, "documents")))


@query("op7_quality_classifier")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    scored = quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query("op6_nearest_neighbours")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


@query("op8_lattice_lm")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return lm.score(table(spark, sf, "documents"))


@query("op1_spaced_seed_decontamination")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("rid")


@query("op13_merkle_manifest", merkle.MANIFEST_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.verify(table(spark, sf, "documents"))


@query("op12_virtual_slots", shards.SHARDS_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return shards.shard(table(spark, sf, "documents"))


@query("op11_zfast_trie", trie.TRIE_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return trie.trie(trie.with_shared_heads(trie.turn_lists(table(spark, sf, "conversations"))))
