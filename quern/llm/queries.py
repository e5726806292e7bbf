"""The registered queries of this subpackage: thin digests of the operators' results, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, divergence, forest, licenses, mixing, pii, preferences, quality, runs, sharding, simhash, token_counts, vectors
from .common import read, written

WORD_BPE = "word_bpe_49k.json"


def op1_crf_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digests(pii.find_in(docs))


def op2_ngram_llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every whole text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.digests(quality.score(docs, quality.trusted_ids(read(spark, sf_dir, "labels"))))


def op3_subset_sum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.digests(mixing.mix(docs, keep_text=False))


SHARDS = sharding.Tree(24)


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of three regions; a 25th would open a region."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.place(docs, SHARDS).drop("text")
    return sharding.digests(sharding.number(written(placed, "placed")))


def op5_adaptive_scan_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vectors.nearest_neighbours(rows, rows.where("vec_id % 20 = 0").select("vec_id"))


def op6_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text of documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.digests(docs, public_tokenizers.path(WORD_BPE))


def op7_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as chosen, against itself with the last reply of the next."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = preferences.with_borrowed_reply(preferences.conversations(turns))
    return preferences.digests(preferences.format_pairs(pairs))


def op8_bpe_merge_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents encoded and decoded again, as digests."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path(WORD_BPE)
    return bpe.digests(bpe.round_trip(docs, path))


def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and detections of every whole text."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.digests(licenses.scan_documents(docs))


def op10_simhash_vp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = simhash.with_fingerprint(docs).select("doc_id", "fingerprint")
    return simhash.digests(simhash.grouped(coded))


def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every whole text, with repetitions planted in every tenth."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return runs.digests(runs.with_runs(docs, turn=runs.planted_turn(F.col("doc_id"))))


def op12_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over the four-word shingle sets of all documents."""
    return forest.digests(forest.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language part, and by which terms."""
    return divergence.audit(read(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES = {
    "op1_crf_personal_data": op1_crf_personal_data,
    "op2_ngram_llr_quality": op2_ngram_llr_quality,
    "op3_subset_sum_mix": op3_subset_sum_mix,
    "op4_hash_tree_shards": op4_hash_tree_shards,
    "op5_adaptive_scan_neighbours": op5_adaptive_scan_neighbours,
    "op6_pretoken_counts": op6_pretoken_counts,
    "op7_preference_pairs": op7_preference_pairs,
    "op8_bpe_merge_rounds": op8_bpe_merge_rounds,
    "op9_license_rules": op9_license_rules,
    "op10_simhash_vp_forest": op10_simhash_vp_forest,
    "op11_word_runs": op11_word_runs,
    "op12_lsh_forest": op12_lsh_forest,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES = {"op4_hash_tree_shards": sharding.oracle_sql(SHARDS), "op7_preference_pairs": preferences.ORACLE_SQL, "op12_lsh_forest": forest.ORACLE_SQL, "op13_source_divergence": divergence.ORACLE_SQL}
