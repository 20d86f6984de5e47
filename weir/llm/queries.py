"""The queries of this subpackage: each applies one operator to a whole given table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import (
    bpe,
    centroids,
    chat,
    fingerprints,
    merkle,
    mixing,
    pieces,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)
from weir.llm.common import keep, read_table

#: SimHash near-duplicates: words in a shingle and the largest number of differing bits.
SIMHASH_WORDS, SIMHASH_BITS = 4, 4
SHARDS = 16
#: Context limits that are answered whether or not a document has that length.
CONTEXT_LIMITS = [1 << n for n in range(7, 18)]
#: Tokenizer files; small, and sent to the executors with the code that uses them.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document, with its source's target."""
    sized = keep(mixing.sizes(read_table(spark, sf_dir, "documents")), "mix-sizes")
    return mixing.copies(sized).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation as each participant's dialogue renders and masks it."""
    return chat.rotate(read_table(spark, sf_dir, "conversations"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the strings of 400 bytes that start anywhere else too."""
    return suffix_dedup.removal_digests(read_table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; shards have near equal bytes."""
    placed = sharding.shards(read_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's fingerprint, and its likeness to the edited text's and the next document's."""
    return fingerprints.compare_with_next(read_table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of encoded lengths with what holds at each length, and at usual limits, as the context limit."""
    texts = read_table(spark, sf_dir, "documents").select("text")
    lengths = token_counts.token_lengths(texts, token_counts.read_ranks(BYTE_BPE), public_tokenizers.PATTERN)
    return token_counts.context_table(keep(token_counts.histogram(lengths), "token-histogram"), CONTEXT_LIMITS)


def op7_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids and of the text they decode to."""
    return bpe.encode_digests(read_table(spark, sf_dir, "documents"), bpe.read_definition(WORD_BPE))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of each document under SimHash links."""
    docs = read_table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, SIMHASH_WORDS, SIMHASH_BITS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the adaptive rules for each document."""
    judged = quality.judge(read_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "failed_rule")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, by a model fitted on labelled documents."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit_sample(docs, labels))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's piece ids, begin and end included, and of the text they decode to."""
    return pieces.encode_digests(read_table(spark, sf_dir, "documents"), pieces.read_model(PIECE_BPE))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's digest, roots and proof, and whether its tampered self still proves the root."""
    return merkle.manifest(read_table(spark, sf_dir, "documents")).verify()


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster and distance, the inertias and the digest of its centroid."""
    return centroids.cluster(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of this subpackage by name."""
    found = (
        op1_mixing,
        op2_chat_formatting,
        op3_suffix_array_dedup,
        op4_sharding,
        op5_fingerprints,
        op6_token_counts,
        op7_bpe_encoding,
        op8_simhash_near_dedup,
        op9_quality_rules,
        op10_toxicity,
        op11_sentencepiece,
        op12_merkle_manifest,
        op13_centroid_clustering,
        pipeline,
    )
    return {query.__name__: query for query in found}
