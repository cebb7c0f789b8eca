"""The registered queries of the dealt operators, and their DuckDB SQL.

Each query applies its operator to the whole table and derives the digest
columns that the query's contract names."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reconlake.llm import (
    op1_crf,
    op2_repeats,
    op3_chat,
    op4_pii,
    op5_minhash,
    op6_voronoi,
    op7_tiling,
    op8_quality,
    op9_bpe,
    op10_secrets,
    op11_align,
    op12_search,
    op13_pieces,
)
from reconlake.llm.oracles import ORACLES  # noqa: F401
from reconlake.llm.store import bounded_batches, table
from reconlake.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op1_crf.main_text(table(spark, sf_dir, "pages"))


def op2_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark, "4m")
    return op2_repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op3_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings."""
    bounded_batches(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)],
                                  "conv_id long, turn long, role string, text string")
    return op3_chat.conversation_digests(op3_chat.format_turns(turns.unionByName(extra)))


def op4_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_pii.digest(op4_pii.personal_data(table(spark, sf_dir, "documents")))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op5_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op6_voronoi.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op7_tiling.coverage(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op8_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op9_bpe.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = op10_secrets.BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    return op10_secrets.digest(ledger.scan(table(spark, sf_dir, "documents")))


def op11_aligned_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op11_align.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTES),
                                public_tokenizers.path(PIECES))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    index = op12_search.build_index(table(spark, sf_dir, "documents"))
    return op12_search.search(index, table(spark, sf_dir, "benchmark"), k=50)


def op13_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op13_pieces.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


QUERIES = {
    "op1_html_crf": op1_html_crf,
    "op2_repeated_bytes": op2_repeated_bytes,
    "op3_chat_parts": op3_chat_parts,
    "op4_contextual_pii": op4_contextual_pii,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_voronoi_top_k": op6_voronoi_top_k,
    "op7_string_tiling": op7_string_tiling,
    "op8_quality_network": op8_quality_network,
    "op9_bpe_chunks": op9_bpe_chunks,
    "op10_secret_ledger": op10_secret_ledger,
    "op11_aligned_tokens": op11_aligned_tokens,
    "op12_ranked_search": op12_ranked_search,
    "op13_piece_rounds": op13_piece_rounds,
}
