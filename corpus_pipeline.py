"""The corpus pipeline: documents in, token digests of the clean documents out.

Each stage gets what its predecessor kept, as a table that was written and reread.
All but the last return the columns of documents:

1. quality: the byte network scores every text; rows below 0.5 go. Trained on
   labelled rows that are not held out.
2. near_duplicates: of each component of near copies (80 percent of shingles) one row
   stays, the one with the smallest doc_id (nulls last, then any one of its rows). Rows
   are judged one by one: a doc_id may repeat, with other or the same text, or be null.
   Rows without words are copies of nothing and stay.
3. decontamination: rows of which a benchmark item is covered by half go.
4. secrets: every span found is replaced by [REDACTED], and n_chars follows the
   new text. No row goes.
5. tokens: doc_id, n_tokens and digests of ids and decoded text.

Null and empty texts pass all stages as they are (if the network keeps them); an
empty table stays empty. Extra columns pass through to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reconlake.llm import op5_minhash, op7_tiling, op8_quality, op9_bpe, op10_secrets
from reconlake.llm.store import bounded_batches, free_name, table, written
from reconlake.session import scratch_path

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    model = op8_quality.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    return op8_quality.with_score(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    row = free_name(docs, "row")
    rows = written(spark, "pipeline-rows", docs.withColumn(row, F.monotonically_increasing_id()))
    found = op5_minhash.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), percent=80).select(
        F.col("doc_id").alias(row), "component_id")
    placed = written(spark, "pipeline-components", found.join(rows.select(row, "doc_id"), row))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row)).alias("least")
    kept = placed.groupBy("component_id").agg(least).select(F.col(f"least.{row}").alias(row))
    copies = placed.join(kept, row, "left_anti").select(row)
    return rows.join(copies, row, "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op7_tiling.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ledger = op10_secrets.BlobLedger(spark, scratch_path(spark, "pipeline-ledger"))
    blob, found = free_name(docs, "blob"), free_name(docs, "found")
    spans_of = ledger.scan(docs).where(F.size("spans") > 0).groupBy(F.col("blob").alias(blob)).agg(
        F.first("spans").alias(found))
    marked = docs.withColumn(blob, op10_secrets.address(F.col("text"))).join(spans_of, blob, "left")
    hit = F.col(found).isNotNull()
    clean = marked.withColumn("text", F.when(hit, op10_secrets.redacted(F.col("text"), F.col(found)))
                              .otherwise(F.col("text")))
    clean = clean.withColumn("n_chars", F.when(hit, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return op9_bpe.encoding_digests(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

# the network of the first stage is beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, f"pipeline-{name}", stage(spark, docs, sf_dir))
    return docs
