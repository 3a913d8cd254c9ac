"""The operators of this subpackage applied to whole tables, with the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstream.llm import (
    imatch, infill, katz, lines, packing, phrases, pieces, sharding, substring, superminhash, toxicity, transducer,
    vectors,
)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.repeated_spans(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    found = sharding.sharded(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.clean_lines(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.nearest(_table(spark, folder, "embeddings"))


def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, _table(spark, folder, "labels")))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def katz_scores(spark: SparkSession, folder: str) -> DataFrame:
    return katz.scored(_table(spark, folder, "documents"))


def imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.edited_fingerprints(_table(spark, folder, "documents"))


def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.near_duplicates(_table(spark, folder, "documents"))


def sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(_table(spark, folder, "documents"), PIECE_BPE)


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"), BYTE_BPE)


def streamed_ids(spark: SparkSession, folder: str) -> DataFrame:
    found = transducer.coded(_table(spark, folder, "documents"), BYTE_BPE)
    return found.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def filled_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    found = infill.transformed(_table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def collocations(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(_table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup,
    "op2_sharding": shards,
    "op3_line_dedup": line_dedup,
    "op4_nearest_vectors": nearest_vectors,
    "op5_toxicity": toxic_documents,
    "op6_katz": katz_scores,
    "op7_imatch": imatch_fingerprints,
    "op8_superminhash": near_duplicates,
    "op9_sentence_pieces": sentence_pieces,
    "op10_best_fit_packing": best_fit_packing,
    "op11_bpe_transducer": streamed_ids,
    "op12_infill": filled_in_middle,
    "op13_phrases": collocations,
}
