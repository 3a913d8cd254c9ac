"""From raw documents to packed token sequences, in five stages.

Toxic documents go; boilerplate lines stay in one document; of near duplicates the smallest
doc_id stays; later copies of long passages go; what is left is packed. Each stage works on
what the one before kept and is written as Parquet before the next reads it.

All columns of documents, whatever their names, are carried to the last stage. Null texts are
empty to every stage and stay null. Rows that share a doc_id are one document to the
near-duplicate stage, which keeps one of them; rows without a doc_id are never linked there,
only equal texts among them fall together. The other stages take each row as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstream.llm import lines, packing, substring, superminhash, toxicity
from tierstream.llm.queries import BYTE_BPE
from tierstream.session import working_folder


def _with_text(found: DataFrame, columns: list[str], changed: Column, text: str) -> DataFrame:
    """The carried columns, with the new text and its length where it changed."""
    new = {
        "text": F.when(changed, F.col(text)).otherwise(F.col("rest.text")),
        "n_chars": F.when(changed, F.char_length(text).cast("long")),
    }
    if "n_chars" in columns:
        new["n_chars"] = new["n_chars"].otherwise(F.col("rest.n_chars"))
    return found.select(*(new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    others = [c for c in docs.columns if c != "text"]
    found = toxicity.scored(docs, model, carry=others, with_text=True).where("predicted = 0")
    return found.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = lines.clean_lines(docs, carry=docs.columns)
    return _with_text(found, docs.columns, F.col("n_dropped") > 0, "kept")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = superminhash.near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.where("doc_id IS NULL").dropDuplicates(["text"])
    return named.select(*docs.columns).unionByName(nameless)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = substring.repeated_spans(docs, carry=docs.columns)
    return _with_text(found, docs.columns, F.col("n_removed") > 0, "kept_words")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

# Tokenizing, the trained classifier and best-fit planning are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = working_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
