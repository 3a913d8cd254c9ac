"""The country lookup: a small CSV file with a header."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tierstream import schemas
from tierstream.sources import files

_VERSION = "version="


def read_countries(spark: SparkSession, path: str) -> DataFrame:
    """Empty fields are null, the text ``NA`` stays text, quoted commas stay whole."""
    return spark.read.schema(schemas.COUNTRY_LOOKUP).option("header", True).csv(path)


def _versions(spark: SparkSession, table_path: str) -> list[str]:
    return [name for name in files.children(spark, table_path) if name.startswith(_VERSION)]


def loaded_countries(spark: SparkSession, table_path: str) -> DataFrame:
    """The lookup as last loaded; a folder written by other means is read as it is."""
    versions = _versions(spark, table_path)
    folder = f"{table_path}/{versions[-1]}" if versions else table_path
    return spark.read.schema(schemas.COUNTRY_LOOKUP).parquet(folder)


def load_countries(spark: SparkSession, csv_path: str, table_path: str, mode: str = "overwrite") -> None:
    """Write the lookup to its table; modes overwrite, append, error and ignore.

    Each load is a version of its own, published by one rename, and earlier ones stay: a
    stream that is reading the lookup never loses its files.
    """
    rows = read_countries(spark, csv_path)
    there = bool(files.children(spark, table_path))
    if mode not in ("overwrite", "append", "error", "ignore"):
        raise ValueError(f"unknown mode {mode}")
    if there and mode == "error":
        raise ValueError(f"{table_path} is already there")
    if there and mode == "ignore":
        return
    if there and mode == "append":
        rows = loaded_countries(spark, table_path).unionByName(rows)
    versions = _versions(spark, table_path)
    number = int(versions[-1].removeprefix(_VERSION)) + 1 if versions else 0
    staged = f"{table_path}/_staging/{uuid.uuid4().hex}"
    rows.write.parquet(staged)
    if not files.publish(spark, staged, f"{table_path}/{_VERSION}{number:012d}"):
        files.remove(spark, staged)
        raise RuntimeError(f"another load of {table_path} took version {number}")


def load_countries_table(spark: SparkSession, csv_path: str, table: str, mode: str = "overwrite") -> None:
    """The same into a catalog table."""
    read_countries(spark, csv_path).write.mode(mode).saveAsTable(table)
