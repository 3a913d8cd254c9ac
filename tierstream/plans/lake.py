"""Where the tables of a pipeline live."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tierstream import schemas
from tierstream.sources.lookup import loaded_countries
from tierstream.streaming.catalog import CatalogTable, Namespace
from tierstream.streaming.metrics import metrics_table
from tierstream.streaming.tables import AppendTable, MergeTable


@dataclass(frozen=True)
class Lake:
    """All tables as Parquet folders under ``root``.

    ``buckets`` is the number of hash buckets in which the base of a merged table lies, by
    default one per 512 MB at each rewrite. ``pace`` holds source options for every stream over
    these tables, such as ``maxBytesPerTrigger``: without one, a stream that starts on a
    backlog takes all of it as its first batch.
    """

    spark: SparkSession
    root: str
    checkpoint_root: str | None = None
    env: str | None = None
    buckets: int | None = None
    pace: dict[str, str] = field(default_factory=dict)

    def path(self, layer: str, name: str) -> str:
        base = f"{self.root}/{self.env}" if self.env else self.root
        return f"{base}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.checkpoint_root or self.root + '/_checkpoints'}/{layer}/{name}_cp"

    def create(self) -> Lake:
        """Make all folders, so that streams can start before their sources have data."""
        for table in (self.books, self.customers, self.orders, self.customers_orders,
                      self.books_orders, self.authors_stats, self.metrics):
            table.create()
        return self

    def topic(self, name: str) -> DataFrame:
        """A bronze topic table as a stream."""
        return self.spark.readStream.schema(schemas.ENVELOPE).options(**self.pace).parquet(self.path("bronze", name))

    @property
    def country_lookup(self) -> DataFrame:
        return loaded_countries(self.spark, self.path("bronze", "country_lookup"))

    @property
    def books(self) -> MergeTable:
        # The part before a bar decides the bucket: rows with equal fingerprints then
        # share one even if a title holds a bar.
        return MergeTable(
            self.spark, self.path("silver", "silver_books"), schemas.BOOKS,
            bucket_by=("substring_index(book_id, '|', 1)",), buckets=self.buckets, cluster_by=("current", "book_id"),
        )

    @property
    def customers(self) -> MergeTable:
        return MergeTable(
            self.spark, self.path("silver", "silver_customers"), schemas.CUSTOMERS,
            bucket_by=("customer_id",), buckets=self.buckets, change_feed=True,
        )

    @property
    def orders(self) -> AppendTable:
        return AppendTable(
            self.spark, self.path("silver", "silver_orders"), schemas.ORDERS,
            cluster_by=("order_id",), time="order_timestamp",
        )

    @property
    def customers_orders(self) -> MergeTable:
        return MergeTable(
            self.spark, self.path("silver", "silver_customers_orders"), schemas.CUSTOMERS_ORDERS,
            # A changed customer touches one bucket, however many orders it has.
            bucket_by=("customer_id",), buckets=self.buckets,
            cluster_by=("order_id", "customer_id", "processed_timestamp"),
        )

    @property
    def books_orders(self) -> AppendTable:
        return AppendTable(self.spark, self.path("silver", "silver_books_orders"), schemas.BOOKS_ORDERS)

    @property
    def authors_stats(self) -> MergeTable:
        return MergeTable(
            self.spark, self.path("gold", "gold_authors_stats"), schemas.AUTHORS_STATS,
            # Open windows are recent: a batch touches the buckets of a few hours.
            bucket_by=("date_trunc('HOUR', time.start)",), buckets=self.buckets,
        )

    @property
    def metrics(self) -> AppendTable:
        return metrics_table(self.spark, self.path("metrics", "batch_metrics"))


@dataclass(frozen=True)
class CatalogLake(Lake):
    """The same tables in a catalog whose table format has MERGE and a change feed.

    ``root`` holds the metrics and, without ``checkpoint_root``, the checkpoints.
    """

    def _table(self, layer: str, name: str) -> CatalogTable:
        return CatalogTable(self.spark, Namespace(layer, self.env).table(name))

    def topic(self, name: str) -> DataFrame:
        return self._table("bronze", name).stream(**self.pace)

    @property
    def country_lookup(self) -> DataFrame:
        return self._table("bronze", "country_lookup").read()

    @property
    def books(self) -> CatalogTable:
        return self._table("silver", "silver_books")

    @property
    def customers(self) -> CatalogTable:
        return self._table("silver", "silver_customers")

    @property
    def orders(self) -> CatalogTable:
        return self._table("silver", "silver_orders")

    @property
    def customers_orders(self) -> CatalogTable:
        return self._table("silver", "silver_customers_orders")

    @property
    def books_orders(self) -> CatalogTable:
        return self._table("silver", "silver_books_orders")

    @property
    def authors_stats(self) -> CatalogTable:
        return self._table("gold", "gold_authors_stats")


