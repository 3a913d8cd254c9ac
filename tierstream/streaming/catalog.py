"""Catalog databases and tables, and tables whose format has a native MERGE."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tierstream import schemas
from tierstream.operators.merge import Policy


@dataclass(frozen=True)
class Namespace:
    """A database, in two- or, with an environment, three-level naming."""

    database: str
    env: str | None = None

    def __str__(self) -> str:
        return f"{self.env}.{self.database}" if self.env else self.database

    def table(self, name: str) -> str:
        return f"{self}.{name}"


@dataclass(frozen=True)
class TableSpec:
    """What CREATE TABLE needs to know."""

    name: str
    schema: str
    cluster_by: tuple[str, ...] = ()
    change_feed: bool = False


# Topic tables are named as the ingest writes them.
BRONZE = (
    TableSpec("books", schemas.ENVELOPE),
    TableSpec("customers", schemas.ENVELOPE),
    TableSpec("orders", schemas.ENVELOPE),
    TableSpec("country_lookup", schemas.COUNTRY_LOOKUP),
)
SILVER = (
    TableSpec("silver_books", schemas.BOOKS),
    TableSpec("silver_customers", schemas.CUSTOMERS, change_feed=True),
    TableSpec("silver_orders", schemas.ORDERS, ("order_id", "order_timestamp")),
    TableSpec("silver_customers_orders", schemas.CUSTOMERS_ORDERS, ("order_id", "customer_id", "processed_timestamp")),
    TableSpec("silver_books_orders", schemas.BOOKS_ORDERS),
)
GOLD = (TableSpec("gold_authors_stats", schemas.AUTHORS_STATS),)


def create_database(spark: SparkSession, space: Namespace, location: str, managed: bool = False) -> None:
    """Create a database if absent and make it the current one.

    ``managed`` asks for a managed location, which only some catalogs know.
    """
    clause = "MANAGED LOCATION" if managed else "LOCATION"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {space} {clause} '{location}'")
    spark.sql(f"USE {space}")


def create_table(
    spark: SparkSession,
    space: Namespace,
    spec: TableSpec,
    table_format: str | None = None,
    feed_property: str = "delta.enableChangeDataFeed",
) -> None:
    """Create a table if absent, with clustering and change feed where the spec asks."""
    using = f" USING {table_format}" if table_format else ""
    cluster = f" CLUSTER BY ({', '.join(spec.cluster_by)})" if spec.cluster_by else ""
    feed = f" TBLPROPERTIES ('{feed_property}' = 'true')" if spec.change_feed else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {space.table(spec.name)} ({spec.schema}){using}{cluster}{feed}")


def create_tables(
    spark: SparkSession, space: Namespace, specs: tuple[TableSpec, ...], table_format: str | None = None
) -> None:
    """All tables of a layer. The database has to exist."""
    if not specs:
        raise ValueError("no tables to create")
    if not spark.catalog.databaseExists(str(space)):
        raise ValueError(f"database {space} does not exist; create it first")
    for spec in specs:
        create_table(spark, space, spec, table_format)


def set_up_layer(
    spark: SparkSession,
    space: Namespace,
    location: str,
    specs: tuple[TableSpec, ...],
    table_format: str | None = None,
    managed: bool = False,
) -> None:
    """Database, then tables."""
    create_database(spark, space, location, managed)
    create_tables(spark, space, specs, table_format)


def create_countries_view(spark: SparkSession, gold: Namespace, silver: Namespace) -> None:
    """Persistent view of orders per country and day."""
    spark.sql(
        f"""CREATE VIEW IF NOT EXISTS {gold.table('countries_stats_vw')} AS
            SELECT country, date_trunc('DD', order_timestamp) AS order_date,
                   count(order_id) AS orders_count, sum(quantity) AS total_books
            FROM {silver.table('silver_customers_orders')}
            GROUP BY country, date_trunc('DD', order_timestamp)"""
    )


@dataclass(frozen=True)
class CatalogTable:
    """A table whose format merges, streams and keeps a change feed by itself.

    Same calls as the Parquet tables. The format decides what a replayed batch
    does; the policies tolerate it as far as their conditions do.
    """

    spark: SparkSession
    name: str

    def create(self) -> CatalogTable:
        return self

    def read(self) -> DataFrame:
        return self.spark.read.table(self.name)

    def read_like(self, batch: DataFrame) -> DataFrame:
        """All rows: the format prunes files itself."""
        return self.read()

    def stream(self, **options: str) -> DataFrame:
        return self.spark.readStream.options(**options).table(self.name)

    @property
    def changes(self) -> CatalogFeed:
        return CatalogFeed(self.spark, self.name)

    def append(self, rows: DataFrame, writer: str, batch_id: int) -> bool:
        # The two options make formats that know them skip a batch written before.
        rows.write.option("txnAppId", writer).option("txnVersion", batch_id).mode("append").saveAsTable(self.name)
        return True

    def merge(self, source: DataFrame, policy: Policy, writer: str, batch_id: int) -> bool:
        view = f"batch_{uuid.uuid4().hex}"
        columns = self.spark.read.table(self.name).columns
        source.createOrReplaceTempView(view)
        try:
            source.sparkSession.sql(policy.to_sql(self.name, view, columns))
        finally:
            source.sparkSession.catalog.dropTempView(view)
        return True


@dataclass(frozen=True)
class CatalogFeed:
    """The change feed of a catalog table."""

    spark: SparkSession
    name: str

    def stream(self, **options: str) -> DataFrame:
        return self.spark.readStream.option("readChangeFeed", "true").options(**options).table(self.name)
