"""Catalog databases, tables, views and the native MERGE text."""

import pytest
from pyspark.errors import AnalysisException, UnsupportedOperationException

from tests.helpers import day, rows
from tierstream import schemas
from tierstream.operators import merge
from tierstream.plans.bronze import ingest_topic
from tierstream.plans.lake import CatalogLake
from tierstream.sources import lookup
from tierstream.streaming import catalog
from tierstream.streaming.catalog import CatalogTable, Namespace
from tierstream.streaming.run import DRAIN, drain


def test_names():
    assert Namespace("silver").table("x") == "silver.x"
    assert Namespace("silver", "dev").table("x") == "dev.silver.x"


@pytest.fixture
def layers(spark, tmp_path):
    names = {}
    for layer, specs in (("bronze", catalog.BRONZE), ("silver", catalog.SILVER), ("gold", catalog.GOLD)):
        space = Namespace(layer)
        catalog.set_up_layer(spark, space, str(tmp_path / layer), specs, table_format="parquet")
        names[layer] = space
    yield names
    for layer in names:
        spark.sql(f"DROP DATABASE {layer} CASCADE")
    spark.sql("USE default")


def test_setup_creates_every_table_and_can_run_again(spark, layers, tmp_path):
    assert spark.catalog.currentDatabase() == "gold"
    tables = {t.name for layer in layers for t in spark.catalog.listTables(layer) if not t.isTemporary}
    assert tables == {
        "books", "customers", "orders", "country_lookup", "silver_books", "silver_customers", "silver_orders",
        "silver_customers_orders", "silver_books_orders", "gold_authors_stats",
    }
    catalog.set_up_layer(spark, layers["silver"], str(tmp_path / "silver"), catalog.SILVER, table_format="parquet")
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED silver.silver_orders").collect()}
    assert described["books"] == "array<struct<book_id:string,quantity:bigint,subtotal:bigint>>"
    create = spark.sql("SHOW CREATE TABLE silver.silver_customers").first()[0]
    assert "enableChangeDataFeed" in create
    assert "clusteringColumns" in spark.sql("SHOW CREATE TABLE silver.silver_orders").first()[0]


def test_setup_needs_tables_and_a_database(spark):
    with pytest.raises(ValueError):
        catalog.create_tables(spark, Namespace("default"), ())
    with pytest.raises(ValueError):
        catalog.create_tables(spark, Namespace("nowhere"), catalog.BRONZE)


def test_countries_view(spark, layers):
    catalog.create_countries_view(spark, layers["gold"], layers["silver"])
    assert spark.table("gold.countries_stats_vw").columns == ["country", "order_date", "orders_count", "total_books"]


def test_topic_into_a_catalog_table(spark, layers, tmp_path):
    inbox = str(tmp_path / "inbox")
    frame = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"v"), "books", 0, 1, day(1), 0)], schemas.ENVELOPE
    )
    frame.write.parquet(inbox)
    lake = CatalogLake(spark, str(tmp_path / "lake"))
    stream = spark.readStream.schema(schemas.ENVELOPE).parquet(inbox)
    drain(ingest_topic(lake, "books", stream, DRAIN))
    assert rows(spark.table("bronze.books"), "topic", "offset") == [("books", 1)]
    seen = lake.topic("books").writeStream.format("memory").queryName("topic_seen").trigger(availableNow=True).start()
    drain(seen)
    assert spark.table("topic_seen").count() == 1


def test_lookup_into_a_catalog_table(spark, layers, tmp_path):
    path = tmp_path / "countries.csv"
    path.write_text('calling_code,code,country\n+1-268,AG,Antigua\n,AQ,Antarctica\n264,NA,Namibia\n599,BQ,"Bonaire, Saba"\n')
    lookup.load_countries_table(spark, str(path), "bronze.country_lookup")
    lookup.load_countries_table(spark, str(path), "bronze.country_lookup")
    assert rows(spark.table("bronze.country_lookup")) == [
        (None, "AQ", "Antarctica"), ("+1-268", "AG", "Antigua"),
        ("264", "NA", "Namibia"), ("599", "BQ", "Bonaire, Saba"),
    ]
    with pytest.raises(AnalysisException):
        lookup.load_countries_table(spark, str(path), "bronze.country_lookup", mode="error")
    lookup.load_countries_table(spark, str(path), "bronze.country_lookup", mode="append")
    assert spark.table("bronze.country_lookup").count() == 8
    lookup.load_countries_table(spark, str(path), "bronze.country_lookup", mode="ignore")
    assert spark.table("bronze.country_lookup").count() == 8


@pytest.mark.parametrize(
    "table, policy, extra",
    [
        ("silver.silver_books", merge.BOOK_HISTORY, "CAST(NULL AS STRING) AS merge_key"),
        ("silver.silver_orders", merge.NEW_ORDERS, "1 AS more"),
        ("silver.silver_customers", merge.CUSTOMER_STATE, "1 AS more"),
        ("silver.silver_customers_orders", merge.CUSTOMER_ORDER_STATE, "1 AS more"),
        ("gold.gold_authors_stats", merge.AUTHOR_WINDOWS, "1 AS more"),
    ],
)
def test_merge_text_is_accepted_up_to_the_table_format(spark, layers, table, policy, extra):
    """Parquet tables refuse MERGE, but only after Spark has parsed and resolved it."""
    source = spark.table(table).selectExpr("*", extra)
    with pytest.raises(UnsupportedOperationException) as error:
        CatalogTable(spark, table).merge(source, policy, "w", 0)
    assert error.value.getCondition() == "UNSUPPORTED_FEATURE.TABLE_OPERATION"


def test_merge_text():
    text = merge.CUSTOMER_STATE.to_sql("silver.t", "batch", ["customer_id", "row_time"])
    assert text.splitlines() == [
        "MERGE INTO silver.t AS t USING batch AS s ON t.customer_id = s.customer_id",
        "WHEN MATCHED AND s.row_time > t.row_time AND s.row_status = 'update' THEN "
        "UPDATE SET t.customer_id = s.customer_id, t.row_time = s.row_time",
        "WHEN MATCHED AND s.row_time > t.row_time AND s.row_status = 'delete' THEN DELETE",
        "WHEN NOT MATCHED THEN INSERT (customer_id, row_time) VALUES (s.customer_id, s.row_time)",
    ]
