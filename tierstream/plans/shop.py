"""Messages of a bookshop, derived from the star-schema tables.

A part is a book (author: its brand), a nation a country, and an order with its
line items an order document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstream.plans.lake import Lake
from tierstream.sources import files
from tierstream.sources.topics import envelope, next_offset

# Lines that one order document holds at most: a message size, so the same at every data
# size. Orders up to it stay whole; larger ones become several documents with all lines.
LINES_PER_DOCUMENT = 10_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table, its zoneless times read as UTC."""
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    zoneless = [field.name for field in rows.schema if field.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same as a stream, whether the table is one file or a folder of files."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files.is_folder(spark, path):
        rows = reader.parquet(path)
    else:
        rows = reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    zoneless = [field.name for field in schema if field.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})


def text(column: str) -> Column:
    return F.col(column).cast("string")


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def money(amount: Column) -> Column:
    """Cents as text with a currency sign, two decimals."""
    whole, rest = F.floor(amount / 100), amount % 100
    return F.concat(F.lit("$"), whole.cast("string"), F.lit("."), F.lpad(rest.cast("string"), 2, "0"))


def at(moment: str) -> Column:
    return F.lit(moment).cast("timestamp")


def books(spark: SparkSession, folder: str, updated: str) -> DataFrame:
    """Book messages; ``p_partkey`` stays for choosing slices and is not sent."""
    return table(spark, folder, "part").select(
        text("p_partkey").alias("book_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("author"),
        money(cents("p_retailprice")).alias("price"),
        at(updated).alias("updated"),
        "p_partkey",
        cents("p_retailprice").alias("cents"),
    )


BOOK_FIELDS = ["book_id", "title", "author", "price", "updated"]


def customers(spark: SparkSession, folder: str, status: str, row_time: str) -> DataFrame:
    """Customer messages; ``c_custkey`` stays for choosing slices and is not sent."""
    return table(spark, folder, "customer").select(
        text("c_custkey").alias("customer_id"),
        F.concat(F.lower("c_name"), F.lit("@example.org")).alias("email"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_custkey") % 2 == 0, "f").otherwise("m").alias("gender"),
        F.concat(F.lit("Street "), (F.col("c_custkey") % 100).cast("string")).alias("street"),
        F.concat(F.lit("City "), text("c_nationkey")).alias("city"),
        text("c_nationkey").alias("country_code"),
        F.lit(status).alias("row_status"),
        at(row_time).alias("row_time"),
        "c_custkey",
    )


CUSTOMER_FIELDS = [
    "customer_id", "email", "first_name", "last_name", "gender",
    "street", "city", "country_code", "row_status", "row_time",
]


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.concat(F.lit("+"), text("n_nationkey")).alias("calling_code"),
        text("n_nationkey").alias("code"),
        F.col("n_name").alias("country"),
    )


def order_time() -> Column:
    """The order's day with a time of day taken from its number."""
    return F.timestamp_seconds(F.unix_seconds("o_orderdate") + F.col("o_orderkey") % 86400)


def order_quantity() -> Column:
    return F.col("o_orderkey") % 9 + 1


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """One-line order messages straight from the order table, without a shuffle."""
    total = money(cents("o_totalprice"))
    line = F.struct(
        (F.col("o_orderkey") % 100).cast("string").alias("book_id"),
        order_quantity().alias("quantity"),
        total.alias("subtotal"),
    )
    return table(spark, folder, "orders").select(
        text("o_orderkey").alias("order_id"),
        order_time().alias("order_timestamp"),
        text("o_custkey").alias("customer_id"),
        order_quantity().alias("quantity"),
        total.alias("total"),
        F.array(line).alias("books"),
        "o_orderkey",
    )


ORDER_FIELDS = ["order_id", "order_timestamp", "customer_id", "quantity", "total", "books"]


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their line items nested; orders without lines have an empty array.

    Lines of a large order are dealt by their content, so documents do not depend on how
    the table is stored. ``order_number`` undoes the split in the id.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        F.struct(
            "l_partkey",
            F.col("l_quantity").cast("bigint").alias("quantity"),
            cents("l_extendedprice").alias("cents"),
        ).alias("line"),
    )
    # Only orders that need a split are joined back: few rows, which Spark broadcasts if they are.
    heavy = lines.groupBy("l_orderkey").agg(F.count("*").alias("n")).where(F.col("n") > LINES_PER_DOCUMENT).select(
        "l_orderkey", F.ceil(F.col("n") / LINES_PER_DOCUMENT).alias("parts")
    )
    nested = (
        lines.join(heavy, "l_orderkey", "left")
        .groupBy("l_orderkey", F.pmod(F.xxhash64("line"), F.coalesce("parts", F.lit(1))).alias("part"))
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )
    # A part that chance or equal lines made larger than a document is cut once more.
    cuts = F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / LINES_PER_DOCUMENT).cast("int"))
    nested = nested.select("l_orderkey", "part", "lines", F.explode(cuts).alias("cut")).select(
        "l_orderkey",
        F.concat_ws("-", "part", "cut").alias("part"),
        F.slice("lines", F.col("cut") * LINES_PER_DOCUMENT + 1, LINES_PER_DOCUMENT).alias("lines"),
    )
    header = table(spark, folder, "orders")
    documents = header.join(nested, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey").withColumns(
        {
            "part": F.coalesce("part", F.lit("0-0")),
            "lines": F.coalesce("lines", F.array().cast(nested.schema["lines"].dataType)),
        }
    )
    as_text = F.transform(
        "lines",
        lambda line: F.struct(
            line["l_partkey"].cast("string").alias("book_id"),
            line["quantity"].alias("quantity"),
            money(line["cents"]).alias("subtotal"),
        ),
    )
    return documents.select(
        F.concat_ws("/", text("o_orderkey"), "part").alias("order_id"),
        order_time().alias("order_timestamp"),
        text("o_custkey").alias("customer_id"),
        order_quantity().alias("quantity"),
        money(cents("o_totalprice")).alias("total"),
        as_text.alias("books"),
    )


def order_number(order_id: str = "order_id") -> Column:
    return F.substring_index(order_id, "/", 1)


def send(lake: Lake, topic: str, documents: DataFrame, key: str) -> None:
    """Put documents into a bronze table as a topic's next messages."""
    messages = documents.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"))
    path = lake.path("bronze", topic)
    envelope(messages, topic, next_offset(lake.spark, path)).write.mode("append").parquet(path)
