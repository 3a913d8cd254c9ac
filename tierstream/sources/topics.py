"""Message topics: live from Kafka, or from Parquet folders of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstream import schemas
from tierstream.sources import files


def kafka_options(servers: str, user: str, password: str) -> dict[str, str]:
    """Connection options for a broker with SASL_SSL and a plain login."""
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": f"{login} required username='{user}' password='{password}';",
    }


def kafka_topic(spark: SparkSession, topic: str, connection: dict[str, str], **options: str) -> DataFrame:
    """A topic as a stream from its earliest message. Needs Spark's Kafka connector."""
    reading = {"subscribe": topic, "startingOffsets": "earliest", "failOnDataLoss": "false", **options}
    return spark.readStream.format("kafka").options(**connection, **reading).load()


def folder_topic(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """A topic as a stream over a folder of envelope-shaped Parquet files."""
    reader = spark.readStream.schema(schemas.ENVELOPE).option("recursiveFileLookup", True)
    return reader.options(**options).parquet(path)


def to_envelope(lines: DataFrame, key_column: str, topic: str, count: int = 0, first_offset: int = 0) -> DataFrame:
    """JSON lines (column ``value``) as keyed messages; ``count`` 0 takes all of them."""
    if count > 0:
        lines = lines.limit(count)
    key = F.get_json_object("value", f"$.{key_column}")
    return envelope(lines.select(key.alias("key"), "value"), topic, first_offset)


def next_offset(spark: SparkSession, path: str) -> int:
    """The first offset that no message of a folder topic has, in any partition."""
    if not files.exists(spark, path):
        return 0
    highest = spark.read.schema(schemas.ENVELOPE).option("recursiveFileLookup", True).parquet(path).agg(F.max("offset"))
    found = highest.first()[0]
    return 0 if found is None else found + 1


def envelope(messages: DataFrame, topic: str, first_offset: int = 0) -> DataFrame:
    """Key and value texts in the shape of a topic's messages."""
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.spark_partition_id().alias("partition"),
        # Unique and rising within a partition, not gapless: that would need one task.
        (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) + first_offset).alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def publish(spark: SparkSession, json_path: str, key_column: str, topic: str, path: str, count: int = 0) -> None:
    """Append a JSON-lines file to a folder topic."""
    first = next_offset(spark, path)
    to_envelope(spark.read.text(json_path), key_column, topic, count, first).write.mode("append").parquet(path)


def publish_to_kafka(
    spark: SparkSession, json_path: str, key_column: str, topic: str, connection: dict[str, str], count: int = 0
) -> None:
    """Send a JSON-lines file to a Kafka topic. Needs Spark's Kafka connector."""
    messages = to_envelope(spark.read.text(json_path), key_column, topic, count)
    messages.select("key", "value", "topic").write.format("kafka").options(**connection).save()
