"""What the physical plans have to look like, and whole results under skew."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tests.helpers import day
from tierstream import schemas
from tierstream.operators.curve import curve, ranks
from tierstream.operators.dedup import rows_and_days, rows_not_in
from tierstream.operators.joins import broadcast_if_small
from tierstream.operators.latest import newest_per_key
from tierstream.operators.merge import CUSTOMER_STATE, merge_effects
from tierstream.plans import shop, silver
from tierstream.plans.lake import Lake
from tierstream.session import pipeline_session, working_folder

FOLDER = "/root/testdata/sf0.001"


def plan(frame):
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)


def test_newest_row_is_cut_before_the_shuffle(spark):
    frame = shop.table(spark, FOLDER, "events").select("user_id", "ts", "event_id")
    text = plan(newest_per_key(frame, ["user_id"], "ts")).split("\n\n\n")[0]
    steps = re.findall(r"(WindowGroupLimit|Exchange)", text)
    assert steps == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


@pytest.mark.parametrize("name", [
    "parse_payload", "clean_keys", "extract_price", "order_subtotals", "order_lines_explode", "dedup_against_target",
    "latest_per_key", "latest_change_rank", "scd2_merge_keys", "country_enrich", "authors_stats_window", "countries_stats",
])
def test_no_python_and_no_cross_join(raw_spark, name):
    text = plan(contract.queries()[name](raw_spark, FOLDER))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", text)


def test_scans_read_only_the_columns_they_need(raw_spark):
    text = plan(contract.queries()["authors_stats_window"](raw_spark, FOLDER))
    read = re.findall(r"ReadSchema: struct<(.*)>", text)
    lineitem = next(columns for columns in read if "l_orderkey" in columns)
    assert "l_tax" not in lineitem and "l_shipdate" not in lineitem


def test_aggregates_combine_before_the_shuffle(raw_spark):
    for name in ("authors_stats_window", "countries_stats"):
        assert "partial_count" in plan(contract.queries()[name](raw_spark, FOLDER))


def test_insert_only_reads_the_days_of_the_batch(spark, tmp_path):
    """One order of 1970 among new ones costs one more day, not all days in between."""
    orders = Lake(spark, str(tmp_path)).create().orders
    stored = spark.range(400).select(
        F.col("id").cast("string").alias("order_id"),
        F.timestamp_seconds(F.col("id") * 86_400 * 40).alias("order_timestamp"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], schemas.ORDERS).schema[2:]],
    )
    orders.append(stored, "w", 0)
    orders.append(stored.filter("false"), "w", 1)
    orders.append(stored.filter("order_id = '7'").withColumn("order_timestamp", F.lit(None).cast("timestamp")), "w", 2)
    batch = stored.filter("order_id IN ('0', '399')").union(stored.filter("order_id = '399'").withColumn("order_id", F.lit("new")))
    count, days = rows_and_days(batch, "order_timestamp")
    assert (count, len(days)) == (3, 2)
    known = orders.read_days(days)
    scan = known._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*_month", scan)
    assert known._jdf.queryExecution().optimizedPlan().toString().count("order_timestamp#") >= 4  # two spans
    assert known.count() == 2 and known.select("_metadata.file_path").distinct().count() == 2
    many = rows_and_days(stored, "order_timestamp")[1]
    assert orders.read_days(many).count() == 400 and orders.read_days(many, spans=1).count() == 400
    assert orders.read_days([]).count() == 0
    new = rows_not_in(batch, known, ["order_id", "order_timestamp"])
    assert [r["order_id"] for r in new.collect()] == ["new"]
    assert orders.read().count() == 401


def test_each_message_is_parsed_once(spark, tmp_path):
    lake = Lake(spark, str(tmp_path)).create()
    messages = spark.createDataFrame([], schemas.ENVELOPE)
    for build in (silver.clean_books, silver.clean_orders, silver.clean_customers):
        text = build(messages)._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json") == 1
    text = silver.clean_orders(messages)._jdf.queryExecution().optimizedPlan().toString()
    # Unusable order ids go before the rows are dealt by them.
    assert text.index("Aggregate") < text.index("lower(order_id") and lake.orders.read().count() == 0


def test_a_filter_on_any_cluster_column_skips_files(spark, tmp_path):
    frame = spark.range(20_000).select(
        F.sha1(F.col("id").cast("string")).alias("a"), (F.hash("id") % 1000).cast("double").alias("b"),
        F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("c"),
    )
    place = curve(ranks(frame, ["a", "b", "c"]))
    laid = frame.withColumn("_curve", place).repartitionByRange(64, "_curve").sortWithinPartitions("_curve")
    laid.drop("_curve").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    spans = stored.groupBy("_metadata.file_path").agg(*[f(c).alias(f"{c}_{f.__name__}") for c in "abc" for f in (F.min, F.max)]).collect()
    some = frame.limit(1).first()
    assert len(spans) >= 60
    for c in "abc":
        hit = sum(s[f"{c}_min"] <= some[c] <= s[f"{c}_max"] for s in spans)
        assert hit <= len(spans) / 2
    empty = ranks(frame.filter("false"), ["a"])
    assert frame.select(curve(empty).alias("x")).distinct().count() == 1


def test_a_merge_leaves_the_table_where_it_lies(spark, tmp_path):
    """A small batch is broadcast to the target; only rows with its keys are shuffled or joined further."""
    spark.createDataFrame([], f"{schemas.CUSTOMERS}, id BIGINT").write.parquet(str(tmp_path / "t"))
    spark.range(1_000_000).select(F.col("id").cast("string").alias("customer_id")).write.parquet(str(tmp_path / "big"))
    target = spark.read.schema(f"{schemas.CUSTOMERS}, id BIGINT").parquet(str(tmp_path / "t"), str(tmp_path / "big"))
    batch = spark.createDataFrame([("1", day(1))], "customer_id STRING, row_time TIMESTAMP")
    source = batch.select(*[F.col(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name)
                            for f in target.drop("id").schema]).persist()
    source.count()
    text = plan(merge_effects(target, source, CUSTOMER_STATE, ["id"]))
    source.unpersist()
    assert "PushedFilters: [IsNotNull(customer_id)]" in text
    tree = text.split("\n\n\n")[0]
    above_scan = tree[: tree.index("Scan parquet")].splitlines()[-6:]
    assert any("BroadcastHashJoin LeftSemi" in line for line in above_scan)
    assert not any("Exchange" in line and "Broadcast" not in line for line in above_scan)


def test_lookup_is_broadcast_only_if_small(spark):
    small = spark.range(10)
    assert "ResolvedHint" in broadcast_if_small(small, 10)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(small, 9)._jdf.queryExecution().analyzed().toString()


def test_large_orders_are_split_without_losing_lines(spark, monkeypatch, tmp_path):
    """One order with a third of all lines, documents of at most twenty."""
    for name in ("orders", "lineitem"):
        shop.table(spark, FOLDER, name).createOrReplaceTempView(name)
    hot = spark.sql("SELECT * FROM lineitem").withColumn(
        "l_orderkey", F.when(F.pmod(F.hash("*"), F.lit(3)) == 0, 1).otherwise(F.col("l_orderkey"))
    )
    hot.write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.table("orders").write.parquet(str(tmp_path / "orders.parquet"))
    monkeypatch.setattr(shop, "LINES_PER_DOCUMENT", 20)
    documents = shop.order_documents(spark, str(tmp_path)).persist()
    assert documents.agg(F.max(F.size("books"))).first()[0] <= 20
    lines = documents.select(shop.order_number().alias("o"), F.explode("books").alias("b")).select("o", "b.book_id", "b.subtotal")
    wanted = hot.select(
        F.col("l_orderkey").cast("string").alias("o"), F.col("l_partkey").cast("string").alias("book_id"),
        shop.money(shop.cents("l_extendedprice")).alias("subtotal"),
    )
    assert lines.exceptAll(wanted).isEmpty() and wanted.exceptAll(lines).isEmpty()
    documents.unpersist()


def test_order_documents_do_not_depend_on_the_layout(spark, tmp_path):
    for name, files in (("one", 1), ("six", 6)):
        for table in ("orders", "lineitem"):
            rows = spark.read.parquet(f"{FOLDER}/{table}.parquet")
            rows.repartition(files).write.parquet(str(tmp_path / name / f"{table}.parquet"))
    one, six = (shop.order_documents(spark, str(tmp_path / name)) for name in ("one", "six"))
    assert one.exceptAll(six).isEmpty() and six.exceptAll(one).isEmpty()
    assert one.count() == spark.read.parquet(f"{FOLDER}/orders.parquet").count()


def test_settings(raw_spark):
    session = pipeline_session(raw_spark)
    assert session.conf.get("spark.sql.shuffle.partitions") == "2"
    base = raw_spark.conf.get("spark.checkpoint.dir")
    assert working_folder(session, "x").startswith(base)
    assert working_folder(session, "x") != working_folder(session, "x")


def test_entry(raw_spark):
    frame = contract.entry(raw_spark)
    assert frame.columns == ["window_start", "window_end", "author", "orders_count", "avg_quantity"]
    assert not frame.isEmpty()


def test_sql_parses():
    connection = duckdb.connect()
    for text in contract.oracle_sql().values():
        assert len(connection.extract_statements(text)) == 1
