"""What handlers get, and what they need not do."""

from pyspark.sql import functions as F

from tests.helpers import day, rows
from tierstream.operators.latest import newest_with_ties as _newest_with_ties
from tierstream.plans import silver
from tierstream.plans.lake import Lake
from tierstream.sources import files
from tierstream.streaming.run import DRAIN, drain, for_each_batch


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_batch_used_twice_is_computed_once(spark, tmp_path):
    """A plan that holds the batch twice reads it twice; neither place goes back to the stream's state."""
    spark.range(20).selectExpr("id % 5 AS k", "id AS n").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k BIGINT, n BIGINT").parquet(f"{tmp_path}/in").dropDuplicates(["k"])
    seen = []

    def handle(batch, writer, batch_id):
        mates = batch.join(batch.select("k").distinct(), "k", "left_semi").persist()
        again = mates.join(batch.select(F.col("k").alias("other")), F.col("k") == F.col("other"))
        seen.append((again.count(), plan(again)))
        mates.unpersist()

    drain(for_each_batch(stream, handle, f"{tmp_path}/cp", "twice", DRAIN))
    [(count, text)] = [s for s in seen if s[0]]
    assert count == 5
    assert "ExistingRDD" not in text and "RocksDB" not in text
    assert files.children(spark, f"{tmp_path}/cp_batch") == []


def test_first_merge_needs_no_join(spark, tmp_path):
    lake = Lake(spark, str(tmp_path)).create()
    empty = lake.customers._rows()
    source = spark.range(3).selectExpr("CAST(id AS STRING) AS customer_id")
    joined = source.join(empty.select(F.col("customer_id").alias("c")), F.col("customer_id") == F.col("c"), "left")
    assert "Join" not in plan(joined)


def test_changes_of_one_commit_are_not_ranked(spark, tmp_path, monkeypatch):
    """Ranking by commit time is left out where a batch has one time, and only there."""
    ranked = []
    monkeypatch.setattr(
        silver, "newest_with_ties", lambda frame, keys, by: ranked.append(frame) or _newest_with_ties(frame, keys, by)
    )
    lake = Lake(spark, str(tmp_path)).create()
    schema = "order_id STRING, customer_id STRING, street STRING, _change_type STRING, _commit_version BIGINT, _commit_timestamp TIMESTAMP"
    handle = silver.upsert_customers_orders(lake, "joined")
    for batch_id, (times, calls) in enumerate([((1, 1), 0), ((2, 3), 1)]):
        batch = spark.createDataFrame(
            [("o", "c", "old", "insert", 0, day(times[0])), ("o2", "c", "new", "insert", 0, day(times[1]))], schema
        )
        handle(_whole(batch, lake, batch_id), "w", batch_id)
        assert len(ranked) == calls
    assert rows(lake.customers_orders.read(), "order_id") == [("o-0",), ("o-1",), ("o2-0",), ("o2-1",)]


def _whole(batch, lake, batch_id):
    """The missing columns as nulls, and ids of the batch's own."""
    from pyspark.sql.types import StructType

    fields = [f for f in StructType.fromDDL(lake.customers_orders.schema) if f.name not in (*batch.columns, "processed_timestamp")]
    extra = {f.name: F.lit(None).cast(f.dataType) for f in fields}
    return batch.withColumns(extra | {"order_id": F.concat("order_id", F.lit(f"-{batch_id}"))})


def test_stream_join_query_slices_hot_customers_only(raw_spark, monkeypatch):
    from tierstream.plans.queries import QUERIES

    slices, joined = [], silver.changes_with_orders
    monkeypatch.setattr(silver, "kept_hot_customers", lambda lake, checkpoint: ["7"])
    monkeypatch.setattr(
        silver, "changes_with_orders", lambda c, o, salts, within, hot: slices.append(hot) or joined(c, o, salts, within, hot)
    )
    found = QUERIES["customers_orders_stream_join"](raw_spark, "/root/testdata/sf0.001")
    assert slices == [["7"]] and found.count() > 0
