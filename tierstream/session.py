"""Session settings and the shared working folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Spark's own default; a session that still shows it has chosen nothing.
_UNSET_SHUFFLE_PARTITIONS = "200"


def pipeline_session(spark: SparkSession) -> SparkSession:
    """A session on the same application with the settings the jobs rely on.

    The caller's session is left alone. A shuffle partition count the caller chose is
    kept; choose it for the full data, because streaming state fixes the number at its
    first start. Otherwise it is at least the number of cores, locally exactly that.
    """
    session = spark.newSession()
    settings = {
        "spark.sql.shuffle.partitions": _shuffle_partitions(spark),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # State outgrows executor heap; keep it off-heap and upload only deltas.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # One store per stream join and partition where the older layout has four.
        "spark.sql.streaming.join.stateFormatVersion": "3",
        # Counting all state rows needs an extra lookup on every write.
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    }
    for key, value in settings.items():
        session.conf.set(key, value)
    return session


def _shuffle_partitions(spark: SparkSession) -> str:
    chosen = spark.conf.get("spark.sql.shuffle.partitions")
    cores = spark.sparkContext.defaultParallelism
    if chosen != _UNSET_SHUFFLE_PARTITIONS:
        return chosen
    return str(cores if _is_local(spark) else max(cores, int(chosen)))


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


@contextlib.contextmanager
def adaptive(session: SparkSession) -> Iterator[None]:
    """Adaptive execution for the batch jobs inside a foreachBatch callback.

    Streams run with it switched off, which would leave the callback's joins
    without skew splitting. The stream's own plan has already been built here.
    """
    key = "spark.sql.adaptive.enabled"
    before = session.conf.get(key)
    session.conf.set(key, "true")
    try:
        yield
    finally:
        session.conf.set(key, before)


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder all executors can reach, under ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        base = tempfile.mkdtemp(prefix="tierstream-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
