"""Tables on a plain Parquet folder, written by foreachBatch and safe to replay.

``AppendTable`` only grows and can be read as a stream. ``MergeTable`` is changed by
merge policies: a merge appends the effects of its batch, and the table is the newest
effect of each row. What is written is also the change feed, so table and feed are one
commit. A table format with a native MERGE does the same job: see
:mod:`tierstream.streaming.catalog`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierstream.operators.curve import curve, ranks
from tierstream.operators.latest import newest_per_key
from tierstream.operators.merge import MergeError, Policy, change_rows, merge_effects
from tierstream.sources import files

# A stored row's identity: the commit that inserted it, and its place there.
_ROW = ["_born", "_number"]
_EFFECT_COLUMNS = "_effect STRING, _version BIGINT, _at TIMESTAMP, _born BIGINT, _number BIGINT"
_BYTES_PER_BUCKET = 512 * 2**20


@dataclass(frozen=True)
class AppendTable:
    """A folder of batches, each published whole by one rename.

    With ``time``, a timestamp column, each batch lies in one folder per month (UTC), sorted
    by time, so that :meth:`read_days` lists the months of its days only and reads their row
    groups by the days' statistics. Folders per day would leave a backlog in thousands of
    files. ``cluster_by`` sorts rows of the same time.
    """

    spark: SparkSession
    path: str
    schema: str
    cluster_by: tuple[str, ...] = ()
    time: str | None = None

    def create(self) -> AppendTable:
        files.make_folder(self.spark, self.path)
        return self

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self.path)

    def stream(self, **options: str) -> DataFrame:
        reader = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", True)
        return reader.options(**options).parquet(self.path)

    def has(self, writer: str, batch_id: int) -> bool:
        return files.exists(self.spark, self._folder(writer, batch_id))

    def append(self, rows: DataFrame, writer: str, batch_id: int) -> bool:
        """Publish a batch; false, and nothing written, if it is already there."""
        if self.has(writer, batch_id):
            return False
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        order = list(self.cluster_by)
        if self.time:
            # Rebalancing writes a month by few tasks, and by several if it is large.
            rows = rows.withColumn("_month", F.date_trunc("month", self.time).cast("date")).hint("rebalance", "_month")
            order = ["_month", self.time, *order]
        if order:
            rows = rows.sortWithinPartitions(*order)
        write = rows.write.partitionBy("_month") if self.time else rows.write
        write.parquet(staged)
        published = files.publish(self.spark, staged, self._folder(writer, batch_id))
        if not published:
            files.remove(self.spark, staged)
        return published

    def read_days(self, days: list[date], spans: int = 16) -> DataFrame:
        """At least the rows of some days, and of other days only those in between: the days
        are taken as ``spans`` ranges, cut at the largest gaps. Rows without a time belong to
        no day."""
        rows = self.spark.read.schema(f"{self.schema}, batch STRING, _month DATE").parquet(self.path)
        if not days:
            return rows.filter("false").drop("batch", "_month")
        days = sorted(days)
        gaps = sorted(range(1, len(days)), key=lambda i: days[i] - days[i - 1], reverse=True)[: spans - 1]
        edges = [0, *sorted(gaps), len(days)]
        wanted = F.lit(False)
        for low, high in zip(edges, edges[1:]):
            first, last = (F.lit(d).cast("timestamp") for d in (days[low], days[high - 1] + timedelta(days=1)))
            wanted |= (F.col(self.time) >= first) & (F.col(self.time) < last)
        months = {d.replace(day=1) for d in days}
        return rows.filter(F.col("_month").isin(months) & wanted).drop("batch", "_month")

    def _folder(self, writer: str, batch_id: int) -> str:
        return f"{self.path}/batch={writer}-{batch_id:012d}"


@dataclass
class Commit:
    """What a commit says besides its rows: kept beside them, published by the same rename."""

    version: int = -1
    at: str = ""
    batches: dict[str, int] = field(default_factory=dict)  # writer -> its last batch


@dataclass(frozen=True)
class MergeTable:
    """A table changed by merge policies, one writer at a time.

    Each merge appends one folder of effects: the rows it inserted, changed or deleted, with
    the version, so its output follows the batch whatever the table's size. A row is known
    by the commit that inserted it and its place there, and its newest effect is its state.
    :meth:`rewrite_base` folds the effects so far into a base, from which reading goes on;
    a merge does so by itself every ``base_after`` commits.

    The base lies in hash buckets of ``bucket_by``, SQL expressions over the row that are
    equal whenever the match keys are; a merge reads the buckets of its batch only. Within a
    bucket, rows follow a curve through the ``cluster_by`` columns, so that a filter on any
    one of them skips files by their statistics. ``change_feed`` keeps the rows as they were before an update, too.
    """

    spark: SparkSession
    path: str
    schema: str
    bucket_by: tuple[str, ...]
    buckets: int | None = None
    change_feed: bool = False
    cluster_by: tuple[str, ...] = ()
    base_after: int = 100

    # -- reading ---------------------------------------------------------------

    def create(self) -> MergeTable:
        files.make_folder(self.spark, self._effects.path)
        return self

    @property
    def changes(self) -> ChangeFeed:
        """Change feed: all columns plus change type, version and commit time."""
        return ChangeFeed(self._effects, tuple(self._columns))

    @property
    def _effects(self) -> AppendTable:
        return AppendTable(self.spark, f"{self.path}/effects", f"{self.schema}, {_EFFECT_COLUMNS}")

    @property
    def _columns(self) -> list[str]:
        return StructType.fromDDL(self.schema).names

    def last_commit(self) -> Commit:
        versions = self._versions("effects")
        if not versions:
            return Commit()
        return Commit(**json.loads(files.read_text(self.spark, f"{self._folder('effects', versions[-1])}/_commit.json")))

    def read(self) -> DataFrame:
        """The current rows."""
        return self._rows().select(*self._columns)

    def read_like(self, batch: DataFrame) -> DataFrame:
        """The current rows that share the values of ``bucket_by`` with some row of a batch,
        which holds all columns these need."""
        keys = [F.expr(e).alias(f"_key{i}") for i, e in enumerate(self.bucket_by)]
        wanted = batch.select(*keys).distinct()
        rows = self._rows(self._touched(batch)).select("*", *keys)
        same = [rows[f"_key{i}"].eqNullSafe(wanted[f"_key{i}"]) for i in range(len(keys))]
        return rows.join(wanted, same, "left_semi").select(*self._columns)

    def _rows(self, buckets: list[int] | None = None) -> DataFrame:
        """The current rows with their identity: those of the base that nothing happened to
        since, and the newest effects."""
        bases, versions = self._versions("base"), self._versions("effects")
        if bases:
            versions = [v for v in versions if v > bases[-1]]
        reader = self.spark.read.schema(self._effects.schema)
        folders = [self._folder("effects", v) for v in versions]
        # Without effects the filter tells the optimizer that a first merge needs no join.
        nothing = self.spark.createDataFrame([], self._effects.schema).filter("false")
        effects = reader.parquet(*folders) if folders else nothing
        newest = effects.filter("_effect <> 'update_preimage'")
        if len(versions) > 1:
            newest = newest_per_key(newest, _ROW, "_version", ties=[])
        current = newest.filter("_effect <> 'delete'").select(*self._columns, *_ROW)
        if not bases:
            return current
        schema = f"{self.schema}, _born BIGINT, _number BIGINT, _bucket INT"
        base = self.spark.read.schema(schema).parquet(self._folder("base", bases[-1]))
        if buckets is not None:
            base = base.filter(F.col("_bucket").isin(buckets))
        base = base.drop("_bucket")
        if not versions:
            return base
        return base.join(newest.select(*_ROW), _ROW, "left_anti").select(*current.columns).unionByName(current)

    def _touched(self, batch: DataFrame) -> list[int] | None:
        """The base's buckets that a batch belongs to, at most one number each; none without a base."""
        bases = self._versions("base")
        if not bases:
            return None
        stored = json.loads(files.read_text(self.spark, f"{self._folder('base', bases[-1])}/_base.json"))
        return batch.agg(F.collect_set(self._bucket(stored["buckets"])).alias("found")).first()["found"]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.hash(*[F.expr(e) for e in self.bucket_by]), F.lit(buckets)).alias("_bucket")

    def _versions(self, kind: str) -> list[int]:
        names = files.children(self.spark, f"{self.path}/{kind}")
        return sorted(int(name.removeprefix("v=")) for name in names if name.startswith("v="))

    def _folder(self, kind: str, version: int) -> str:
        return f"{self.path}/{kind}/v={version:020d}"

    # -- writing ---------------------------------------------------------------

    def merge(self, source: DataFrame, policy: Policy, writer: str, batch_id: int) -> bool:
        """Apply a policy to a batch; false if this batch has been applied before.

        The effects are staged, checked, and count from the rename that publishes them
        together with the commit's own data: until then nothing has happened, so another
        batch may take the place of one that failed. A batch without effect is no commit.
        """
        last = self.last_commit()
        if batch_id <= last.batches.get(writer, -1):
            return False
        at = datetime.now(UTC)
        if last.at:
            at = max(at, datetime.fromisoformat(last.at) + timedelta(milliseconds=1))
        commit = Commit(last.version + 1, at.isoformat(), last.batches | {writer: batch_id})
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        source = source.persist()
        try:
            merged = merge_effects(self._rows(self._touched(source)), source, policy, _ROW)
            effects = change_rows(merged, _ROW, before=self.change_feed)
            effects.select(
                *self._columns, "_effect",
                F.lit(commit.version).cast("bigint").alias("_version"), F.lit(at).alias("_at"),
                F.coalesce("_born", F.lit(commit.version)).cast("bigint").alias("_born"),
                F.coalesce("_number", F.monotonically_increasing_id()).alias("_number"),
            ).write.parquet(staged)
        finally:
            source.unpersist()
        # Staged, so that the check is one small job over what was written.
        written = self.spark.read.schema(self._effects.schema).parquet(staged).filter("_effect <> 'update_preimage'")
        rows, most = written.groupBy(*_ROW).count().agg(F.count("*"), F.max("count")).first()
        if rows == 0 or most > 1:
            files.remove(self.spark, staged)
            if rows:
                raise MergeError("several source rows match and would change the same target row")
            return True
        self._publish(staged, commit)
        bases = self._versions("base")
        if commit.version - (bases[-1] if bases else -1) >= self.base_after:
            self.rewrite_base()
        return True

    def _publish(self, staged: str, commit: Commit) -> None:
        files.write_text(self.spark, f"{staged}/_commit.json", json.dumps(asdict(commit)))
        if not files.publish(self.spark, staged, self._folder("effects", commit.version)):
            raise RuntimeError(f"another writer has committed version {commit.version} of {self.path}")

    def rewrite_base(self, keep: int = 2) -> None:
        """Fold all effects so far into a new base, by one job; the change feed stays.

        Of older bases, the newest ``keep`` - 1 remain for readers that still use them.
        """
        version, bases = self.last_commit().version, self._versions("base")
        if version < 0 or (bases and bases[-1] == version):
            return
        later = [self._folder("effects", v) for v in self._versions("effects") if not bases or v > bases[-1]]
        size = sum(files.size(self.spark, path) for path in [*later, *[self._folder("base", b) for b in bases[-1:]]])
        buckets = self.buckets or -(-size // _BYTES_PER_BUCKET)
        staged = f"{self.path}/_staging/{uuid.uuid4().hex}"
        rows, place = self._rows().withColumn("_bucket", self._bucket(buckets)), F.lit(0)
        if self.cluster_by:
            place = curve(ranks(rows, list(self.cluster_by)))
        # Ranges of bucket and curve: an oversized bucket is several tasks' work and several files.
        rows = rows.withColumn("_curve", place).repartitionByRange("_bucket", "_curve")
        rows.sortWithinPartitions("_bucket", "_curve").drop("_curve").write.partitionBy("_bucket").parquet(staged)
        files.write_text(self.spark, f"{staged}/_base.json", json.dumps({"buckets": buckets}))
        if not files.publish(self.spark, staged, self._folder("base", version)):
            files.remove(self.spark, staged)
        for old in self._versions("base")[:-keep]:
            files.remove(self.spark, self._folder("base", old))


@dataclass(frozen=True)
class ChangeFeed:
    """The effects of a merged table under the names of a change feed."""

    effects: AppendTable
    columns: tuple[str, ...]

    def read(self) -> DataFrame:
        return self._named(self.effects.read())

    def stream(self, **options: str) -> DataFrame:
        return self._named(self.effects.stream(**options))

    def _named(self, rows: DataFrame) -> DataFrame:
        return rows.select(
            *self.columns, F.col("_effect").alias("_change_type"), F.col("_version").alias("_commit_version"),
            F.col("_at").alias("_commit_timestamp"),
        )
