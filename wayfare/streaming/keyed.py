"""Tables that a stream keeps up to date.

Each micro-batch writes its changed rows to a folder of its own, named by the batch id: a
batch that runs again after a failure replaces its folder, so no change counts twice. A
reader takes the latest row per key. The cost of a batch follows the number of
changed keys, not the size of the table. After so many batches a snapshot is taken; it bounds what
a reader goes through, and what it makes needless is removed, but for the snapshot before it
and what came since, from which a batch that is run again reads.

Spark marks a folder when all its files are in place. Readers pass over folders without the mark, so a
batch is seen whole or not at all.

Rows can be put into buckets by key, a folder each, so that a reader that needs a few keys opens their
buckets only. A key can be taken away: a row with the flag ``removed`` hides it until a later batch brings it
back, and a snapshot leaves it out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare.operators.tables import REMOVED, latest_per_key, without_removed

SNAPSHOT_EVERY = 100
BATCH = "batch"
BUCKET = "bucket"
# Spark's own mark of a folder that is complete.
FINISHED = "_SUCCESS"


# Up to so many keys are looked up by their values, more of them by a join.
FEW_KEYS = 100


class Keys:
    """Distinct keys to look up; a few of them are known to the driver and become a filter."""

    def __init__(self, frame: DataFrame):
        self.frame = frame.distinct()
        rows = self.frame.limit(FEW_KEYS + 1).collect()
        self.few = rows if len(rows) <= FEW_KEYS else None

    def among(self, rows: DataFrame) -> DataFrame:
        """The ``rows`` that have one of the keys, none of whose columns is null."""
        columns = self.frame.columns
        if self.few is None:
            return rows.join(self.frame, columns, "left_semi")
        if len(columns) == 1:
            return rows.filter(F.col(columns[0]).isin(*[self.value(key, columns[0]) for key in self.few]))
        equal = [reduce(and_, [F.col(c) == self.value(key, c) for c in columns]) for key in self.few]
        return rows.filter(reduce(or_, equal, F.lit(False)))

    def value(self, key: Row, column: str) -> Column:
        return F.lit(key[column]).cast(self.frame.schema[column].dataType)

    def in_buckets(self, columns: Sequence[str], buckets: int) -> Column:
        """Whether a row's bucket is that of a key; which ones these are is known before anything is read."""
        if self.few is None:
            # at most as many as there are buckets
            found = self.frame.select(bucket_of([F.col(c) for c in columns], buckets)).distinct().collect()
            return F.col(BUCKET).isin(*[r[0] for r in found])
        return F.col(BUCKET).isin(*[bucket_of([self.value(key, c) for c in columns], buckets) for key in self.few])


def bucket_of(key: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class KeyedTable:
    """Latest row per key, written by one stream and read by any session.

    Without keys it is a plain log, in which every row of every batch counts.
    ``partition_by`` names key columns that get a folder per value, ``buckets`` how many folders there are below,
    by all key columns or by ``bucket_by``. A schema with the flag ``removed`` lets rows take keys away; readers do not see the flag.
    """

    def __init__(
        self, path: str, schema: T.StructType, keys: Sequence[str],
        partition_by: Sequence[str] = (), snapshot_every: int = SNAPSHOT_EVERY, buckets: int = 0,
        bucket_by: Sequence[str] = (),
    ):
        self.path, self.schema, self.keys = path, schema, list(keys)
        self.partition_by, self.snapshot_every, self.buckets = list(partition_by), snapshot_every, buckets
        self.bucket_by = list(bucket_by or keys)
        self.removes = REMOVED in schema.names
        self.columns = [name for name in schema.names if name != REMOVED]

    def _batches(self, spark: SparkSession, name: str) -> list[int]:
        """The finished batches among the folders ``name``, of which there are at most two snapshots' worth."""
        path = self._path(spark, name)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        folders = [s.getPath() for s in files.listStatus(path) if s.getPath().getName().startswith(f"{BATCH}=")]
        new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(int(f.getName().split("=")[1]) for f in folders if files.exists(new(f, FINISHED)))

    def _path(self, spark: SparkSession, name: str):
        return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _rows(
        self, spark: SparkSession, name: str, batches: Sequence[int], only: Keys | None = None
    ) -> DataFrame:
        """(schema, batch) rows of finished batches, from the buckets of some keys only if given."""
        extra = [T.StructField(BATCH, T.LongType())] + ([T.StructField(BUCKET, T.IntegerType())] if self.buckets else [])
        schema = T.StructType(self.schema.fields + extra)
        columns = [*self.schema.names, BATCH]
        if not batches:
            return spark.createDataFrame([], schema).select(*columns)
        paths = [f"{self.path}/{name}/{BATCH}={batch}" for batch in batches]
        rows = spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*paths)
        if only is not None and self.buckets:
            rows = rows.filter(only.in_buckets(self.bucket_by, self.buckets))
        return rows.select(*columns)

    def _current(self, spark: SparkSession, before: int | None, only: Keys | None = None) -> DataFrame:
        """All rows that count, with their batches: the last snapshot and the changes after it."""
        def earlier(name: str) -> list[int]:
            return [b for b in self._batches(spark, name) if before is None or b < before]

        upto = earlier("snapshots")[-1:] if self.keys else []
        changes = [b for b in earlier("changes") if not upto or b > upto[0]]
        rows = self._rows(spark, "changes", changes, only)
        return self._rows(spark, "snapshots", upto, only).unionByName(rows) if upto else rows

    def read(
        self, spark: SparkSession, before: int | None = None, only: DataFrame | Keys | None = None
    ) -> DataFrame:
        """The table as it was ``before`` a batch, or as it is now; ``only`` the rows of the keys in that table.

        ``only`` has the columns that buckets go by, without nulls. For a table in buckets no others than
        those of the keys are read.
        """
        if isinstance(only, DataFrame):
            only = Keys(only.select(*self.bucket_by))
        rows = self._current(spark, before, only)
        if not self.keys:
            return rows.select(*self.columns)
        if only is not None:
            rows = only.among(rows)
        return self._latest(rows).select(*self.columns)

    def _latest(self, rows: DataFrame, hide: bool = True) -> DataFrame:
        latest = latest_per_key(rows, self.keys, [BATCH])
        return without_removed(latest) if hide and self.removes else latest

    def last_batch(self, spark: SparkSession, before: int | None = None) -> int | None:
        """The last finished batch, of those ``before`` one if given, if there is any."""
        batches = self._batches(spark, "changes") + self._batches(spark, "snapshots")
        return max((b for b in batches if before is None or b < before), default=None)

    def since(self, spark: SparkSession, after: int | None) -> DataFrame:
        """The latest rows of the keys that changed ``after`` a batch, removals among them with their flag.

        The cost follows the batches since then. Where changes from then on have been given up for a snapshot,
        every row counts as changed.
        """
        oldest = self._batches(spark, "snapshots")[:1] if self.keys else []
        if after is None or (oldest and after < oldest[0]):
            rows = self._current(spark, None)
        else:
            rows = self._rows(spark, "changes", [b for b in self._batches(spark, "changes") if b > after])
        if not self.keys:
            return rows.select(*self.schema.names)
        return self._latest(rows, hide=False).select(*self.schema.names)

    def write(self, changes: DataFrame, batch_id: int) -> None:
        """The changed rows of a batch; a key occurs at most once in them."""
        self._store(changes.select(*self.schema.names), "changes", batch_id)
        if not self.keys:
            return
        spark = changes.sparkSession
        taken = self._batches(spark, "snapshots")
        since = [b for b in self._batches(spark, "changes") if not taken or b > taken[-1]]
        if len(since) >= self.snapshot_every:
            self.take_snapshot(spark, batch_id)

    def _store(self, rows: DataFrame, name: str, batch_id: int) -> None:
        folders = list(self.partition_by)
        if self.buckets:
            rows = rows.withColumn(BUCKET, bucket_of([F.col(c) for c in self.bucket_by], self.buckets))
            folders.append(BUCKET)
        if self.keys:
            # few files of a good size, whatever the number of shuffle partitions
            rows = rows.hint("rebalance", *folders)
        writer = rows.write.mode("overwrite").partitionBy(*folders)
        writer.parquet(f"{self.path}/{name}/{BATCH}={batch_id}")

    def take_snapshot(self, spark: SparkSession, batch_id: int) -> None:
        rows = self.read(spark, before=batch_id + 1)
        if self.removes:
            rows = rows.withColumn(REMOVED, F.lit(False))
        self._store(rows.select(*self.schema.names), "snapshots", batch_id)
        kept = [b for b in self._batches(spark, "snapshots") if b < batch_id][-1:]
        for name in ("snapshots", "changes") if kept else ():
            for batch in self._batches(spark, name):
                if batch < kept[0] or (batch == kept[0] and name == "changes"):
                    self._remove(spark, f"{name}/{BATCH}={batch}")

    def _remove(self, spark: SparkSession, name: str) -> None:
        path = self._path(spark, name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
