"""Current state in buckets of its key, for tables too large to shuffle at every read.

Batches and bases are stored alike: bucketed by the key and sorted within buckets. So the newest
version of each key is found, its row fetched and a fold written bucket by bucket, without a
shuffle. Versions, (ts_ms, offset), are compared first on the narrow key columns alone; whole rows are
read once and only picked, never sorted or aggregated.

Like ``state``, every micro-batch overwrites its own folder, folds are announced when complete,
and readers take the newest announced base and the batches after it. A fold then removes what only
older readers could still need: batches the base before it holds, and older bases. The
number of folders stays bounded, however long the stream runs.

Keys are primary keys: a change with a NULL in one belongs to no row and is left out.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake.operators.cdc import latest_changes
from txnlake.session import path_exists, remove_folder, subfolders
from txnlake.streaming.run import for_each_batch

FOLD_EVERY = 20
#: Buckets of a new state; about the input of one task each. An existing state keeps its own number.
BUCKETS = 64

_VERSION = ["ts_ms", "offset", "_folder"]


class KeyedState:
    """The changes of a table, with ``keys``, ts_ms, offset and is_delete, stored below ``root``."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), keys
        layout = f"{self.root}/layout"
        if path_exists(spark, layout):
            buckets = spark.read.schema("buckets int").parquet(layout).first()[0]
        else:
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(layout)
        self.buckets = buckets

    def store(self, changes: DataFrame, batch_id: int) -> None:
        """Keep the last change per key of a batch; a replay overwrites it."""
        last = latest_changes(changes.dropna(subset=self.keys), self.keys)
        self._write(last.repartition(self.buckets, *self.keys), "batch", batch_id)

    def newest(self, upto: int | None = None) -> DataFrame:
        """The last change of every key, deletes included, up to a batch."""
        every = self._every(upto)
        version = F.struct(*_VERSION)
        last = every.groupBy(*self.keys).agg(F.max(version).alias("_last"))
        # Not "==": the version would become a part of the join's key, which the buckets are not by.
        rows = every.join(last, self.keys).where(version >= F.col("_last"))
        return rows.drop("_last", "_folder")

    def read(self) -> DataFrame:
        """The live rows."""
        return self.newest().where(~F.col("is_delete"))

    def fold(self, upto: int) -> None:
        """Fold all up to a batch into a new base and remove what is no longer needed; run again, it
        changes nothing."""
        before = self._base(upto)
        if before == upto:
            return
        # Rows stand in their buckets already.
        self._write(self.newest(upto), "base", upto)
        announced = self.spark.createDataFrame([(upto,)], "upto bigint").coalesce(1)
        announced.write.mode("overwrite").parquet(f"{self.root}/folds/upto={upto}")
        if before is None:
            return
        for folder, last in (("rows/kind=batch", before), ("rows/kind=base", before - 1), ("folds", before - 1)):
            for number, path in subfolders(self.spark, f"{self.root}/{folder}").items():
                if number <= last:
                    remove_folder(self.spark, path)

    def _base(self, upto: int | None = None) -> int | None:
        """The newest base whose announcement is complete."""
        folds = subfolders(self.spark, f"{self.root}/folds")
        known = [n for n, path in folds.items() if path_exists(self.spark, f"{path}/_SUCCESS")]
        return max((n for n in known if upto is None or n <= upto), default=None)

    def _every(self, upto: int | None) -> DataFrame:
        base = self._base(upto)
        base = -1 if base is None else base
        later = (F.col("kind") == "batch") & (F.col("number") > base)
        if upto is not None:
            later &= F.col("number") <= upto
        rows = self._table().where(later | ((F.col("kind") == "base") & (F.col("number") == base)))
        return rows.withColumnRenamed("number", "_folder").drop("kind")

    def _path(self, kind: str, number: int) -> str:
        return f"{self.root}/rows/kind={kind}/number={number}"

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        # The catalogue only lends its notion of buckets: the name goes at once, the files stay.
        name = f"txnlake_{uuid.uuid4().hex}"
        writer = rows.write.mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        try:
            writer.option("path", self._path(kind, number)).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _table(self) -> DataFrame:
        """All folders as one bucketed table, registered anew, as folders come and go."""
        name = f"txnlake_state_{hashlib.sha256(self.root.encode()).hexdigest()[:32]}"
        fields = self.spark.read.parquet(f"{self.root}/rows").schema
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in fields if f.name not in ("kind", "number")
        )
        keys = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}, kind string, number bigint) USING parquet "
            f"PARTITIONED BY (kind, number) CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.root}/rows'"
        )
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return self.spark.table(name)


def start_keyed_state(
    changes: DataFrame,
    keys: list[str],
    root: str,
    checkpoint: str,
    every: str | None = None,
    fold_every: int = FOLD_EVERY,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep the last change per key of a stream; every ``fold_every`` batches are folded."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        state = KeyedState(batch.sparkSession, root, keys, buckets)
        state.store(batch, batch_id)
        if batch_id and batch_id % fold_every == 0:
            # This batch may yet be replayed; those before it are final.
            state.fold(batch_id - 1)

    return for_each_batch(changes, upsert, checkpoint, every)
