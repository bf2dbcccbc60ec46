"""Current state kept from a change stream.

Every micro-batch stores only the last change per key it saw, under its batch id; a replay
overwrites the same folder. From time to time the stream folds finished batches into a base,
which has a folder and a name of its own and is announced only when it is complete. Readers
fold the newest announced base and the batches after it, so neither a replayed batch nor a
fold that broke off can lose or hide a change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake.operators.cdc import current_state, latest_changes
from txnlake.session import path_exists
from txnlake.streaming.run import for_each_batch

FOLD_EVERY = 50


def start_state_sink(
    changes: DataFrame,
    keys: list[str],
    root: str,
    checkpoint: str,
    every: str | None = None,
    fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Keep the last change per key under ``root``; every ``fold_every`` batches are folded."""

    def upsert(batch: DataFrame, batch_id: int) -> None:
        _store(latest_changes(batch, keys), root, batch_id)
        if batch_id and batch_id % fold_every == 0:
            # This batch may yet be replayed; those before it are final.
            fold(batch.sparkSession, root, keys, batch_id - 1)

    return for_each_batch(changes, upsert, checkpoint, every)


def stored_changes(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """The newest base and the batches after it, up to batch ``upto``."""
    batches = spark.read.parquet(f"{root}/batches")
    if upto is not None:
        batches = batches.where(F.col("batch_id") <= upto)
    base = _newest_base(spark, root, upto)
    if base is None:
        return batches.drop("batch_id")
    later = batches.where(F.col("batch_id") > base).drop("batch_id")
    return later.unionByName(spark.read.parquet(f"{root}/bases/upto={base}"))


def read_state(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    return current_state(stored_changes(spark, root), keys)


def fold(spark: SparkSession, root: str, keys: list[str], upto: int) -> None:
    """Fold all up to batch ``upto`` into a new base; run again, it changes nothing.

    Deletes stay, so that a change delivered again cannot bring its row back.
    """
    if _newest_base(spark, root, upto) == upto:
        return
    latest_changes(stored_changes(spark, root, upto), keys).write.mode("overwrite").parquet(
        f"{root}/bases/upto={upto}"
    )
    announced = spark.createDataFrame([(upto,)], "upto bigint").coalesce(1)
    announced.write.mode("append").parquet(f"{root}/folds")


def _newest_base(spark: SparkSession, root: str, upto: int | None = None) -> int | None:
    if not path_exists(spark, f"{root}/folds"):
        return None
    folds = spark.read.schema("upto bigint").parquet(f"{root}/folds")
    if upto is not None:
        folds = folds.where(F.col("upto") <= upto)
    return folds.agg(F.max("upto")).first()[0]


def _store(changes: DataFrame, root: str, batch_id: int) -> None:
    changes.write.mode("overwrite").parquet(f"{root}/batches/batch_id={batch_id}")
