"""Snapshot and high-water-mark reads of the source tables, and their load state."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.operators.cdc import envelope_text
from txnlake.schemas import PRIMARY_KEYS, WATERMARK_COLUMN, polled_tables
from txnlake.sources.tables import Tables, values_table

# Where polled messages go, and the state log: one row per finished or reset table.
POLL_PREFIX = "pg"
STATE_DDL = (
    "table_name string, status string, n_rows bigint, completed_at timestamp, offset bigint"
)
Marks = Mapping[str, datetime] | datetime


def _mark(marks: Marks, table: str) -> datetime:
    return marks[table] if isinstance(marks, Mapping) else marks


def snapshot(df: DataFrame) -> DataFrame:
    """Every row as a snapshot read.

    The scan is already split by files (or by key range over JDBC), so rows come in
    parallel; there is no paging.
    """
    return df.withColumn("op", F.lit("r"))


def snapshot_keys(tables: Tables) -> DataFrame:
    """``table_name, pk, op`` of a full load of all tables."""
    return _union(
        snapshot(df).select(
            F.lit(name).alias("table_name"), F.col(PRIMARY_KEYS[name]).cast("bigint").alias("pk"), "op"
        )
        for name, df in tables.items()
    )


def poll(df: DataFrame, high_water: object, column: str = WATERMARK_COLUMN) -> DataFrame:
    """Rows strictly newer than the high-water mark; the filter reaches the scan."""
    return df.where(F.col(column) > F.lit(high_water)).withColumn("op", F.lit("c"))


def poll_all(tables: Tables, marks: Marks) -> DataFrame:
    """``table_name, pk, op, created_at`` of one poll of every table that can be followed."""
    return _union(
        poll(tables[name], _mark(marks, name)).select(
            F.lit(name).alias("table_name"),
            F.col(PRIMARY_KEYS[name]).cast("bigint").alias("pk"),
            "op",
            WATERMARK_COLUMN,
        )
        for name in polled_tables()
        if name in tables
    )


def new_high_water(tables: Tables, marks: Marks) -> DataFrame:
    """Per table, rows found by a poll and the mark for the next; no rows keep the mark."""

    def one(name: str) -> DataFrame:
        return (
            poll(tables[name], _mark(marks, name))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.max(WATERMARK_COLUMN).alias("newest"))
            .select(
                F.lit(name).alias("table_name"),
                "n_rows",
                F.coalesce("newest", F.lit(_mark(marks, name))).alias("high_water"),
            )
        )

    return _union(one(name) for name in polled_tables() if name in tables)


def table_list(spark: SparkSession) -> DataFrame:
    return values_table(spark, [(name,) for name in PRIMARY_KEYS], "table_name string")


def pending_tables(catalogue: DataFrame, state: DataFrame) -> DataFrame:
    """Tables still to load: their latest state message is not ``completed``.

    ``state`` holds ``table_name, status, offset``; a ``reset`` undoes a completion.
    """
    latest = (
        state.where(F.col("status").isin("completed", "reset"))
        .groupBy("table_name")
        .agg(F.max_by("status", "offset").alias("status"))
    )
    done = latest.where("status = 'completed'").select("table_name")
    return catalogue.join(done, "table_name", "left_anti")


def _messages(
    rows: DataFrame, table: str, op: str, *keep: str | Column, said: list[str] | None = None
) -> DataFrame:
    return rows.select(
        F.lit(table).alias("table_name"),
        *keep,
        F.lit(f"{POLL_PREFIX}.{table}").alias("topic"),
        envelope_text(said or rows.columns, table, op).alias("value"),
    )


def kafka_publisher(brokers: str) -> Callable[[DataFrame], None]:
    """Publishes ``topic, value`` rows; needs the Kafka connector on the class path."""

    def publish(messages: DataFrame) -> None:
        (
            messages.select("topic", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("kafka.acks", "all")
            .option("kafka.compression.type", "gzip")
            .option("kafka.linger.ms", "20")
            .save()
        )

    return publish


def load_state(spark: SparkSession, root: str) -> DataFrame:
    """The state log of full loads; empty before the first."""
    try:
        return spark.read.schema(STATE_DDL).parquet(f"{root}/state")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE_DDL)


def set_state(spark: SparkSession, root: str, table: str, status: str, n_rows: int = 0) -> None:
    """Append a ``completed`` or ``reset`` mark for a table."""
    last = load_state(spark, root).agg(F.max("offset")).first()[0]
    row = (table, status, n_rows, datetime.now(), 0 if last is None else last + 1)
    spark.createDataFrame([row], STATE_DDL).coalesce(1).write.mode("append").parquet(
        f"{root}/state"
    )


def full_load(tables: Tables, root: str) -> list[str]:
    """Write a snapshot of every table not yet completed below ``<root>/snapshot``.

    A table is marked once it is written whole; a run that broke off writes it again.
    Returns the tables loaded.
    """
    spark = next(iter(tables.values())).sparkSession
    pending = pending_tables(table_list(spark), load_state(spark, root))
    names = [r["table_name"] for r in pending.collect() if r["table_name"] in tables]
    for name in names:
        path = f"{root}/snapshot/{name}"
        _messages(tables[name], name, "r").write.mode("overwrite").parquet(path)
        set_state(spark, root, name, "completed", spark.read.parquet(path).count())
    return names


def poll_cycle(
    tables: Tables,
    root: str,
    cycle: int,
    start: Marks,
    publish: Callable[[DataFrame], None] | None = None,
    overlap: timedelta = timedelta(0),
) -> dict[str, datetime]:
    """One poll of every table that can be followed; returns the marks for the next.

    New rows are stored below ``<root>/polled`` under the cycle's number and the marks are
    the newest times among just those rows, so rows that arrive meanwhile wait for the next
    cycle. A repeated cycle overwrites itself. ``start`` serves the first cycle only.

    A row whose time lies at or before the mark when it becomes visible would be lost: clocks are
    coarse, and transactions commit out of order. With ``overlap`` a poll looks back that far behind
    the mark (never behind ``start``) and leaves out what it has sent: key and time of the rows
    of that last span, all that has to be remembered, are stored with the marks.
    """
    spark = next(iter(tables.values())).sparkSession
    followed = [name for name in polled_tables() if name in tables]
    marks = {name: _mark(start, name) for name in followed}
    sent = None
    if cycle > 0:
        before = spark.read.parquet(f"{root}/marks/cycle={cycle - 1}")
        marks.update({r["table_name"]: r["high_water"] for r in before.collect()})
        if overlap:
            sent = spark.read.parquet(f"{root}/sent/cycle={cycle - 1}")

    def since(name: str) -> Column:
        return F.lit(max(marks[name] - overlap, _mark(start, name)) if overlap else marks[name])

    def new_rows(name: str) -> DataFrame:
        key = F.col(PRIMARY_KEYS[name]).cast("bigint")
        fresh = tables[name].where(F.col(WATERMARK_COLUMN) > since(name))
        if sent is not None:
            of = sent.where(F.col("table_name") == name).select(F.col("pk").alias("_pk"), F.col(WATERMARK_COLUMN).alias("_at"))
            same = (key == F.col("_pk")) & (F.col(WATERMARK_COLUMN) == F.col("_at"))
            fresh = fresh.join(of, same, "left_anti")
        keyed = fresh.withColumn("_pk", key)
        return _messages(keyed, name, "c", WATERMARK_COLUMN, F.col("_pk").alias("pk"), said=fresh.columns)

    path = f"{root}/polled/cycle={cycle}"
    _union(new_rows(name) for name in followed).write.mode("overwrite").parquet(path)
    stored = spark.read.parquet(path)
    kind = stored.schema[WATERMARK_COLUMN].dataType.simpleString()
    if publish is not None:
        publish(stored)
    newest = stored.groupBy("table_name").agg(F.max(WATERMARK_COLUMN).alias("high_water"))
    # A late row does not move a mark back.
    marks.update({r["table_name"]: max(r["high_water"], marks[r["table_name"]]) for r in newest.collect()})
    if overlap:
        now = stored.select("table_name", "pk", WATERMARK_COLUMN)
        every = now if sent is None else sent.unionByName(now)
        late = reduce(
            lambda a, b: a | b,
            [(F.col("table_name") == n) & (F.col(WATERMARK_COLUMN) > since(n)) for n in followed],
        )
        every.where(late).write.mode("overwrite").parquet(f"{root}/sent/cycle={cycle}")
    kept = spark.createDataFrame(list(marks.items()), f"table_name string, high_water {kind}")
    kept.coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/cycle={cycle}")
    return marks


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
