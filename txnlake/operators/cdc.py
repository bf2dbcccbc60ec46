"""Change-stream operators, as DataFrame -> DataFrame steps for batch and streaming alike.

A feed has the columns of a Kafka source: ``topic, value, offset, timestamp``. ``value``
is JSON text, or NULL for a tombstone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake import fixed_values as fixed
from txnlake.functions.temporal import epoch_millis

META_PREFIX = "__"
MESSAGE_META = "__op string, __source_ts_ms bigint, __table string, __deleted string"


def topic_pattern(prefix: str = fixed.TOPIC_PREFIX, database: str = fixed.DATABASE) -> str:
    """Regular expression of a database's change topics."""
    return f"^{re.escape(f'{prefix}.{database}')}\\..+"


def table_topic(
    table: str, prefix: str = fixed.TOPIC_PREFIX, database: str = fixed.DATABASE
) -> str:
    return f"{prefix}.{database}.{table}"


def subscribe(feed: DataFrame, pattern: str | None = None) -> DataFrame:
    """Messages whose topic matches; a Kafka source takes the same pattern as an option."""
    return feed.where(F.col("topic").rlike(pattern or topic_pattern()))


def route(feed: DataFrame) -> DataFrame:
    """Add ``table_name``: the last dotted part of the topic."""
    return feed.withColumn("table_name", F.element_at(F.split("topic", r"\."), -1))


def _once(value: Column) -> Column:
    """``value`` computed once per row: filters on its fields are not pushed below it.

    Otherwise the optimizer would parse a message for the filter and again for the rest.
    """
    return F.explode(F.array(value))


def _parse_envelope(envelopes: DataFrame, row_ddl: str) -> DataFrame:
    image = f"struct<{_struct_body(row_ddl)}>"
    ddl = (
        f"before {image}, after {image}, op string, "
        "source struct<ts_ms: bigint, `table`: string>"
    )
    return envelopes.withColumn("_e", _once(F.from_json("value", ddl, {"mode": "FAILFAST"})))


def unwrap(envelopes: DataFrame, row_ddl: str) -> DataFrame:
    """Routed before/after envelopes to the columns of ``decode``, in one parse.

    A delete keeps its last row image; tombstones drop out.
    """
    live = envelopes.where(F.col("value").isNotNull())
    return _parse_envelope(live, row_ddl).select(
        "table_name",
        "offset",
        "timestamp",
        F.coalesce("_e.after", "_e.before").alias("row"),
        F.col("_e.op").alias("op"),
        F.col("_e.source.ts_ms").alias("ts_ms"),
        (F.col("_e.op") == "d").alias("is_delete"),
    )


def unwrap_messages(envelopes: DataFrame, row_ddl: str) -> DataFrame:
    """Envelopes to flat messages for publishing on; tombstones stay."""
    row = F.coalesce("_e.after", "_e.before")
    flat = F.struct(
        *[row[name].alias(name) for name in _field_names(row_ddl)],
        F.col("_e.op").alias("__op"),
        F.col("_e.source.ts_ms").alias("__source_ts_ms"),
        F.col("_e.source.table").alias("__table"),
        F.when(F.col("_e.op") == "d", "true").otherwise("false").alias("__deleted"),
    )
    text = F.when(F.col("value").isNotNull(), F.to_json(flat))
    return _parse_envelope(envelopes, row_ddl).withColumn("value", _once(text)).drop("_e")


def decode(feed: DataFrame, row_ddl: str, mode: str = "FAILFAST") -> DataFrame:
    """Parse routed messages to ``row`` plus ``op, ts_ms, is_delete``; drop tombstones.

    A message without an operation is a snapshot read; one without a delete mark is live.
    """
    message = F.from_json("value", f"{row_ddl}, {MESSAGE_META}", {"mode": mode})
    op = F.coalesce("_m.__op", F.lit("r"))
    deleted = F.coalesce("_m.__deleted", F.lit("false"))
    return (
        feed.where(F.col("value").isNotNull())
        .withColumn("_m", _once(message))
        .select(
            "table_name",
            "offset",
            "timestamp",
            F.struct(*[F.col(f"_m.{n}").alias(n) for n in _field_names(row_ddl)]).alias("row"),
            op.alias("op"),
            F.col("_m.__source_ts_ms").alias("ts_ms"),
            ((deleted == "true") | (op == "d")).alias("is_delete"),
        )
    )


def decoded(feed: DataFrame, row_ddl: str) -> DataFrame:
    """Subscribe, route and decode in one step."""
    return decode(route(subscribe(feed)), row_ddl)


def handle_deletes(changes: DataFrame, skip: bool = True) -> DataFrame:
    """Drop deletes, or keep every change with a ``_deleted`` flag."""
    if skip:
        return changes.where(~F.col("is_delete"))
    return changes.withColumn("_deleted", F.col("is_delete"))


def normalise(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Decimals to double and nested values to JSON text, as the lake stores them."""

    def plain(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            value = F.to_json(value)
        return value.alias(field.name)

    chosen = columns or rows.columns
    return rows.select(*[plain(f) if f.name in chosen else f.name for f in rows.schema])


def with_metadata(changes: DataFrame, ingest: Column | None = None) -> DataFrame:
    """Row fields without ``__`` ones, plus ``_cdc_op``, ``_cdc_ts_ms`` and ``_cdc_ingest``."""
    ingest = F.current_timestamp() if ingest is None else ingest
    names = [f for f in changes.schema["row"].dataType.names if not f.startswith(META_PREFIX)]
    kept = [c for c in ("table_name", "offset", "_deleted") if c in changes.columns]
    return changes.select(
        *kept,
        *[F.col(f"row.{n}").alias(n) for n in names],
        F.col("op").alias("_cdc_op"),
        F.col("ts_ms").alias("_cdc_ts_ms"),
        F.date_format(ingest, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_cdc_ingest"),
        ingest.alias("_ingested_at"),
    )


def lake_rows(
    feed: DataFrame,
    row_ddl: str,
    skip_deletes: bool = True,
    ingest: Column | None = None,
) -> DataFrame:
    """The whole way from feed to the rows the lake stores."""
    changes = handle_deletes(decoded(feed, row_ddl), skip_deletes)
    return normalise(with_metadata(changes, ingest), _field_names(row_ddl))


def is_broken(value: Column) -> Column:
    """Whether a message is text that is no JSON object; tombstones are not."""
    probe = F.from_json(
        value, "_broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    )
    return value.isNotNull() & probe["_broken"].isNotNull()


def dead_letters(feed: DataFrame) -> DataFrame:
    """Routed messages that cannot be decoded, as they came."""
    return route(subscribe(feed)).where(is_broken(F.col("value")))


def without_dead_letters(feed: DataFrame) -> DataFrame:
    """The feed that ``decode`` can take; what it leaves out is in ``dead_letters``."""
    return feed.where(~is_broken(F.col("value")) | F.col("value").isNull())


def skip_stats(feed: DataFrame, skip_deletes: bool = True) -> DataFrame:
    """Messages per table by fate: tombstone, broken, delete or kept, from one parse."""
    message = F.from_json(
        "value",
        "__op string, __deleted string, _broken string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"},
    )
    routed = route(subscribe(feed)).withColumn("_m", _once(message))
    op = F.coalesce("_m.__op", F.lit("r"))
    deleted = F.coalesce("_m.__deleted", F.lit("false"))
    is_delete = F.lit(skip_deletes) & ((deleted == "true") | (op == "d"))
    fate = (
        F.when(F.col("value").isNull(), "tombstone")
        .when(F.col("_m._broken").isNotNull(), "broken")
        .when(is_delete, "delete")
        .otherwise("kept")
    )
    return routed.groupBy("table_name", fate.alias("reason")).agg(
        F.count(F.lit(1)).alias("n_messages")
    )


def op_counts(changes: DataFrame) -> DataFrame:
    """Changes per table, one column per operation."""
    return changes.groupBy("table_name").agg(
        *[F.count_if(F.col("op") == op).alias(op) for op in fixed.CHANGE_OPS]
    )


def without_tombstones(feed: DataFrame) -> DataFrame:
    """Routed messages that are changes; counting them needs no parse."""
    return route(subscribe(feed)).where(F.col("value").isNotNull())


def operations(feed: DataFrame) -> DataFrame:
    """Routed changes with their operation, the one field that is parsed."""
    message = F.from_json("value", "__op string", {"mode": "FAILFAST"})
    return without_tombstones(feed).select(
        "table_name", "offset", F.coalesce(message["__op"], F.lit("r")).alias("op")
    )


def pending_by_table(changes: DataFrame, since_offset: int | None = None) -> DataFrame:
    """Changes per table after the offset of the last refresh, deletes included."""
    if since_offset is not None:
        changes = changes.where(F.col("offset") > since_offset)
    return changes.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_pending"))


def latest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The last change per key, deletes included.

    ``max_by`` combines on the map side, so a key with very many changes reaches the
    shuffle as one row per task.
    """
    rest = [c for c in changes.columns if c not in keys]
    version = F.struct("ts_ms", "offset")
    return (
        changes.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), version).alias("_last"))
        .select(*keys, "_last.*")
    )


def current_state(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The live rows after all changes: the last one per key unless it is a delete."""
    return latest_changes(changes, keys).where(~F.col("is_delete"))


#: Columns that tell where and when a change was delivered, not what it says.
DELIVERY = ("topic", "partition", "offset", "off", "timestamp")


def delivery_identity(changes: DataFrame, keys: list[str]) -> Column:
    """What a change says besides its key and source time: operation and row, hashed.

    Source clocks are coarse, so a key may well change twice at one time; a repeated
    delivery says the same in everything.
    """
    said = [c for c in changes.columns if c not in (*keys, "ts_ms", *DELIVERY)]
    return F.xxhash64(F.to_json(F.struct(*said))) if said else F.lit(0).cast("bigint")


def dedupe(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Drop repeated deliveries: same key, source time, operation and row."""
    marked = changes.withColumn("_said", delivery_identity(changes, keys))
    return marked.dropDuplicates([*keys, "ts_ms", "_said"]).drop("_said")


def envelope_text(columns: list[str], table: str, op: str, ts: Column | None = None) -> Column:
    """Polled-message text ``{"_meta": {table, op, ts_ms}, "payload": {...}}``."""
    ts = F.current_timestamp() if ts is None else ts
    meta = F.struct(
        F.lit(table).alias("table"), F.lit(op).alias("op"), epoch_millis(ts).alias("ts_ms")
    )
    message = F.struct(meta.alias("_meta"), F.struct(*columns).alias("payload"))
    options = {
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
        "ignoreNullFields": "false",
    }
    return F.to_json(message, options)


def envelope(rows: DataFrame, table: str, op: str, ts: Column | None = None) -> DataFrame:
    return rows.select(envelope_text(rows.columns, table, op, ts).alias("value"))


def _field_names(row_ddl: str) -> list[str]:
    return T.StructType.fromDDL(row_ddl).names


def _struct_body(row_ddl: str) -> str:
    schema = T.StructType.fromDDL(row_ddl)
    return ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema)
