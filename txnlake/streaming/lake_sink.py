"""From the change feed to the raw lake, exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake.operators import cdc
from txnlake.sources.lake import DAY, with_day
from txnlake.streaming.run import start


def start_lake_sink(
    feed: DataFrame,
    table: str,
    row_ddl: str,
    lake: str,
    checkpoints: str,
    compression: str = "snappy",
    skip_deletes: bool = True,
    ingest: Column | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Archive one table's changes below ``<lake>/<table>`` by ingest day.

    Each table has its own query, schema and checkpoint, so a slow or broken one holds up
    no other. The file sink's log makes a replayed batch visible once.
    """
    changes = feed.where(F.col("topic") == cdc.table_topic(table))
    rows = cdc.lake_rows(changes, row_ddl, skip_deletes, ingest)
    writer = (
        with_day(rows.drop("table_name"))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*DAY)
        .option("compression", compression)
        .option("path", f"{lake}/{table}")
        .option("checkpointLocation", f"{checkpoints}/{table}")
    )
    return start(writer, feed.sparkSession, every)
