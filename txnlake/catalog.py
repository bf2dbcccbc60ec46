"""The registered queries: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import fixed_values as fixed
from txnlake.functions import money, risk
from txnlake.functions import temporal as temporal_
from txnlake.operators import cdc, fraud, joins, key_pages, monitor, ordering, quality, settlement
from txnlake.plans import increments, marts, rebuild, serve, staging
from txnlake.schemas import PRIMARY_KEYS, SERVING_TYPES, polled_tables
from txnlake.session import scratch_path, tune, written
from txnlake.sources import compaction, ingest, lake, serving, stand_in
from txnlake.sources.tables import LazyTables, Tables, row_counts
from txnlake.streaming import lake_sink as lake_sink_
from txnlake.streaming import keyed_state, monitors, refresh, run, state

Query = Callable[[SparkSession, str], DataFrame]


def _over_tables(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(stand_in.load_tables(tune(spark), sf_dir))


def _over_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(
        tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    )


def _marts() -> dict[str, Query]:
    return {name: _over_tables(build) for name, build in marts.MARTS.items()}


def _increments() -> dict[str, Query]:
    def kept(name: str) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            tables = stand_in.load_tables(tune(spark), sf_dir)
            store = increments.MartIncrements(spark, scratch_path(spark, "increments"))
            for batch in (0, 1, 2, 2):  # the last batch is replayed
                now = stand_in.changed_tables(tables, batch)
                changed = stand_in.batch_changes(tables, batch, increments.columns_read([name]))
                store.apply(batch, changed, now, [name])
            return store.view(name, now)

        return query

    return {f"{name}_increments": kept(name) for name in marts.MARTS}


def _staging() -> dict[str, Query]:
    return {
        "stg_transactions": _over_tables(lambda t: staging.stg_transactions(t["transactions"])),
        "stg_clients": _over_tables(lambda t: staging.stg_clients(t["clients"])),
        "stg_merchants": _over_tables(lambda t: staging.stg_merchants(t["merchants"])),
        "stg_fraud_alerts": _over_tables(lambda t: staging.stg_fraud_alerts(t["fraud_alerts"])),
    }


def _joins() -> dict[str, Query]:
    return {
        "join_inner_status": _over_tables(
            lambda t: joins.with_status(t["transactions"], t["transaction_statuses"]).select(
                "txn_id", "amount", "status_code"
            )
        ),
        "join_left_keep_unmatched": _over_tables(
            lambda t: joins.approved_per_merchant(
                t["merchants"], t["transactions"], t["transaction_statuses"]
            )
        ),
        "resolve_merchant": _over_tables(
            lambda t: joins.resolve_merchant(t["transactions"], t["pos_terminals"]).select(
                "txn_id", "pos_id", "merchant_id", "resolved_merchant_id"
            )
        ),
        "card_network_match": _over_tables(
            lambda t: joins.match_card_network(
                t["payment_cards"].select("card_id", "masked_pan"), t["card_networks"]
            )
        ),
    }


def _serving() -> dict[str, Query]:
    return {
        "serve_recent_days": _over_tables(
            lambda t: serve.recent_days(marts.daily_transaction_summary(t))
        ),
        "serve_top_merchants": _over_tables(
            lambda t: serve.top_merchants(marts.merchant_performance(t))
        ),
        "serve_top_clients": _over_tables(lambda t: serve.top_clients(marts.client_360(t))),
        "serve_risky_clients": _over_tables(
            lambda t: serve.top_clients(marts.client_360(t), by="risk_score")
        ),
        "serve_fraud_outcomes": _over_tables(
            lambda t: serve.fraud_outcomes(marts.fraud_analysis(t))
        ),
        "order_fraud_by_risk": _over_tables(
            lambda t: ordering.rank_by_risk(
                t["fraud_alerts"]
                .select("alert_id", "txn_id", "risk_score")
                .join(t["transactions"].select("txn_id", "amount"), "txn_id")
                .drop("txn_id")
            )
        ),
        "page_by_key": _over_tables(
            lambda t: ordering.page_by_key(
                t["transactions"].select("txn_id", "client_id", "amount", "initiated_at"),
                "txn_id",
                size=500,
                offset=1000,
            )
        ),
        "page_after_key": _over_tables(
            lambda t: ordering.page_after(
                t["transactions"].select("txn_id", "client_id", "amount", "initiated_at"),
                "txn_id",
                size=500,
                last=700,
            )
        ),
        "serve_alerts_by_outcome": _over_tables(
            lambda t: serve.fraud_alerts_for(
                marts.fraud_analysis(t),
                outcome="Confirmed Fraud",
                min_risk=70,
                since=datetime(1995, 1, 1),
            ).select("alert_id", "txn_id", "risk_score", "amount", "initiated_at")
        ),
        "sample_approved": _over_tables(
            lambda t: ordering.sample_approved(
                t["transactions"].select("txn_id", "amount", "status_id"),
                t["transaction_statuses"],
            ).select("txn_id", "amount")
        ),
    }


def _scalars() -> dict[str, Query]:
    def computed_fee(t: Tables) -> DataFrame:
        # Rates would be columns of a fee table; here they follow from the transaction id.
        rate = F.array(*[F.lit(p).cast("decimal(4,3)") for p in fixed.FEE_RATES])
        flat = F.array(*[F.lit(f).cast("decimal(3,2)") for f in fixed.FEE_FLATS])
        k = F.col("txn_id") - 1
        fee = money.fee(F.col("amount"), rate[k % 4], flat[k % 3])
        return t["transactions"].select("txn_id", "amount", fee.alias("computed_fee"))

    return {
        "net_amount": _over_tables(
            lambda t: t["transactions"].select(
                "txn_id",
                "amount",
                "fee",
                money.net_amount(F.col("amount"), F.col("fee")).alias("net_amount"),
            )
        ),
        "fee_compute": _over_tables(computed_fee),
        "risk_band": _over_tables(
            lambda t: t["transactions"].select(
                "txn_id",
                "amount",
                risk.risk_band(F.col("amount")).alias("risk_band"),
                risk.capped_score(
                    risk.risk_band(F.col("amount")) + F.col("txn_id") % 16
                ).alias("capped_score"),
            )
        ),
        "json_field": _over_events(
            lambda e: e.select(
                "event_id", F.get_json_object("props", "$.k").cast("int").alias("k")
            )
        ),
    }


# Thresholds at which the given tables show each pattern.
EVENT_THRESHOLDS = fraud.Thresholds(
    velocity_txns=2, testing_txns=2, testing_seconds=fraud.DAY_SECONDS
)
TABLE_THRESHOLDS = fraud.Thresholds(
    velocity_txns=2,
    velocity_seconds=30 * fraud.DAY_SECONDS,
    testing_amount="100.00",
    testing_txns=2,
    testing_seconds=180 * fraud.DAY_SECONDS,
    night_txns=1,
    spree_txns=2,
    spree_seconds=180 * fraud.DAY_SECONDS,
)
MIN_ROWS = {"transactions": 10_000, "clients": 1_000, "fraud_alerts": 1_000}


def _fraud() -> dict[str, Query]:
    def on_events(detector) -> Query:
        return _over_events(
            lambda e: detector(stand_in.events_as_transactions(e), EVENT_THRESHOLDS)
        )

    def on_tables(detector) -> Query:
        return _over_tables(lambda t: detector(t["transactions"], TABLE_THRESHOLDS))

    return {
        "fraud_velocity": on_events(fraud.velocity),
        "fraud_card_testing": on_events(fraud.card_testing),
        "fraud_high_value": on_tables(fraud.high_value),
        "fraud_night_owl": on_events(fraud.night_owl),
        "fraud_intl_spree": on_tables(fraud.international_spree),
        "fraud_account_takeover": on_tables(fraud.account_takeover),
        "fraud_alerts_build": on_tables(fraud.build_alerts),
        "fraud_alerts_documented": _over_tables(lambda t: fraud.build_alerts(t["transactions"])),
        "rule_candidates": _over_tables(lambda t: fraud.candidates(t["transactions"])),
        "fraud_rule_summary": _over_tables(lambda t: fraud.rule_summary(t["fraud_alerts"])),
        "pos_activity": _over_tables(
            lambda t: fraud.pos_activity(t["pos_terminals"], t["transactions"])
        ),
        "default_card": _over_tables(lambda t: fraud.default_card(t["payment_cards"])),
        "settlement_batches": _over_tables(lambda t: t["settlement_batches"]),
        "refund_reconcile": _over_tables(
            lambda t: settlement.reconcile_refunds(t["refunds"], t["transactions"])
        ),
    }


def _quality() -> dict[str, Query]:
    def with_marts(t: Tables) -> Tables:
        built = {name: partial(build, t) for name, build in marts.MARTS.items()}
        return LazyTables({**{name: partial(t.__getitem__, name) for name in t}, **built})

    def by_day(t: Tables) -> DataFrame:
        # Pages kept per ingest day, as a daily job would store them, then merged.
        keys = [(n, c) for n, c in quality.SOURCE_KEYS if n in ("transactions", "refunds")]
        dated = {n: t[n].withColumn("day", F.to_date("created_at")) for n in {n for n, _ in keys}}
        pages = written(key_pages.key_pages(dated, keys, "day"), "key_pages")
        return quality.unique_keys(dated, keys, pages)

    return {
        "dq_unique_by_day": _over_tables(by_day),
        "dq_not_null": _over_tables(
            lambda t: quality.row_checks(with_marts(t), quality.MART_NOT_NULL)
        ),
        "dq_unique": _over_tables(
            lambda t: quality.unique_keys(with_marts(t), quality.MART_UNIQUE)
        ),
        "dq_unique_keys": _over_tables(lambda t: quality.unique_keys(t, quality.SOURCE_KEYS)),
        "dq_referential": _over_tables(quality.referential),
        "dq_accepted_values": _over_tables(
            lambda t: quality.row_checks(with_marts(t), quality.ACCEPTED)
        ),
        "dq_range": _over_tables(lambda t: quality.row_checks(with_marts(t), quality.RANGES)),
    }


def _monitor() -> dict[str, Query]:
    def lagging(events: DataFrame) -> DataFrame:
        changes = cdc.decoded(stand_in.change_feed(events), stand_in.FEED_ROW)
        seen = F.col("timestamp") <= monitor.newest(changes, "timestamp") - F.expr(
            "INTERVAL 1 DAY"
        )
        return monitor.backlog(changes, changes.where(seen))

    return {
        "monitor_row_counts": _over_tables(lambda t: monitor.min_row_counts(t, MIN_ROWS)),
        "monitor_ingestion_rate": _over_events(
            lambda e: monitor.ingestion_rate(stand_in.events_as_transactions(e))
        ),
        "monitor_fraud_spike": _over_events(
            lambda e: monitor.fraud_spike(stand_in.events_as_transactions(e))
        ),
        "monitor_unreviewed_high_risk": _over_tables(
            lambda t: monitor.unreviewed_high_risk(t["fraud_alerts"])
        ),
        "monitor_freshness": _over_tables(monitor.freshness),
        "monitor_summary": _over_tables(lambda t: monitor.summary(t, minimums=MIN_ROWS)),
        "monitor_backlog": _over_events(lagging),
    }


def _changes() -> dict[str, Query]:
    def over_feed(build: Callable[[DataFrame], DataFrame]) -> Query:
        return _over_events(lambda e: build(stand_in.change_feed(e)))

    def over_changes(build: Callable[[DataFrame], DataFrame]) -> Query:
        return over_feed(lambda feed: build(cdc.decoded(feed, stand_in.FEED_ROW)))

    def off(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("offset", "off")

    def live_rows(changes: DataFrame) -> DataFrame:
        return changes.select(
            "table_name", "row.*", "ts_ms", "offset", "op", "is_delete"
        )

    def unwrapped(events: DataFrame) -> DataFrame:
        routed = cdc.route(cdc.subscribe(stand_in.change_envelopes(events)))
        return off(live_rows(cdc.unwrap(routed, stand_in.FEED_ROW))).drop("props")

    def temporal(events: DataFrame) -> DataFrame:
        encoded = events.selectExpr(
            "event_id",
            "unix_date(to_date(ts)) as days",
            "unix_millis(cast(ts as timestamp)) as ms",
            "unix_micros(cast(ts as timestamp)) as us",
            "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") as iso",
        )
        return encoded.select(
            "event_id",
            temporal_.decode_date(F.col("days")).alias("from_days"),
            temporal_.decode_millis(F.col("ms")).cast("timestamp_ntz").alias("from_ms"),
            temporal_.decode_micros(F.col("us")).cast("timestamp_ntz").alias("from_us"),
            temporal_.decode_iso(F.col("iso")).cast("timestamp_ntz").alias("from_iso"),
        )

    def replayed(changes: DataFrame) -> DataFrame:
        # A tenth of the changes is delivered again; another tenth is followed by a delete of
        # the same key at the same time.
        again = changes.where("offset % 10 = 0")
        ended = changes.where("offset % 10 = 5 AND op <> 'd'").withColumn("op", F.lit("d"))
        both = live_rows(changes).unionByName(live_rows(again)).unionByName(live_rows(ended))
        return off(cdc.dedupe(both, ["table_name", "pk"])).select(
            "table_name", "pk", "ts_ms", "off", "op"
        )

    return {
        "cdc_topic_filter": over_feed(
            lambda f: cdc.subscribe(f).select(F.col("offset").alias("off"), "topic")
        ),
        "cdc_route": over_feed(
            lambda f: cdc.route(cdc.subscribe(f)).select(
                F.col("offset").alias("off"), "topic", "table_name"
            )
        ),
        "cdc_decode": over_changes(
            lambda c: off(live_rows(c)).withColumn("k", F.col("props.k")).drop("props")
        ),
        "cdc_unwrap": _over_events(unwrapped),
        "cdc_temporal_decode": _over_events(temporal),
        "cdc_skip_stats": over_feed(cdc.skip_stats),
        "cdc_dead_letters": over_feed(
            lambda f: cdc.dead_letters(
                f.withColumn(
                    "value",
                    F.when(F.col("offset") % 50 == 0, F.expr("left(value, length(value) - 1)"))
                    .otherwise(F.col("value")),
                )
            ).select(F.col("offset").alias("off"), "table_name")
        ),
        "cdc_skip_deletes": over_changes(
            lambda c: off(cdc.handle_deletes(c, skip=True)).select("off", "table_name", "op")
        ),
        "cdc_keep_deletes": over_changes(
            lambda c: off(cdc.handle_deletes(c, skip=False)).select(
                "off", "table_name", "op", F.col("_deleted").cast("int").alias("_deleted")
            )
        ),
        "cdc_metadata": over_changes(
            lambda c: off(cdc.with_metadata(cdc.handle_deletes(c))).drop(
                "props", "_cdc_ingest", "_ingested_at"
            )
        ),
        "cdc_normalise": over_changes(
            lambda c: cdc.normalise(c.select("row.*", F.col("offset").alias("off"))).select(
                "off", "pk", "amount", "props"
            )
        ),
        "cdc_op_counts": over_feed(lambda f: cdc.op_counts(cdc.operations(f))),
        "cdc_pending_by_table": over_feed(
            lambda f: cdc.pending_by_table(cdc.without_tombstones(f))
        ),
        "cdc_current_state": over_changes(
            lambda c: off(cdc.current_state(live_rows(c), ["table_name", "pk"])).select(
                "table_name", "pk", "user_id", "event_type", "amount", "op", "ts_ms", "off"
            )
        ),
        "cdc_dedupe": over_changes(replayed),
    }


# The mark of the incremental reads.
HIGH_WATER = datetime(1998, 1, 1)
POLL_OVERLAP = timedelta(days=30)


def _ingest() -> dict[str, Query]:
    def envelopes(t: Tables) -> DataFrame:
        columns = ["txn_id", "amount", "channel", "merchant_id", "initiated_at", "settled_at"]
        messages = cdc.envelope(t["transactions"].select(columns), "transactions", "r")
        field = lambda path: F.get_json_object("value", path)
        return messages.select(
            field("$._meta.table").alias("table_name"),
            field("$._meta.op").alias("op"),
            field("$.payload.txn_id").cast("bigint").alias("txn_id"),
            field("$.payload.amount").cast("decimal(14,2)").alias("amount"),
            field("$.payload.channel").alias("channel"),
            field("$.payload.merchant_id").cast("bigint").alias("merchant_id"),
            field("$.payload.initiated_at").alias("initiated_at"),
            field("$.payload.settled_at").alias("settled_at"),
        )

    def late_rows(t: Tables) -> DataFrame:
        # A tenth of all rows is committed only after the first of two polls.
        names = [name for name in polled_tables() if name in t]
        spark = t[names[0]].sparkSession
        root = scratch_path(spark, "polls")
        in_time = {name: t[name].where(F.col(PRIMARY_KEYS[name]) % 10 != 3) for name in names}
        ingest.poll_cycle(in_time, root, 0, HIGH_WATER, overlap=POLL_OVERLAP)
        ingest.poll_cycle({n: t[n] for n in names}, root, 1, HIGH_WATER, overlap=POLL_OVERLAP)
        return spark.read.parquet(f"{root}/polled").select("cycle", "table_name", "pk")

    def pending(t: Tables) -> DataFrame:
        # The state log of a load: each merchant's id stands for one state message, dealt
        # over the 13 tables in turn; every third one is a reset.
        catalogue = ingest.table_list(t["merchants"].sparkSession)
        names = F.array(*[F.lit(n) for n in PRIMARY_KEYS])
        m = F.col("merchant_id")
        state = t["merchants"].select(
            names[(m % len(PRIMARY_KEYS)).cast("int")].alias("table_name"),
            F.when(m % 3 == 2, "reset").otherwise("completed").alias("status"),
            m.alias("offset"),
        )
        return ingest.pending_tables(catalogue, state)

    return {
        "scan_sources": _over_tables(row_counts),
        "snapshot_load": _over_tables(ingest.snapshot_keys),
        "incremental_poll": _over_tables(lambda t: ingest.poll_all(t, HIGH_WATER)),
        "incremental_poll_overlap": _over_tables(late_rows),
        "incremental_high_water": _over_tables(lambda t: ingest.new_high_water(t, HIGH_WATER)),
        "snapshot_pending_tables": _over_tables(pending),
        "envelope_encode": _over_tables(envelopes),
    }


# Refresh rule at which the hourly clock of the given events fires by rows and by time.
HOURLY_RULE = refresh.RefreshRule(rows=80, seconds=6 * 3600)


def _by_day_and_op(archived: DataFrame) -> DataFrame:
    return archived.groupBy(
        "table_name", *[F.col(c).cast("int").alias(c) for c in lake.DAY], "_cdc_op"
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col("amount").cast("decimal(14,2)")).alias("amount"),
    )


def _lake() -> dict[str, Query]:
    def lake_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(tune(spark), "lake_sink")
        feed = stand_in.change_feed(stand_in.events_stream(spark, sf_dir))
        running = [
            lake_sink_.start_lake_sink(
                feed,
                table,
                stand_in.FEED_ROW,
                f"{root}/raw",
                f"{root}/checkpoints",
                ingest=F.col("timestamp"),
            )
            for table in stand_in.FEED_TABLES
        ]
        for query in running:
            query.awaitTermination()
        archived = [
            lake.read_lake(spark, f"{root}/raw/{table}").withColumn("table_name", F.lit(table))
            for table in stand_in.FEED_TABLES
        ]
        return _by_day_and_op(reduce(DataFrame.unionByName, archived))

    def archive(spark: SparkSession, sf_dir: str, root: str, compression: str) -> DataFrame:
        events = tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        rows = cdc.lake_rows(
            stand_in.change_feed(events), stand_in.FEED_ROW, ingest=F.col("timestamp")
        )
        lake.write_day_partitions(rows, root, compression)
        return lake.read_lake(spark, root)

    def compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Three appends; closed days are compacted after two and again after late rows came.
        root = scratch_path(tune(spark), "lake_compacted")
        events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        rows = cdc.lake_rows(
            stand_in.change_feed(events), stand_in.FEED_ROW, ingest=F.col("timestamp")
        )
        open_day = events.agg(F.to_date(F.max("ts"))).first()[0]
        for i in range(3):
            lake.write_day_partitions(rows.where(F.pmod(F.xxhash64("_cdc_ts_ms", "pk"), F.lit(3)) == i), root)
            if i:
                compaction.compact(spark, root, open_day)
        compaction.drop_replaced(spark, root)
        return _by_day_and_op(compaction.read_compacted(spark, root))

    def codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(tune(spark), "lake_codec")
        counts = [
            archive(spark, sf_dir, f"{root}/{codec}", codec)
            .groupBy("table_name")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(codec).alias("codec"), "table_name", "n_rows")
            for codec in lake.CODECS
        ]
        return reduce(DataFrame.unionByName, counts)

    def revenue(t: Tables) -> DataFrame:
        # A snapshot of the transactions, archived on one ingest day.
        txns, day = t["transactions"], datetime(2024, 1, 31)
        root = scratch_path(txns.sparkSession, "lake_revenue")
        rows = cdc.normalise(ingest.snapshot(txns)).withColumn("_ingested_at", F.lit(day))
        lake.write_day_partitions(rows, root)
        archived = lake.read_lake(txns.sparkSession, root, day.date(), day.date())
        return lake.revenue_by(archived, "channel")

    return {
        "lake_sink": lake_sink,
        "lake_compacted": compacted,
        "lake_sink_codec": codecs,
        "lake_channel_revenue": _over_tables(revenue),
    }


def _load() -> dict[str, Query]:
    def loaded(spark: SparkSession, sf_dir: str) -> tuple[str, serving.ParquetTarget]:
        root = scratch_path(tune(spark), "marts")
        target = serving.ParquetTarget(f"{root}/serving")
        rebuild.write_marts(stand_in.load_tables(spark, sf_dir), f"{root}/marts")
        rebuild.load_marts(spark, f"{root}/marts", target)
        return f"{root}/marts", target

    def mart_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, target = loaded(spark, sf_dir)
        return target.read(spark, "mart_client_360").drop("loaded_at")

    def load_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, target = loaded(spark, sf_dir)
        return serving.reconcile(spark, root, target, list(marts.MARTS))

    def type_clean(t: Tables) -> DataFrame:
        # Untyped input: text for numbers and times, NaN where a client has no spend.
        mart = marts.client_360(t)
        spent = F.col("max_txn_amount").cast("double")
        dirty = mart.select(
            "client_id",
            F.col("risk_score").cast("string").alias("risk_score"),
            F.col("last_txn_at").cast("string").alias("last_txn_at"),
            F.when(F.col("total_txns") == 0, "n/a")
            .otherwise(F.col("total_txns").cast("string"))
            .alias("total_txns"),
            F.when(spent > 0, spent).otherwise(F.lit(float("nan"))).alias("max_txn_amount"),
        )
        return serving.clean_types(dirty, SERVING_TYPES["mart_client_360"])

    def insert_ignored(t: Tables) -> DataFrame:
        # Batches of odd merchants are already there, with a count of zero; all batches
        # arrive, each twice.
        new = t["settlement_batches"].select("batch_id", "merchant_id", "batch_date", "txn_count")
        existing = new.where("merchant_id % 2 = 1").withColumn("txn_count", F.lit(0).cast("bigint"))
        added = serving.insert_ignore(
            existing, new.unionByName(new), ["merchant_id", "batch_date"], "batch_id"
        )
        return existing.unionByName(added)

    return {
        "mart_reload": mart_reload,
        "load_reconcile": load_reconcile,
        "mart_type_clean": _over_tables(type_clean),
        "insert_ignore": _over_tables(insert_ignored),
    }


def _streams() -> dict[str, Query]:
    def to_end(name: str, build: Callable[[DataFrame], DataFrame], per_key: bool = True) -> Query:
        def run_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
            root = scratch_path(tune(spark), name)
            out = build(stand_in.events_stream(spark, sf_dir))
            # State per key grows with the input, state per time does not.
            n = run.state_partitions(spark, f"{sf_dir.rstrip('/')}/events.parquet") if per_key else None
            run.append_to(out, f"{root}/out", f"{root}/checkpoint", partitions=n).awaitTermination()
            return spark.read.parquet(f"{root}/out")

        return run_stream

    def timed(events: DataFrame) -> DataFrame:
        txns = stand_in.events_as_transactions(events)
        return txns.withColumns(
            {c: F.col(c).cast("timestamp") for c in ("initiated_at", "created_at")}
        )

    def state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(tune(spark), "state")
        feed = stand_in.change_feed(stand_in.events_stream(spark, sf_dir))
        changes = cdc.decoded(feed, stand_in.FEED_ROW).select(
            "table_name", "row.*", "ts_ms", "offset", "op", "is_delete"
        )
        keys = ["table_name", "pk"]
        state.start_state_sink(
            changes, keys, f"{root}/state", f"{root}/checkpoint"
        ).awaitTermination()
        return (
            state.read_state(spark, f"{root}/state", keys)
            .withColumnRenamed("offset", "off")
            .drop("props", "is_delete")
        )

    def bucketed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, keys = scratch_path(tune(spark), "keyed_state"), ["table_name", "pk"]
        changes = cdc.decoded(stand_in.change_feed(stand_in.events_stream(spark, sf_dir)), stand_in.FEED_ROW)
        flat = changes.select("table_name", "row.*", "ts_ms", "offset", "op", "is_delete")
        keyed_state.start_keyed_state(
            flat, keys, f"{root}/state", f"{root}/checkpoint", buckets=spark.sparkContext.defaultParallelism
        ).awaitTermination()
        live = keyed_state.KeyedState(spark, f"{root}/state", keys).read()
        return live.withColumnRenamed("offset", "off").drop("props", "is_delete")

    def replayed(events: DataFrame) -> DataFrame:
        feed = stand_in.change_feed(events)
        changes = cdc.decoded(feed, stand_in.FEED_ROW).select(
            "table_name", "row.pk", "ts_ms", F.col("offset").alias("off"), "op", "timestamp"
        )
        ended = changes.where("off % 10 = 5 AND op <> 'd'").withColumn("op", F.lit("d"))
        both = changes.unionByName(changes.where("off % 10 = 0")).unionByName(ended)
        return monitors.dedupe(both, ["table_name", "pk"]).drop("timestamp")

    return {
        "refresh_trigger": _over_events(
            lambda e: refresh.refresh_decisions(
                cdc.decoded(stand_in.change_feed(e), stand_in.FEED_ROW), HOURLY_RULE, 3600
            )
        ),
        "cdc_current_state_stream": state_stream,
        "cdc_current_state_buckets": bucketed_state,
        "cdc_dedupe_stream": to_end("dedupe", replayed),
        "stream_ingestion_rate": to_end(
            "ingestion_rate", lambda e: monitors.ingestion_rate(timed(e)), per_key=False
        ),
        "stream_fraud_rate": to_end(
            "fraud_rate", lambda e: monitors.fraud_rate(timed(e)), per_key=False
        ),
        "stream_fraud_velocity": to_end(
            "velocity", lambda e: monitors.velocity_windows(timed(e), minimum=2)
        ),
        "stream_fraud_sessions": to_end(
            "sessions",
            lambda e: monitors.velocity_sessions(timed(e), minimum=2, gap="600 seconds"),
        ),
    }


def queries() -> dict[str, Query]:
    return {
        **_marts(),
        **_increments(),
        **_staging(),
        **_joins(),
        **_serving(),
        **_scalars(),
        **_fraud(),
        **_quality(),
        **_monitor(),
        **_changes(),
        **_ingest(),
        **_lake(),
        **_load(),
        **_streams(),
    }
