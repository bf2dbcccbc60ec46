"""When to rebuild the marts: enough pending changes, or enough time with any."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from txnlake.session import written
from txnlake.streaming.run import for_each_batch

#: Ticks that one task decides at a time; results do not depend on it.
SEGMENT_TICKS = 65_536
LOG_DDL = (
    "decided_at timestamp, n_events bigint, pending bigint, elapsed_seconds bigint, "
    "reason string, last_refresh timestamp"
)


@dataclass(frozen=True)
class RefreshRule:
    rows: int = 500
    seconds: int = 60

    def reason(self, pending: int, elapsed: float) -> str:
        """``rows``, ``time`` or ``none``."""
        if pending >= self.rows:
            return "rows"
        if elapsed >= self.seconds and pending > 0:
            return "time"
        return "none"


def refresh_decisions(
    changes: DataFrame,
    rule: RefreshRule = RefreshRule(),
    tick_seconds: int = 10,
    segment_ticks: int = SEGMENT_TICKS,
) -> DataFrame:
    """The decision at every tick of a clock over a change log.

    After a refresh nothing is pending, so the next refresh depends on that tick alone: it is the
    first tick by which enough rows have come, or, if sooner, the first at least ``seconds`` later
    with any. Time is cut into segments. Each segment finds the next refresh of all its ticks at
    once, from running totals, and by doubling these steps the tick at which a chain of refreshes
    that enters it leaves it. Entries (few a segment) are then followed across segments, again by
    doubling, and every segment marks its refreshes from where the true chain enters. Segments
    without changes cost nothing but their output.
    """
    spark = changes.sparkSession
    # Plain values only, so that workers need nothing but numpy and pandas.
    rows, wait = rule.rows, max(1, -(-rule.seconds // tick_seconds))
    size = max(segment_ticks, wait + 1)
    tick = F.floor(F.unix_seconds("timestamp") / tick_seconds).cast("bigint")
    counts = written(changes.groupBy(tick.alias("tick")).agg(F.count(F.lit(1)).alias("n")), "ticks")
    ends = counts.agg(F.min("tick").alias("first"), F.max("tick").alias("last")).first()
    first = ends["first"] if ends["first"] is not None else 0
    # Ticks count from 1; at 0 stands a refresh that never was, from which the first wait runs.
    final = ends["last"] - first + 1 if ends["last"] is not None else 0
    numbered = counts.select((F.col("tick") - first + 1).alias("at"), "n").withColumn(
        "seg", F.floor(F.col("at") / size)
    )
    segments = written(_segments(numbered, final // size), "segments")

    # A segment looks ahead as far as the longest wait.
    ahead = (F.col("at") % size < wait) & (F.col("seg") > 0)
    dealt = numbered.withColumn(
        "seg", F.explode(F.when(ahead, F.array("seg", F.col("seg") - 1)).otherwise(F.array("seg")))
    )
    marker = segments.select((F.col("seg") * size).alias("at"), F.lit(0).cast("long").alias("n"), "seg")
    dealt = dealt.unionByName(marker).join(segments, "seg")

    def next_refreshes(frame: pd.DataFrame) -> tuple:
        """Of a segment: its first tick, counts, running totals, and the next refresh of each tick."""
        import numpy as np

        start, length = int(frame["seg"].iloc[0]) * size, size + wait
        n = np.zeros(length, np.int64)
        np.add.at(n, frame["at"].to_numpy() - start, frame["n"].to_numpy())
        total = np.cumsum(n) + int(frame["base"].iloc[0])
        later = frame["later"].iloc[0]
        beyond = never if pd.isna(later) else int(later) - start
        own = np.arange(size)
        some = np.searchsorted(total, total[:size] + 1)
        by_time = np.maximum(own + wait, np.where(some < length, some, beyond))
        by_rows = np.searchsorted(total, total[:size] + rows)
        return start, n, total, np.minimum(by_time, np.where(by_rows < length, by_rows, never))

    def pass_through(frame: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        start, n, total, following = next_refreshes(frame)
        last = np.where(following < size, following, np.arange(size))
        for _ in range(size.bit_length()):
            last = last[last]
        entry = np.unique(np.append(np.arange(wait), np.flatnonzero(n[:size])[:1]))
        last = last[entry]
        leaves = np.where(following[last] < never, following[last] + start, -1)
        return pd.DataFrame(
            {"entry": entry + start, "last": last + start, "last_total": total[last], "leaves": leaves}
        )

    def decide(frame: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        start, n, total, following = next_refreshes(frame)
        fired, entry = np.zeros(size, bool), frame["entry"].iloc[0]
        if not pd.isna(entry):
            step = np.append(np.minimum(following, size), size)
            marked = np.array([int(entry) - start])
            for _ in range(size.bit_length()):
                marked = np.unique(np.append(marked, step[marked]))
                step = step[step]
            fired[marked[marked < size]] = True
        before = np.maximum.accumulate(np.where(fired, np.arange(size), -1))
        before = np.append(-1, before[:-1])
        known = before >= 0
        at = np.arange(size) + start
        pending = total[:size] - np.where(known, total[before], int(frame["before_total"].fillna(0).iloc[0]))
        waited = at - np.where(known, before + start, int(frame["before"].fillna(0).iloc[0]))
        reason = np.where(fired, np.where(pending >= rows, "rows", "time"), "none")
        out = pd.DataFrame({"at": at, "n_events": n[:size], "pending": pending, "waited": waited, "reason": reason})
        return out[(at >= 1) & (at <= final)]

    never = 1 << 62
    passes = "entry long, last long, last_total long, leaves long"
    entries = written(dealt.groupBy("seg").applyInPandas(pass_through, passes), "entries")
    chain = _followed(entries, segments.count()).withColumn("seg", F.floor(F.col("entry") / size))
    # At most one entry a segment is on the chain, and later ones have later refreshes.
    earlier = Window.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    placed = segments.select("seg", "following_seg").join(chain, "seg", "left")
    placed = placed.withColumns(
        {
            "before": F.max("last").over(earlier),
            "before_total": F.max("last_total").over(earlier),
        }
    )
    placed = written(placed, "chain")
    decided = dealt.join(placed.select("seg", "entry", "before", "before_total"), "seg")
    ticks = decided.groupBy("seg").applyInPandas(
        decide, "at long, n_events long, pending long, waited long, reason string"
    )
    # Segments in which nothing happens: nothing is pending any more.
    silent = (
        placed.where("following_seg > seg + 1")
        .select(
            F.explode(F.sequence(F.col("seg") + 1, F.col("following_seg") - 1)).alias("seg"),
            F.coalesce("last", "before").alias("before"),
        )
        .select(F.explode(F.sequence(F.col("seg") * size, (F.col("seg") + 1) * size - 1)).alias("at"), "before")
    )
    nothing = F.lit(0).cast("long")
    ticks = ticks.unionByName(
        silent.select(
            "at",
            nothing.alias("n_events"),
            nothing.alias("pending"),
            (F.col("at") - F.col("before")).alias("waited"),
            F.lit("none").alias("reason"),
        )
    )
    return ticks.select(
        F.timestamp_seconds((F.col("at") + (first - 1)) * tick_seconds).cast("timestamp_ntz").alias("tick_start"),
        "n_events",
        "pending",
        (F.col("waited") * tick_seconds).alias("elapsed_seconds"),
        "reason",
    )


def _segments(numbered: DataFrame, last_seg: int) -> DataFrame:
    """Segments with changes and those right after them: seg, base (changes before it), later (the
    next tick with changes after it), following_seg. One row for all ticks of a segment, so the
    windows over them stay small."""
    own = numbered.groupBy("seg").agg(F.sum("n").alias("n"), F.min("at").alias("first_at"))
    start = own.sparkSession.range(1).select(F.col("id").alias("seg"))
    next_ = own.select((F.col("seg") + 1).alias("seg")).where(F.col("seg") <= last_seg)
    every = start.unionByName(next_).distinct().join(own, "seg", "full")
    order = Window.orderBy("seg")
    return every.select(
        "seg",
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.min("first_at").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("later"),
        F.lead("seg").over(order).alias("following_seg"),
    )


def _followed(entries: DataFrame, n_segments: int) -> DataFrame:
    """The entries that the chain from tick 0 comes by: steps are doubled until they span all
    segments, and at each length what is reached so far takes one more step."""
    step = entries.select("entry", "leaves")
    reached = entries.where("entry = 0").select("entry")
    for _ in range(max(0, n_segments - 1).bit_length()):
        further = reached.join(step, "entry").select(F.col("leaves").alias("entry"))
        reached = written(reached.unionByName(further).distinct(), "reached")
        onward = step.select(F.col("entry").alias("leaves"), F.col("leaves").alias("further"))
        step = written(step.join(onward, "leaves").select("entry", F.col("further").alias("leaves")), "steps")
    return entries.join(reached, "entry")


class RefreshTrigger:
    """Rebuilds marts from a change stream by the rule; batches are serial, so never two at once.

    Its state is one log row per micro-batch in a shared folder. A replayed batch starts
    from the row before it and overwrites its own, so a restart changes no decision.
    """

    def __init__(
        self,
        spark: SparkSession,
        log: str,
        refresh: Callable[[str], None],
        rule: RefreshRule = RefreshRule(),
        clock: Callable[[DataFrame], datetime] | None = None,
    ):
        self.spark, self.log, self.refresh, self.rule = spark, log, refresh, rule
        self.clock = clock or (lambda _: datetime.now())

    def start(
        self, changes: DataFrame, checkpoint: str, every: str | None = None
    ) -> StreamingQuery:
        """Decide at every micro-batch. With ``every``, a clock stream runs beside the changes,
        so that the time rule is tested also while nothing arrives."""
        marked = changes.withColumn("_change", F.lit(True))
        if every:
            ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
            marked = marked.select("_change", "timestamp").unionByName(
                ticks.select(F.lit(False).alias("_change"), "timestamp")
            )
        return for_each_batch(marked, self._on_marked, checkpoint, every)

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        self._decide(batch_id, batch.count(), self.clock(batch))

    def _on_marked(self, batch: DataFrame, batch_id: int) -> None:
        self.on_batch(batch.where("_change").drop("_change"), batch_id)

    def final_pass(self, batch_id: int) -> None:
        """The last refresh at shutdown, when anything is pending."""
        before = self._before(batch_id)
        if before and before["reason"] == "none" and before["pending"] > 0:
            self.refresh("shutdown")

    def decisions(self) -> DataFrame:
        return self.spark.read.schema(f"{LOG_DDL}, batch_id bigint").parquet(self.log)

    def _before(self, batch_id: int) -> dict | None:
        if batch_id == 0:
            return None
        row = self.spark.read.schema(LOG_DDL).parquet(f"{self.log}/batch_id={batch_id - 1}")
        return row.first().asDict()

    def _decide(self, batch_id: int, n_events: int, now: datetime) -> None:
        before = self._before(batch_id)
        last = before["last_refresh"] if before else now
        carried = before["pending"] if before and before["reason"] == "none" else 0
        pending = carried + n_events
        elapsed = int((now - last).total_seconds())
        reason = self.rule.reason(pending, elapsed)
        if reason != "none":
            self.refresh(reason)
            last = now
        row = (now, n_events, pending, elapsed, reason, last)
        self.spark.createDataFrame([row], LOG_DDL).coalesce(1).write.mode("overwrite").parquet(
            f"{self.log}/batch_id={batch_id}"
        )


DECISION_DDL = (
    "mart string, decided_at timestamp, n_events bigint, pending bigint, elapsed_seconds bigint, reason string"
)


def decision_stream(
    changes: DataFrame, rule: RefreshRule = RefreshRule(), marts: dict[str, list[str]] | None = None
) -> DataFrame:
    """A stream of decisions to refresh, by rows when enough changes have come and by a timer
    when the wait is over, also while nothing arrives.

    ``marts`` names the tables that each mart is built from: a mart is due only for changes of its
    own tables. Without it there is one mart, ``all``. ``changes`` needs ``table_name`` then. Each
    task counts its changes first, so the keyed state, pending changes and the last refresh,
    receives a row per task and mart.
    """
    rows, wait = rule.rows, rule.seconds * 1000
    if marts:
        names = F.array(*[F.lit(m) for m in marts])
        feeds = F.array(*[F.array(*[F.lit(t) for t in tables]) for tables in marts.values()])
        of = F.filter(names, lambda m: F.array_contains(feeds[F.array_position(names, m).cast("int") - 1], F.col("table_name")))
        keyed = changes.select(F.explode(of).alias("mart"))
    else:
        keyed = changes.select(F.lit("all").alias("mart"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, int] = {}
        for frame in frames:
            for mart, n in frame["mart"].value_counts().items():
                totals[mart] = totals.get(mart, 0) + n
        yield pd.DataFrame({"mart": list(totals), "n": list(totals.values())})

    class Pending(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("pending", "n bigint, since bigint, due bigint")

        def handleInputRows(self, key, rows_, timerValues):  # noqa: N802, N803
            now = timerValues.getCurrentProcessingTimeInMs()
            before, since, due = self.state.get() if self.state.exists() else (0, now, 0)
            n = sum(int(frame["n"].sum()) for frame in rows_)
            reason = "rows" if before + n >= rows else "time" if now - since >= wait else None
            yield from self.decide(key, now, n, before + n, since, due, reason)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
            now = timerValues.getCurrentProcessingTimeInMs()
            pending, since, due = self.state.get()
            # A refresh in between moved the time that is due.
            reason = "time" if pending and now - since >= wait else None
            yield from self.decide(key, now, 0, pending, since, 0 if now >= due else due, reason)

        def decide(self, key, now, n, pending, since, due, reason):
            if reason:
                self.state.update((0, now, due))
                elapsed = (now - since) // 1000
                at = pd.Timestamp(now, unit="ms", tz="UTC")
                out = [(key[0], at, n, pending, elapsed, reason)]
                yield pd.DataFrame(
                    out, columns=["mart", "decided_at", "n_events", "pending", "elapsed_seconds", "reason"]
                )
                return
            if pending and due <= now:
                due = since + wait
                self.handle.registerTimer(due)
            self.state.update((pending, since, due))

        def close(self) -> None:
            pass

    counted = keyed.mapInPandas(count, "mart string, n bigint")
    return counted.groupBy("mart").transformWithStateInPandas(
        Pending(), DECISION_DDL, outputMode="append", timeMode="ProcessingTime"
    )


def start_refreshes(
    changes: DataFrame,
    refresh: Callable[[str, str], None],
    log: str,
    checkpoint: str,
    every: str,
    rule: RefreshRule = RefreshRule(),
    marts: dict[str, list[str]] | None = None,
) -> StreamingQuery:
    """Call ``refresh(mart, reason)`` for each decision, one after the other, and keep a log of them
    by batch; a replayed batch refreshes again and overwrites its log."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = sorted(batch.collect())  # as many as marts at most
        for row in rows:
            refresh(row["mart"], row["reason"])
        if rows:
            kept = batch.sparkSession.createDataFrame(rows, DECISION_DDL).coalesce(1)
            kept.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    return for_each_batch(decision_stream(changes, rule, marts), handle, checkpoint, every)
