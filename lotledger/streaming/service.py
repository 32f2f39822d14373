"""Service metrics over request events; every function takes a batch or a stream.

Streams need event time as ``timestamp`` and a watermark (:func:`as_event_time`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import sanitize
from ..operators.policy import input_verdict
from ..session import scratch_path

# Histogram bounds for predicted prices and for chat latency.
PRICE_BUCKETS = (100_000, 250_000, 500_000, 1_000_000, 2_500_000, 5_000_000, 10_000_000, 25_000_000, 50_000_000)
LATENCY_BUCKETS = (0.1, 0.5, 1, 2, 5, 10, 30, 60)
WATERMARK = "1 minute"


def as_event_time(events: DataFrame, ts: str = "ts", watermark: str = WATERMARK) -> DataFrame:
    """Cast ``ts`` to an instant and, on a stream, declare how late rows may be."""
    timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
    return timed.withWatermark(ts, watermark) if events.isStreaming else timed


def totals(events: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Counter per label combination; a missing label counts as ``unknown``."""
    named = events.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in labels})
    return named.groupBy(*labels).agg(F.count(F.lit(1)).alias("total"))


def tool_totals(events: DataFrame, tools: str = "tools_used") -> DataFrame:
    """Counter per tool over a list column."""
    return totals(events.select(F.explode(tools).alias("tool_name")), ["tool_name"])


def _bucket_counts(value: Column, bounds: Sequence[float]) -> Column:
    """Cumulative counts at or below each bound, then the count of all."""
    return F.array(*[F.count_if(value <= float(b)) for b in bounds], F.count(value))


def histogram(events: DataFrame, value: str, bounds: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """One row per key and bound ``le`` (``+Inf`` last) with the cumulative count; sum and count repeat."""
    labels = F.array(*[F.lit(f"{float(b):g}") for b in bounds], F.lit("+Inf"))
    grouped = events.groupBy(*keys).agg(
        _bucket_counts(F.col(value), bounds).alias("_b"), F.sum(value).alias("sum"), F.count(value).alias("count")
    )
    cells = F.explode(F.arrays_zip(labels.alias("le"), F.col("_b").alias("cumulative")))
    return grouped.select(*keys, "sum", "count", cells.alias("_c")).select(*keys, "_c.le", "_c.cumulative", "sum", "count")


def bucket_quantile(counts: Column, bounds: Sequence[float], q: float = 0.95) -> Column:
    """Quantile from cumulative bucket counts, linear inside a bucket.

    Beyond the last bound the last bound is returned; NULL without events.
    """
    total = F.element_at(counts, len(bounds) + 1)
    rank = total * F.lit(float(q))
    out = F.when(total == 0, F.lit(None).cast("double"))
    for i, bound in enumerate(bounds):
        upto = F.element_at(counts, i + 1)
        before = F.element_at(counts, i) if i else F.lit(0)
        low = float(bounds[i - 1]) if i else 0.0
        inside = F.try_divide(rank - before, upto - before)
        out = out.when(upto >= rank, F.lit(low) + (F.lit(float(bound)) - F.lit(low)) * F.coalesce(inside, F.lit(0.0)))
    return out.otherwise(F.lit(float(bounds[-1])))


def windowed_quantile(events: DataFrame, value: str, bounds: Sequence[float], keys: Sequence[str] = (), ts: str = "ts",
                      width: str = "5 minutes", slide: str | None = None, q: float = 0.95) -> DataFrame:
    """Bucket quantile per event-time window."""
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    grouped = events.groupBy(span.alias("window"), *keys).agg(_bucket_counts(F.col(value), bounds).alias("_b"))
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
        bucket_quantile(F.col("_b"), bounds, q).alias("quantile"),
    )


def rate(events: DataFrame, keys: Sequence[str] = (), ts: str = "ts", width_s: int = 300, slide_s: int = 15,
         panes: bool | None = None) -> DataFrame:
    """Events per second over a sliding window.

    Events are first counted per slide-long pane (one row per pane and key) and
    only the panes are spread over the windows they belong to. A stream in
    ``append`` mode emits a window once the watermark has passed it, and then
    forgets it; ``panes`` asks for the two steps there too, which the
    ``complete`` mode does not allow.
    """
    width, slide = f"{width_s} seconds", f"{slide_s} seconds"
    panes = not events.isStreaming if panes is None else panes
    if width_s % slide_s or not panes:
        grouped = events.groupBy(F.window(ts, width, slide).alias("window"), *keys).agg(F.count(F.lit(1)).alias("n"))
    else:
        counted = events.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(F.count(F.lit(1)).alias("n"))
        grouped = counted.groupBy(F.window(F.col("pane"), width, slide).alias("window"), *keys).agg(F.sum("n").alias("n"))
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys,
        (F.col("n") / F.lit(float(width_s))).alias("per_second"),
    )


def error_rate(events: DataFrame, status: str = "status", pattern: str = "^[45]..$", **options) -> DataFrame:
    """:func:`rate` of failing statuses, by status."""
    return rate(events.where(F.col(status).cast("string").rlike(pattern)), [status], **options)


def mean_value(events: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean with the denominator kept at one or more, so no events give zero."""
    return events.groupBy(*keys).agg(
        (F.coalesce(F.sum(value), F.lit(0.0)) / F.greatest(F.count(value), F.lit(1))).alias("mean_value")
    )


def absence_alerts(events: DataFrame, source: str, ts: str = "ts", quiet_s: int = 60) -> DataFrame:
    """When each source had been silent for ``quiet_s`` seconds.

    A stream uses session windows, whose end is the alert. In batch events are
    first reduced to the first and last of every ``quiet_s`` bucket of a source:
    two events of one bucket cannot be that far apart, so the silences lie
    between a bucket's last event and the next bucket's first one. Events
    without a time say nothing.
    """
    if events.isStreaming:
        sessions = events.groupBy(F.session_window(ts, f"{quiet_s} seconds").alias("s"), source).agg(F.count(F.lit(1)).alias("n"))
        return sessions.select(source, F.col("s.end").alias("alert_at"))
    bucket = F.floor(F.unix_micros(F.col(ts)) / F.lit(quiet_s * 1_000_000))
    spans = events.where(F.col(ts).isNotNull()).groupBy(source, bucket.alias("_bucket")).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
    following = F.lead("_first").over(Window.partitionBy(source).orderBy("_bucket"))
    alert = F.col("_last") + F.make_dt_interval(secs=F.lit(quiet_s))
    gaps = spans.withColumn("_next", following).where(F.col("_next").isNull() | (F.col("_next") > alert))
    return gaps.select(source, alert.alias("alert_at"))


def live_absence_alerts(events: DataFrame, source: str, ts: str = "ts", quiet_s: int = 60) -> DataFrame:
    """:func:`absence_alerts` of a stream that also speaks when nothing arrives any more.

    Every source keeps its latest event as state and sets a timer. Gaps between
    events of a batch, and to the latest one before it, give alerts at once;
    when the timer ends without an event, the silence after the latest one is
    told, once. An event older than the latest closes no silence already told.
    Times are read in the session's zone; events without a time say nothing.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    kind = events.schema[source].dataType.simpleString()
    named = events.where(F.col(ts).isNotNull()).select(F.col(source).alias("source"), F.unix_micros(F.col(ts)).alias("at"))
    quiet = quiet_s * 1_000_000

    def watch(key, batches, state):
        import numpy as np
        import pandas as pd

        last, told = state.get if state.exists else (None, False)
        out = []
        if state.hasTimedOut:
            if not told:
                out.append(last + quiet)
                state.update((last, True))
        else:
            # the first and last event of every quiet_s: no silence lies between two events of one
            spans: dict = {}
            for batch in batches:
                for bucket, at in batch["at"].groupby(batch["at"] // quiet):
                    low, high = spans.get(bucket, (at.min(), at.max()))
                    spans[bucket] = (min(low, at.min()), max(high, at.max()))
            for bucket in sorted(spans):
                for at in map(int, spans[bucket]):
                    if last is None or at > last:
                        if last is not None and at > last + quiet and not told:
                            out.append(last + quiet)
                        last, told = at, False
            state.update((last, told))
            if not told:
                state.setTimeoutDuration(quiet_s * 1000)
        yield pd.DataFrame({"source": [key[0]] * len(out), "alert_us": np.array(out, np.int64)})

    found = named.groupBy("source").applyInPandasWithState(
        watch, f"source {kind}, alert_us long", "last long, told boolean", "append", GroupStateTimeout.ProcessingTimeTimeout)
    return found.select(F.col("source").alias(source), F.timestamp_micros("alert_us").alias("alert_at"))


def screen_messages(messages: DataFrame, text: str = "message") -> DataFrame:
    """Policy verdict per chat request."""
    clean = messages.withColumn("_v", input_verdict(sanitize(F.col(text))))
    return clean.select(*messages.columns, F.col("_v.allowed").alias("allowed"), F.col("_v.reason").alias("reason"))


def run_available(stream: DataFrame, mode: str = "append", label: str = "stream") -> DataFrame:
    """Process what is available now and return the result as a table.

    ``append`` keeps every emitted row; ``complete`` keeps the last full result.
    Output and checkpoint live in the shared folder. Each batch has its own
    folder, so a batch that is retried replaces its output.
    """
    spark: SparkSession = stream.sparkSession
    out, checkpoint = scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")
    latest = {}

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        latest["id"] = batch_id

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(keep)
    writer.trigger(availableNow=True).start().awaitTermination()
    if not latest:
        return spark.createDataFrame([], stream.schema)
    path = f"{out}/batch={latest['id']}" if mode == "complete" else f"{out}/batch=*"
    return spark.read.schema(stream.schema).parquet(path)
