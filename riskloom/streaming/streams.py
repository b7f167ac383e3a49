"""Streaming twins of the batch queries.

Event time needs a ``timestamp`` (not ``timestamp_ntz``) and every stateful step a watermark: rows later than the
delay are dropped and counted by Spark. A bounded replay is closed by a row far in the future (:func:`closed_stream`), so that
its last windows and stretches come out as well and the results are those of the batch queries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from riskloom.functions.shape import as_double, ratio
from riskloom.operators import drift, learn
from riskloom.operators.metrics import recall
from riskloom.session import STATE_STORE, work_dir


def file_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType, ts: str | None = None,
                files_per_trigger: int = 100) -> DataFrame:
    """Parquet files called ``name`` in ``folder`` as a stream, with ``ts`` as event time."""
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", name)
        .option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    )
    return stream if ts is None else stream.withColumn(ts, F.col(ts).cast("timestamp"))


def table_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """A Parquet table as a stream: one file, or a folder of part files. A path without a file is an error, not an empty stream."""
    if not spark.read.schema(schema).parquet(path).inputFiles():
        raise ValueError(f"no files at {path}")
    # As a pattern that matches nothing else: a plain path must be a folder.
    path = path.rstrip("/")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path[:-1]}[{path[-1]}]")


FAR = "2200-01-01"


def closed_stream(stream: DataFrame, ts: str, tag: str) -> tuple[DataFrame, Callable[[], None]]:
    """``stream`` with a second source of one row, and what writes that row: nulls, and ``ts`` far in the future.

    Once everything else has been processed, the row moves the watermark past all windows. It lies in no window that is emitted.
    It must pass the filters in front of the watermark; join keys, which are filtered for nulls there, need a value for it.
    """
    spark = stream.sparkSession
    folder = work_dir(spark, tag)
    spark.createDataFrame([], stream.schema).write.parquet(folder)

    def close() -> None:
        row = {f.name: F.lit(None).cast(f.dataType) for f in stream.schema} | {ts: F.lit(FAR).cast("timestamp")}
        spark.range(1).select(*[c.alias(n) for n, c in row.items()]).write.mode("append").parquet(folder)

    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder)), close


def use_rocksdb(spark: SparkSession) -> None:
    """Arbitrary state and large windows live in RocksDB rather than on the heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def run_available(stream: DataFrame, tag: str, partition_by: Sequence[str] = (), close: Callable[[], None] | None = None) -> DataFrame:
    """Process what is there, then stop; the sink is a Parquet folder with exactly-once commits.

    With ``close``, the query goes on from its checkpoint once the closing row is written.
    """
    spark = stream.sparkSession
    base = work_dir(spark, tag)
    writer = (
        stream.writeStream.format("parquet").option("path", f"{base}/data")
        .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start().awaitTermination()
    if close is not None:
        close()
        writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/data")


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], tag: str, close: Callable[[], None] | None = None) -> None:
    """As :func:`run_available`, with a function of every micro-batch as the sink."""
    checkpoint = f"{work_dir(stream.sparkSession, tag)}/checkpoint"
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start().awaitTermination()
    if close is not None:
        close()
        writer.start().awaitTermination()


# -- stateless and windowed ------------------------------------------------------------------------------------


def score_stream(model: PipelineModel | None, stream: DataFrame, features: Sequence[str], id_col: str,
                 threshold: float = 0.5) -> DataFrame:
    """The same plan as in batch."""
    return learn.score_batch(model, stream, features, id_col, threshold)


def windowed_counts(stream: DataFrame, ts: str, window: str, delay: str, labels: Sequence[str] = (),
                    slide: str | None = None, **aggregates: Column) -> DataFrame:
    """Counts, and any further aggregates, per event-time window; a window is emitted once it is closed."""
    span = F.window(ts, window, slide) if slide else F.window(ts, window)
    grouped = stream.withWatermark(ts, delay).groupBy(span.alias("w"), *labels)
    out = grouped.agg(F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in aggregates.items()])
    return out.select(F.unix_seconds("w.start").alias("window_start"), *labels, "n", *aggregates)


def live_recall(scores: DataFrame, labels: DataFrame, id_col: str, window: str, label_delay: str,
                threshold: float = 0.5) -> DataFrame:
    """Recall and false-positive rate per window of scoring time, from labels that arrive up to ``label_delay`` later.

    ``scores`` has ``(id, scored_at, probability)``, ``labels`` has ``(id, labelled_at, y)``. Both sides carry a
    watermark and the join is bounded in time, so neither side's state grows without limit. A score whose label has not come when the
    watermark passes its time leaves the state as ``unlabelled`` and counts in no other cell.
    """
    left = scores.withWatermark("scored_at", label_delay).alias("s")
    right = labels.withColumnRenamed(id_col, "label_id").withWatermark("labelled_at", label_delay).alias("l")
    joined = left.join(
        right,
        (F.col(id_col) == F.col("label_id")) & (F.col("labelled_at") >= F.col("scored_at"))
        & (F.col("labelled_at") <= F.col("scored_at") + F.expr(f"interval {label_delay}")),
        "left",
    )
    hit, real = F.col("probability") >= threshold, F.col("y") == 1
    cells = joined.groupBy(F.window("scored_at", window).alias("w")).agg(
        F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & real).alias("fn"), F.count_if(~hit & ~real).alias("tn"), F.count_if(F.col("label_id").isNull()).alias("unlabelled"),
    )
    return cells.select(
        F.unix_seconds("w.start").alias("window_start"), "tp", "fp", "fn", "tn", "unlabelled",
        recall(F.col("tp"), F.col("fn")).alias("recall"), ratio(F.col("fp"), F.col("fp") + F.col("tn")).alias("fpr"),
    )


def drift_stream(stream: DataFrame, reference: DataFrame, columns: Sequence[str], path: str,
                 method: str = "asymptotic", min_n: int = 10) -> DataFrame:
    """Scores of every micro-batch against a fixed reference, one folder per batch.

    The reference is counted and saved once. A batch that is run again after a failure overwrites its own folder.
    """
    saved = work_dir(stream.sparkSession, "reference")
    drift.save_reference(reference, columns, saved)

    def check(batch: DataFrame, number: int) -> None:
        scores = drift.feature_scores(drift.ks_saved(saved, batch, min_n), method=method)
        scores.write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_batches(stream, check, "drift")
    return stream.sparkSession.read.parquet(path)


def window_drift_stream(stream: DataFrame, ts: str, window: str, delay: str, reference: DataFrame, columns: Sequence[str], path: str,
                        method: str = "asymptotic", min_n: int = 1, close: Callable[[], None] | None = None) -> DataFrame:
    """Scores of every event-time window against a fixed reference: ``window_start`` and the columns of the drift scores.

    The state holds counts per (window, feature, value). A window is judged when the watermark has passed it, as a whole, so the rows
    don't depend on how they came in files and micro-batches. A batch that is run again overwrites its own folder.
    """
    saved = work_dir(stream.sparkSession, "reference")
    drift.save_reference(reference, columns, saved)
    entries = F.array(*[F.struct(F.lit(i).alias("feature"), as_double(c).alias("value")) for i, c in enumerate(columns)])
    # Missing values go behind the watermark, so that the closing row still moves it.
    long = stream.withWatermark(ts, delay).select(ts, F.inline(entries)).where(F.col("value").isNotNull())
    counts = long.groupBy(F.window(ts, window).alias("w"), "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select(F.unix_seconds("w.start").alias("window_start"), "feature", "value", "n")

    def check(batch: DataFrame, number: int) -> None:
        ks = drift.ks_windows(saved, batch, ["window_start"], min_n)
        drift.feature_scores(ks, method=method, by=["window_start"]).write.mode("overwrite").parquet(f"{path}/batch={number}")

    run_batches(counts, check, "drift", close)
    return stream.sparkSession.read.parquet(path).drop("batch")


# -- arbitrary state -------------------------------------------------------------------------------------------


def _key_row(names: Sequence[str], key: tuple, **values) -> dict:
    return {**dict(zip(names, key)), **values}


class SustainedProcessor(StatefulProcessor):
    """Per key: since when the condition has held, the last evaluation, and whether that was reported.

    Evaluations of one key are few (one per step), so a batch of them is sorted in place. They must not come in a later batch than
    a later step, as is so for closed windows.
    """

    def __init__(self, names: list[str], hold: int, step: int):
        self.names, self.hold, self.step = names, hold, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.since = handle.getValueState("since", "since bigint, fired boolean, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        steps = sorted((int(t), bool(on)) for chunk in rows for t, on in zip(chunk["t"], chunk["on"]))
        since, fired, last = self.since.get() if self.since.exists() else (None, False, None)
        out = []
        for t, on in steps:
            if last is not None and t - last > self.step:
                since, fired = None, False
            last = t
            if not on:
                since, fired = None, False
                continue
            since = t if since is None else since
            if not fired and t - since >= self.hold:
                fired = True
                out.append(_key_row(self.names, key, active_since=since, fired_at=since + self.hold))
        if since is None:
            self.since.clear()
        else:
            self.since.update((since, fired, last))
        if out:
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def alert_stream(steps: DataFrame, keys: Sequence[str], hold: int, step: int, key_types: str) -> DataFrame:
    """``steps`` has ``(*keys, t, on)``; emits ``(*keys, active_since, fired_at)`` once per stretch that lasts.

    Evaluations more than ``step`` seconds apart do not belong to one stretch.
    """
    use_rocksdb(steps.sparkSession)
    return steps.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=SustainedProcessor(list(keys), hold, step),
        outputStructType=f"{key_types}, active_since bigint, fired_at bigint", outputMode="Append", timeMode="None",
    )


class NotifyProcessor(StatefulProcessor):
    """Per group: when it was last notified. Alerts wait until the watermark has passed them, so they are judged in event time."""

    def __init__(self, names: list[str], repeat: int):
        self.names, self.repeat = names, repeat

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last bigint")
        self.waiting = handle.getMapState("waiting", "minute bigint", "seconds bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # The seconds of each minute as bits, gathered over all rows first: state is written once a minute, however many rows there are.
        minutes: dict[int, int] = {}
        for chunk in rows:
            for t in chunk["us"].floordiv(1_000_000).unique().tolist():
                minutes[t // 60] = minutes.get(t // 60, 0) | 1 << t % 60
        for minute, seconds in minutes.items():
            if self.waiting.containsKey((minute,)):
                seconds |= self.waiting.getValue((minute,))[0]
            else:
                self.handle.registerTimer((minute + 1) * 60_000)
            self.waiting.updateValue((minute,), (seconds,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        minute = expiredTimerInfo.getExpiryTimeInMs() // 60_000 - 1
        if not self.waiting.containsKey((minute,)):
            return
        seconds = self.waiting.getValue((minute,))[0]
        self.waiting.removeKey((minute,))
        before = last = self.last.get()[0] if self.last.exists() else None
        out = []
        for t in (minute * 60 + s for s in range(60) if seconds >> s & 1):
            if last is None or t - last >= self.repeat:
                last = t
                out.append(_key_row(self.names, key, notified_at=t))
        if last != before:
            self.last.update((last,))
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def first_alerts(alerts: DataFrame, ts: str, delay: str, key_types: str, keys: Sequence[str] = ("alertname", "category"),
                 repeat: int = 3 * 3600) -> DataFrame:
    """``(*keys, notified_at)``: the first alert of a group, and again the first one ``repeat`` seconds or more after the last."""
    use_rocksdb(alerts.sparkSession)
    rows = alerts.withWatermark(ts, delay).select(*keys, ts, F.unix_micros(ts).alias("us"))
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=NotifyProcessor(list(keys), repeat), outputStructType=f"{key_types}, notified_at bigint",
        outputMode="Append", timeMode="EventTime",
    )


class SilenceProcessor(StatefulProcessor):
    """Per source: the last time seen. Rows are folded into spans while they are read, never held."""

    def __init__(self, names: list[str], gap: int):
        self.names, self.gap = names, gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last bigint, reported boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        gap = self.gap * 1_000_000
        spans: dict[int, tuple[int, int]] = {}
        for chunk in rows:
            groups = chunk["us"].groupby(chunk["us"] // gap)
            for span, low, high in zip(groups.groups, groups.min(), groups.max()):
                known = spans.get(span, (low, high))
                spans[span] = (min(low, known[0]), max(high, known[1]))
        last, reported = self.last.get() if self.last.exists() else (None, False)
        out = []
        for _, (low, high) in sorted(spans.items()):
            if last is not None and low - last > gap and not reported:
                out.append(_key_row(self.names, key, silent_from=int(last // 1_000_000)))
            if last is None or high > last:
                last, reported = int(high), False
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.last.update((last, reported))
        # In milliseconds; one more, as only a gap longer than the limit is silence.
        self.handle.registerTimer(max((last + gap) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))
        if out:
            yield pd.DataFrame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, reported = self.last.get()
        if not reported:
            self.last.update((last, True))
            yield pd.DataFrame([_key_row(self.names, key, silent_from=int(last // 1_000_000))])

    def close(self) -> None:
        pass


def silence_stream(stream: DataFrame, ts: str, keys: Sequence[str], gap: int, delay: str, key_types: str) -> DataFrame:
    """``(*keys, silent_from)`` once for every stretch longer than ``gap`` seconds without a row."""
    use_rocksdb(stream.sparkSession)
    rows = stream.withWatermark(ts, delay).select(*keys, ts, F.unix_micros(ts).alias("us"))
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=SilenceProcessor(list(keys), gap), outputStructType=f"{key_types}, silent_from bigint",
        outputMode="Append", timeMode="EventTime",
    )


class RetrainProcessor(StatefulProcessor):
    """Per model: days since the last retraining. What is urgent is decided before, by plain columns."""

    def __init__(self, names: list[str], period: int):
        self.names, self.period = names, period

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getValueState("days", "days bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        steps = sorted((int(d), bool(u)) for chunk in rows for d, u in zip(chunk["day"], chunk["urgent"]))
        days = self.days.get()[0] if self.days.exists() else 0
        out = []
        for day, urgent in steps:
            days += 1
            retrained = urgent or days >= self.period
            days = 0 if retrained else days
            out.append(_key_row(self.names, key, day=day, retrained=retrained))
        self.days.update((days,))
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


def retrain_stream(daily: DataFrame, keys: Sequence[str], urgent: Column, period: int, key_types: str) -> DataFrame:
    """``(*keys, day, retrained)`` as the days of each model come in."""
    use_rocksdb(daily.sparkSession)
    rows = daily.select(*keys, "day", F.coalesce(urgent, F.lit(False)).alias("urgent"))
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=RetrainProcessor(list(keys), period), outputStructType=f"{key_types}, day bigint, retrained boolean",
        outputMode="Append", timeMode="None",
    )
