"""Continuous telemetry: late data, duplicates, availability, outages.

With output mode ``append`` a window appears once the watermark has passed it,
48 hours after its end; ``update`` and ``complete`` show open windows as well.
Rows later than the watermark are dropped by Spark and counted in the query
progress; ``late_rows`` reads that count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthmill.operators.outages import uptime
from hearthmill.operators.quality import TIMELY_HOURS
from hearthmill.operators.telemetry import with_fallback
from hearthmill.sources.shared import fresh_path

WATERMARK = f"{TIMELY_HOURS} hours"
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# 48 hours of keys do not fit in memory; state is kept on disk and only its
# changes go to the progress folder.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_SPREAD = 16


def read_sample_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """JSON-lines folder as a stream.

    ``record`` holds a line that does not fit the schema; ``_arrival`` spreads
    the copies of a row.
    """
    fields = [*schema.fields, T.StructField("record", T.StringType())]
    reader = (
        spark.readStream.schema(T.StructType(fields))
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("columnNameOfCorruptRecord", "record")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file_part = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    return reader.json(folder).withColumn("_arrival", F.pmod(file_part, F.lit(_SPREAD)))


def readable(samples: DataFrame, timestamp: str) -> DataFrame:
    """Samples that fit the schema and say when they were taken."""
    return samples.where(F.col("record").isNull() & F.col(timestamp).isNotNull()).drop("record")


def unreadable(samples: DataFrame, timestamp: str) -> DataFrame:
    """The other ones, for a quarantine stream of their own."""
    return samples.where(F.col("record").isNotNull() | F.col(timestamp).isNull()).drop("_arrival")


def without_duplicates(samples: DataFrame, key: Sequence[str], timestamp: str) -> DataFrame:
    """First arrival of each key within the watermark.

    A key that holds much of the stream is thinned per arrival file before
    all its copies meet in one task.
    """
    return (
        samples.withWatermark(timestamp, WATERMARK)
        .dropDuplicatesWithinWatermark([*key, "_arrival"])
        .dropDuplicatesWithinWatermark(list(key))
    )


def uptime_stream(
    samples: DataFrame, component: Sequence[str], good: Column, timestamp: str, width: str = "1 hour"
) -> DataFrame:
    return uptime(samples, component, good, timestamp, width)


def outage_stream(
    samples: DataFrame, component: Sequence[str], good: Column, timestamp: str, gap: str = "30 minutes"
) -> DataFrame:
    """Bad samples of a component at most ``gap`` apart, as one session."""
    # Sessions of a task are merged before the shuffle, which spreads a component
    # that sends most of the samples.
    samples.sparkSession.conf.set(
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true"
    )
    return (
        samples.where(~good)
        .groupBy(*component, F.session_window(timestamp, gap).alias("_outage"))
        .agg(F.count("*").alias("n_bad"), F.max(timestamp).alias("outage_end"))
        .select(*component, F.col("_outage.start").alias("outage_start"), "outage_end", "n_bad")
    )


def probe_windows(
    samples: DataFrame, component: str, good: Column, timestamp: str, hours: int = 1
) -> DataFrame:
    """Samples, mean value and last status per component and window."""
    return (
        samples.groupBy(component, F.window(timestamp, f"{hours} hours").alias("_window"))
        .agg(
            F.count("*").alias("n_samples"),
            F.count_if(good).alias("n_good"),
            F.avg("metric_value").alias("metric_value"),
            F.max_by("status", timestamp).alias("status"),
        )
        .select(component, F.col("_window.start").alias("window_start"), "n_samples", "n_good",
                "metric_value", "status")
    )


def fill_closed_windows(
    closed: DataFrame, expected: DataFrame, fixture: DataFrame, component: str, hours: int = 1,
    filled_to: int | None = None,
) -> DataFrame:
    """Closed windows with the fixture's row where an expected probe is absent.

    An absent probe shows only once its window has closed, so this runs per
    batch of an append-mode stream. ``fixture`` has one row per component.
    ``filled_to`` is the start of the last window filled by an earlier batch,
    in microseconds; windows between it and this batch are filled too.
    """
    span = closed.agg(F.unix_micros(F.min("window_start")), F.unix_micros(F.max("window_start")))
    first, last = span.first()
    if first is not None and filled_to is not None:
        first = filled_to + hours * 3_600_000_000
    step = F.make_dt_interval(hours=F.lit(hours))
    starts = F.array().cast("array<timestamp>")
    if first is not None:
        starts = F.sequence(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last)), step)
    grid = expected.select(component, F.explode(starts).alias("window_start"))
    backup = fixture.select(
        component,
        F.lit(0).cast("bigint").alias("n_samples"),
        F.lit(0).cast("bigint").alias("n_good"),
        F.col("metric_value").cast("double").alias("metric_value"),
        "status",
    )
    return with_fallback(grid, closed, backup, [component], ["status"], run=["window_start"])


def run_to_table(
    result: DataFrame,
    mode: str,
    label: str,
    per_batch: Callable[[DataFrame, int | None], DataFrame] = lambda batch, reached: batch,
    state_partitions: int | None = None,
    folder: str | None = None,
    reaches: str | None = None,
    carry: Callable[[DataFrame, DataFrame | None], tuple[DataFrame, DataFrame]] | None = None,
) -> tuple[DataFrame, StreamingQuery]:
    """Process what is available; return what was written, and the query.

    Each batch overwrites its own folder, so a repeated batch leaves one copy.
    In complete mode the newest batch holds the whole result. State is spread
    over ``state_partitions``, by default one per core of the cluster.

    ``folder`` keeps progress and output: a later run with the same folder goes
    on where the last one ended. Without it each run starts anew. ``per_batch``
    is also given the greatest ``reaches`` time, in microseconds, that earlier
    batches have written. ``carry`` takes its place where batches hang
    together: from a batch and the rows carried over by the one before (None
    at first) it makes the rows to write and the rows to carry on, which the
    folder keeps under ``carried``.
    """
    spark = result.sparkSession
    folder = folder or fresh_path(spark, label)
    out, marks = f"{folder}/rows", f"{folder}/reached"
    none = spark.createDataFrame([], result.schema)
    nothing = carry(none, None)[0] if carry else per_batch(none, None)
    nothing.write.mode("ignore").parquet(f"{out}/batch=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        own, reached = f"{out}/batch={batch_id}", None
        if reaches or carry:
            # Written first, so that steps which read the batch twice do not compute it twice.
            taken = f"{folder}/taken/batch={batch_id}"
            batch.write.mode("overwrite").parquet(taken)
            batch = spark.read.schema(result.schema).parquet(taken)
            if batch_id and reaches:
                reached = spark.read.parquet(f"{marks}/batch={batch_id - 1}").first()[0]
        if carry:
            before = spark.read.parquet(f"{folder}/carried/batch={batch_id - 1}") if batch_id else None
            rows, kept = carry(batch, before)
            rows.write.mode("overwrite").parquet(own)
            kept.write.mode("overwrite").parquet(f"{folder}/carried/batch={batch_id}")
            return
        per_batch(batch, reached).write.mode("overwrite").parquet(own)
        if reaches:
            latest = spark.read.schema(nothing.schema).parquet(own).agg(F.unix_micros(F.max(reaches)).alias("at"))
            latest = latest.select(F.coalesce("at", F.lit(reached).cast("bigint")).alias("at"))
            latest.write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")

    # A query keeps the settings and the number of state partitions it starts with.
    partitions = str(state_partitions or spark.sparkContext.defaultParallelism)
    wanted = {**STATE_CONF, "spark.sql.shuffle.partitions": partitions}
    earlier = {setting: spark.conf.get(setting, None) for setting in wanted}
    for setting, value in wanted.items():
        spark.conf.set(setting, value)
    query = (
        result.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    for setting, value in earlier.items():
        spark.conf.unset(setting) if value is None else spark.conf.set(setting, value)
    query.awaitTermination()
    schema = T.StructType([*nothing.schema.fields, T.StructField("batch", T.LongType())])
    written = spark.read.schema(schema).parquet(out)
    if mode == "complete":
        written = written.where(F.col("batch") == written.agg(F.max("batch")).first()[0])
    return written.drop("batch"), query


def late_rows(query: StreamingQuery) -> int:
    """Rows that arrived behind the watermark, over the batches Spark still reports."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
