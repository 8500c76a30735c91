"""Streams of readings: source, duplicate suppression, windows, enrichment, running."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq import schema
from airq.session import scratch_path
from airq.sources.readers import conform_readings

WATERMARK = "2 hours"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_SHUFFLE = "spark.sql.shuffle.partitions"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sensor_csv_stream(spark: SparkSession, path: str, max_files: int = 100, **kw) -> DataFrame:
    """Readings from CSV files as they arrive."""
    raw = spark.readStream.schema(schema.READING_CSV).option("header", True).option("maxFilesPerTrigger", max_files).csv(path)
    return conform_readings(raw, **kw)


def parquet_stream(spark: SparkSession, path: str, fields, max_files: int = 100, glob: str | None = None) -> DataFrame:
    reader = spark.readStream.schema(fields).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def deduplicated(readings: DataFrame, keys: list[str], time: str = "time", delay: str = WATERMARK) -> DataFrame:
    """First of the exact repeats of (keys, time) that a re-read file delivers."""
    return readings.withWatermark(time, delay).dropDuplicatesWithinWatermark([*keys, time])


def hourly(readings: DataFrame, keys: list[str], time: str = "time", value: str = "h2s_ppb", delay: str = WATERMARK) -> DataFrame:
    """Mean, maximum and count per tumbling hour."""
    return _windowed(readings, keys, F.window(time, "1 hour"), time, value, delay)


def rolling_day(readings: DataFrame, keys: list[str], time: str = "time", value: str = "h2s_ppb", delay: str = WATERMARK) -> DataFrame:
    """The same over 24 hours, every hour."""
    return _windowed(readings, keys, F.window(time, "24 hours", "1 hour"), time, value, delay)


def exceedance_sessions(readings: DataFrame, keys: list[str], threshold: float, time: str = "time", value: str = "h2s_ppb",
                        gap: str = "3 hours", delay: str = WATERMARK) -> DataFrame:
    """Exceedances less than ``gap`` apart as one session."""
    return _windowed(readings.filter(F.col(value) >= threshold), keys, F.session_window(time, gap), time, value, delay)


def _windowed(readings, keys, window, time, value, delay):
    marked = readings if readings.isStreaming is False else readings.withWatermark(time, delay)
    agg = marked.groupBy(*keys, window.alias("w")).agg(
        F.avg(value).alias("mean"), F.max(value).alias("max"), F.count(F.lit(1)).alias("n"))
    return agg.select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "mean", "max", "n")


def enriched(readings: DataFrame, forecast: DataFrame, weather: DataFrame, keys: list[str]) -> DataFrame:
    """Stream rows beside the latest forecast summary and weather (static sides)."""
    return readings.join(forecast, keys, "left").join(weather, [k for k in keys if k in weather.columns], "left")


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None = None):
    """Settings for the stateful queries started inside: state in RocksDB, which spills
    to disk and checkpoints incrementally, and no more state stores than twice the
    cores, since each costs a store per batch however little it holds."""
    few = min(int(spark.conf.get(_SHUFFLE)), 2 * spark.sparkContext.defaultParallelism)
    wanted = {_PROVIDER: _ROCKS, _SHUFFLE: str(partitions or few)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available(stream: DataFrame, label: str, timeout_s: int | None = None, checkpoint: str | None = None, sink: str | None = None,
                  foreach_batch=None) -> DataFrame | None:
    """Run a stream over all files present now into parquet below the shared folder and
    return what was written; ``timeout_s`` is for tests, a run has no time limit by itself."""
    spark = stream.sparkSession
    out = sink or scratch_path(spark, f"{label}-out")
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint or scratch_path(spark, f"{label}-cp")).trigger(availableNow=True)
    with state_settings(spark):
        if foreach_batch is not None:
            q = writer.foreachBatch(foreach_batch).start()
        else:
            q = writer.format("parquet").option("path", out).start()
        done = q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination() or True
    if not done:
        q.stop()
        raise TimeoutError(f"stream {label} did not finish in {timeout_s} s")
    return None if foreach_batch is not None else spark.read.schema(stream.schema).parquet(out)
