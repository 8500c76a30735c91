"""Writers: multi-format copies, versioned and partitioned tables, event archive."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airq.operators.ordering import earliest


def with_event_id(events: DataFrame, keys: list[str]) -> DataFrame:
    """A stable id from the station, tier and start of an event."""
    parts = [F.regexp_replace(F.col(k).cast("string"), " ", "-") for k in [*keys, "tier"]]
    return events.withColumn("event_id", F.concat_ws("_", *parts, F.date_format("event_start", "yyyyMMdd'T'HHmm")))


def newest_index(events: DataFrame, cap: int = 500) -> DataFrame:
    """The newest ``cap`` events: each task keeps its own newest before they meet."""
    return events.orderBy(F.desc("generated_at"), "event_id").limit(cap)


def _iso(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text."""
    return df.select(*[
        F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(f.name) if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_formats(df: DataFrame, base: str, formats=("csv", "json"), updated: Column | None = None) -> list[str]:
    """The same rows as CSV, JSON records (with ``lastUpdated``) and / or parquet below ``base``."""
    paths = []
    for fmt in formats:
        path = f"{base}.{fmt}"
        if fmt == "csv":
            _iso(df).write.mode("overwrite").option("header", True).csv(path)
        elif fmt == "json":
            stamp = updated if updated is not None else F.current_timestamp()
            _iso(df.withColumn("lastUpdated", stamp)).write.mode("overwrite").json(path)
        elif fmt == "parquet":
            df.write.mode("overwrite").parquet(path)
        else:
            raise ValueError(f"unknown format {fmt!r}")
        paths.append(path)
    return paths


def write_versioned(df: DataFrame, base: str, version: str, latest: bool = True) -> DataFrame:
    """Write ``base/version`` and copy it, as written, to ``base/latest``."""
    spark = df.sparkSession
    path = f"{base}/{version}"
    df.write.mode("overwrite").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    if latest:
        written.write.mode("overwrite").parquet(f"{base}/latest")
    return written


def write_predictions(df: DataFrame, path: str, model: str, run_time: str = "run_time") -> None:
    """Predictions partitioned by model, year, month, day and run hour; only the partitions
    present in ``df`` are replaced."""
    t = F.col(run_time)
    df.withColumns({
        "model": F.lit(model), "year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t),
    }).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "year", "month", "day", "hour").parquet(path)


def write_q_field(field: DataFrame, path: str, now: str, max_age_days: int = 30, week: str = "week") -> None:
    """Weekly partitions always; ``latest`` only from the newest week that ended at most
    ``max_age_days`` before ``now``."""
    field.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(week).parquet(f"{path}/weekly")
    age = F.datediff(F.lit(now).cast("date"), F.date_add(F.col(week), 7))
    fresh = field.filter(age <= max_age_days)
    top = fresh.agg(F.max(week).alias("w")).first().w
    if top is not None:
        fresh.filter(F.col(week) == F.lit(top)).write.mode("overwrite").parquet(f"{path}/latest")


def write_snapshot(df: DataFrame, path: str, stamp: str) -> str:
    """A timestamped copy of the exact training input."""
    target = f"{path}/snapshot_ts={stamp}"
    df.write.mode("errorifexists").parquet(target)
    return target


def save_model_variant(model, features: list[str], path: str, spark) -> None:
    import json

    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(features),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/features")


def event_reports(events: DataFrame, stations: DataFrame, context: DataFrame, keys: list[str]) -> DataFrame:
    """Nested report per event: station, observation, meteorology, flow, thresholds."""
    from airq import catalog as C

    d = with_event_id(events, keys).join(stations, "site_name", "left").join(context, [k for k in keys if k in context.columns], "left")
    n = lambda c: F.expr(f"try_cast({c} AS double)")
    report = F.struct(
        F.lit("1.0").alias("schema_version"), F.col("event_id"), F.col("tier"),
        F.struct(F.col("site_name").alias("name"), F.col("station_lat").alias("lat"), F.col("station_lon").alias("lon")).alias("station"),
        F.struct(F.date_format("peak_time", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time_utc"), F.col("peak").alias("h2s_ppb")).alias("observation"),
        F.struct(n("wind_speed_10m").alias("wind_speed_ms"), n("wind_direction_10m").alias("wind_direction_deg"),
                 n("temperature_2m").alias("temperature_c"), n("relative_humidity_2m").alias("relative_humidity_pct")).alias("meteorology"),
        F.struct(n("sbiwtp_flow_mgd").alias("sbiwtp_flow_mgd"), F.lit(C.PLANT_BASELINE_MGD).alias("sbiwtp_baseline_mgd"),
                 F.round(C.PLANT_BASELINE_MGD - n("sbiwtp_flow_mgd"), 2).alias("sbiwtp_deficit_mgd")).alias("flow"),
        F.struct(F.lit(C.WATCH_PPB).alias("watch_ppb"), F.lit(C.CRITICAL_PPB).alias("critical_ppb")).alias("thresholds"))
    return d.select(*keys, "tier", "event_id", "last_exceedance", F.to_json(report).alias("report"))


def archive_batch(path: str):
    """A ``foreachBatch`` writer that keeps one folder per batch: a batch that is retried
    replaces its own folder, so no event is archived twice."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.dropDuplicates(["event_id"]).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


class ReportArchive:
    """An archive of reports that many runs add to, with one row per ``event_id`` when read.

    A batch goes to a folder of its own, and a commit, written last, names it. A batch that is retried commits
    again under its run and number and so replaces itself; a restart under a new checkpoint or a
    second run may write an event again, and reading keeps the row of the earliest commit. ``compact`` writes
    what is read as one folder and a commit that replaces all before it, so that readers of
    the old folders are not disturbed; ``vacuum`` deletes what no commit names any more.
    """

    COMMIT = "run string, batch bigint, at timestamp, folder string, replaces array<string>"

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folders(self, below: str) -> list[str]:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        at = hadoop.Path(f"{self.path}/{below}")
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []

    def _commit(self, name: str, run: str, batch: int, folder: str, replaces: list[str]) -> None:
        one = self.spark.createDataFrame([(run, batch, folder, replaces)], "run string, batch bigint, folder string, replaces array<string>")
        one.withColumn("at", F.current_timestamp()).select("run", "batch", "at", "folder", "replaces").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{name}")

    def commits(self) -> DataFrame:
        """The commits that hold, one row each: as many as batches since the last compaction."""
        made = [f"{self.path}/commits/{n}" for n in self._folders("commits") if n in self._finished()]
        if not made:
            return self.spark.createDataFrame([], self.COMMIT + ", name string")
        all_ = self.spark.read.schema(self.COMMIT).parquet(*made).withColumn("name", F.element_at(F.split(F.input_file_name(), "/"), -2))
        gone = all_.select(F.explode("replaces").alias("name"))
        return all_.join(gone, "name", "left_anti")

    def _finished(self) -> set[str]:
        """Commits whose writing ended."""
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        done = set()
        for n in self._folders("commits"):
            mark = hadoop.Path(f"{self.path}/commits/{n}/_SUCCESS")
            if mark.getFileSystem(conf).exists(mark):
                done.add(n)
        return done

    def add(self, batch: DataFrame, batch_id: int, run: str) -> None:
        folder = uuid.uuid4().hex
        batch.write.parquet(f"{self.path}/data/{folder}")
        self._commit(f"{run}-{batch_id}", run, batch_id, folder, [])

    def writer(self, run: str):
        """For ``foreachBatch``; ``run`` names the checkpoint that counts the batches."""
        return lambda batch, batch_id: self.add(batch, batch_id, run)

    def _all(self) -> tuple[DataFrame | None, list[str]]:
        held = self.commits().select("name", "folder", "at").collect()
        out = None
        for r in held:
            one = self.spark.read.parquet(f"{self.path}/data/{r.folder}").withColumn("_at", F.struct(F.lit(r.at).alias("at"), F.lit(r.name).alias("name")))
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
        return out, [r.name for r in held]

    def read(self) -> DataFrame | None:
        """One row per event, that of the earliest commit and in it the least by all columns; None while nothing is committed."""
        d, _ = self._all()
        if d is None:
            return None
        rest = [c for c in d.columns if c not in ("event_id", "_at")]
        return earliest(d, ["event_id"], ["_at", *rest], keep=rest).select(*[c for c in d.columns if c != "_at"])

    def compact(self) -> None:
        d, names = self._all()
        if d is None or len(names) < 2:
            return
        folder = uuid.uuid4().hex
        self.read().write.parquet(f"{self.path}/data/{folder}")
        self._commit(f"compaction-{folder}", "compaction", 0, folder, names)

    def vacuum(self) -> None:
        """Deletes folders and commits that are replaced; to be called when nobody reads an older state or writes."""
        held = self.commits().select("name", "folder").collect()
        keep = {f"data/{r.folder}" for r in held} | {f"commits/{r.name}" for r in held}
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for below in ("commits", "data"):
            for n in self._folders(below):
                if f"{below}/{n}" not in keep:
                    at = hadoop.Path(f"{self.path}/{below}/{n}")
                    at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
