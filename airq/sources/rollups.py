"""Daily partial results that are kept and refreshed where their input changed.

The input is a table in folders ``day=YYYY-MM-DD``. A day's fingerprint is the list of its files with
their sizes and times, so finding what changed reads no rows. A refresh reads the changed days' folders
only, replaces their partial results and then the fingerprints; one that is broken off is done again for
those days by the next. Periods of any length merge from what is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class DailyRollup:
    """``build`` maps input rows of some days (with ``day``) to partial rows with ``day``, day by day."""

    def __init__(self, spark: SparkSession, source: str, store: str, build: Callable[[DataFrame], DataFrame]):
        self.spark, self.source, self.store, self.build = spark, source.rstrip("/"), store.rstrip("/"), build

    def _list(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return list(fs.listStatus(at)) if fs.exists(at) else []

    def fingerprints(self) -> dict[str, str]:
        """Of every day of the input; one line per file goes through the driver and none is kept."""
        out = {}
        for folder in self._list(self.source):
            name = folder.getPath().getName()
            if not name.startswith("day="):
                continue
            files = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in self._list(f"{self.source}/{name}")]
            held = sorted(f for f in files if not f[0].startswith(("_", ".")))
            if held:
                out[name[4:]] = hashlib.sha256(repr(held).encode()).hexdigest()
        return out

    def kept(self) -> dict[str, str]:
        if not self._list(f"{self.store}/days"):
            return {}
        return {r.day: r.mark for r in self.spark.read.schema("day string, mark string").parquet(f"{self.store}/days").collect()}

    def changed(self) -> tuple[list[str], list[str]]:
        """Days that are new or differ from what was kept, and days that are gone."""
        now, then = self.fingerprints(), self.kept()
        return sorted(d for d, m in now.items() if then.get(d) != m), sorted(set(then) - set(now))

    def rows_of(self, days: list[str]) -> DataFrame:
        """Input rows of these days; no other folder is opened."""
        rows = self.spark.read.option("basePath", self.source).parquet(*[f"{self.source}/day={d}" for d in days])
        return rows.withColumn("day", F.to_date("day"))

    def refresh(self) -> list[str]:
        """Brings the store up to date; returns the days that were computed."""
        now = self.fingerprints()
        days, gone = self.changed()
        if days:
            for d in days:  # a day of which nothing is left keeps no old rows
                self._drop(f"{self.store}/cells/day={d}")
            self.build(self.rows_of(days)).write.mode("append").partitionBy("day").parquet(f"{self.store}/cells")
        for d in gone:
            self._drop(f"{self.store}/cells/day={d}")
        if days or gone:
            self.spark.createDataFrame(sorted(now.items()), "day string, mark string").coalesce(1).write.mode("overwrite").parquet(f"{self.store}/days")
        return days

    def _drop(self, path: str) -> None:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    def cells(self) -> DataFrame:
        """All partial rows that are kept."""
        return self.spark.read.parquet(f"{self.store}/cells").withColumn("day", F.to_date("day"))
