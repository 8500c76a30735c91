"""Metrics documents and scorecards as nested JSON, read into and from long rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airq import schema

# fixed value: the class order the writer of a document uses for its matrix
WRITER_ORDER = ["green", "orange", "yellow"]


def _class(index: str, order: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in order]), F.col(index) + 1)


def read_metrics_documents(spark: SparkSession, path, class_order: list[str] = WRITER_ORDER) -> DataFrame:
    """Documents with a ``sites`` map and flat one-site documents as long confusion cells."""
    docs = spark.read.schema(schema.METRICS_DOC).json(path)
    flat = F.create_map(F.coalesce("site", F.lit("unknown")), F.struct(
        F.col("n_predictions"), F.col("n_matched_observations"), F.lit(None).cast("bigint").alias("n_matched"),
        F.col("balanced_accuracy"), F.col("confusion_matrix")))
    sites = docs.select(F.to_date("day").alias("day"), "pipeline", F.explode(F.coalesce("sites", flat)).alias("site_name", "m"))
    rows = sites.filter(F.col("m.confusion_matrix").isNotNull()).select(
        "day", "pipeline", "site_name", F.posexplode("m.confusion_matrix").alias("_a", "_row"))
    cells = rows.select("day", "pipeline", "site_name", "_a", F.posexplode("_row").alias("_p", "n"))
    return cells.select("day", "pipeline", "site_name", _class("_a", class_order).alias("actual"),
                        _class("_p", class_order).alias("predicted"), "n")


def confusion_to_documents(cm: DataFrame, nested: Column, class_order: list[str] = WRITER_ORDER,
                           group: list[str] | None = None) -> DataFrame:
    """Long cells as documents: where ``nested`` holds one document per day, pipeline and
    ``group`` (a network, so a document has few sites) with a ``sites`` map, elsewhere one
    flat document per site."""
    group = group or []
    cell = lambda a, p: F.sum(F.when((F.col("actual") == a) & (F.col("predicted") == p), F.col("n")).otherwise(0))
    matrix = F.array(*[F.array(*[cell(a, p) for p in class_order]) for a in class_order])
    per = cm.withColumn("_nested", nested).groupBy("day", "pipeline", *group, "_nested", "site_name").agg(
        matrix.alias("confusion_matrix"), F.sum("n").alias("n_matched_observations"))
    doc = F.struct(F.col("n_matched_observations").alias("n_predictions"), "n_matched_observations", "confusion_matrix")
    wide = per.filter("_nested").groupBy("day", "pipeline", *group).agg(
        F.map_from_entries(F.collect_list(F.struct("site_name", doc.alias("m")))).alias("sites")
    ).withColumn("schema_version", F.lit(2))
    one = per.filter("NOT _nested").select(
        "day", "pipeline", *group, F.lit(1).alias("schema_version"), F.col("site_name").alias("site"), "n_matched_observations", "confusion_matrix")
    return wide.unionByName(one, allowMissingColumns=True)


def nest_sites(cards: DataFrame, keys: list[str], site: str, cols: list[str]) -> DataFrame:
    """Scorecard rows as one ``sites`` map per key."""
    return cards.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(site), F.struct(*cols).alias("m")))).alias("sites"))


def flatten_sites(doc: DataFrame, keys: list[str], site: str) -> DataFrame:
    """A ``sites`` map as tidy rows."""
    return doc.select(*keys, F.explode("sites").alias(site, "m")).select(*keys, site, "m.*")
