"""Table schemas and the one projection that makes inputs conform to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "date": T.DateType(),
}


def _schema(**columns) -> T.StructType:
    """A nullable struct; built without a session, so importing this module needs none."""
    return T.StructType([
        T.StructField(n.replace("__", " "), t if isinstance(t, T.DataType) else _TYPES[t], True) for n, t in columns.items()])


_MET = dict.fromkeys([
    "wind_speed_10m", "wind_direction_10m", "temperature_2m", "dewpoint_2m", "relative_humidity_2m", "surface_pressure",
    "precipitation", "cloud_cover", "flow_border", "tide_height",
], "double") | {"tidal_state": "string", "sbiwtp_flow_mgd": "double"}
OBS = _schema(network="bigint", site_name="string", obs_time="timestamp", h2s="double", h2s_measured="boolean", **_MET)
FORECAST = _schema(network="bigint", obs_time="timestamp", day_night="string", **_MET)
READING_CSV = _schema(Site__Name="string", Date__with__time="string", Parameter="string", Result="string", level="string")
READING = _schema(network="bigint", site_name="string", time="timestamp", h2s_ppb="double", level="string")
PREDICTION = _schema(
    network="bigint", site_name="string", obs_time="timestamp", predicted_category="string", probability_green="double",
    probability_yellow="double", probability_orange="double", confidence="double", alert="boolean", h2s_risk="double")
CM_LONG = _schema(day="date", pipeline="string", site_name="string", actual="string", predicted="string", n="bigint")
_MATRIX = T.ArrayType(T.ArrayType(T.LongType()))
_SITE_DOC = _schema(
    n_predictions="bigint", n_matched_observations="bigint", n_matched="bigint", balanced_accuracy="double", confusion_matrix=_MATRIX)
METRICS_DOC = _schema(
    day="string", pipeline="string", schema_version="int", site="string", sites=T.MapType(T.StringType(), _SITE_DOC),
    n_predictions="bigint", n_matched_observations="bigint", balanced_accuracy="double", confusion_matrix=_MATRIX)
SPILL_CSV = _schema(
    Latitude="string", Longitude="string", Discharge__Location="string", Start__Date="string", End__Date="string",
    Approximate__Discharge__Volume="string")
COMPLAINT_CSV = _schema(date="string", description="string", site="string")


def conform(df: DataFrame, schema: T.StructType, aliases: dict[str, str] | None = None,
            defaults: dict | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rename by ``aliases`` (old -> new), cast, turn NaN into NULL, default what
    is missing.  Columns of ``keep`` pass through unchanged."""
    aliases, defaults = aliases or {}, defaults or {}
    for old, new in aliases.items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    out = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        out.append(c.alias(f.name))
    return df.select(*out, *[F.col(k) for k in keep or []])


def model_matrix(df: DataFrame, features: list[str], keys: list[str], fill: float = 0.0) -> DataFrame:
    """Keys and exactly ``features``: absent columns and missing values become ``fill``."""
    return df.select(*keys, *[
        F.coalesce(F.col(f).cast("double"), F.lit(fill)).alias(f) if f in df.columns
        else F.lit(fill).alias(f)
        for f in features
    ])
