"""The catalogue of checked queries.

Each query states its output as ``name:type`` items; both engines finish with
the same casts: ``i`` bigint, ``d`` double rounded once to six places, ``s``
string, ``t`` timestamp as text, ``b`` boolean.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airq.plans.inputs import BASE_SQL, Inputs


@dataclass(frozen=True)
class Query:
    name: str
    spec: list[tuple[str, str]]
    run: Callable[[Inputs], DataFrame]
    sql: str | None
    ids: str


QUERIES: dict[str, Query] = {}


def query(name: str, ids: str, spec: str, sql: str | None = None, ctes: str = ""):
    """Register a query; ``sql`` is the body after the shared input CTEs."""
    fields = [tuple(x.split(":")) for x in spec.split()]

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fields, fn, _finish_sql(sql, ctes, fields) if sql else None, ids)
        return fn

    return register


def _finish_sql(sql: str, ctes: str, fields) -> str:
    def cast(n, t):
        if t == "i":
            return f"CAST({n} AS BIGINT) AS {n}"
        if t == "d":
            return f"round(CAST({n} AS DOUBLE), 6) + 0.0 AS {n}"
        if t == "t":
            return f"strftime(CAST({n} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS {n}"
        return f"CAST({n} AS {'BOOLEAN' if t == 'b' else 'VARCHAR'}) AS {n}"

    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    cols = ", ".join(cast(n, t) for n, t in fields)
    return f"WITH {BASE_SQL}{extra},\nanswer AS (\n{sql.strip()}\n)\nSELECT {cols} FROM answer"


def finish(df: DataFrame, fields) -> DataFrame:
    def cast(n, t):
        c = F.col(n)
        if t == "i":
            c = c.cast("bigint")
        elif t == "d":
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif t == "t":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        else:
            c = c.cast("boolean" if t == "b" else "string")
        return c.alias(n)

    return df.select(*[cast(n, t) for n, t in fields])


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(q: Query):
        return lambda spark, sf_dir: finish(q.run(Inputs(spark, sf_dir)), q.spec)

    return {n: bind(q) for n, q in QUERIES.items()}


def sql_queries() -> dict[str, str]:
    return {n: q.sql for n, q in QUERIES.items() if q.sql}
