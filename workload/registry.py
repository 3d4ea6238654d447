"""Registered queries and the SQL each is compared with.

A query declares its output columns once as ``name:type`` words; both sides are
cast to that shape, so counts are BIGINT, ratios DOUBLE rounded to six digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from workload.ctes import with_ctes
from workload.frames import Frames, frames

SPARK_TYPE = {"s": "string", "i": "bigint", "f": "double", "d": "date", "b": "boolean"}
SQL_TYPE = {"s": "VARCHAR", "i": "BIGINT", "f": "DOUBLE", "d": "DATE", "b": "BOOLEAN"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(word.split(":")) for word in spec.split()]


def shape(frame: DataFrame, spec: str) -> DataFrame:
    def one(name, kind):
        c = F.col(name).cast(SPARK_TYPE[kind])
        return (F.round(c, 6) if kind == "f" else c).alias(name)

    return frame.select(*[one(n, k) for n, k in columns(spec)])


def shaped_sql(body: str, spec: str) -> str:
    def one(name, kind):
        c = f'CAST("{name}" AS {SQL_TYPE[kind]})'
        return f'{f"ROUND({c}, 6)" if kind == "f" else c} AS "{name}"'

    picked = ", ".join(one(n, k) for n, k in columns(spec))
    return f"SELECT {picked} FROM (\n{body}\n) AS answer"


def query(name: str, spec: str, sql: str | None = None, recursive: bool = False):
    """Register a builder ``(Frames) -> DataFrame`` under a name with its SQL."""
    def register(build: Callable[[Frames], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return shape(build(frames(spark, folder)), spec)

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(shaped_sql(sql, spec), recursive)
        return build

    return register
