"""Register a Spark query under a name, with the SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def select(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run SQL whose tables are the given parquet files.

    Input views are stated once and used by both engines.
    """
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same SQL with bare table names."""
    return sql.format(**{t: t for t in TABLES})


def queries():
    return dict(_QUERIES)


def oracle_sql():
    return dict(_SQL)
