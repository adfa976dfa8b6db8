"""Replacing a saved folder in one step.

A new version is written to whichever of two folders is not the current one, ``path`` and ``path.next``; then a small
file, ``path.current``, is swapped to name it, and the other folder is deleted. A failure before the swap leaves the
old version as it was, one after it leaves the new one. Without that file ``path`` itself is the current version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import delete_path, path_exists, read_text, write_text

CURRENT, NEXT = ".current", ".next"


def current(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version, if there is one."""
    path = path.rstrip("/")
    name = read_text(spark, path + CURRENT)
    folder = path if name is None else path.rpartition("/")[0] + "/" + name.strip()
    return folder if path_exists(spark, folder) else None


def commit(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new version's folder, then make it the current one; returns the folder."""
    path = path.rstrip("/")
    old = current(spark, path)
    folder = path if old != path else path + NEXT
    delete_path(spark, folder)  # what an earlier failure left
    write(folder)
    write_text(spark, path + CURRENT, folder.rpartition("/")[2])
    if old is not None:
        delete_path(spark, old)
    return folder


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Put ``df`` in place of the table at ``path``, which it may itself be read from, and read the new one."""
    spark = df.sparkSession
    folder = commit(spark, path, lambda to: df.write.format(fmt).options(**options).save(to))
    return spark.read.format(fmt).options(**options).schema(df.schema).load(folder)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """The current version of a table."""
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(path)
    return spark.read.format(fmt).options(**options).load(folder)
