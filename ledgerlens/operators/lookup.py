"""Lookups: overrides, mapping tables, range tables, group values.

Lookup tables are staged or read from files, so Spark knows their size and
broadcasts one only under its size threshold; above it the join shuffles and
adaptive execution splits skewed partitions. No broadcast is forced here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import strip_upper
from ..session import stage
from ..sources.versions import read_table, replace_table

UNMAPPED = "UNKNOWN"


def attach_override(df: DataFrame, lookup: DataFrame, on: str, value: str, alias: str) -> DataFrame:
    """Left join one override column under the name ``alias``."""
    return df.join(lookup.select(on, F.col(value).alias(alias)), on, "left")


def override_where(
    df: DataFrame, lookup: DataFrame, on: str, column: str, value: str, when: Column
) -> DataFrame:
    """Replace ``column`` by the override where ``when`` holds (null if there is none)."""
    out = attach_override(df, lookup, on, value, "_override")
    return out.withColumn(column, F.when(when, F.col("_override")).otherwise(F.col(column))).drop(
        "_override"
    )


def override_first(
    df: DataFrame, lookup: DataFrame, on: str, column: str, value: str
) -> DataFrame:
    """The override wins wherever there is one."""
    out = attach_override(df, lookup, on, value, "_override")
    return out.withColumn(column, F.coalesce("_override", column)).drop("_override")


def mapping_table(mapping: DataFrame, key: str, value: str, normalise_key: bool = True) -> DataFrame:
    """``(_key, _value)`` with one row per key; the smallest target wins on clashes."""
    k = strip_upper(F.col(key)) if normalise_key else F.col(key)
    return (
        mapping.select(k.alias("_key"), F.col(value).alias("_value"))
        .where(F.col("_key").isNotNull())
        .groupBy("_key")
        .agg(F.min("_value").alias("_value"))
    )


def map_values(
    df: DataFrame,
    column: str,
    mapping: DataFrame,
    key: str,
    value: str,
    out: str,
    default: str = UNMAPPED,
    normalise_key: bool = True,
) -> DataFrame:
    """Map the stripped, upper-cased column through a mapping table."""
    table = stage(mapping_table(mapping, key, value, normalise_key), "mapping")
    return attach_mapped(df, column, table, out, default)


def attach_mapped(
    df: DataFrame, column: str, table: DataFrame, out: str, default: str = UNMAPPED
) -> DataFrame:
    """Join a ``(_key, _value)`` table of unique keys on the normalised column."""
    joined = df.withColumn("_key", strip_upper(F.col(column))).join(table, "_key", "left")
    return joined.withColumn(out, F.coalesce("_value", F.lit(default))).drop("_key", "_value")


def unmapped_values(
    df: DataFrame, column: str, mapping: DataFrame, key: str, value: str, normalise_key: bool = True
) -> DataFrame:
    """``(value, n)``: normalised values that no mapping row covers."""
    table = mapping_table(mapping, key, value, normalise_key).where(F.col("_value").isNotNull())
    seen = df.groupBy(strip_upper(F.col(column)).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    return seen.join(table, seen["_key"].eqNullSafe(table["_key"]), "left_anti").select(
        F.col("_key").alias("value"), "n"
    )


def duplicate_keys(mapping: DataFrame, key: str) -> DataFrame:
    """Mapping rows whose exact key occurs more than once."""
    twice = (
        mapping.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(key)
    )
    return mapping.join(twice, mapping[key].eqNullSafe(twice[key]), "left_semi")


def require_unique_keys(mappings: Mapping[str, tuple[DataFrame, str]]) -> None:
    """Raise when any mapping table ``{name: (table, key)}`` repeats a key."""
    keys = reduce(
        DataFrame.unionByName,
        [t.select(F.lit(n).alias("name"), F.col(k).alias("key")) for n, (t, k) in mappings.items()],
    )
    twice = keys.groupBy("name", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    bad = [r["name"] for r in twice.select("name").distinct().orderBy("name").collect()]
    if bad:
        raise ValueError(f"duplicate mapping keys in {bad}")


def upsert_mapping(mapping: DataFrame, rows: DataFrame, key: str, value: str) -> DataFrame:
    """Put new or changed ``(key, value)`` rows into a mapping table.

    Both texts are stripped and upper-cased; every existing row whose key is the
    same after that gives way. Of new rows with one key the one with the smallest
    target stays. Columns of the table that the new rows lack stay null.
    """
    shared = [c for c in mapping.columns if c in rows.columns]
    fresh = rows.select(
        *[strip_upper(F.col(c)).alias(c) if c in (key, value) else F.col(c) for c in shared]
    )
    rest = [c for c in shared if c not in (key, value)]
    one = F.min(F.struct(value, *rest)).alias("_row")
    fresh = fresh.groupBy(key).agg(one).select(key, "_row.*")
    taken = fresh.select(F.col(key).alias("_key"))
    old = mapping.join(taken, strip_upper(F.col(key)) == F.col("_key"), "left_anti")
    return old.unionByName(fresh, allowMissingColumns=True)


def attach_range(
    df: DataFrame, ranges: DataFrame, on: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Left join a range table on a composite key; ``_matched`` marks the hits.

    A key that the table repeats would repeat rows, so it is an error. The keys
    are counted as they come: normalise them first.
    """
    twice = ranges.dropna(subset=list(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    bad = twice.where(F.col("_n") > 1).select(*on).limit(5).collect()
    if bad:
        raise ValueError(f"range keys occur more than once: {[tuple(r) for r in bad]}")
    table = ranges.select(*on, *values, F.lit(True).alias("_matched"))
    return df.join(table, list(on), "left").withColumn(
        "_matched", F.coalesce("_matched", F.lit(False))
    )


def attach_group(
    df: DataFrame, group: str, aggregates: Mapping[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Join per-group aggregates back, null for rows without a group.

    They are taken from ``source`` if given, else from ``df`` itself.

    Aggregate and join rather than a window: the aggregate combines on the map
    side, so a group with a third of the rows is one row when it is exchanged,
    and the wide rows are not sorted. The staged table is broadcast if small.
    """
    table = (
        (df if source is None else source)
        .where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(*[c.alias(n) for n, c in aggregates.items()])
    )
    return df.join(stage(table, "groups"), group, "left")


def flag_member(df: DataFrame, others: DataFrame, key: str, flag: str) -> DataFrame:
    """1 when the row's key occurs in ``others``, else 0."""
    keys = others.where(F.col(key).isNotNull()).select(key).distinct()
    marked = keys.withColumn("_in", F.lit(1))
    return df.join(marked, key, "left").withColumn(
        flag, F.coalesce("_in", F.lit(0))
    ).drop("_in")


def last_value_per_key(
    df: DataFrame, key: str, value: str, order: Sequence[str], out: str
) -> DataFrame:
    """``(key, out)``: the value of the key's last row in ``order``."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*order, F.col(value).alias("_v")))["_v"].alias(out))
    )


def update_mapping(
    spark: SparkSession, path: str, rows: DataFrame, key: str, value: str, fmt: str = "parquet", **options
) -> DataFrame:
    """``upsert_mapping`` into the mapping table stored at ``path``, and the new table read back.

    The table is read while its successor is written beside it; readers through ``read_table`` see the old
    one until the new one is whole.
    """
    return replace_table(upsert_mapping(read_table(spark, path, fmt, **options), rows, key, value), path, fmt, **options)
