"""Which phases of a preparation are finished, and what they were made from.

Each phase's folder gets a small file, written last: the facts that the phase and those before it depend on. A folder
without it is unfinished, whatever else it holds. A preparation that goes on from finished phases must have the same
facts; other settings, lookups or input files are an error that names them.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import delete_path, read_text, write_text
from .settings import Lookups, Preparation

MANIFEST = "_MANIFEST.json"
PHASES = ["extraction", "label", "clean", "features", "group", "bin"]
# what each phase adds to the facts of the one before
OWN_FACTS = {
    "extraction": ["input schema", "input files", "extraction settings"],
    "clean": ["override and range lookups"],
    "group": ["mapping tables"],
    "bin": ["dropped sales"],
}


def gather(raw: DataFrame, lookups: Lookups, settings: Preparation) -> dict[str, str | None]:
    """The facts of this preparation. Tables that are not read from files have no known input files."""
    extraction = [
        settings.key, list(settings.columns), settings.country, settings.sale_status, settings.attribute_view,
        settings.price_view, settings.date_format, settings.thin_days, settings.evaluation and list(settings.evaluation),
        settings.after_end,
    ]
    fixed = {n: getattr(lookups, n) for n in ("id_type", "nationality", "city", "area_range")}
    found = _contents({**fixed, **{f"mapping {n}": t for n, t in lookups.mappings.items()}})
    return {
        "input schema": _digest(json.loads(raw.schema.json())),
        "input files": _files(raw),
        "extraction settings": json.dumps(extraction),
        "override and range lookups": _digest([found.get(n) for n in fixed]),
        "mapping tables": _digest(sorted((n, v) for n, v in found.items() if n not in fixed)),
        "dropped sales": json.dumps(sorted(settings.dropped_sales)),
    }


def _digest(value: object) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def _contents(tables: dict[str, DataFrame]) -> dict[str, list]:
    """Rows and a sum of row hashes of each lookup table, in one pass over all."""
    hashed = [
        t.select(F.lit(n).alias("name"), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in t.columns]).alias("h"))
        for n, t in tables.items()
    ]
    sums = reduce(DataFrame.unionByName, hashed).groupBy("name").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).cast("string").alias("h")
    )
    return {r["name"]: [r["n"], r["h"], tables[r["name"]].columns] for r in sums.collect()}


def _files(df: DataFrame) -> str | None:
    """Names, sizes and times of the files that a table is read from; one listing a folder."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    wanted = {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)).toString() for f in df.inputFiles()}
    if not wanted:
        return None
    seen = []
    for folder in {f.rpartition("/")[0] for f in wanted}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        for status in path.getFileSystem(conf).listStatus(path):
            name = status.getPath().toString()
            if name in wanted:
                seen.append([name, status.getLen(), status.getModificationTime()])
    return _digest(sorted(seen))


def _upto(phase: str) -> list[str]:
    return [f for p in PHASES[: PHASES.index(phase) + 1] for f in OWN_FACTS.get(p, [])]


def write(spark: SparkSession, save_dir: str, phase: str, facts: dict[str, str | None]) -> None:
    text = json.dumps({"phase": phase, "facts": {f: facts[f] for f in _upto(phase)}})
    write_text(spark, f"{save_dir.rstrip('/')}/{phase}/{MANIFEST}", text)


def forget(spark: SparkSession, save_dir: str) -> None:
    """Phases of an earlier preparation count as unfinished from now on."""
    for phase in PHASES:
        delete_path(spark, f"{save_dir.rstrip('/')}/{phase}/{MANIFEST}")


def last_finished(spark: SparkSession, save_dir: str, facts: dict[str, str | None]) -> str | None:
    """The last finished phase; one that was made from other facts is an error."""
    for phase in reversed(PHASES):
        text = read_text(spark, f"{save_dir.rstrip('/')}/{phase}/{MANIFEST}")
        if text is None:
            continue
        stored = json.loads(text)["facts"]
        # files are compared where both sides have some
        other = [f for f, v in stored.items() if facts[f] != v and not (f == "input files" and None in (v, facts[f]))]
        if other:
            raise ValueError(f"{save_dir} holds a preparation with other {', '.join(other)}: take another folder, or prepare without resume")
        return phase
    return None
