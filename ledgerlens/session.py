"""Session access and staged tables.

A staged table is a parquet write in the shared folder named by
``spark.checkpoint.dir``. It cuts lineage, survives lost executors, and gives
the optimizer a real file size, so a join against it is broadcast only when
that size is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; a private one only in local tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-"))
    return sc.getCheckpointDir()


def staged_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/ledgerlens/{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Delete this application's staged tables, once their frames are done with."""
    delete_path(spark, staged_dir(spark))


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@dataclass
class Staging:
    """The tables that were staged inside a ``staging`` block."""

    spark: SparkSession | None = None
    paths: list[str] = field(default_factory=list)
    kept: list[str] = field(default_factory=list)

    def keep(self, *frames: DataFrame | None) -> None:
        """Leave the tables that these frames still read."""
        for df in frames:
            if df is not None and self.paths:
                files = df.inputFiles()
                self.kept += [p for p in self.paths if any(p.rpartition("/")[2] in f for f in files)]


_open = threading.local()


@contextmanager
def staging() -> Iterator[Staging]:
    """Delete at the block's end what was staged inside it by this thread, but for what was kept; that passes to
    the block around it, if there is one."""
    blocks = _open.__dict__.setdefault("blocks", [])
    blocks.append(own := Staging())
    try:
        yield own
    except BaseException:
        own.kept.clear()
        raise
    finally:
        blocks.pop()
        for path in own.paths:
            if path not in own.kept:
                delete_path(own.spark, path)
            elif blocks:
                blocks[-1].spark = own.spark
                blocks[-1].paths.append(path)


def with_callers_staging(task: Callable) -> Callable:
    """A function that, in whichever thread it runs, stages into the blocks that are open here."""
    blocks = list(_open.__dict__.get("blocks", []))

    @wraps(task)
    def run(*args, **how):
        _open.blocks = list(blocks)
        return task(*args, **how)

    return run


def tidied(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function whose staged tables are deleted when it returns, but for those that its result reads."""

    @wraps(make)
    def run(*args, **how) -> DataFrame:
        with staging() as staged:
            out = make(*args, **how)
            staged.keep(out)
        return out

    return run


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back."""
    path = f"{staged_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    for block in _open.__dict__.get("blocks", [])[-1:]:
        block.spark = df.sparkSession
        block.paths.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


WHOLE_STAGE = "spark.sql.codegen.wholeStage"
_wide_lock = threading.Lock()
_wide: list[tuple[SparkSession, str]] = []


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """For actions on rows of many columns: the operators of their stages are not compiled into one method.

    That method is longer than what the JVM compiles (8,000 bytes), so it would be interpreted for every row; single
    expressions and projections are split into short methods. Blocks may overlap in several threads; the last to end
    puts the setting back.
    """
    with _wide_lock:
        _wide.append((spark, spark.conf.get(WHOLE_STAGE)) if not _wide else _wide[0])
        spark.conf.set(WHOLE_STAGE, "false")
    try:
        yield
    finally:
        with _wide_lock:
            first, before = _wide.pop()
            if not _wide:
                first.conf.set(WHOLE_STAGE, before)


def packed(df: DataFrame, flat: Mapping[str, Column], into: str = "_row") -> DataFrame:
    """The columns ``flat``, and all of ``df`` in one struct: joins then pass on a row as one value."""
    whole = F.struct(*[df[f"`{c}`"].alias(c) for c in df.columns])
    return df.select(*[c.alias(n) for n, c in flat.items()], whole.alias(into))


def unpacked(df: DataFrame, columns: Sequence[str], *more: Column, into: str = "_row") -> DataFrame:
    """The struct's columns in the order given, then ``more``."""
    return df.select(*[F.col(into)[c].alias(c) for c in columns], *more)


def release(*frames: DataFrame) -> None:
    """Delete the tables of staged frames that nothing will read again; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            delete_path(df.sparkSession, path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or nothing where there is none."""
    if not path_exists(spark, path):
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place of what was there: readers see the old text or the new one, never a part."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    fs = target.getFileSystem(conf)
    stream = fs.create(fresh, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    over = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(over, 1)
    how[0] = over.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(target).toUri(), conf).rename(
        fs.makeQualified(fresh), fs.makeQualified(target), how
    )
