"""Per-key ordered operators: neighbours, ordinals, recency thinning.

Ordinary keys use one hash exchange on the key and plain windows. A key with
more than ``hot_rows`` rows would put all of them in one window task, so such
keys take another, exact way:

* neighbours and ordinals: the hot rows are range-partitioned on the full
  order, so a key spreads over many contiguous slices, and only one row per
  slice is exchanged to join the slices up;
* thinning: the rows are first reduced to one per instant; range slices find
  where the run of each instant ends and the next begins, and doubling the steps
  marks the instants that do begin one.

The set of hot keys holds at most rows / hot_rows values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import packed, shuffle_partitions, stage

HOT_ROWS = 100_000
SAMPLE_HITS = 1_000


def hot_keys(df: DataFrame, key: str, hot_rows: int | None = HOT_ROWS) -> DataFrame | None:
    """Staged table of the keys to split, None if there are none.

    Every key with more than ``hot_rows`` rows is in it. Pass None for ``hot_rows`` only where a bound on the rows of a key is known.
    """
    if hot_rows is None:
        return None
    rows = df.where(F.col(key).isNotNull()).select(key)
    limit = hot_rows
    if hot_rows > SAMPLE_HITS:
        # a sample is enough: a hot key has a thousand hits in it, and a key
        # that is split without need costs time only
        fraction = SAMPLE_HITS / hot_rows
        rows, limit = rows.sample(fraction, seed=1), SAMPLE_HITS // 2
    heavy = (
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(key)
    )
    return None if heavy.isEmpty() else stage(heavy, "hot-keys")


def ordered_slices(df: DataFrame, order: Sequence[str], n: int | None = None) -> DataFrame:
    """Stage ``df`` in global order; ``_slice`` numbers its contiguous ranges."""
    n = n or shuffle_partitions(df.sparkSession)
    ranged = df.repartitionByRange(n, *[F.col(c) for c in order])
    return stage(ranged.withColumn("_slice", F.spark_partition_id()), "slices")


def next_event(
    df: DataFrame,
    key: str,
    when: str,
    row_id: str,
    take: Mapping[str, str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add per row: ordinal, rows of the key, and the next row's columns.

    Order within a key is ``when`` (nulls last) then ``row_id``, which must be
    unique. Adds ``purchase_no``, ``purchase_count``, ``has_next`` and one
    column per ``take`` item ``{new name: source column}``. Rows with a null
    key are dropped.
    """
    df = df.where(F.col(key).isNotNull())
    hot = hot_keys(df, key, hot_rows)
    if hot is None:
        return _neighbours_by_window(df, key, when, row_id, take)
    usual = df.join(hot, key, "left_anti")
    heavy = df.join(hot, key, "left_semi")
    return _neighbours_by_window(usual, key, when, row_id, take).unionByName(
        _neighbours_by_slice(heavy, key, when, row_id, take)
    )


def _follower(take: Mapping[str, str]) -> Column:
    return F.struct(F.lit(True).alias("_is"), *[F.col(s).alias(o) for o, s in take.items()])


def _spread(df: DataFrame, columns: Sequence[str], take: Mapping[str, str]) -> DataFrame:
    return df.select(
        *columns,
        F.col("purchase_no").cast("long").alias("purchase_no"),
        F.col("purchase_count").cast("long").alias("purchase_count"),
        F.col("_next").isNotNull().alias("has_next"),
        *[F.col("_next")[o].alias(o) for o in take],
    )


def _neighbours_by_window(df, key, when, row_id, take):
    by_key = W.partitionBy("_key")
    ordered = by_key.orderBy(F.col("_when").asc_nulls_last(), F.col("_id"))
    # the windows pass on a row as one value
    rows = packed(df, {"_key": F.col(key), "_when": F.col(when), "_id": F.col(row_id), "_taken": _follower(take)})
    return _spread(
        rows.withColumns(
            {
                "purchase_no": F.row_number().over(ordered),
                "purchase_count": F.count(F.lit(1)).over(by_key),
                "_next": F.lead("_taken").over(ordered),
            }
        ),
        [F.col("_row")[c].alias(c) for c in df.columns],
        take,
    )


def _neighbours_by_slice(df, key, when, row_id, take):
    undated = F.col(when).isNull()
    slices = ordered_slices(df.withColumn("_undated", undated), [key, "_undated", when, row_id])
    local = W.partitionBy("_slice", key).orderBy("_undated", when, row_id)
    # first row of the following non-empty slice, one row per slice
    first = F.min_by(
        F.struct(F.col(key).alias("_key"), _follower(take).alias("_next")),
        F.struct(key, "_undated", when, row_id),
    )
    heads = slices.groupBy("_slice").agg(first.alias("_head"))
    heads = stage(
        heads.select("_slice", F.lead("_head").over(W.orderBy("_slice")).alias("_head")), "heads"
    )
    # rows of the key in earlier slices, at most slices + hot keys rows
    counts = slices.groupBy("_slice", key).agg(F.count(F.lit(1)).alias("_n"))
    by_key = W.partitionBy(key)
    earlier = by_key.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    counts = stage(
        counts.select(
            "_slice",
            key,
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(by_key).alias("purchase_count"),
        ),
        "key-counts",
    )
    joined = (
        slices.withColumns(
            {"_rn": F.row_number().over(local), "_in": F.lead(_follower(take)).over(local)}
        )
        .join(heads, "_slice", "left")
        .join(counts, ["_slice", key], "left")
    )
    across = F.when(F.col("_head._key") == F.col(key), F.col("_head._next"))
    return _spread(
        joined.withColumns(
            {
                "purchase_no": F.col("_before") + F.col("_rn"),
                "_next": F.coalesce(F.col("_in"), across),
            }
        ),
        df.columns,
        take,
    )


def thin_recent(
    df: DataFrame,
    key: str,
    when: str,
    row_id: str | Sequence[str],
    days: int = 30,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Keep the last row of every run of transactions close to the run's first.

    A run starts at an anchor row and takes every later row of the key at most
    ``days`` whole days after that anchor; the next row starts a new run. An
    undated row is a run of its own; rows without a key are dropped. Rows of one
    instant are ordered by ``row_id`` (one column or several), then by the
    other columns as they stand, nulls first; so of repeated ids one row stays,
    the same one for any ``hot_rows``. Columns of maps have no order: rows that
    differ in those alone are ties.

    Select the columns that are needed before, not after: then both parts of
    the plan ask for the same columns and share one exchange.
    """
    df = df.where(F.col(key).isNotNull())
    ids = [row_id] if isinstance(row_id, str) else list(row_id)
    hot = hot_keys(df, key, hot_rows)
    if hot is None:
        return _thin_by_island(df, key, when, ids, days)
    # three parts read it
    df = stage(df, "to-thin")
    usual = _thin_by_island(df.join(hot, key, "left_anti"), key, when, ids, days)
    heavy = df.join(hot, key, "left_semi")
    dated = heavy.where(F.col(when).isNotNull())
    return (
        usual.unionByName(_thin_by_doubling(dated, key, when, ids, days))
        .unionByName(heavy.where(F.col(when).isNull()))
    )


def _ties(df: DataFrame, key: str, when: str, ids: Sequence[str]) -> list[str]:
    """Columns that order the rows of one instant."""
    rest = [f.name for f in df.schema if not _holds_map(f.dataType)]
    return [*ids, *(c for c in rest if c not in {key, when, *ids})]


def _holds_map(kind) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def _reach(days: int) -> Column:
    """A row belongs to an anchor's run while it is before anchor + reach."""
    return F.make_dt_interval(F.lit(days + 1))


def _thin_by_island(df, key, when, ids, days):
    """One window pass settles the first run of every island; a fold the rest.

    A gap from the previous row longer than the reach always starts a run, so
    it cuts a key into islands. The anchor of an island's first run is known
    at once (``_from``), and so is that run's last row. Only rows past the
    first run go to the fold, which reuses the exchange on the key.
    """
    ties = _ties(df, key, when, ids)
    other = [c for c in df.columns if c not in ties]
    # the windows pass on a row as two values, of which the first orders the rows of one instant
    rows = df.select(
        F.col(key).alias("_key"), F.col(when).alias("_at"), F.struct(ties).alias("_ties"), F.struct(other).alias("_other")
    )
    ordered = W.partitionBy("_key").orderBy(F.col("_at").asc_nulls_last(), "_ties")
    at, reach = F.col("_at"), _reach(days)
    before = F.lag("_at").over(ordered)
    marked = rows.withColumns(
        {
            "_start": F.when(before.isNull() | (at >= before + reach), at),
            "_next": F.lead("_at").over(ordered),
        }
    ).withColumn("_from", F.max("_start").over(ordered))
    first_run = at < F.col("_from") + reach
    run_ends = F.col("_next").isNull() | (F.col("_next") >= F.col("_from") + reach)
    easy = marked.where(at.isNull() | (first_run & run_ends)).select("_ties", "_other")

    # rows of one instant make one entry, the last of them
    last = F.max_by(F.struct("_ties", "_other"), F.col("_ties")).alias("_row")
    instants = marked.where(~first_run).groupBy("_key", "_from", "_at").agg(last)
    rest = instants.groupBy("_key", "_from").agg(
        F.array_sort(F.collect_list(F.struct("_at", "_row")), lambda a, b: F.when(a["_at"] < b["_at"], -1).otherwise(1)).alias("_rows")
    )
    folded = F.aggregate(
        "_rows",
        F.struct(
            F.element_at("_rows", 1)["_at"].alias("anchor"),
            F.slice("_rows", 1, 0).alias("kept"),
        ),
        lambda run, r: F.when(
            r["_at"] < run["anchor"] + reach,
            F.struct(
                run["anchor"].alias("anchor"),
                F.concat(
                    F.slice(run["kept"], F.lit(1), F.greatest(F.size(run["kept"]) - 1, F.lit(0))),
                    F.array(r),
                ).alias("kept"),
            ),
        ).otherwise(
            F.struct(r["_at"].alias("anchor"), F.concat(run["kept"], F.array(r)).alias("kept"))
        ),
        lambda run: run["kept"],
    )
    hard = rest.select(F.explode(folded).alias("_kept")).select("_kept._row.*")
    kept = easy.unionByName(hard)
    return kept.select([F.col("_ties" if c in ties else "_other")[c].alias(c) for c in df.columns])


def _thin_by_doubling(df, key, when, ids, days):
    """The kept rows of hot keys, whose dated rows are ``df``.

    The rows are reduced to the last of every (key, instant), on the map side
    first. Sorted with a probe at each instant + reach, every instant learns the
    next anchor if it were one itself, and its run's last instant. The
    first instant of a key is an anchor; then each round doubles the steps that
    anchors are followed by: as many rounds as the logarithm of the runs.
    """
    ties = _ties(df, key, when, ids)
    last = F.max_by(F.struct(df.columns), F.struct(ties)).alias("_row")
    instants = stage(df.groupBy(key, when).agg(last), "instants")
    steps = stage(_steps(instants.select(key, F.col(when).alias("_at")), key, days), "steps")
    jump = steps.where(F.col("_to").isNotNull()).select(key, "_at", "_to")
    anchors = stage(steps.groupBy(key).agg(F.min("_at").alias("_at")), "anchors")
    while not jump.isEmpty():
        # anchors so far and those one jump after them; then jumps twice as long
        after = anchors.join(jump, [key, "_at"]).select(key, F.col("_to").alias("_at"))
        anchors = stage(anchors.unionByName(after).distinct(), "anchors")
        second = jump.select(key, F.col("_at").alias("_to"), F.col("_to").alias("_far"))
        jump = stage(jump.join(second, [key, "_to"]).select(key, "_at", F.col("_far").alias("_to")), "jumps")
    ends = anchors.join(steps, [key, "_at"]).select(key, F.col("_end").alias(when))
    return instants.join(ends, [key, when], "left_semi").select("_row.*")


def _steps(instants, key, days):
    """(key, _at, _to, _end): the first instant beyond the reach of ``_at``, null if there is
    none, and the last within it. No slice holds more than a range of the instants."""
    probes = instants.select(key, (F.col("_at") + _reach(days)).alias("_when"), F.lit(0).alias("_kind"), "_at")
    both = instants.select(key, F.col("_at").alias("_when"), F.lit(1).alias("_kind"), "_at").unionByName(probes)
    # a probe stands before an instant of the same time: that one is beyond
    slices = ordered_slices(both, [key, "_when", "_kind", "_at"])
    instant = F.when(F.col("_kind") == 1, F.col("_when"))
    local = W.partitionBy("_slice", key).orderBy("_when", "_kind", "_at")
    found = slices.withColumns({
        "_next": F.first(instant, True).over(local.rowsBetween(0, W.unboundedFollowing)),
        "_prev": F.last(instant, True).over(local.rowsBetween(W.unboundedPreceding, 0)),
    }).where("_kind = 0")
    # at most a row for each slice and one for each key
    edges = slices.groupBy("_slice", key).agg(F.min(instant).alias("_first"), F.max(instant).alias("_last"))
    by_key = W.partitionBy(key).orderBy("_slice")
    edges = stage(edges.select(
        "_slice", key,
        F.first("_first", True).over(by_key.rowsBetween(1, W.unboundedFollowing)).alias("_after"),
        F.last("_last", True).over(by_key.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
    ), "edges")
    found = found.join(edges, ["_slice", key])
    return found.select(key, "_at", F.coalesce("_next", "_after").alias("_to"), F.coalesce("_prev", "_before").alias("_end"))
