"""Global and per-group statistics.

Statistics that feed expressions are uncorrelated scalar subqueries
(``DataFrame.scalar``): lazy, one value, no join. Everything is reduced on the
map side before it is exchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(column, n)``, most frequent first, ties by value; nulls left out."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.col(column))
    )


def mode_frame(df: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent non-null value, the smallest one on ties."""
    return value_counts(df, column).limit(1).select(column)


def mean_frame(df: DataFrame, column: str, keep: Column | None = None) -> DataFrame:
    """One row: the mean over the rows where ``keep`` holds."""
    rows = df if keep is None else df.where(keep)
    return rows.agg(F.avg(column).alias(column))


def mode_value(df: DataFrame, column: str) -> Column:
    return mode_frame(df, column).scalar()


def mean_value(df: DataFrame, column: str, keep: Column | None = None) -> Column:
    return mean_frame(df, column, keep).scalar()


def fixed(frame: DataFrame) -> Column:
    """The single value of a one-row frame, computed now, as a literal."""
    r = frame.first()
    return F.lit(None if r is None else r[0]).cast(frame.schema[0].dataType)


def bounds(df: DataFrame, column: str) -> tuple:
    """Smallest and largest value, as one row."""
    r = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()
    return r["a"], r["b"]


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, n_null)`` for all columns from one aggregate."""
    columns = list(columns or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return one.select(F.expr(f"stack({len(columns)}, {pairs}) as (column, n_null)"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def class_weights(df: DataFrame, label: str, classes: Sequence = (0, 1)) -> dict:
    """Balanced weights: rows / (number of classes * rows of the class)."""
    seen = {
        r[label]: r["n"]
        for r in df.where(F.col(label).isin(list(classes)))
        .groupBy(label)
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    missing = [c for c in classes if c not in seen]
    if missing:
        raise ValueError(f"no rows of class {missing} in {label}")
    total = sum(seen.values())
    return {c: total / (len(classes) * seen[c]) for c in classes}


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` for the classes present."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("k"))).scalar()
    return counts.select(label, "n", (totals["rows"] / (totals["k"] * F.col("n"))).alias("weight"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row: true positives, true negatives, false positives, false negatives."""
    t, p = F.col(truth), F.col(predicted)
    return df.agg(
        F.count_if((t == 1) & (p == 1)).alias("tp"),
        F.count_if((t == 0) & (p == 0)).alias("tn"),
        F.count_if((t == 0) & (p == 1)).alias("fp"),
        F.count_if((t == 1) & (p == 0)).alias("fn"),
    )


def share(num: Column, den: Column) -> Column:
    """Ratio that is 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, truth: str, predicted: str, digits: int = 4) -> DataFrame:
    """Confusion counts with accuracy, precision, recall and F1."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    scores = {
        "accuracy": share(tp + tn, tp + tn + fp + fn),
        "precision": share(tp, tp + fp),
        "recall": share(tp, tp + fn),
        "f1": share(2 * tp, 2 * tp + fp + fn),
    }
    return confusion(df, truth, predicted).withColumns(
        {name: F.bround(c, digits) for name, c in scores.items()}
    )


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy and averages.

    The table of (truth, predicted) counts is the only thing built from the
    rows; the rest works on a handful of rows.
    """
    pairs = (
        df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
        .groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(F.col("t").alias("c"), F.lit("t").alias("side"), "n", (F.col("t") == F.col("p")).alias("hit")),
                F.struct(F.col("p").alias("c"), F.lit("p").alias("side"), "n", (F.col("t") == F.col("p")).alias("hit")),
            )
        )
    )
    is_truth = F.col("side") == "t"
    per = (
        sides.groupBy("c")
        .agg(
            F.sum(F.when(is_truth & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"),
            F.sum(F.when(is_truth, F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(~is_truth, F.col("n")).otherwise(0)).alias("called"),
        )
        .withColumns(
            {
                "precision": share(F.col("hits"), F.col("called")),
                "recall": share(F.col("hits"), F.col("support")),
                "f1": share(2 * F.col("hits"), F.col("called") + F.col("support")),
            }
        )
    )
    names = ["precision", "recall", "f1"]
    # one entry per class from here on
    overall = share(F.sum("hits"), F.sum("support"))
    summary = {
        "accuracy": {m: overall for m in names},
        "macro avg": {m: F.avg(m) for m in names},
        "weighted avg": {
            m: share(F.sum(F.col(m) * F.col("support")), F.sum("support")) for m in names
        },
    }
    lines = [
        F.struct(
            F.lit(name).alias("class"), *[c.alias(m) for m, c in scores.items()],
            F.sum("support").alias("support"),
        )
        for name, scores in summary.items()
    ]
    per_class = F.collect_list(F.struct(F.col("c").cast("string").alias("class"), *names, "support"))
    return per.agg(F.concat(per_class, F.array(*lines)).alias("lines")).select(F.inline("lines"))
