"""A text quality score learnt from pairs: Bradley-Terry on feature differences."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import others

#: Features: shares of the 256 byte values, then these.
SHAPES = (
    "log_bytes", "log_words", "word_length", "distinct_words", "repeated_words", "distinct_lines", "line_length",
    "capital_words", "marked_words", "commonest_word", "distinct_pairs", "long_words",
)
#: A score from which a document is predicted good.
CUT = 0.7
#: Pairs whose differences are in memory at a time.
PAIRS_AT_ONCE = 4096


def features(text: str | None) -> np.ndarray:
    """The features of one whole text; a null text is empty. No label, source or language enters."""
    text = text or ""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    n = max(len(data), 1)
    out = np.empty(256 + len(SHAPES), np.float32)
    # square roots keep rare marks in sight beside letters
    out[:256] = np.sqrt(np.bincount(data, minlength=256) / n)
    words = text.split()
    m = max(len(words), 1)
    lines = [x for x in text.split("\n") if x]
    ids: dict[str, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pairs = at[1:] * len(ids) + at[:-1]
    out[256:] = (
        np.log1p(len(data)),
        np.log1p(len(words)),
        np.log1p(len(text) / m),
        len(ids) / m,
        np.count_nonzero(at[1:] == at[:-1]) / m,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(text) / max(len(lines), 1)),
        sum(map(str.isupper, words)) / m,
        sum(not w[-1].isalnum() for w in words) / m,
        np.bincount(at).max() / m if len(words) else 0,
        len(np.unique(pairs)) / max(len(pairs), 1),
        sum(len(w) > 20 for w in words) / m,
    )
    return out


@dataclass(frozen=True)
class PairModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs_per_row: int = 8, ridge: float = 1e-3, steps: int = 30, seed: int = 0) -> PairModel:
    """Weights under which the better document of a pair wins: logistic loss on the difference of
    features, by Newton steps. The cut is the quantile of the scores at the share of bad documents, so
    that as many fall below it as are bad.

    Without a document of either kind there are no pairs: every strength is then 0 and every
    document is good unless all are bad.
    """
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = (x - mean) / scale
    win, lose = np.flatnonzero(good == 1), np.flatnonzero(good == 0)
    w = np.zeros(x.shape[1])
    if not len(win) or not len(lose):
        return PairModel(mean, scale, w, 1.0 if len(lose) else -1.0)
    rng = np.random.default_rng(seed)
    n = pairs_per_row * len(x)
    # every document of the smaller kind meets many of the other
    first, second = win[rng.permutation(n) % len(win)], lose[rng.permutation(n) % len(lose)]
    for _ in range(steps):
        grad, hess = -ridge * w, (ridge + 1e-9) * np.eye(len(w))
        for at in range(0, n, PAIRS_AT_ONCE):
            d = (z[first[at : at + PAIRS_AT_ONCE]] - z[second[at : at + PAIRS_AT_ONCE]]).astype(np.float64)
            p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # that the worse one wins
            grad += d.T @ p / n
            hess += (d * (p * (1 - p))[:, None]).T @ d / n
        step = np.linalg.solve(hess, grad)
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    s = np.sort(z @ w)
    at = len(lose)
    return PairModel(mean, scale, w, float(s[at - 1] + s[at]) / 2)


def _packed(batches):
    """mapInArrow over (i, t, y): ids with labels, and the features of the texts, of a batch in one value each."""
    import pyarrow as pa

    for b in batches:
        if len(b):
            keys = [*zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
            x = np.array([features(t) for t in b.column(1).to_pylist()], "<f4")
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(keys)], pa.binary()), pa.array([x.tobytes()], pa.binary())], ["keys", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, text: str = "text", doc_id: str = "doc_id", label: str = "quality", seed: int = 0) -> PairModel:
    """Learn from labelled documents, of which about ``fit_rows`` chosen by a hash of the id are
    used when there are more; that bound keeps them in the driver's memory. Null ids and labels
    teach nothing; an id labelled twice counts by its smallest label, one with several texts by the least, so repeated
    rows count once. A null text is empty; whole texts are read, however long. Other columns, whatever their
    names, play no part. Without labelled rows every strength is 0 and every document is good."""
    known = labels.select(F.col(doc_id).alias("i"), F.col(label).alias("y")).where("i is not null and y is not null").groupBy("i").agg(F.min("y").alias("y"))
    n = known.count()
    if n > fit_rows:
        known = known.where(F.pmod(F.xxhash64("i", F.lit(seed)), F.lit(1 << 30)) < int(fit_rows / n * (1 << 30)))
    # at most about fit_rows ids: a bounded table
    rows = docs.select(F.col(doc_id).alias("i"), F.col(text).alias("t")).join(F.broadcast(known), "i")
    # one row an id, so a repeated id is no more to the driver than another
    rows = rows.groupBy("i").agg(F.min("t").alias("t"), F.min("y").alias("y"))
    # a few whole arrays come to the driver, not objects for each row
    keys, x = [], []
    for part in rows.mapInArrow(_packed, "keys binary, x binary").toLocalIterator():
        keys += pickle.loads(part["keys"])
        x.append(np.frombuffer(part["x"], "<f4").reshape(-1, 256 + len(SHAPES)))
    if not keys:
        return fit_pairs(np.zeros((1, 256 + len(SHAPES)), np.float32), np.array([]), seed=seed)
    order = sorted(range(len(keys)), key=lambda at: keys[at][0])
    x = np.concatenate(x)[order]
    good = np.array([keys[at][1] for at in order])
    return fit_pairs(x, good, seed=seed)


def quality_of(model: PairModel, text: Column) -> Column:
    """Score of 0 to 1: the logistic of the strength, moved so that the model's cut is at ``CUT``."""
    shift = float(np.log(CUT / (1 - CUT)))

    @F.pandas_udf("double")
    def score(batch):
        import pandas as pd

        if not len(batch):
            return pd.Series([], dtype="float64")
        s = model.strength(np.array([features(t) for t in batch])) - model.cut + shift
        return pd.Series(1 / (1 + np.exp(-np.clip(s, -500, 500))))

    return score(text)


def classify_quality(docs: DataFrame, model: PairModel, text: str = "text") -> DataFrame:
    """Adds ``score`` and ``predicted`` (1 from a score of 0.7) to every row; columns so named are
    replaced, others stay. A null text scores as an empty one, whole texts are read however long, and equal
    texts, in repeated rows too, have equal scores. No rows: no rows."""
    rows = docs.select(*others(docs, "score", "predicted")).withColumn("score", quality_of(model, F.col(text)))
    return rows.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
