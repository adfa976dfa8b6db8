"""Hard negatives by angular triangle filtering and exact integer scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stage

#: Reference directions whose angles every vector stores.
DIRECTIONS = 8
#: Rows, and anchors, that one task compares with each other; and anchors taken together there.
BLOCK, TOGETHER = 4096, 256
#: Share of the norms' product by which bounds are widened: angles are stored in single precision, so an angle's sum
#: or difference is off by less than 1e-6, and cosines by no more.
SLACK = 4e-6
#: Integers of up to this size are exact in double precision.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def references(dim: int, directions: int, seed: int) -> np.ndarray:
    """Orthonormal rows while there are dimensions, then random unit rows."""
    x = np.random.default_rng([seed, dim]).normal(size=(directions, dim))
    if dim:
        x[: min(directions, dim)] = np.linalg.qr(x[:dim].T)[0].T[: min(directions, dim)]
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


def _prepared(scale: float, directions: int, seed: int):
    """mapInPandas: integer components, their norm, the angles to the references and the nearest of these."""

    def run(batches):
        import pandas as pd

        known: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                dim = int(dim)
                if dim not in known:
                    known[dim] = references(dim, directions, seed)
                with np.errstate(over="ignore"):
                    x = np.floor(scale * np.array([np.asarray(v, np.float64) for v in part["vec"]]).reshape(len(part), dim))
                fine = np.isfinite(x).all(axis=1)
                x, part = x[fine], part[fine]
                # by the largest component first, so that no square overflows
                top = np.maximum(np.abs(x).max(axis=1, initial=0), 1e-300)
                unit = x / top[:, None]
                length = np.sqrt((unit * unit).sum(axis=1))
                cosine = (unit @ known[dim].T) / np.maximum(length, 1e-300)[:, None]
                angle = np.arccos(np.clip(cosine, -1, 1)).astype("<f4")
                with np.errstate(over="ignore"):
                    norm = np.minimum(length * top, 1e300)
                yield pd.DataFrame({
                    "id": part["id"], "label": part["label"], "anchor": part["anchor"], "dim": part["dim"],
                    "x": [r.tobytes() for r in x.astype("<f8")], "norm": norm,
                    "angles": [r.tobytes() for r in angle], "nearest": angle.argmin(axis=1).astype(np.int32),
                })

    return run


class Side:
    """Rows of one side of a comparison as arrays."""

    def __init__(self, frame):
        n = len(frame)
        self.id, self.norm = frame["id"].to_numpy(), frame["norm"].to_numpy()
        self.label = frame["label"].to_numpy()
        self.x = np.frombuffer(b"".join(frame["x"]), "<f8").reshape(n, -1)
        angle = np.frombuffer(b"".join(frame["angles"]), "<f4").reshape(n, -1).astype(np.float64)
        self.cos, self.sin = np.cos(angle), np.sin(angle)

    def part(self, a: int, b: int) -> Side:
        out = object.__new__(Side)
        for k, v in vars(self).items():
            setattr(out, k, v[a:b])
        return out


def bounds(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that the triangle inequality of angles leaves each pair: the angle between
    two vectors is at least the difference of their angles to a reference, at most the sum."""
    low, high = np.full((len(a.id), len(b.id)), -1.0), np.ones((len(a.id), len(b.id)))
    for k in range(a.cos.shape[1]):
        straight, across = np.outer(a.cos[:, k], b.cos[:, k]), np.outer(a.sin[:, k], b.sin[:, k])
        np.minimum(high, straight + across, out=high)
        np.maximum(low, straight - across, out=low)
    with np.errstate(over="ignore"):
        size = np.outer(a.norm, b.norm)
    # scores that a long may not hold count as the nearest long, so nothing is known of their order
    fits = size < 2.0**62
    size = np.where(fits, size, 0)
    return np.where(fits, size * (low - SLACK) - 1, -np.inf), np.where(fits, size * (high + SLACK) + 1, np.inf)


def scores(a: Side, b: Side, wanted: np.ndarray) -> np.ndarray:
    """Exact inner products of integers as long where ``wanted``; what no long holds is the nearest one."""
    out = np.zeros(wanted.shape, np.int64)
    if not wanted.any():
        return out
    if float(a.norm.max()) * float(b.norm.max()) >= EXACT:
        whole = lambda x: [[int(v) for v in r] for r in x]
        x, y = whole(a.x), whole(b.x)
        for i, j in zip(*np.nonzero(wanted)):
            out[i, j] = max(-LONG - 1, min(LONG, sum(p * q for p, q in zip(x[i], y[j]))))
    elif wanted.mean() > 1 / 16:
        out[wanted] = (a.x @ b.x.T)[wanted]
    else:
        at, to = np.nonzero(wanted)
        for s in range(0, len(at), 1 << 16):
            i, j = at[s : s + (1 << 16)], to[s : s + (1 << 16)]
            out[i, j] = np.einsum("ij,ij->i", a.x[i], b.x[j])
    return out


def _positives(most: int):
    """Of a block of anchors and one of rows of their label: each anchor's best ``most`` there."""

    def run(anchors, rows):
        import pandas as pd

        out = []
        if len(anchors) and len(rows):
            b = Side(rows)
            whole = Side(anchors)
            for s in range(0, len(anchors), TOGETHER):
                a = whole.part(s, s + TOGETHER)
                other = a.id[:, None] != b.id[None, :]
                low, high = bounds(a, b)
                low[~other] = -np.inf
                if low.shape[1] > most:
                    # what cannot reach the least score of the best by their lower bounds
                    least = np.partition(low, -most, axis=1)[:, -most]
                    other &= high >= least[:, None]
                found = scores(a, b, other)
                for i in range(len(a.id)):
                    j = np.flatnonzero(other[i])
                    j = j[np.lexsort((b.id[j], -found[i, j].astype(object) if found[i].min() == -LONG - 1 else -found[i, j]))[:most]]
                    out.append((np.full(len(j), a.id[i]), b.id[j], found[i, j]))
        a, p, n = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pd.DataFrame({"anchor_id": a, "positive_id": p, "positive_score": n})

    return run


def _negatives(most: int, low_share: int, high_share: int):
    """Of a block of anchors and one of rows: for each of an anchor's positive scores the best ``most`` of
    another label inside its window."""

    def run(anchors, rows):
        import pandas as pd

        out = []
        if len(anchors) and len(rows):
            b, whole = Side(rows), Side(anchors)
            # 100 n >= low_share p and 100 n <= high_share p, in integers of any size
            wanted = [sorted({int(p) for p in w}, reverse=True) for w in anchors["wanted"]]
            spans = [[(p, -(-low_share * p // 100), high_share * p // 100) for p in w if low_share * p <= high_share * p] for w in wanted]
            for s in range(0, len(anchors), TOGETHER):
                a, mine = whole.part(s, s + TOGETHER), spans[s : s + TOGETHER]
                low, high = bounds(a, b)
                inside = np.zeros(low.shape, bool)
                for i, own in enumerate(mine):
                    for _, least, largest in own:
                        inside[i] |= (high[i] >= least) & (low[i] <= largest)
                inside &= a.label[:, None] != b.label[None, :]
                found = scores(a, b, inside)
                for i, own in enumerate(mine):
                    j = np.flatnonzero(inside[i])
                    n = found[i, j]
                    for p, least, largest in own:
                        at = np.flatnonzero((n >= least) & (n <= largest))
                        if len(at) > 4 * most:
                            # only what is at least the most-th largest can be among the first
                            at = at[n[at] >= np.partition(n[at], -most)[-most]]
                        at = at[np.lexsort((b.id[j[at]], -n[at]))[:most]]
                        out.append((np.full(len(at), a.id[i]), np.full(len(at), p), b.id[j[at]], n[at]))
        a, p, m, n = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4
        return pd.DataFrame({"anchor_id": a, "positive_score": p, "negative_id": m, "negative_score": n})

    return run


def _first(found: DataFrame, by: list[str], most: int, score: str, tie: str) -> DataFrame:
    """The first rows of each group, numbered from 1; every block has sent ``most`` at most."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _cogrouped(a: DataFrame, b: DataFrame, by: list[str]):
    """Both sides come of one table, so the columns of one are named anew."""
    b = b.select(*(F.col(c).alias(c) for c in b.columns))
    return a.groupBy(*by).cogroup(b.groupBy(*by))


def mine_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    low_share: int = 80,
    high_share: int = 100,
    scale: float = 256.0,
    directions: int = DIRECTIONS,
    block: int = BLOCK,
    seed: int = 0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and positive its
    hardest negatives.

    A component x counts as floor(scale * x); a score is the integer inner product with the anchor, higher ones come
    first, ties by the smaller id. Anchors are the rows where ``anchors`` holds; positives are the first of
    an anchor's other rows of its label; negatives the first rows of another label whose score is between
    ``low_share`` and ``high_share`` hundredths of the positive's. All, where there are fewer.

    Every vector stores its angles to a few reference directions. For an anchor and a row these give an interval of
    the angle between them, so, multiplied by the norms and widened for rounding, least and largest scores.
    Only rows whose interval reaches the best found by lower bounds (positives) or a window (negatives) get a
    score, in exact integers. The anchors, a share of all rows, are compared with all rows in blocks of about
    ``block`` on either side, positives only inside a label; each pair of blocks is one group, of which at most
    ``negatives`` rows for a positive leave. The work is the product of the number of anchors and that of rows, as the
    definition asks; no row is left out.

    Rows with a null id, label or vector, with a null or non-finite component, or one that ``scale`` takes beyond doubles,
    take no part. Vectors are compared with those of their length only; a zero vector scores 0. Rows of one id are one
    vector, the least of them. Scores that no long holds count as the nearest long. Other columns are left out, whatever
    their names. No rows or anchors: no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(embedding).alias("vec"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "vec", "anchor")).alias("v")).select("id", "v.*", F.size("v.vec").alias("dim"))
    kind = dict(rows.dtypes)["label"]
    rows = rows.mapInPandas(_prepared(scale, directions, seed), f"id long, label {kind}, anchor boolean, dim int, x binary, norm double, angles binary, nearest int")
    rows = stage(rows, "angles")
    spread = F.xxhash64("id")

    # positives: blocks inside each label
    counts = rows.groupBy("dim", "label").agg(F.ceil(F.count(F.lit(1)) / block).alias("rb"), F.ceil(F.count_if("anchor") / block).alias("ab"))
    numbered = rows.join(stage(counts.where("ab > 0"), "counts"), ["dim", "label"])
    mine = numbered.where("anchor").withColumns({"i": F.pmod(spread, "ab"), "j": F.explode(F.expr("sequence(0, rb - 1)"))})
    theirs = numbered.withColumns({"j": F.pmod(spread, "rb"), "i": F.explode(F.expr("sequence(0, ab - 1)"))})
    columns = ["dim", "label", "i", "j", "id", "x", "norm", "angles"]
    pairs = _cogrouped(mine.select(*columns), theirs.select(*columns), ["dim", "label", "i", "j"])
    best = pairs.applyInPandas(_positives(positives), "anchor_id long, positive_id long, positive_score long")
    best = stage(_first(best, ["anchor_id"], positives, "positive_score", "positive_id").drop("rank"), "positives")

    # negatives: blocks of rows with one nearest direction
    wanted = best.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("wanted"))
    seekers = stage(rows.where("anchor").join(wanted, "id").withColumn("of", F.lit(0)), "seekers")
    sizes = rows.groupBy("dim", "nearest").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    upto = Window.partitionBy("dim").orderBy("nearest")
    sizes = sizes.withColumn("before", F.sum("blocks").over(upto) - F.col("blocks"))
    asked = seekers.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).alias("ab"))
    total = sizes.groupBy("dim").agg(F.sum("blocks").alias("rb")).join(asked, "dim")
    sizes, total = stage(sizes.join(asked, "dim"), "sizes"), stage(total, "totals")
    mine = seekers.join(total, "dim").withColumns({"i": F.pmod(spread, "ab"), "j": F.explode(F.expr("sequence(0, rb - 1)"))})
    theirs = rows.join(sizes, ["dim", "nearest"]).withColumns({"j": F.col("before") + F.pmod(spread, "blocks"), "i": F.explode(F.expr("sequence(0, ab - 1)"))})
    columns = ["dim", "i", "j", "id", "label", "x", "norm", "angles"]
    pairs = _cogrouped(mine.select(*columns, "wanted"), theirs.select(*columns), ["dim", "i", "j"])
    hard = pairs.applyInPandas(_negatives(negatives, low_share, high_share), "anchor_id long, positive_score long, negative_id long, negative_score long")
    hard = _first(hard, ["anchor_id", "positive_score"], negatives, "negative_score", "negative_id")
    return best.join(hard, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
