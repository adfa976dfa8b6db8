"""Near-duplicate classes from DartMinHash signatures."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stage

from .common import fresh
from .components import connected_components
from .hashing import GOLDEN, Shingler, mix, uniform

#: Coordinates of a signature, in bands of ROWS; at a similarity of 0.8 one pair in 20,000 shares no band.
BANDS, ROWS = 25, 5
WORDS_IN_SHINGLE, SIMILAR = 5, 0.8
#: Pairs whose signatures agree less than this are not read: four standard deviations below SIMILAR.
PLAUSIBLE = 0.64
#: Coordinates, of one byte each, by which what a bucket still holds apart is compared; and how far, four
#: standard deviations, their agreement may be below the similarity.
WIDE, SLACK = 1024, 0.05
#: Texts of a bucket that one task compares with as many others.
BLOCK = 512
#: Texts taken together when darts are thrown.
TOGETHER = 256


def throw(elements: list[np.ndarray], weights: list[np.ndarray], k: int, seed: int = 0) -> np.ndarray:
    """A row of k coordinates (uint64) for each weighted set; two rows agree in a share of
    coordinates whose mean is the generalised Jaccard similarity of the sets.

    The region of an element is its weight by time. It is cut into strips [0, 1), [1, 2), [2, 4), ... of
    the weight, into each of which darts fall at random times that depend on the element and strip
    alone. A dart counts if its height is below the weight; it belongs to a random coordinate, which keeps
    its earliest dart. Time runs, set by set, until about k ln k + 2k darts have
    fallen, and on until no coordinate is empty. A set without elements has zeros.
    """
    out = np.zeros((len(elements), k), np.uint64)
    best = np.full((len(elements), k), np.inf)
    if not elements:
        return out
    owner = np.repeat(np.arange(len(elements)), [len(e) for e in elements])
    element, weight = np.concatenate(elements).astype(np.uint64), np.concatenate(weights).astype(np.float64)
    mass = np.bincount(owner, weight, len(elements))
    strips = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(np.int64) + 1
    at = np.repeat(np.arange(len(element)), strips)
    strip = np.arange(len(at)) - np.repeat(np.cumsum(strips) - strips, strips)
    width = np.where(strip > 0, 2.0 ** (strip - 1), 1.0)
    low = np.where(strip > 0, width, 0.0)
    owner, top = owner[at], weight[at]
    state = mix(mix(element[at] + np.uint64(seed) * GOLDEN) + strip.astype(np.uint64) * GOLDEN)
    number = np.ones(len(state), np.uint64)
    dart = mix(state + number * GOLDEN)
    time = -np.log(uniform(dart)) / width
    end = (k * np.log(k) + 2 * k) / np.maximum(mass, 1e-300)
    empty = mass > 0
    while empty.any():
        live = np.flatnonzero((time <= end[owner]) & empty[owner])
        while len(live):
            second = mix(dart[live] ^ GOLDEN)
            third = mix(second + GOLDEN)
            hit = low[live] + uniform(third) * width[live] < top[live]
            rows, t = owner[live][hit], time[live][hit]
            cell = rows * k + (second[hit] % np.uint64(k)).astype(np.int64)
            # the last write of a cell stays: the earliest dart is written last
            order = np.argsort(-t, kind="stable")
            cell, t, name = cell[order], t[order], third[hit][order]
            first = t < best.ravel()[cell]
            best.ravel()[cell[first]] = t[first]
            out.ravel()[cell[first]] = name[first]
            number[live] += np.uint64(1)
            dart[live] = mix(state[live] + number[live] * GOLDEN)
            time[live] -= np.log(uniform(dart[live])) / width[live]
            live = live[time[live] <= end[owner[live]]]
        empty &= np.isinf(best).any(axis=1)
        end = np.where(empty, end * 1.5, end)
    return out


def signatures(size: int, k: int, weighted: bool, seed: int, width: int = 4):
    """mapInPandas over (text, ...): the text gives way to ``shingles`` (how many distinct) and
    ``signature`` (the low ``width`` bytes of each coordinate)."""

    def run(batches):
        import pandas as pd

        cut = Shingler(size)
        for batch in batches:
            for start in range(0, len(batch), TOGETHER):
                part = batch.iloc[start : start + TOGETHER]
                found = [cut(t) for t in part["text"]]
                rows = throw([e for e, _ in found], [n if weighted else np.ones(len(n)) for _, n in found], k, seed).astype(f"<u{width}")
                yield part.drop(columns="text").assign(shingles=[len(e) for e, _ in found], signature=pd.Series([r.tobytes() for r in rows], index=part.index, dtype=object))

    return run


def _agreeing(a, b):
    """Share of coordinates in which two signatures agree."""

    @F.pandas_udf("double")
    def share(x, y):
        import pandas as pd

        if not len(x):
            return pd.Series([], dtype="float64")
        p = np.frombuffer(b"".join(x), "<u4").reshape(len(x), -1)
        q = np.frombuffer(b"".join(y), "<u4").reshape(len(x), -1)
        return pd.Series((p == q).mean(axis=1))

    return share(a, b)


def _apart(least: float):
    """Of one block of a bucket and another: pairs of different classes, not both the main one, whose wide
    signatures agree in a share of at least ``least``."""

    def run(group):
        import pandas as pd

        wide = np.frombuffer(b"".join(group["wide"]), np.uint8).reshape(len(group), -1)
        n, c = group["n"].to_numpy(), group["c"].to_numpy()
        left = (group["block"] == group["i"]).to_numpy()
        right = np.flatnonzero((group["block"] == group["j"]).to_numpy())
        outside = c != group["main"].iloc[0]
        found = []
        for at in np.flatnonzero(left):
            # a pair is taken once: in its own block by place, else from the left one
            to = right[right > at] if group["i"].iloc[0] == group["j"].iloc[0] else right
            to = to[(c[to] != c[at]) & (outside[to] | outside[at])]
            if len(to):
                to = to[(wide[to] == wide[at]).mean(axis=1) >= least]
                found += [(n[at], m) for m in n[to]]
        pairs = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
        return pd.DataFrame({"x": pairs[:, 0], "y": pairs[:, 1]})

    return run


def _similarity(size: int, weighted: bool, a, b):
    """Exact Jaccard similarity of two texts' shingles, generalised if weighted."""

    @F.pandas_udf("double")
    def similarity(x, y):
        import pandas as pd

        cut = Shingler(size)
        last, own = None, None
        out = []
        for s, t in zip(x, y):
            if s is not last:
                last, own = s, cut(s)
            (e, n), (f, m) = own, cut(t)
            _, i, j = np.intersect1d(e, f, assume_unique=True, return_indices=True)
            if weighted:
                low = np.minimum(n[i], m[j]).sum()
                out.append(low / max(n.sum() + m.sum() - low, 1))
            else:
                out.append(len(i) / max(len(e) + len(f) - len(i), 1))
        return pd.Series(out, dtype="float64")

    return similarity(a, b)


def near_duplicates(
    docs: DataFrame,
    similar: float = SIMILAR,
    size: int = WORDS_IN_SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    plausible: float = PLAUSIBLE,
    weighted: bool = False,
    seed: int = 0,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, address, copies, class_id, kept): one row for each distinct document, a pair of id and text.

    Texts are the same class when a chain of pairs joins them, each found in a common band and at least
    ``similar`` by the exact Jaccard similarity of their shingles of ``size`` words (with their counts
    if ``weighted``). The class id is its smallest document id; ``kept`` marks the one row that stands for the
    class. ``address`` is the text's SHA-256, ``copies`` how many rows have this id and text.

    Equal texts are one class before any signature is made. In a bucket of a band everything is compared
    with the bucket's most central text, never with everything. Only where a bucket then still holds
    several classes, its texts outside the largest class are compared, in blocks and by wider signatures,
    with those of other classes; that is quadratic in such a bucket, but only likely pairs leave a block.

    A null text is empty; texts without words are a class only with equal ones. A null id is after all others.
    Whole texts are read, however long. Other columns are left out, whatever their names. No rows: no rows.
    """
    spark = docs.sparkSession
    k = bands * rows
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("address", F.sha2("text", 256))
    named = stage(whole.groupBy("doc_id", "address").agg(F.count(F.lit(1)).alias("copies")), "named")
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("doc_id"))
    # texts are numbered by a hash of their address; two texts with one number end the job
    number = F.xxhash64("address").alias("n")
    texts = named.groupBy("address").agg(F.min(order).alias("first"))
    texts = stage(texts.select(number, "address", "first"), "texts")
    if not texts.groupBy("n").count().where("count > 1").isEmpty():
        raise RuntimeError("two texts have the same number")

    # every text's signature, made where the text is read; equal texts give equal rows
    made = whole.select("text", number).mapInPandas(signatures(size, k, weighted, seed), "n long, shingles long, signature binary")
    made = stage(made, "signed")
    signed = stage(made.where("shingles > 0").groupBy("n").agg(F.first("signature").alias("signature")), "signatures")
    cut = lambda b: F.xxhash64(F.lit(b), F.substring("signature", 4 * rows * b + 1, 4 * rows))
    buckets = signed.select("n", F.posexplode(F.array(*(cut(b) for b in range(bands)))).alias("band", "bucket")).select("n", F.col("bucket").alias("b"))
    shared = stage(buckets.groupBy("b").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    member = stage(buckets.join(shared, "b"), "members")
    # the text that most others share a bucket with is the likely source of the copies around it
    central = stage(member.groupBy("n").agg(F.sum("size").alias("central")), "central")
    member = member.select("b", "n").join(central, "n")
    heads = stage(member.groupBy("b").agg(F.max_by("n", F.struct("central", "n")).alias("head")), "heads")
    member = stage(member.join(heads, "b").select("b", "n", "head"), "headed")

    def verified(pairs: DataFrame) -> DataFrame:
        """Of (x, y), x < y, those that are similar."""
        pairs = pairs.distinct()
        side = lambda name: signed.select(F.col("n").alias(name), F.col("signature").alias(f"s{name}"))
        pairs = pairs.join(side("x"), "x").join(side("y"), "y")
        pairs = stage(pairs.where(_agreeing(F.col("sx"), F.col("sy")) >= plausible).select("x", "y"), "plausible")
        ends = stage(pairs.select(F.explode(F.array("x", "y")).alias("n")).distinct(), "ends")
        read = whole.select(number, "text").join(ends, "n", "left_semi").groupBy("n").agg(F.first("text").alias("text"))
        read = stage(read, "read")
        end = lambda name: read.select(F.col("n").alias(name), F.col("text").alias(f"t{name}"))
        pairs = pairs.join(end("x"), "x").join(end("y"), "y")
        return stage(pairs.where(_similarity(size, weighted, F.col("tx"), F.col("ty")) >= similar).select("x", "y"), "similar")

    to_head = member.where("n != head").select(F.least("head", "n").alias("x"), F.greatest("head", "n").alias("y"))
    links = verified(to_head)
    classes = stage(connected_components(links, "x", "y"), "classes")
    of = member.join(classes, F.col("n") == F.col("node"), "left").select("b", "n", "head", F.coalesce("component", "n").alias("c"))
    of = stage(of, "of")
    # buckets that still hold several classes, and the largest class of each
    held = of.groupBy("b", "c").agg(F.count(F.lit(1)).alias("size")).groupBy("b").agg(F.max_by("c", F.struct("size", "c")).alias("main"), F.count(F.lit(1)).alias("classes"), F.sum("size").alias("size"))
    # in a bucket of two, the two have been compared
    blocks = F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")
    mixed = stage(held.where("classes > 1 and size > 2").select("b", "main", blocks), "mixed")
    here = stage(of.join(mixed, "b").select("b", "n", "c", "main", "blocks"), "here")
    apart = stage(here.select("n").distinct(), "apart")
    wide = whole.select("text", number).join(apart, "n", "left_semi").mapInPandas(signatures(size, WIDE, weighted, seed + 1, 1), "n long, shingles long, signature binary")
    wide = stage(wide.groupBy("n").agg(F.first("signature").alias("wide")), "wide")
    here = here.join(wide, "n").withColumn("block", F.pmod(F.xxhash64("n"), F.col("blocks")).cast("int"))
    here = here.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    here = here.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    rest = here.select("b", "i", "j", "block", "n", "c", "main", "wide").groupBy("b", "i", "j").applyInPandas(_apart(similar - SLACK), "x long, y long")
    more = verified(rest)
    texts = texts.join(classes, F.col("n") == F.col("node"), "left").select("n", "address", "first", F.coalesce("component", "n").alias("c"))
    if not more.isEmpty():
        # classes that a late link joins: components over classes, not over texts
        texts = stage(texts, "classed")
        side = lambda end: texts.select(F.col("n").alias(end), F.col("c").alias(f"c{end}"))
        joined = connected_components(more.join(side("x"), "x").join(side("y"), "y"), "cx", "cy")
        texts = texts.join(joined, F.col("c") == F.col("node"), "left").withColumn("c", F.coalesce("component", "c"))
    texts = stage(texts.select("address", "first", "c"), "classed")
    ids = stage(texts.groupBy("c").agg(F.min(F.struct("first", "address")).alias("best")), "best")
    texts = texts.join(ids, "c").select(F.col("address").alias("a"), "best")
    own = F.struct(order.alias("first"), F.col("address").alias("address"))
    out = named.join(texts, F.col("address") == F.col("a"))
    return out.select("doc_id", "address", "copies", F.col("best.first.doc_id").alias("class_id"), (own == F.col("best")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """The documents less all but one of every class; of rows with the kept id and text, one stays. All columns stay,
    whatever their names; for nulls and the rest see ``near_duplicates``."""
    kept = stage(near_duplicates(docs, text=text, doc_id=doc_id, **how).where("kept").select("doc_id", "address", "copies"), "kept")
    mark, own, n = fresh(docs, "_address", "_id", "_copies")
    kept = kept.select(F.col("address").alias(mark), F.col("doc_id").alias(own), F.col("copies").alias(n))
    rows = docs.withColumn(mark, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    same = F.col(f"d.{doc_id}").eqNullSafe(F.col(f"k.{own}")) & (F.col(f"d.{mark}") == F.col(f"k.{mark}"))
    found = lambda k: rows.alias("d").join(k.alias("k"), same, "left_semi").select("d.*")
    once = found(kept.where(F.col(n) == 1))
    again = kept.where(F.col(n) > 1)
    if not again.isEmpty():
        once = once.unionByName(found(again).dropDuplicates([doc_id, mark]))
    return once.drop(mark)
