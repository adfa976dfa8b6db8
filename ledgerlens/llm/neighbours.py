"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stage, tidied

from .components import connected_components

#: The least number of passes; a label of many vectors gets as many as CHANCE takes.
PASSES, BITS, WINDOW = 8, 64, 32
#: That a pair exactly at the threshold, alone in its label, meets in a window of some pass, by the formula
#: of ``link_near_vectors``.
CHANCE = 0.999
#: Vectors of a component that one task compares with as many others.
BLOCK = 256


def _units(vectors) -> np.ndarray:
    """Rows of length one in double precision."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def passes_for(n: Column, similar: float, passes: int = PASSES, window: int = WINDOW, chance: float = CHANCE) -> Column:
    """Passes for a label of ``n`` vectors: the fewest, but at least ``passes``, that give ``chance``."""
    apart = 1 - math.acos(min(1.0, max(-1.0, similar))) / math.pi
    levels = F.log2(F.greatest(n / F.lit(window), F.lit(1.0)))
    missed = 1 - F.pow(F.lit(apart), levels)
    wanted = F.when(missed <= 1 - chance, 1).otherwise(F.ceil(math.log(1 - chance) / F.log(missed)))
    return F.greatest(F.lit(passes), wanted).cast("int")


def _keys(bits: int, seed: int):
    """Adds the sort keys of each row's passes: the signs of random projections, as bytes."""

    def run(batches):
        import pandas as pd

        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            keys = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            for (dim, passes), part in batch.groupby(["dim", "passes"]):
                x, signs = _units(part["vec"]), []
                for p in range(int(passes)):
                    if (dim, p) not in planes:
                        planes[dim, p] = np.random.default_rng([seed, int(dim), p]).normal(size=(int(dim), bits))
                    signs.append(np.packbits(x @ planes[dim, p] >= 0, axis=1))
                for at, i in enumerate(part.index):
                    keys[i] = [row[at].tobytes() for row in signs]
            yield batch.assign(keys=keys)

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, least place of its component) of the places below ``n`` that links (a, b) join to a smaller one."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        live = low < high
        a, b, low, high = a[live], b[live], low[live], high[live]
        np.minimum.at(root, high, low)
        while (further := root[root] != root).any():
            root[further] = root[root[further]]
    joined = np.flatnonzero(root != np.arange(n))
    return joined, root[joined]


def _near(x: np.ndarray, window: int, similar: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of similar unit rows that are at most ``window`` apart."""
    found = [(np.zeros(0, np.int64),) * 2]
    for w in range(1, min(window, len(x) - 1) + 1):
        at = np.flatnonzero(np.einsum("ij,ij->i", x[:-w], x[w:]) >= similar)
        found.append((at, at + w))
    return tuple(np.concatenate(c) for c in zip(*found))


#: What a pass gives: links, and of every partition the rows at its ends.
FOUND = "a long, b long, part int, at long, size long, pass int, label {label}, dim int, id long, vec {vec}"


def _windows(window: int, similar: float):
    """Links between rows of a sorted run whose places differ by at most ``window``: a spanning forest of each batch, so at
    most one a row. Of each partition the first and last ``window`` rows go along, with their places, so
    that windows can go on across its border."""
    names = ["pass", "label", "dim", "id", "vec"]

    def run(batches):
        import pandas as pd

        tail, size, part_id, first = None, 0, 0, None
        for batch in batches:
            if not len(batch):
                continue
            part_id = int(batch["part"].iloc[0])
            batch = batch.assign(at=np.arange(size, size + len(batch)))
            size += len(batch)
            first = batch.head(window) if first is None else pd.concat([first, batch]).head(window)
            batch = batch if tail is None else pd.concat([tail, batch], ignore_index=True)
            for _, rows in batch.groupby(["pass", "label", "dim"], sort=False):
                ids = rows["id"].to_numpy()
                a, b = _near(_units(rows["vec"]), window, similar)
                a, b = _forest(a, b, len(ids))
                yield pd.DataFrame({"a": ids[a], "b": ids[b], **dict.fromkeys(["part", "at", "size", *names])})
            tail = batch.iloc[-window:].reset_index(drop=True)
        if size:
            ends = pd.concat([first, tail]).drop_duplicates("at")
            yield ends[names].assign(a=None, b=None, part=part_id, at=ends["at"], size=size)[["a", "b", "part", "at", "size", *names]]

    return run


def _across(window: int, similar: float):
    """Links across one border, from the rows before and behind it."""

    def run(group):
        import pandas as pd

        group = group.sort_values("place")
        out = [pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})]
        for _, rows in group.groupby(["pass", "label", "dim"]):
            ids, place, x = rows["id"].to_numpy(), rows["place"].to_numpy(), _units(rows["vec"])
            before, behind = np.flatnonzero(place < 0), np.flatnonzero(place >= 0)
            near = (x[before] @ x[behind].T >= similar) & (place[behind][None, :] - place[before][:, None] <= window)
            i, j = np.nonzero(near)
            a, b = _forest(before[i], behind[j], len(ids))
            out.append(pd.DataFrame({"a": ids[a], "b": ids[b]}))
        return pd.concat(out)

    return run


def _borders(sizes: dict[int, int], window: int) -> list[tuple[int, int, int, int]]:
    """(border, part, offset): the rows of ``part`` whose place plus ``offset`` is between -window and window - 1 stand at
    that place at the border, which is named by the part behind it. A part smaller than a window has part in
    several borders."""
    out, parts = [], sorted(sizes)
    for n, border in enumerate(parts[1:], start=1):
        out.append((border, border, 0))
        back, k = 0, n - 1
        while k >= 0 and back < window:
            back += sizes[parts[k]]
            out.append((border, parts[k], -back))
            k -= 1
    return out


def _counted(similar: float):
    """Links within one block, or between two blocks, of a component: (id, links) with copies counted."""

    def run(group):
        import pandas as pd

        x, n = _units(group["vec"]), group["n"].to_numpy()
        left = (group["block"] == group["i"]).to_numpy()
        right = (group["block"] == group["j"]).to_numpy()
        rows, cols = np.flatnonzero(left), np.flatnonzero(right)
        near = x[rows] @ x[cols].T >= similar
        near &= rows[:, None] != cols[None, :]
        ids = group["id"].to_numpy()
        out = [(ids[rows], near @ n[cols])]
        if group["i"].iloc[0] != group["j"].iloc[0]:
            out.append((ids[cols], n[rows] @ near))
        return pd.DataFrame({"id": np.concatenate([o[0] for o in out]), "links": np.concatenate([o[1] for o in out]).astype("int64")})

    return run


@tidied
def link_near_vectors(
    vectors: DataFrame,
    similar: float = 0.93,
    passes: int = PASSES,
    bits: int = BITS,
    window: int = WINDOW,
    seed: int = 0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    chance: float = CHANCE,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each vector.

    Vectors are compared only with those of the same label and length, by cosine in double precision. In
    each pass they are range-sorted by the signs of ``bits`` random projections, and each is compared
    with the next ``window``, across partitions too; equal vectors count as one there. Of the pairs found a forest is kept,
    a link a vector at most, which gives the components of all passes. Then the
    vectors of each component are compared with each other in blocks, which finds the links that windows are too
    narrow for; this is quadratic in the size of a component, but only counts leave a block. ``n_links``
    are a vector's links within its component, equal vectors included.

    More passes find more: two vectors at an angle t meet in a window of one pass with a chance of about
    (1 - t / pi) ** log2(n / window) for n vectors of a label. Each label has as many passes, ``passes`` at least,
    as give a lone pair at the threshold ``chance`` to meet in any of them: at 0.93 and 0.999, 17 for 10,000
    vectors, 27 for 100,000 and 43 for 1,000,000. What is left may miss a link; none is invented.

    A null label, a null or zero vector, and null or non-finite components link with nothing: n_links 0,
    a component of its own. Rows with one id are one vector, the least of them; a null id is returned
    unlinked, row by row, with a null component, and kept. No rows: no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(embedding).alias("vec"))
    nameless = rows.where("id is null").select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    rows = rows.where("id is not null").groupBy("id").agg(F.min(F.struct("label", "vec")).alias("v")).select("id", "v.label", "v.vec")
    rows = stage(rows, "vectors")
    finite = F.forall("vec", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)))
    usable = rows.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    usable = usable.withColumn("dim", F.size("vec"))
    # equal vectors count as one
    distinct = stage(usable.groupBy("label", "dim", "vec").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")), "distinct")

    kind = {f.name: f.dataType.simpleString() for f in distinct.schema}
    columns = f"label {kind['label']}, dim int, vec {kind['vec']}, id long, n long"
    many = distinct.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("vectors"))
    many = stage(many.select("label", "dim", passes_for(F.col("vectors"), similar, passes, window, chance).alias("passes")), "passes")
    keyed = distinct.join(many, ["label", "dim"]).select(*distinct.columns, "passes")
    keyed = keyed.mapInPandas(_keys(bits, seed), f"{columns}, passes int, keys array<binary>")
    keyed = keyed.select("label", "dim", "id", "vec", F.posexplode("keys").alias("pass", "key"))
    keyed = keyed.repartitionByRange("pass", "label", "dim", "key", "id").sortWithinPartitions("pass", "label", "dim", "key", "id")
    keyed = keyed.select("pass", "label", "dim", "id", "vec", F.spark_partition_id().alias("part"))
    made = stage(keyed.mapInPandas(_windows(window, similar), FOUND.format(**kind)), "windows")
    ends = made.where("at is not null")
    # a row for each partition
    sizes = {r["part"]: r["size"] for r in ends.groupBy("part").agg(F.max("size").alias("size")).collect()}
    borders = rows.sparkSession.createDataFrame(_borders(sizes, window), "border int, part int, offset long")
    at_border = ends.join(borders, "part").withColumn("place", F.col("at") + F.col("offset")).where(F.col("place").between(-window, window - 1))
    over = at_border.select("border", "place", "pass", "label", "dim", "id", "vec").groupBy("border").applyInPandas(_across(window, similar), "a long, b long")
    pairs = stage(made.where("a is not null").select("a", "b").unionByName(over).distinct(), "pairs")
    classes = stage(connected_components(pairs, "a", "b"), "classes")

    sizes = classes.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    member = classes.join(stage(sizes.select("component", blocks.alias("blocks")), "sizes"), "component").select(F.col("node").alias("id"), "component", "blocks")
    member = member.join(distinct, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    member = member.withColumn("other", partner).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    counted = member.groupBy("component", "i", "j").applyInPandas(_counted(similar), "id long, links long")
    links = counted.groupBy("id").agg(F.sum("links").alias("links"))

    found = distinct.join(classes.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left")
    found = stage(found.select(F.col("id").alias("first"), "n", F.coalesce("component", "id").alias("component"), F.coalesce("links", F.lit(0)).alias("links")), "found")
    same = usable.alias("u").join(distinct.alias("d"), ["label", "dim", "vec"]).select(F.col("u.id").alias("own"), F.col("d.id").alias("first"))
    of = same.join(found, "first").select("own", "component", (F.col("links") + F.col("n") - 1).alias("links"))
    out = rows.select("id").join(of, F.col("id") == F.col("own"), "left")
    component = F.coalesce("component", "id")
    out = out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("id")).alias("kept"))
    return out.unionByName(nameless)
