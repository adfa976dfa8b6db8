"""A byte model by context-tree weighting, and a word model to compare it with."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import shuffle_partitions, stage, tidied

from . import subtrees
from .hashing import mix

#: Bytes of context; a gram of DEPTH + 1 bytes fits a long.
DEPTH = 5
#: The most frequent words that scoring tasks get, at most; the others are joined.
TOP_WORDS = 1 << 19
#: Stands before and after a text; no byte of UTF-8.
EDGE = 0xFF
#: Newest bytes of a context whose grams one task has together; deeper nodes are written nowhere.
ROOT = 3
#: Grams that a part of them has, about, and bytes of text that a counting task reads at least.
PART_GRAMS, TASK_BYTES = 250_000, 32 << 20
#: Scoring tasks get the ready logarithms of about 2 ** READY_BITS of the most frequent grams at most, of sixteen
#: bytes each; other grams are valued where their nodes are.
READY_BITS = 22
#: Bytes of text taken together (a task holds about a hundred bytes for each), documents that are scored together, and
#: words whose values a scoring task keeps.
CHUNK, TEXTS, KEPT_WORDS = 1 << 19, 1_000, 400_000
END = "\n"  # the end token: no word holds white space
WORD_KIND, GRAM_KIND = 0, 1
LOWER = bytes(range(256)).lower()


def _lowered(text: str | None) -> bytes:
    """UTF-8 with A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(LOWER)


def _words(data: bytes) -> list[bytes]:
    """Tokens: what stands between blanks (space, tab to carriage return), then the end."""
    found = data.split()  # bytes.split() parts at exactly these blanks
    found.append(END.encode())
    return found


def _named(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of depth + 1 bytes that ends at each byte and at each text's end, oldest byte first, and
    the texts' first places. Before a text stand edges."""
    edge = bytes([EDGE])
    data = np.frombuffer(b"".join(edge * depth + t + edge for t in texts), np.uint8)
    n = np.array([len(t) + 1 for t in texts])
    out = np.zeros(len(data) - depth, np.uint64)
    for i in range(depth + 1):
        out = (out << np.uint64(8)) | data[i : len(data) - depth + i]
    own = np.ones(len(out), bool)
    # the places of the edges before all texts but the first
    ends = np.cumsum(n + depth)[:-1] - depth
    own[(ends[:, None] + np.arange(depth)).ravel()] = False
    return out[own], np.cumsum(n) - n


def _chunks(texts: list[bytes]):
    """Ranges of texts of about CHUNK bytes."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= CHUNK:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(n, first) if len(k) else n


def _counter(depth: int):
    """mapInArrow over texts: how often each word and each gram occurs, by task."""

    def run(batches):
        from collections import Counter
        from itertools import chain

        import pyarrow as pa

        def rows(kind, keys, n):
            for i in range(0, len(keys), 1 << 16):
                part = keys[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int8)), pa.array(part), pa.array(n[i : i + (1 << 16)])], ["kind", "key", "n"])

        keys, counts, held = [], [], 0
        for batch in batches:
            texts = [_lowered(t) for t in batch.column(0).to_pylist()]
            found = Counter(chain.from_iterable(map(_words, texts)))
            yield from rows(WORD_KIND, np.fromiter(map(_named, found), np.int64, len(found)), np.fromiter(found.values(), np.int64, len(found)))
            for a, b in _chunks(texts):
                k, n = np.unique(grams(texts[a:b], depth)[0], return_counts=True)
                keys.append(k)
                counts.append(n.astype(np.int64))
                held += len(k)
                if held > 4_000_000:
                    k, n = _merged(keys, counts)
                    if len(k) > 2_000_000:  # what has been gathered goes on; sums are made again behind the shuffle
                        yield from rows(GRAM_KIND, k.astype(np.int64), n)
                        k, n = k[:0], n[:0]
                    keys, counts, held = [k], [n], len(k)
        if keys:
            k, n = _merged(keys, counts)
            yield from rows(GRAM_KIND, k.astype(np.int64), n)

    return run


def tree_nodes(level: DataFrame, root: int) -> list[DataFrame]:
    """(key, zeros, ones, stop) for each depth from 0 to ``root``: every node of the context trees there.

    A byte is eight bits; for each run of bits before one of them there is a tree over the contexts of 0
    to ``depth`` bytes. A node's key is its context's bytes and that run after a leading one. From the
    deepest nodes up, a node's weighted probability is half its own estimate and half the product of
    its children's; ``stop`` is the weight that its own estimate has in that sum. ``level`` has the nodes of the depth
    ``root``; what is above is the sum of the depth below.
    """
    out = [level.select("key", "zeros", "ones", "stop")]
    for d in range(root - 1, -1, -1):
        shorter = F.expr(f"key % {1 << (8 * (d + 1))}")  # without the oldest byte of the context
        level = level.groupBy(shorter.alias("key")).agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("weighted").alias("below"))
        level = stage(level.mapInPandas(_mixed, "key long, zeros long, ones long, stop double, weighted double"), f"depth{d}")
        out.insert(0, level.select("key", "zeros", "ones", "stop"))
    return out


def _mixed(batches):
    for x in batches:
        zeros, ones, below = (x[c].to_numpy(np.float64) for c in ("zeros", "ones", "below"))
        stop, weighted = subtrees.mixture(subtrees.estimate(zeros, ones), below)
        yield x.assign(stop=stop, weighted=weighted)[["key", "zeros", "ones", "stop", "weighted"]]


def chances(levels: list[DataFrame]) -> list[DataFrame]:
    """(key, p, added, left) for each depth from 0: ``p`` is the chance of a one where that node is the deepest known.

    From the root down, each node mixes its own estimate, by the weight ``stop``, with what deeper ones give; so
    a node needs of the shallower ones only what they add, and the weight that they leave. The deepest known node
    takes all the weight left.
    """
    out, above = [], None
    for d, level in enumerate(levels):
        one = (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        here = level.select("key", "stop", one.alias("one"))
        if above is None:
            here = here.withColumns({"added": F.lit(0.0), "left": F.lit(1.0)})
        else:
            here = here.withColumn("up", F.expr(f"key % {1 << (8 * d)}"))
            here = here.join(above.select(F.col("key").alias("up"), "added", "left"), "up")
        here = here.select(
            "key",
            (F.col("added") + F.col("left") * F.col("one")).alias("p"),
            (F.col("added") + F.col("left") * F.col("stop") * F.col("one")).alias("added"),
            (F.col("left") * (1 - F.col("stop"))).alias("left"),
        )
        above = stage(here, f"chances{d}")
        out.append(above)
    return out


#: Logarithm of the chance of ``bit``.
BIT_LOG = "log10(if(bit = 1, p, 1 - p))"


def gram_nodes(gram: DataFrame, depth: int, parts: int) -> DataFrame:
    """(key, zeros, ones, stop, weighted) of the nodes of depth ROOT, from the grams (key, n): what is
    deeper is summed up in the task that has all grams of a root, and written nowhere."""
    root = min(ROOT, depth)
    dealt = gram.withColumn("part", _part("key", root, parts))
    return dealt.groupBy("part").applyInPandas(subtrees.up(depth, root), "key long, zeros long, ones long, stop double, weighted double")


def _part(key: str, root: int, parts: int) -> Column:
    """Where the grams of a root, and its nodes, are dealt."""
    return F.pmod(F.xxhash64(F.expr(f"shiftrightunsigned({key}, 8) & {(1 << 8 * root) - 1}")), F.lit(parts)).cast("int")


def value_grams(gram: DataFrame, asked: DataFrame | None, known: list[DataFrame], depth: int, parts: int, least: int = 0) -> DataFrame:
    """(key, n, value): the exact logarithms of the distinct grams ``asked``, each bit from the deepest node that it has;
    or, if that is None, of the training grams that occur more than ``least`` times.

    A task has all training grams of a root and all asked for there. Only bits without a root go on: one join a
    depth with the nodes above.
    """
    root = min(ROOT, depth)
    rows = gram.select("key", "n")
    if asked is not None:
        rows = rows.unionByName(asked.select("key", F.lit(0).cast("long").alias("n")))
    rows = rows.withColumn("part", _part("key", root, parts))
    tops = known[root].withColumn("part", _part("key", root, parts))
    found = rows.groupBy("part").cogroup(tops.groupBy("part")).applyInPandas(subtrees.down(depth, root, least), "key long, n long, value double, open long")
    if asked is None:
        return found.select("key", "n", "value")
    found = stage(found, "found")
    out = found.select("key", "value")
    place = f"(shiftrightunsigned(key, 8) & {(1 << 8 * (root - 1)) - 1 if root else 0}) * 256 + shiftleft(1L, b) + shiftright(key & 255, 8 - b)"
    bits = F.expr(f"transform(filter(sequence(0, 7), b -> shiftright(open, b) % 2 = 1), b -> struct({place} as at, shiftright(key, 7 - b) & 1 as bit))")
    rest = found.where("open > 0").select("key", F.explode(bits).alias("x")).select("key", "x.at", "x.bit")
    for d in range(root - 1, -1, -1):
        met = stage(rest.join(known[d].select(F.col("key").alias("at"), "p"), "at", "left"), f"met{d}")
        out = out.unionByName(met.where("p is not null").select("key", F.expr(BIT_LOG).alias("value")))
        rest = met.where("p is null").select("key", F.expr(f"at % {1 << (8 * d)}" if d else "at").alias("at"), "bit")
    out = out.unionByName(rest.select("key", F.lit(math.log10(0.5)).alias("value")))
    return out.groupBy("key").agg(F.lit(0).cast("long").alias("n"), F.sum("value").alias("value"))


def _in_use(mark: np.ndarray, *tables: np.ndarray) -> tuple:
    """The places where ``mark`` is not zero, and what tables hold there; for tables at least half full
    no places, and the tables themselves."""
    if 2 * np.count_nonzero(mark) >= len(mark):
        return None, *tables
    at = np.flatnonzero(mark)
    return at.astype(np.uint32), *(t[at] for t in tables)


def _spread(bits: int, at: np.ndarray | None, tables) -> list[np.ndarray]:
    """The tables again."""
    if at is None:
        return list(tables)
    out = [np.zeros(1 << bits, t.dtype) for t in tables]
    for table, t in zip(out, tables):
        table[at] = t
    return out


def _columns(df: DataFrame, **kinds: str):
    """The columns of a bounded frame as arrays, batch by batch, without a Python object for each row."""

    def packed(batches):
        import pyarrow as pa

        for x in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x.column(c).to_numpy().astype(k).tobytes()]) for c, k in kinds.items()], list(kinds))

    for r in df.mapInArrow(packed, ", ".join(f"{c} binary" for c in kinds)).toLocalIterator():
        yield [np.frombuffer(r[c], k) for c, k in kinds.items()]


def _frequent(counts: DataFrame, distinct: int, most: int) -> tuple[int, DataFrame]:
    """The rows whose ``n`` is above the first result: all, or about ``most`` of the largest."""
    if distinct <= most:
        return 0, counts
    # counts above this one are those of ``most`` rows at most, but for the quantile's error
    least = counts.agg(F.percentile_approx("n", 1 - most / distinct, 100_000)).first()[0]
    found = counts.where(F.col("n") > least)
    while found.count() > 2 * most:
        least *= 2
        found = counts.where(F.col("n") > least)
    return least, found


def fit_grams(valued: DataFrame, bits: int = READY_BITS) -> tuple:
    """The exact logarithms (key, n, value) of about 2 ** bits training grams at most: as ``_in_use`` gives tables of
    2 ** bits places, and in order the grams whose place a more frequent one has."""
    # about 2 ** READY_BITS rows at most, whatever the corpus
    found = [*_columns(valued, key="<u8", n="<i8", value="<f8")] or [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))]
    key, n, value = (np.concatenate(c) for c in zip(*found))
    del found
    order = np.lexsort((key, n))  # the most frequent is written last
    key, value = key[order], value[order]
    at = (mix(key) >> np.uint64(64 - bits)).astype(np.int64)
    grams, values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits)
    grams[at], values[at] = key, value
    other = grams[at] != key
    key, value = key[other], value[other]
    order = np.argsort(key)
    return key[order], value[order], bits, *_in_use(grams, grams, values)


def _scorer(ready, top, depth: int, total: int, distinct: int):
    """mapInPandas over (doc_id, text, ...): model and base score; words that ``top`` lacks are left over as
    ``rest``, grams that ``ready`` lacks as ``rest_grams``, with how often they occur."""

    def run(batches):
        from collections import Counter

        import pandas as pd

        names, often = top.value
        unseen = math.log10(total + distinct + 1)
        known: dict[bytes, float | int] = {}  # a frequent word's logarithm, another's name
        more_grams, more_values, place, at, *held = ready.value
        shift = np.uint64(64 - place)
        ready_gram, ready_value = _spread(place, at, held)

        def log10(g):
            """Logarithms, and where they are missing."""
            at = (mix(g) >> shift).astype(np.int64)
            out = ready_value[at]
            other = np.flatnonzero(ready_gram[at] != g)
            if len(other) and len(more_grams):
                new, back = np.unique(g[other], return_inverse=True)
                at = np.minimum(np.searchsorted(more_grams, new), len(more_grams) - 1)
                hit = more_grams[at] == new
                out[other] = np.where(hit, more_values[at], 0)[back]
                other = other[~hit[back]]
            else:
                out[other] = 0
            return out, other

        def learn(words):
            if len(known) > KEPT_WORDS:
                known.clear()
                new = [*words]
            else:
                new = [w for w in words if w not in known]
            if not new:
                return
            h = np.fromiter(map(_named, new), np.int64, len(new))
            at = np.minimum(np.searchsorted(names, h), max(len(names) - 1, 0))
            hit = names[at] == h if len(names) else np.zeros(len(new), bool)
            value = np.log10(often[at] + 1.0) - unseen if len(names) else np.zeros(len(new))
            known.update((w, v if x else name) for w, v, x, name in zip(new, value.tolist(), hit.tolist(), h.tolist()))

        for batch in (b.iloc[i : i + TEXTS] for b in batches for i in range(0, len(b), TEXTS)):
            texts = [_lowered(t) for t in batch["text"]]
            rows = []
            for data in texts:
                found = Counter(_words(data))
                learn(found)
                base, n, seen, rest, times = 0.0, 0, 0, [], []
                for w, k in found.items():
                    v = known[w]
                    n += k
                    if type(v) is int:
                        rest.append(v)
                        times.append(k)
                    else:
                        base += k * v
                        seen += k
                rows.append((n, seen, base, rest, times))
            score, left, left_times = np.zeros(len(texts)), [], []
            for a, b in _chunks(texts):
                g, first = grams(texts[a:b], depth)
                value, other = log10(g)
                score[a:b] = np.add.reduceat(value, first)
                # each text's missing grams, and how often it has them
                text, g = np.searchsorted(first, other, "right") - 1, g[other]
                order = np.lexsort((g, text))
                text, g = text[order], g[order].astype(np.int64)
                new = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(g, prepend=-1) != 0))
                often_here = np.diff(new, append=len(g))
                cuts = np.searchsorted(text[new], np.arange(1, b - a))
                left += np.split(g[new], cuts)
                left_times += np.split(often_here, cuts)
            made = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base_score", "rest", "times"])
            made = made.assign(score=score, rest_grams=left, gram_times=left_times)
            yield pd.concat([batch.drop(columns="text").reset_index(drop=True), made], axis=1)

    return run


@tidied
def score_texts(docs: DataFrame, training: Column, depth: int = DEPTH, bits: int = READY_BITS, top_words: int = TOP_WORDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, training, n_tokens, n_known, train_tokens, base_score, score), a row for each document.

    The rows where ``training`` holds teach, all rows are scored. A text's letters A-Z are lower-cased, a null text
    is empty. ``score``: logarithm to base 10 of the probability that the byte model gives to the text and its end.
    ``base_score``: the same of words drawn one by one, with one added to every count; a text's tokens are its
    words and one end. ``n_known`` tokens occur in training texts.

    Grams and words are counted over all training texts, and every node of the trees counts. Nodes of more than ROOT
    bytes live only in the task that has all grams of their newest ROOT bytes. Only the most frequent
    grams (about 2 ** ``bits`` at most) and words go to the scoring tasks; other words are joined, and other grams, each
    once for the corpus, valued where their nodes are; either way a gram's logarithm is the same double. Words are told
    apart by 64-bit hashes.

    A row with a null id is scored like others, and repeated rows teach and are scored each time. Whole texts are read,
    however long. A null in ``training`` counts as false. Other columns are left out, whatever their names. Without training
    rows, every byte has a chance of 1/256 and no word is known. No rows: no rows.
    """
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    # small files are read together: a task counts a frequent gram once
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    counted = rows.where("training").select("text").coalesce(max(sc.defaultParallelism, math.ceil(size / TASK_BYTES)))
    counted = counted.mapInArrow(_counter(depth), "kind byte, key long, n long")
    counted = stage(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counted")
    gram = counted.where(f"kind = {GRAM_KIND}").select("key", "n")
    often = counted.where(f"kind = {WORD_KIND}").select("key", "n")
    sums = {r["kind"]: r for r in counted.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).collect()}
    total, distinct = (sums[WORD_KIND]["n"], sums[WORD_KIND]["distinct"]) if sums else (0, 0)
    distinct_grams = sums[GRAM_KIND]["distinct"] if sums else 0
    parts = max(shuffle_partitions(docs.sparkSession), math.ceil(distinct_grams / PART_GRAMS))
    levels = tree_nodes(stage(gram_nodes(gram, depth, parts), "roots"), min(ROOT, depth))
    known = chances(levels)
    least, frequent = _frequent(often, distinct, top_words)
    found = [*_columns(frequent, key="<i8", n="<i8")] or [(np.zeros(0, np.int64),) * 2]
    names, counts = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(names)
    top = (names[order], counts[order])
    made = "n_tokens long, n_known long, base_score double, rest array<long>, times array<long>, score double, rest_grams array<long>, gram_times array<long>"
    kind = dict(rows.dtypes)["doc_id"]
    row = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "training", "text")
    often_grams = _frequent(gram, distinct_grams, 1 << bits)[0]
    ready = sc.broadcast(fit_grams(value_grams(gram, None, known, depth, parts, often_grams), bits))
    scored = row.mapInPandas(_scorer(ready, sc.broadcast(top), depth, total, distinct), f"row long, doc_id {kind}, training boolean, {made}")
    scored = stage(scored, "scored")  # settles the rows' numbers
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("key"), F.col("x.times").alias("k"))
    rest = rest.join(often.where(F.col("n") <= least), "key", "left")
    value = F.log10(F.coalesce("n", F.lit(0)) + 1.0) - math.log10(total + distinct + 1)
    rest = rest.select("row", (F.col("k") * value).alias("more"), F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0).alias("seen"), F.lit(0.0).alias("deep"))
    other = scored.select("row", F.explode(F.arrays_zip("rest_grams", "gram_times")).alias("x")).select("row", F.col("x.rest_grams").alias("key"), F.col("x.gram_times").alias("k"))
    valued = stage(value_grams(gram, other.select("key").distinct(), known, depth, parts), "valued")
    other = other.join(valued.select("key", "value"), "key").select("row", F.lit(0.0).alias("more"), F.lit(0).alias("seen"), (F.col("k") * F.col("value")).alias("deep"))
    rest = rest.unionByName(other).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("more", "seen", "deep")))
    out = scored.join(rest, "row", "left")
    return out.select(
        "doc_id", "training", "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("deep", F.lit(0.0))).alias("score"),
    )
