"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import shuffle_partitions

from .common import with_buckets
from .hashing import GOLDEN, MIX_1, Shingler, mix, uniform

SAMPLES, WORDS_IN_SHINGLE = 64, 5
#: Terms of one text that are sampled together; their hashes for all samples fit a core's cache.
TOGETHER = 1 << 9


class Sampler:
    """Consistent weighted samples of weighted sets of hashed terms.

    Each (term, sample) has draws r, c ~ Gamma(2, 1) and b ~ U(0, 1). A term of weight w offers
    t = floor(ln w / r + b), y = exp(r (t - b)) and a = c / (y exp(r)); the sample is the (term, t) of the
    least a, and equal for two sets with a probability of their generalised Jaccard similarity.
    All draws are hashes of the term and the sample. They are made of three exponential draws e, f and g: c = e + f,
    r = x + g with x = ln(c / e), and b = g / r, which have those laws and are independent. Then ln a = ln e - r t;
    a term of weight one has t = 0 and needs only e, which falls as its hash grows. Ties go to the smallest
    term of weight one, then to the smallest other.
    """

    def __init__(self, samples: int, seed: int):
        names = mix(np.arange(1, samples + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed))
        self.names, self.odd = names[:, None], mix(names + np.uint64(1))[:, None] | np.uint64(1)

    def _hashes(self, terms: np.ndarray) -> np.ndarray:
        """Of each (sample, term)."""
        h = terms ^ self.names
        h *= self.odd
        h ^= h >> np.uint64(32)
        h *= MIX_1
        return h

    def _heavy(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ln a and t of each (sample, term)."""
        h = self._hashes(terms)
        e, f, g = (-np.log(uniform(x)) for x in (h, mix(h + GOLDEN), mix(h - GOLDEN)))
        r = np.log1p(f / e) + g
        t = np.floor((np.log(weights) + g) / r)
        return np.log(e) - r * t, t

    def __call__(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 32-bit sample for each coordinate; the terms must be distinct and sorted, and not none."""
        one = weights == 1
        plain, terms, weights = terms[one], terms[~one], weights[~one]
        every = np.arange(len(self.names))
        least, out = np.full(len(every), np.inf), np.zeros(len(every), np.uint64)
        if len(plain):
            most = None
            for start in range(0, len(plain), TOGETHER):
                e = plain[start : start + TOGETHER]
                h = self._hashes(e)
                best = h.argmax(axis=1)
                value = h[every, best]
                if most is None:
                    most, out = value, e[best]
                else:
                    out = np.where(value > most, e[best], out)
                    most = np.maximum(value, most)
            least = np.log(-np.log(uniform(most)))
        for start in range(0, len(terms), TOGETHER):
            e = terms[start : start + TOGETHER]
            a, t = self._heavy(e, weights[start : start + TOGETHER])
            best = a.argmin(axis=1)
            value, of = a[every, best], t[every, best]
            name = np.where(of != 0, mix(e[best] + of.astype(np.int64).astype(np.uint64) * GOLDEN), e[best])
            out = np.where(value < least, name, out)
            least = np.minimum(value, least)
        return out.astype(np.uint32)


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    """Share of equal samples; two texts without terms are alike."""
    if a is None or b is None:
        return float(a is None and b is None)
    return float((a == b).mean())


def _printed(samples: np.ndarray | None) -> str:
    return "" if samples is None else samples.astype(">u4").tobytes().hex()


def edited(text: str, other: str) -> str:
    """The text with its last floor(n / 2) characters replaced by the first as many of the other."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


def _in_turn(size: int, samples: int, seed: int):
    """Rows in ascending order within their bucket, each bucket begun by the last row before it."""

    def run(batches):
        import hashlib

        import pandas as pd

        cut, sample = Shingler(size), Sampler(samples, seed)

        def of(text):
            terms, n = cut(text)
            return sample(terms, n) if len(terms) else None

        last, last_print = "", None
        for batch in batches:
            rows, kept = [], []
            for at, (guest, text) in enumerate(zip(batch["guest"], batch["text"])):
                own = of(text)
                if not guest:
                    new = edited(text, last)
                    own_new = of(new)
                    kept.append(at)
                    rows.append((
                        len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(),
                        _printed(own), _printed(own_new), likeness(own, own_new), likeness(own, last_print),
                    ))
                last, last_print = text, own
            made = pd.DataFrame(rows, columns=["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            passed = batch.drop(columns=["guest", "text"]).iloc[kept].reset_index(drop=True)
            yield pd.concat([passed, made], axis=1)

    return run


def fingerprints(docs: DataFrame, samples: int = SAMPLES, size: int = WORDS_IN_SHINGLE, seed: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), a row for each document.

    The terms of a text are its runs of ``size`` words, their weights how often they occur. The next
    document is that of the next smaller id, after the last one the first; null ids are the last; ties go
    by a hash of the text. The edited text ends in the first half of the next one's place, see ``edited``.
    ``near_*``: share of equal samples. A null text is empty; a text without words has an empty
    fingerprint, like only another such. Equal texts have equal fingerprints. A lone document is its own next.
    """
    spark = docs.sparkSession
    parts = max(2, shuffle_partitions(spark))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = with_buckets(rows, "doc_id", "tie", "part", "sub", parts)
    # of every bucket the last row, which the next bucket begins with: one row a bucket
    ends = rows.groupBy("part", "sub").agg(F.max(F.struct(F.col("doc_id"), F.col("tie"))).alias("end")).collect()
    ends.sort(key=lambda r: (r["part"], r["sub"]))
    after = [(r["end"]["doc_id"], r["end"]["tie"], r["part"], r["sub"], *(ends[(i + 1) % len(ends)][k] for k in ("part", "sub"))) for i, r in enumerate(ends)]
    kind = dict(rows.dtypes)["doc_id"]
    after = spark.createDataFrame(after, f"id {kind}, t long, p int, s int, part int, sub int")
    mine = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("t")) & (F.col("r.part") == F.col("p")) & (F.col("r.sub") == F.col("s"))
    # at most a row for each bucket, however large the table
    guests = rows.alias("r").join(F.broadcast(after.alias("a")), mine).groupBy("a.part", "a.sub", "doc_id", "tie").agg(F.first("text").alias("text"))
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    both = both.repartition(parts, "part", "sub").sortWithinPartitions("part", "sub", F.desc("guest"), "doc_id", "tie")
    made = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return both.select("doc_id", "guest", "text").mapInPandas(_in_turn(size, samples, seed), made)
