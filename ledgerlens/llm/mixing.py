"""Temperature mixing of sources to target weights, in native operations only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import stage

from .common import exclusive_sums, fresh, others, words

#: The exponent is searched in [0, TOP] on a grid of 2 ** -BITS of it.
TOP, BITS = 8.0, 24
#: Halvings answered by one pass over the sources.
AT_ONCE = 8
#: Rows that one bucket of a source's permutation holds, about.
BUCKET_ROWS = 4000


def source_totals(counted: DataFrame, key: str, tokens: str) -> DataFrame:
    return stage(counted.groupBy(key).agg(F.sum(tokens).alias("t"), F.count(F.lit(1)).alias("n")), "sources")


def _measures(shares: DataFrame, ks: list[int]) -> dict[int, tuple]:
    """For each exponent k / 2**BITS * TOP: entropy, and the largest and least weight by share."""
    rows = shares.select("p", F.explode(F.lit(ks)).alias("k")).withColumn("e", F.col("k") * (TOP / 2**BITS))
    rows = rows.select("k", "e", "p", F.pow("p", F.col("e")).alias("w"), F.pow("p", F.col("e") - 1).alias("r"))
    rows = rows.groupBy("k", "e").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.ln("p")).alias("s"), F.max("r").alias("hi"), F.min("r").alias("lo"))
    return {r["k"]: (math.log(r["z"]) - r["e"] * r["s"] / r["z"], r["hi"] / r["z"], r["lo"] / r["z"]) for r in rows.collect()}


def find_exponent(shares: DataFrame, too_flat, top: int = 2**BITS) -> int:
    """The least k of the grid below ``top`` whose measures are not ``too_flat``, by halving; else ``top``.

    ``shares`` has a column p. Eight halvings share a pass, which returns a bounded number of rows.
    """
    low, high = -1, top
    while high - low > 1:
        step = max(1, (high - low) >> AT_ONCE)
        ks = list(range(low + step, high, step)) or [high - 1]
        seen = _measures(shares, ks)
        while ks:
            k = ks[len(ks) // 2]
            if too_flat(*seen[k]):
                low, ks = k, ks[len(ks) // 2 + 1 :]
            else:
                high, ks = k, ks[: len(ks) // 2]
    return high


def mix_sources(
    docs: DataFrame,
    target_entropy: float | None = None,
    max_repeat: float | None = None,
    budget: int | None = None,
    keep_all: bool = False,
    block_tokens: int = 1_000_000,
    seed: int = 0,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Rows repeated or left out so that sources meet weights w ~ share ** exponent; a share is of tokens.

    Give one aim. ``target_entropy``: a share of the logarithm of the number of sources; the
    weights' entropy is brought down to it, or stays at what exponent 0 gives if that is less.
    ``max_repeat``: the flattest weights for which no source is passed more often than this.
    ``budget``: tokens to give out, by default as many as there are. ``keep_all``: instead, the
    least budget that uses every document once (``max_repeat`` is then against the least used source).

    A source's quota is spent on passes over one random order of its rows, the last cut where
    its quota ends (a row that would pass it is left out). A row's place in its source's quota gives its
    block, so every block of about ``block_tokens`` has the target weights; inside a block rows
    are shuffled. Adds ``n_tokens``, ``quota`` (of the source), ``exponent``, ``copy``, ``block`` and
    ``position`` (in the block); input columns so named are replaced. A null source is a source of its
    own. Null and empty texts have no tokens and cost nothing; a source of only such rows is
    passed once. Rows equal in id and text may swap places. No rows: no rows.
    """
    if (target_entropy is None) == (max_repeat is None):
        raise ValueError("give target_entropy or max_repeat")
    if max_repeat is not None and max_repeat < 1:
        raise ValueError("max_repeat is at least 1")
    if keep_all and budget is not None:
        raise ValueError("keep_all sets the budget")
    docs = docs.select(*others(docs, "n_tokens", "quota", "exponent", "copy", "block", "position"))
    key, order, bucket, before, passes, t, digits = fresh(docs, "_key", "_order", "_bucket", "_before", "_passes", "_t", "_digits")
    mark = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))))
    rows = docs.withColumns({
        key: F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")),
        "n_tokens": words(F.col(text)),
    })
    sources = source_totals(rows, key, "n_tokens")
    known = sources.where("t > 0").agg(F.sum("t").alias("t"), F.count(F.lit(1)).alias("n")).first()
    total, n_sources = known["t"] or 0, known["n"]
    k, z, spend = 2**BITS, 1.0, 0
    if total:
        shares = sources.where("t > 0").select((F.col("t") / total).alias("p"))
        spend = total if budget is None else budget
        if target_entropy is not None:
            least = target_entropy * math.log(n_sources)
            # the last exponent whose entropy still reaches the target
            k = max(0, find_exponent(shares, lambda h, hi, lo: h >= least - 1e-12) - 1)
        else:
            limit = max_repeat + 1e-12
            if spend > limit * total:
                raise ValueError("the budget is more than max_repeat times the tokens there are")
            natural = int(2**BITS / TOP)  # exponent 1
            k = find_exponent(shares, lambda h, hi, lo: (hi / lo if keep_all else hi * spend / total) > limit, natural)
        exponent = k * (TOP / 2**BITS)
        z = shares.agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0]
        if keep_all:
            spend = math.ceil(total / _measures(shares, [k])[k][2])
    exponent = k * (TOP / 2**BITS)
    quota = F.round(F.pow(F.col("t") / max(total, 1), F.lit(exponent)) / z * spend).cast("long")
    quota = F.greatest(quota, F.col("t")) if keep_all else quota
    n_blocks = max(1, math.ceil(spend / block_tokens))
    sources = sources.select(
        key,
        F.col("t").alias(t),
        F.when(F.col("t") > 0, quota).otherwise(0).cast("long").alias("quota"),
        F.greatest(F.lit(1), F.least(F.lit(8), F.ceil(F.log(16.0, F.col("n") / BUCKET_ROWS)))).cast("int").alias(digits),
    )
    rows = rows.withColumn(order, F.md5(mark)).join(sources, key)
    rows = rows.withColumn(bucket, F.expr(f"substr(`{order}`, 1, `{digits}`)"))
    rows = exclusive_sums(rows, [key], [bucket], [order], {before: "n_tokens"})
    full = F.when(F.col(t) > 0, F.expr(f"quota div `{t}`")).otherwise(0)
    rest = F.col("quota") - full * F.col(t)
    # one more pass for a row that still fits into what full passes leave; the last row of a source ends a pass
    extra = F.when((F.col(t) == 0) | ((rest > 0) & (F.col(before) + F.col("n_tokens") <= rest)), 1).otherwise(0)
    rows = rows.withColumn(passes, (full + extra).cast("int")).where(F.col(passes) > 0)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col(passes) - 1)))
    place = F.col("copy") * F.col(t) + F.col(before)
    spread = F.conv(F.substring(order, 1, 8), 16, 10).cast("long") % n_blocks
    by_place = F.least(F.call_function("div", place * n_blocks, F.greatest(F.col("quota"), F.lit(1))), F.lit(n_blocks - 1))
    rows = rows.withColumn("block", F.when(F.col("quota") > 0, by_place).otherwise(spread).cast("long"))
    shuffled = F.md5(F.concat_ws(":", F.col("copy").cast("string"), F.col("block").cast("string"), F.col(order)))
    rows = rows.withColumn("position", (F.row_number().over(Window.partitionBy("block").orderBy(shuffled)) - 1).cast("long"))
    return rows.withColumn("exponent", F.lit(exponent)).select(*docs.columns, "n_tokens", "quota", "exponent", "copy", "block", "position")
