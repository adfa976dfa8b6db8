"""Spelling variants against all pairs of words."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.variants import spelling_variants, word_counts

SCHEMA = "word string, n long"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    """(word, n, n_near, form, form_n, root) of each word."""
    form, near = {}, {}
    for w, n in counts.items():
        near[w] = [o for o in counts if one_edit(w, o)]
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= ratio * n and counts[best] > n:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root))
    return sorted(out)


def found(spark, rows, ratio=10):
    df = spark.createDataFrame(rows, SCHEMA)
    got = spelling_variants(df, ratio).select("word", "n", "n_near", "form", "form_n", "root")
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("letters", ["ab", "abc$", "aé\U0001F600z"])
def test_random_words(spark, letters):
    """Few letters give runs of equal ones, many ties and words that meet at several places."""
    rng = random.Random(len(letters))
    counts = {"".join(rng.choice(letters) for _ in range(rng.randrange(0, 7))): rng.choice([1, 1, 2, 9, 10, 100, 1000]) for _ in range(120)}
    assert found(spark, list(counts.items())) == brute(counts)


def test_chains(spark):
    counts = {"a" * i: 10**i for i in range(1, 12)}
    got = found(spark, list(counts.items()))
    assert got == brute(counts)
    assert {r[5] for r in got} == {"a" * 11}


def test_one_hot_word(spark):
    """All variants of one word, of a large alphabet."""
    base = "frequent"
    counts = {base: 100_000} | {base[:i] + chr(c) + base[i + 1 :]: 2 for i in range(8) for c in range(97, 123) if base[i] != chr(c)}
    got = found(spark, list(counts.items()))
    assert got == brute(counts)
    assert dict((r[0], r[2]) for r in got)[base] == 200


def test_long_words(spark, monkeypatch):
    """Words around the length from which rotations are hashed."""
    rng = random.Random(4)
    base = "".join(rng.choice("ab") for _ in range(66))
    words = [base[:i] for i in range(60, 67)]
    for _ in range(150):
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abc") + w[i:], w[:i] + rng.choice("abc") + w[i + 1 :]]))
    counts = {w: rng.choice([2, 3, 30, 300]) for w in words}
    assert found(spark, list(counts.items())) == brute(counts)
    giant = "y" * 300_000
    got = found(spark, [(giant, 2), (giant + "y", 20), (giant[:-1] + "z", 3)])
    assert [(len(r[0]), r[2], len(r[3] or "")) for r in got] == [(300_000, 2, 300_001), (300_001, 1, 0), (300_000, 1, 0)]


def test_edges(spark):
    rows = [("word", 1), ("word", 2), (None, 50), ("worm", None), ("x" * 5000, 1), ("x" * 4999 + "y", 20), ("", 4), ("a", 40), ("b", 40), ("no", 0), ("on", 0), ("o", 0)]
    counts = Counter()
    for w, n in rows:
        if w is not None:
            counts[w] += n or 0
    assert found(spark, rows) == brute(counts)
    assert found(spark, []) == []
    df = spark.createDataFrame([("word", 1), ("wor", 30)], SCHEMA)
    for name in ("key", "place", "root", "form", "best", "near"):
        df = df.withColumn(name, F.lit("clash"))
    assert sorted(r["root"] for r in spelling_variants(df).collect()) == ["wor", "wor"]


def counted(rows, typo_every=31):
    import re

    counts = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if typo_every and h % typo_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def test_word_counts(spark):
    rows = [(i, "Straßenbahn ÀÉÎÕÜÝÞ ÀÉÎÕÜÝÞ letters123letters _Letters_ sevenle eightlet short " * 3) for i in range(60)]
    rows += [(None, "sevenle eightlet"), (None, None), (7, ""), (7, "sevenle " * 50_000), (8, "y" * 300_000), (9, "y" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for every in (31, None):
        got = word_counts(df.withColumn("name", F.lit(1)), typo_every=every)
        assert dict(tuple(r) for r in got.collect()) == counted(rows, every)
    assert word_counts(df.limit(0)).count() == 0


def test_query(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    counts = counted(rows)
    got = QUERIES["op12_permuterm_variants"](spark, sf_small).select("word", "n", "n_near", "form", "form_n", "root")
    assert sorted(tuple(r) for r in got.collect()) == brute(counts)
