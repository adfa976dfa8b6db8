"""Quality pairs and the context-tree model against plain loops and held-out rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm.common import held_out
from ledgerlens.llm.contexts import grams, score_texts
from ledgerlens.llm.queries import QUERIES
from ledgerlens.llm.quality import classify_quality, features, fit_pairs, fit_quality

SMALL = "/root/testdata/sf0.01"


def test_quality_held_out(spark):
    rows = QUERIES["op2_pairwise_quality"](spark, SMALL).collect()
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    assert len(rows) == docs.count()
    said = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    test = [r for r in rows if r["held_out"] and r["doc_id"] in said]
    assert len(test) > 50 and sum(r["predicted"] == said[r["doc_id"]] for r in test) >= 0.95 * len(test)


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    keep = ~held_out(F.col("doc_id"), 4, 2)
    flipped = labels.withColumn("quality", F.when(keep, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = (fit_quality(docs, x.where(keep)) for x in (labels, flipped))
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_pairs_and_quantile():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    good = (x @ [2, -1, 0, 0, 0] + 0.3 * rng.normal(size=400) > -1).astype(int)
    model = fit_pairs(x, good)
    s = model.strength(x)
    assert (s < model.cut).sum() == (good == 0).sum()
    assert ((s >= model.cut) == good).mean() > 0.93
    assert (fit_pairs(x, np.ones(400)).strength(x) >= fit_pairs(x, np.ones(400)).cut).all()
    assert not (fit_pairs(x, np.zeros(400)).strength(x) >= fit_pairs(x, np.zeros(400)).cut).any()


def plain_features(text):
    """The features by loops over characters, words and lines."""
    text = text or ""
    data, words = text.encode("utf-8", "replace"), text.split()
    n, m = max(len(data), 1), max(len(words), 1)
    lines = [x for x in text.split("\n") if x]
    pairs = list(zip(words, words[1:]))
    shares = [math.sqrt(sum(b == v for b in data) / n) for v in range(256)]
    return shares + [
        math.log1p(len(data)), math.log1p(len(words)), math.log1p(len(text) / m), len(set(words)) / m,
        sum(a == b for a, b in pairs) / m, len(set(lines)) / max(len(lines), 1), math.log1p(len(text) / max(len(lines), 1)),
        sum(w.isupper() for w in words) / m, sum(not w[-1].isalnum() for w in words) / m,
        max(Counter(words).values(), default=0) / m, len(set(pairs)) / max(len(pairs), 1), sum(len(w) > 20 for w in words) / m,
    ]


def test_scores_by_plain_loops(spark):
    """Every score is the logistic of the model's weights on features counted by loops."""
    rng = random.Random(2)
    vocabulary = ["the", "Cat,", "SAT", "mat.", "mat.", "x" * 25, "é\u00a0ñ", "\n", "12", "日本"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40))) for _ in range(30)] + [None, "", "\n\n", "a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(len(texts))], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    for r in classify_quality(docs, model).collect():
        x = plain_features(texts[r["doc_id"]])
        strength = sum((v - a) / b * w for v, a, b, w in zip(x, model.mean, model.scale, model.weights))
        want = 1 / (1 + math.exp(-(strength - model.cut + math.log(0.7 / 0.3))))
        assert r["score"] == pytest.approx(want, rel=1e-4, abs=1e-6)


def test_pair_loss_is_least():
    """No step along any feature makes the loss over all pairs smaller."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3))
    good = (x[:, 0] + rng.normal(size=60) > 0).astype(int)
    model = fit_pairs(x, good, pairs_per_row=200, ridge=1e-3)
    z = (x - model.mean) / model.scale
    win, lose = np.flatnonzero(good == 1), np.flatnonzero(good == 0)

    def loss(w):
        pairs = [math.log1p(math.exp(-float((z[i] - z[j]) @ w))) for i in win for j in lose]
        return sum(pairs) / len(pairs) + 0.5e-3 * float(w @ w)

    for k in range(3):
        for step in (-0.2, 0.2):
            assert loss(model.weights + step * np.eye(3)[k]) > loss(model.weights)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, "good words here", "x"), (2, None, "y"), (3, "", "z"), (None, "w " * 50_000, "q"), (1, "good words here", "x")], "doc_id long, text string, Score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    out = classify_quality(docs, fit_quality(docs, labels)).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert out[1]["score"] == out[2]["score"] and out[0]["score"] == out[4]["score"]
    none = fit_quality(docs.limit(0), labels)
    assert classify_quality(docs.limit(0), none).count() == 0 and classify_quality(docs, none).count() == 5
    assert np.isfinite(features(None)).all() and np.isfinite(features("\n\n \ud800")).all()


def test_repeated_id_teaches_once(spark):
    rows = [(i, f"word{i} " * (i + 1) if i % 2 else f"A{i}. {i}") for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    kind = "doc_id long, text string"
    lone = fit_quality(spark.createDataFrame(rows, kind), labels)
    many = fit_quality(spark.createDataFrame(rows + [(3, f"{rows[3][1]} {k}") for k in range(200)], kind), labels)
    assert np.array_equal(lone.weights, many.weights) and lone.cut == many.cut


WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tree_score(train, text, depth):
    """The model by recursion over dictionaries."""

    def ways(data):
        data = b"\xff" * depth + lowered(data).encode() + b"\xff"
        for i in range(depth, len(data)):
            for b in range(8):
                yield data[i - depth : i], (1 << b) | (data[i] >> (8 - b)), (data[i] >> (7 - b)) & 1

    n = {}
    for t in train:
        for ctx, run, bit in ways(t):
            for d in range(depth + 1):
                n.setdefault((ctx[depth - d :], run), [0, 0])[bit] += 1
    own = {k: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi) for k, (a, b) in n.items()}
    weighted, stop, below = {}, {}, {}
    for k in sorted(n, key=lambda k: -len(k[0])):
        if len(k[0]) == depth:
            weighted[k], stop[k] = own[k], 1.0
        else:
            x = below[k]
            stop[k] = 1 / (1 + math.exp(min(x - own[k], 700)))
            weighted[k] = max(x, own[k]) + math.log1p(math.exp(-abs(x - own[k]))) - math.log(2)
        if k[0]:
            up = (k[0][1:], k[1])
            below[up] = below.get(up, 0) + weighted[k]
    total = 0
    for ctx, run, bit in ways(text):
        p, known = 0.5, False
        for d in range(depth, -1, -1):
            k = (ctx[depth - d :], run)
            if k in n:
                s = stop[k] if known else 1.0
                p = s * (n[k][1] + 0.5) / (sum(n[k]) + 1) + (1 - s) * p
                known = True
        total += math.log10(p if bit else 1 - p)
    return total


def base_score(train, text):
    tokens = lambda t: [*WORDS.findall(lowered(t)), None]
    c = Counter(w for t in train for w in tokens(t))
    n, v = sum(c.values()), len(c)
    own = tokens(text)
    return len(own), sum(c[w] > 0 for w in own), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own)


@pytest.mark.parametrize("depth,top", [(0, 1000), (2, 1000), (5, 7)])
def test_context_tree(spark, depth, top):
    rng = random.Random(depth)
    rows = [(i, " ".join(rng.choice(["the", "The", "cat", "sät", "on\x0ba", "mat.", "xy\x1cz"]) for _ in range(rng.randrange(12)))) for i in range(60)]
    rows += [(None, "cat cat"), (61, None), (62, ""), (62, ""), (63, "unseen wörds   \x85 here " * 20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1))
    learn = ~held_out(F.col("doc_id"), 7, 2)
    got = score_texts(frame, learn, depth=depth, top_words=top).collect()
    assert len(got) == len(rows)
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    train = [t for i, t in rows if not out(i)]
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    for r in got:
        text = texts[r["doc_id"]].pop()
        assert r["training"] == (not out(r["doc_id"]))
        tokens, known, n, base = base_score(train, text)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        # chances and weights are held to sixteen bits
        assert r["score"] == pytest.approx(tree_score(train, text, depth), rel=1e-2, abs=1e-2)


@pytest.mark.parametrize("bits", [4, 22])
def test_context_tree_counts_every_node(spark, bits):
    """However few grams the tasks get ready, all others have their exact values."""
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice("abcdeé ") for _ in range(rng.randrange(60)))) for i in range(40)] + [(40, "zq abc" * 9), (41, None)]
    learn = F.col("doc_id") % 5 != 0
    got = {r["doc_id"]: r["score"] for r in score_texts(spark.createDataFrame(rows, "doc_id long, text string"), learn, bits=bits).collect()}
    train = [t for i, t in rows if i % 5]
    for i, t in rows:
        assert got[i] == pytest.approx(tree_score(train, t, 5), rel=1e-6)


def test_same_scores_whatever_goes_to_the_tasks(spark, monkeypatch):
    """A gram's logarithm is one double, ready in the tasks or not, and however the grams are dealt."""
    from ledgerlens.llm import contexts, subtrees

    rng = random.Random(12)
    rows = [(i, "".join(rng.choice("abcdeé 日") for _ in range(rng.randrange(90)))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    for bits, parts, together in ((22, 10**9, 400_000), (3, 50, 400_000), (8, 200, 1)):
        monkeypatch.setattr(contexts, "PART_GRAMS", parts)
        monkeypatch.setattr(subtrees, "TOGETHER", together)
        got.append({r["doc_id"]: r["score"] for r in score_texts(frame, F.col("doc_id") % 3 != 0, bits=bits).collect()})
    for other in got[1:]:
        assert other == pytest.approx(got[0], rel=1e-12)


def test_context_tree_columns(spark):
    rows = [(i, f"text {i % 3}") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, score_texts(frame, F.col("doc_id") > 2).collect()))
    for name in ("training", "row", "key", "n", "score", "kind", "part", "rest"):
        frame = frame.withColumn(name, F.lit("clash"))
    assert sorted(map(str, score_texts(frame, F.col("doc_id") > 2).collect())) == want


def test_context_tree_without_rows(spark):
    frame = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    row = score_texts(frame, F.lit(False)).first()
    assert row["score"] == pytest.approx(3 * 8 * math.log10(0.5)) and (row["n_known"], row["train_tokens"]) == (0, 0)
    assert score_texts(frame.limit(0), F.lit(True)).count() == 0


def test_grams():
    g, first = grams([b"ab", b"", b"c"], 2)
    assert [hex(x) for x in g] == ["0xffff61", "0xff6162", "0x6162ff", "0xffffff", "0xffff63", "0xff63ff"]
    assert first.tolist() == [0, 3, 4]


def test_training_rows_come_as_arrays(spark, monkeypatch):
    """The classifier's rows come to the driver as a few values, not as an object each; the model is that of plain loops."""
    texts = [f"{'good words ' * (i % 5 + 1)}{i}" if i % 2 else f"x{i} " * 9 for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in reversed(range(60))], "doc_id long, quality int")
    want = fit_pairs(np.array([features(t) for t in texts], np.float32), np.arange(60) % 2)
    monkeypatch.setattr(type(docs), "collect", lambda self: pytest.fail("a row object for each document"))
    got = fit_quality(docs, labels)
    assert np.allclose(got.weights, want.weights) and math.isclose(got.cut, want.cut)
    empty = fit_quality(docs.limit(0), labels)
    assert not empty.weights.any() and empty.cut == -1.0


def test_scoring_holds_a_part_of_the_texts(monkeypatch):
    """A task that scores one large batch keeps little of it in memory at a time, and scores as in small ones."""
    import tracemalloc
    from types import SimpleNamespace

    import pandas as pd

    from ledgerlens.llm import contexts

    rng = random.Random(2)
    batch = pd.DataFrame({"row": range(3000), "text": ["".join(rng.choices(["ab ", "cd ", "efg "], k=1200)) for _ in range(3000)]})
    known = np.unique(grams([t.encode() for t in batch["text"][:50]], 5)[0])
    ready = (known, np.full(len(known), -0.5), 4, None, np.zeros(16, np.uint64), np.zeros(16))
    top = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    score = contexts._scorer(SimpleNamespace(value=ready), SimpleNamespace(value=top), 5, 10, 3)
    tracemalloc.start()
    found = pd.concat(score([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert list(found["row"]) == list(range(3000))
    small = pd.concat(score([batch[:7], batch[7:20]]))
    assert list(small["score"]) == list(found["score"][:20]) and list(small["n_tokens"]) == list(found["n_tokens"][:20])
    assert peak < 100 << 20
