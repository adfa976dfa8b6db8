"""Near duplicates, fingerprints and vector links against all pairs; packing by its laws."""

import hashlib
import math
import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm.darts import drop_near_duplicates, near_duplicates, throw
from ledgerlens.llm.fingerprints import SAMPLES, Sampler, edited, fingerprints
from ledgerlens.llm.hashing import Shingler
from ledgerlens.llm.neighbours import _borders, _forest, link_near_vectors, passes_for
from ledgerlens.llm.packing import best_fit, pack_best_fit, token_pieces, word_ids

SMALL = "/root/testdata/sf0.01"


def components(n, pairs):
    of = list(range(n))

    def find(x):
        while of[x] != x:
            of[x] = of[of[x]]
            x = of[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def brute_classes(texts):
    sets = [set(Shingler(5)(t)[0].tolist()) for t in texts]
    pairs = [(j, i) for i in range(len(texts)) for j in range(i) if texts[i] == texts[j] or jaccard(sets[i], sets[j]) >= 0.8]
    return components(len(texts), pairs)


def family(rng, words, n, edits):
    base = [rng.choice(words) for _ in range(120)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        own = list(base)
        for _ in range(edits):
            own[rng.randrange(len(own))] = rng.choice(words)
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    texts = family(rng, words, 150, 1) + family(rng, words, 60, 2) + family(rng, words, 40, 4)
    passage = " ".join(rng.choice(words) for _ in range(100))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(60)) for _ in range(60)]
    texts += ["same text of some length here"] * 80 + ["two words"] * 3 + ["", "", "two  WORDS!", "one", "!!!", "!!!"]
    rng.shuffle(texts)
    return texts


def test_near_duplicates(spark, copies):
    frame = spark.createDataFrame([(i, t, 1) for i, t in enumerate(copies)], "doc_id long, text string, kept int")
    got = {r["doc_id"]: r for r in near_duplicates(frame).collect()}
    want = brute_classes(copies)
    assert [got[i]["class_id"] for i in range(len(copies))] == want
    assert all(got[i]["kept"] == (want[i] == i) for i in got)
    left = drop_near_duplicates(frame)
    assert left.columns == frame.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(want))


def test_near_duplicates_of_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()}
    want = brute_classes([d["text"] for d in docs])
    assert [got[d["doc_id"]] for d in docs] == [docs[w]["doc_id"] for w in want]


def test_near_duplicates_edges(spark):
    long = " ".join(str(i) for i in range(60_000))
    rows = [(4, None), (None, ""), (7, ""), (4, long), (4, long), (2, long + " x"), (None, "a b c d e f"), (9, "A b, c d e F"), (9, "zz"), (9, "zz")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["address"]): r for r in near_duplicates(frame).collect()}
    at = lambda i, t: got[(i, hashlib.sha256((t or "").encode()).hexdigest())]
    assert len(got) == 8
    assert {at(4, None)["class_id"], at(None, "")["class_id"], at(7, "")["class_id"]} == {4}
    assert at(4, long)["class_id"] == at(2, long + " x")["class_id"] == 2 and at(4, long)["copies"] == 2
    assert at(None, "a b c d e f")["class_id"] == 9 and at(9, "A b, c d e F")["kept"]
    left = drop_near_duplicates(frame.withColumn("_copies", F.lit(1)))
    assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == sorted([(4, ""), (2, long + " x"), (9, "A b, c d e F"), (9, "zz")])
    assert near_duplicates(frame.limit(0)).count() == 0 and drop_near_duplicates(frame.limit(0)).count() == 0


def test_darts_estimate_jaccard():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 900).astype(np.uint64)
    sets = [base[:600], base[100:700], base[300:900], base[:1], base[:1], base[:0], base[:600], base[:600]]
    heavy = [rng.integers(1, 9, 600) * 1.5, rng.integers(1, 9, 600) * 1.0]
    weights = [np.ones(len(s)) for s in sets[:6]] + heavy
    s = throw(sets, weights, 1024)
    assert (s[:5] != 0).all() and (s[5] == 0).all() and (s[3] == s[4]).all()
    for i, j, want in [(0, 1, 500 / 700), (0, 2, 300 / 900), (6, 7, np.minimum(*heavy).sum() / np.maximum(*heavy).sum()), (0, 7, 600 / heavy[1].sum())]:
        assert abs((s[i] == s[j]).mean() - want) < 0.06


def test_samples_estimate_jaccard():
    rng = np.random.default_rng(3)
    terms = np.sort(rng.integers(0, 2**63, 900).astype(np.uint64))
    sample = Sampler(2048, 0)
    a, b = rng.integers(1, 6, 900), rng.integers(1, 6, 900)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sample(terms, a) == sample(terms, b)).mean() - want) < 0.05
    ones = np.ones(600, np.int64)
    assert abs((sample(terms[:600], ones) == sample(terms[300:], ones)).mean() - 1 / 3) < 0.05
    assert len(set(sample(terms, a))) > 300


def test_samples_estimate_jaccard_of_many_weighted_terms():
    """Terms of weight two win twice as often as those of one, however many there are."""
    rng = np.random.default_rng(12)
    terms = np.sort(rng.integers(0, 2**63, 40_000).astype(np.uint64))
    # three sets of 10,000 of weight two and 20,000, 5,000 and 5,000 of weight one
    kind = rng.permutation(np.repeat([0, 1, 2, 3], [10_000, 20_000, 5_000, 5_000]))
    weight = np.where(kind == 0, 2, 1)
    sample = Sampler(1024, 0)
    of = lambda *kinds: sample(terms[np.isin(kind, kinds)], weight[np.isin(kind, kinds)])
    # they share all of weight one: 20,000 of 40,000; all of weight two: 20,000 of 30,000
    assert abs((of(0, 1) == of(1)).mean() - 20_000 / 40_000) < 0.05
    assert abs((of(0, 2) == of(0, 3)).mean() - 20_000 / 30_000) < 0.05
    assert abs((of(0, 1) == of(0)).mean() - 20_000 / 40_000) < 0.05


def test_fingerprints(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    texts = {i: " ".join(rng.choice(words) for _ in range(rng.randrange(120))) for i in range(1, 160)}
    texts[200], texts[201], texts[40], texts[41] = None, "é" * 7, texts[39], "long " * 40_000
    frame = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: r for r in fingerprints(frame).collect()}
    order = sorted(texts, reverse=True)
    sample, cut = Sampler(SAMPLES, 0), Shingler(5)

    def own(t):
        e, n = cut(t)
        return sample(e, n) if len(e) else None

    def like(a, b):
        a, b = own(a), own(b)
        return float((a == b).mean()) if a is not None and b is not None else float(a is b)

    for i, after in zip(order, order[1:] + order[:1]):
        r, t, u = got[i], texts[i] or "", texts[after] or ""
        new = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        assert new == edited(t, u)
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(new.encode()).hexdigest())
        assert (r["near_edited"], r["near_next"]) == (like(t, new), like(t, u))
    assert got[40]["fingerprint"] == got[39]["fingerprint"] and got[40]["near_next"] == 1.0
    assert len(got) == len(texts)


def test_fingerprints_edges(spark):
    lone = fingerprints(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).first()
    assert lone["near_next"] == 1.0 and lone["edited_sha256"] == hashlib.sha256(b"a b a b"[:0] + edited("a b c d", "a b c d").encode()).hexdigest()
    rows = [(None, "x y"), (None, ""), (3, "q"), (3, "q"), (3, None)]
    got = fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 1, 1, 3]
    assert fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def vector_links(rows):
    unit = {}
    for i, v, label in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, float)
        if x is not None and label is not None and np.isfinite(x).all() and np.abs(x).max(initial=0) > 0:
            x = x / np.abs(x).max()
            unit[i] = (label, x / np.linalg.norm(x))
    ids = [r[0] for r in rows]
    near = [(a, b) for a in unit for b in unit if a < b and unit[a][0] == unit[b][0] and len(unit[a][1]) == len(unit[b][1]) and unit[a][1] @ unit[b][1] >= 0.93]
    place = {i: n for n, i in enumerate(sorted(ids))}
    comp = components(len(ids), [(place[a], place[b]) for a, b in near])
    n = defaultdict(int)
    for a, b in near:
        n[a] += 1
        n[b] += 1
    back = sorted(ids)
    return {i: (n[i], back[comp[place[i]]]) for i in ids}


def test_vectors(spark):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(40):
        centre = rng.normal(size=16)
        rows += [(len(rows) + k, (centre + 0.08 * rng.normal(size=16)).tolist(), c % 3) for k in range(1 + c % 9)]
    rows = [(i, v, label) for i, (_, v, label) in enumerate(rows)]
    n = len(rows)
    same, heap = rng.normal(size=16).tolist(), rng.normal(size=16)
    rows += [(n + k, same, 1) for k in range(30)]
    n = len(rows)
    rows += [(n + k, (heap + 0.1 * rng.normal(size=16)).tolist(), 2) for k in range(150)]
    n = len(rows)
    odd = [None, [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [float("inf")] * 16, [1e-300] * 16, [1.0] * 16, [1.0] * 8, [2.0] * 8, []]
    rows += [(n + k, v, 1) for k, v in enumerate(odd)] + [(n + 20, same, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("dim", F.lit("x"))
    got = {r["vec_id"]: r for r in link_near_vectors(frame).collect()}
    want = vector_links(rows)
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_vector_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in table.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in link_near_vectors(table).collect()}
    want = vector_links(rows)
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    assert all(got[i][0] <= want[i][0] for i in want)


def test_vector_passes_grow(spark):
    """Lone pairs just above the threshold are found in a label of many vectors."""
    rng = np.random.default_rng(6)
    n, planted = 30_000, 300
    x = rng.normal(size=(n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(planted, 64))
    side -= (side * x[:planted]).sum(1, keepdims=True) * x[:planted]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([x, 0.931 * x[:planted] + math.sqrt(1 - 0.931**2) * side])
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in link_near_vectors(frame).collect()}
    found = sum(got[n + i]["n_links"] > 0 and got[n + i]["component_id"] == got[i]["component_id"] for i in range(planted))
    assert found >= 0.99 * planted, found
    wanted = frame.limit(1).select(*(passes_for(F.lit(k), 0.93).alias(f"n{k}") for k in (1, 32, 10_000, 100_000, 1_000_000))).first()
    assert list(wanted) == [8, 8, 17, 27, 43]


def test_windows_cross_partitions(spark):
    """With a window of one and about as many partitions as rows, neighbours in order are always in two partitions."""
    rows = [(i, [math.cos(i / 10), math.sin(i / 10)], 1) for i in range(15)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = {}
    try:
        for n in (1, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found[n] = sorted(tuple(r) for r in link_near_vectors(frame, similar=0.99, window=2).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert found[1] == found[40] and {r[2] for r in found[1]} == {0}


def test_borders():
    sizes = {0: 5, 3: 1, 4: 2, 9: 7}
    order = [(p, at) for p in sorted(sizes) for at in range(sizes[p])]
    for border, start in ((3, 5), (4, 6), (9, 8)):
        got = {}
        for b, part, offset in _borders(sizes, 3):
            if b == border:
                got |= {at + offset: (part, at) for at in range(sizes[part]) if -3 <= at + offset < 3}
        want = {i - start: order[i] for i in range(max(0, start - 3), start)}
        want |= {i - start: order[i] for i in range(start, len(order)) if order[i][0] == border and i - start < 3}
        assert got == want


def test_forest():
    rng = random.Random(8)
    for _ in range(30):
        n = rng.randrange(1, 60)
        pairs = [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.randrange(80))]
        a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
        want = components(n, pairs)
        places, roots = _forest(a, b, n)
        assert dict(zip(places.tolist(), roots.tolist())) == {i: w for i, w in enumerate(want) if w != i}


def test_vector_edges(spark):
    kind = "vec_id long, embedding array<float>, label int"
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in link_near_vectors(spark.createDataFrame(rows, kind)).collect()))
    assert got == [(0, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)]
    assert link_near_vectors(spark.createDataFrame([], kind)).count() == 0


ODD = [
    "", "  ", "a\tb", "It's I'LL we've x'd 'S", "ÀÉÎß ñandú ²³ ½x", "ẖ H̱ K K İstanbul ΑΣ ΑΣ. σς", "日本語 テスト mixed漢字abc", "<|endoftext|> a<|startoftext|>b <|x|>",
    "a b c　d\x85e\x1cf", "emoji 😀👩‍👩‍👧 é ́x", "­ soft \x00 nul \x7f", "10.5% 3rd µm ªº ÷×", "a\r\nb\x0bc\x0cd", "don''t '' 's's", "Ǆ ǅ ﬁ Ⅷ ①", "ABC,,def!!1a2",
]


def test_word_ids_match_tokenizer(spark):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = word_ids("word_bpe_49k.json")
    texts = ODD + [r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").limit(200).collect()]
    for t in texts:
        assert b"".join(map(ids.__getitem__, t.replace("\n", " ").split(" "))) == array("I", coder.encode(t, add_special_tokens=False).ids).tobytes(), t


def test_pieces(spark):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(i, t) for i, t in enumerate(ODD)] + [(90, None), (None, "x"), (91, "many words " * 5000), (91, "again")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(0))
    got = defaultdict(list)
    for r in token_pieces(frame, keep_ids=True, capacity=64).collect():
        assert r["ids_crc32"] == zlib.crc32(r["ids"]) and len(r["ids"]) == 4 * r["length"] <= 256
        got[r["doc_id"]].append(r)
    for i, t in rows[:-2]:
        want = array("I", [*coder.encode(t or "", add_special_tokens=False).ids, 1]).tobytes()
        mine = sorted(got[i], key=lambda r: r["piece"])
        assert b"".join(r["ids"] for r in mine) == want
        assert [r["piece"] for r in mine] == list(range(len(mine))) and [r["start"] for r in mine] == [64 * r["piece"] for r in mine]
        assert all(r["length"] == 64 for r in mine[:-1])


def packed(frame, capacity):
    rows = pack_best_fit(frame, capacity).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["sequence_id"]].append((r["offset"], r["length"]))
    for g in groups.values():
        at = 0
        for offset, length in sorted(g):
            assert offset == at
            at += length
        assert at <= capacity
    return rows, groups


@pytest.mark.parametrize("name", ["mixed", "halves", "tiny", "full"])
def test_packing(spark, name):
    rng = random.Random(1)
    lengths = {
        "mixed": [min(100, int(rng.expovariate(1 / 30)) + 1) for _ in range(3000)],
        "halves": [50, 51, 49] * 100 + [1] * 20,
        "tiny": [1] * 5000 + [2] * 100,
        "full": [100] * 40,
    }[name]
    frame = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], "id long, length long, size string")
    rows, groups = packed(frame, 100)
    assert sorted(r["id"] for r in rows) == list(range(len(lengths)))
    least = max(math.ceil(sum(lengths) / 100), sum(n > 50 for n in lengths))
    assert len(groups) <= 1.02 * least + 1


def test_packing_edges(spark):
    assert pack_best_fit(spark.createDataFrame([], "id long, length long")).count() == 0
    same = spark.createDataFrame([(1, 7)] * 30, "id long, length long")
    clash = same.withColumns({"_size": F.lit("s"), "offset": F.lit("o"), "_piece": F.lit(0), "sequence_id": F.lit("q")})
    rows, groups = packed(clash, 10)
    assert len(rows) == 30 and len(groups) == 30 and rows[0]["_size"] == "s"
    for n in (0, 11, None):
        with pytest.raises(Exception, match="1 to capacity"):
            pack_best_fit(spark.createDataFrame([(1, n)], "id long, length long"), 10).collect()


def test_packing_by_runs(spark):
    """A sequence has pieces of one run; a null run is the first."""
    rng = random.Random(11)
    rows = [(i, i % 4 if i % 9 else None, rng.choice([1, 5, 300, 2000, 2100, 4096])) for i in range(400)]
    pieces = spark.createDataFrame(rows, "id long, run long, length long")
    got = pack_best_fit(pieces, run="run").collect()
    assert sorted((r["id"], r["run"], r["length"]) for r in got) == sorted(rows)
    of, ends = defaultdict(set), defaultdict(list)
    for r in got:
        of[r["sequence_id"]].add(r["run"] or 0)
        ends[r["sequence_id"]].append((r["offset"], r["offset"] + r["length"]))
    assert all(len(x) == 1 for x in of.values())
    for spans in ends.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 4096


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_by_counts(seed):
    """The steps made from the counts of sizes are those of a search for each piece on its own."""
    rng = random.Random(seed)
    capacity = rng.choice([10, 97, 400])
    sizes = [max(1, min(capacity, int(rng.expovariate(3 / capacity)))) for _ in range(rng.choice([1, 50, 2000]))]
    left = []
    for s in sorted(sizes, reverse=True):
        fitting = [(gap, i) for i, gap in enumerate(left) if gap >= s]
        if fitting:
            left[min(fitting)[1]] -= s
        else:
            left.append(capacity - s)
    counts = Counter(sizes)
    filled, placed = defaultdict(int), Counter()
    steps = best_fit([*counts.items()], capacity)
    ends = [b[1] if b[0] == a[0] else counts[a[0]] for a, b in zip(steps, [*steps[1:], (0, 0)])]
    for (size, before, each, first, offset), end in zip(steps, ends):
        assert before == placed[size] and (end - before) % each == 0
        for sequence in range(first, first + (end - before) // each):
            assert filled[sequence] == offset
            filled[sequence] += each * size
        placed[size] = end
    assert placed == counts and sorted(filled.values()) == sorted(capacity - gap for gap in left)


def test_packing_takes_few_jobs(spark):
    """Plans of many rounds filled the driver's memory: their number depends on the pieces no more."""
    rng = random.Random(5)
    lengths = [min(4096, int(rng.expovariate(1 / 400)) + 1) for _ in range(20_000)]
    pieces = spark.createDataFrame([*enumerate(lengths)], "id long, length long").repartition(5)
    context = spark.sparkContext
    context.setJobGroup("packing", "packing")
    try:
        rows, groups = packed(pieces, 4096)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r["id"] for r in rows) == list(range(len(lengths))) and len(groups) <= 1.002 * sum(lengths) / 4096 + 1
    assert len(context.statusTracker().getJobIdsForGroup("packing")) <= 20


def test_packing_one_size_for_most(spark):
    """Places among the pieces of one size are gapless over all of their shares."""
    pieces = spark.range(0, 30_000, numPartitions=7).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 90 + 1).otherwise(7).alias("length"))
    rows, groups = packed(pieces, 100)
    assert len(rows) == 30_000 and len(groups) <= 1.02 * sum(r["length"] for r in rows) / 100 + 1
