"""Each stage of the pipeline on what its predecessor kept, by its own law."""

from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from ledgerlens.llm.quality import classify_quality
from test_pairs import brute_classes

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """The tables after 0, 1, ... stages."""
    folder = tmp_path_factory.mktemp("pipeline")
    tables = [spark.read.parquet(f"{SMALL}/documents.parquet")]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SMALL).write.parquet(f"{folder}/{n}")
        tables.append(spark.read.parquet(f"{folder}/{n}"))
    return tables


def test_names():
    assert len(corpus_pipeline.STAGES) == 4 and corpus_pipeline.ORACLE_SQL is None
    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert {n for n in entry.queries() if n.startswith("op")} == {
        "op1_mix_sources", "op2_pairwise_quality", "op3_dart_minhash", "op4_context_tree", "op5_warc_archive", "op6_byte_shards",
        "op7_weighted_fingerprints", "op8_url_aliases", "op9_projection_passes", "op10_best_fit_packing", "op11_fixed_block_anchors",
        "op12_permuterm_variants", "op13_angular_negatives",
    }


def test_columns_of_documents_stay(kept):
    assert all(t.columns == kept[0].columns for t in kept[:4])


def test_classifier(spark, kept):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    left = {r["doc_id"] for r in kept[1].collect()}
    known = {r["doc_id"] for r in kept[0].collect()} & set(labels)
    assert sum((d in left) == bool(labels[d]) for d in known) >= 0.95 * len(known)
    assert classify_quality is corpus_pipeline.classify_quality


def test_one_document_of_each_class(kept):
    rows = kept[1].orderBy("doc_id").collect()
    want = sorted({rows[c]["doc_id"] for c in brute_classes([r["text"] for r in rows])})
    assert sorted(r["doc_id"] for r in kept[2].collect()) == want


def test_mixture(kept):
    times = Counter(r["doc_id"] for r in kept[3].collect())
    assert set(times) == {r["doc_id"] for r in kept[2].collect()} and max(times.values()) <= 2
    texts = {r["doc_id"]: r["text"] for r in kept[2].collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in kept[3].collect())


def test_packing(kept):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = kept[4].collect()
    tokens, times = Counter(), Counter(r["doc_id"] for r in kept[3].collect())
    groups = defaultdict(list)
    for r in rows:
        tokens[r["doc_id"]] += r["length"]
        groups[r["sequence_id"]].append((r["offset"], r["length"]))
    for r in kept[2].collect():
        assert tokens[r["doc_id"]] == times[r["doc_id"]] * (len(coder.encode(r["text"], add_special_tokens=False).ids) + 1)
    for g in groups.values():
        at = 0
        for offset, length in sorted(g):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(groups) <= 1.02 * -(-sum(tokens.values()) // 4096) + 1


def test_run(spark, kept):
    assert sorted(map(str, entry.queries()["pipeline"](spark, SMALL).select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(str, kept[4].select("doc_id", "piece", "length", "ids_crc32").collect())
    )


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0


def test_copies_are_told_apart(kept):
    """A document that the mixture passes twice gives pieces of two rows."""
    rows = kept[4].select("doc_id", "row", "piece", "start", "length").collect()
    assert len({(r["doc_id"], r["row"], r["piece"]) for r in rows}) == len(rows)
    own = defaultdict(set)
    for r in rows:
        own[r["doc_id"]].add(r["row"])
    times = Counter(r["doc_id"] for r in kept[3].collect())
    assert {d: len(x) for d, x in own.items()} == dict(times)
