"""From raw documents to packed training sequences: classify, drop near copies, mix, pack."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import held_out
from ledgerlens.llm.darts import drop_near_duplicates
from ledgerlens.llm.mixing import mix_sources
from ledgerlens.llm.packing import pack_best_fit, token_pieces
from ledgerlens.llm.quality import classify_quality, fit_quality
from ledgerlens.session import staged_dir

#: Sources are flattened until the least used would be outdone by the most used more than this.
MAX_REPEAT = 2.0


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise classifier predicts good, learnt from the labelled ones among them.

    A null or empty text, or a very long one, is scored like any other, a row with a null id teaches nothing, and repeated rows
    go or stay together. All columns stay. No documents: none."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs, labels.where(~held_out(F.col("doc_id"), 4, 2)))
    return classify_quality(docs, model).where("predicted = 1").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the smallest id, a null id last.

    Null and empty texts are one class; of repeated rows one stays. All columns stay. No documents: none."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to MAX_REPEAT times.

    A null source is a source of its own; null and empty texts cost no tokens and come once; repeated rows are documents of
    their own. The columns are those of the documents. No documents: none."""
    return mix_sources(docs, max_repeat=MAX_REPEAT, keep_all=True).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 4096 tokens.

    A null or empty text is its end token, very long ones are cut, and rows with a null id or repeated ones are packed each on
    its own; ``row`` tells the copies of a document that the mixture passes more than once apart. Other columns are left
    out. No documents: no pieces."""
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return pack_best_fit(token_pieces(rows, keep=("row",)).drop("ids"))


STAGES = [
    ("quality classifier", keep_good),
    ("MinHash near-dedup", drop_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL can't express the learnt classifier; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        path = f"{staged_dir(spark)}/pipeline-{n}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
