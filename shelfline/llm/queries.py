"""The registered queries of this subpackage, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline import configure
from shelfline.llm import (
    conversation_trie, cross_polytope, line_dedup, minhash_forest, mixing, packing, quality, sharding, token_counts, vector_dedup, warc, wavelet, whitening,
)
from shelfline.llm.common import shared_folder, table

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

SESSION = {
    # Arrow batches by bytes: texts differ in length by four orders of magnitude.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def session(spark: SparkSession) -> SparkSession:
    configure(spark)
    for key, value in SESSION.items():
        spark.conf.set(key, value)
    return spark


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file is."""
    return public_tokenizers.path(name)


def query(fn: Callable[[SparkSession, str], DataFrame]):
    """Register a function under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(session(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op7_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), limit=512)


def _remainder(key: str = "doc_id"):
    """Labels may be learned where it is not 1."""
    return F.crc32(F.col(key).cast("string")) % 3


@query
def op1_best_fit_packing(spark, sf_dir):
    # Capacities that only tokens can exhaust: the contract asks for as few sequences as possible.
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), end_id=2)
    packed = packing.pack(pieces, 1024, most_documents=1024, most_cost=1024.0**2, score="norm", weights=(1.0, 0.0, 0.0))
    return packed.withColumnRenamed("key", "doc_id")


@query
def op2_line_dedup(spark, sf_dir):
    docs = line_dedup.drop_site_lines(table(spark, sf_dir, "documents"), site="source", ratio=0.1, least_pages=3)
    return docs.select("doc_id", "source", "text", F.col("_dropped").alias("n_dropped"))


@query
def op6_source_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable=_remainder() != 1)
    scored = quality.scores(docs, model)
    return scored.select("doc_id", (_remainder() == 1).alias("held_out"), "score", "predicted")


@query
def op10_minhash_forest(spark, sf_dir):
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), percent=85, words=5)


@query
def op5_wavelet_shards(spark, sf_dir):
    return wavelet.token_shards(table(spark, sf_dir, "documents"), tokenizer(WORD_BPE), end_id=1)


@query
def op3_warc_from_arc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


@query
def op4_vector_near_duplicates(spark, sf_dir):
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.93)


@query
def op8_cross_polytope(spark, sf_dir):
    return cross_polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query
def op11_lanczos_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"), components=8)


@query
def op12_rendezvous_shards(spark, sf_dir):
    shards = sharding.write_shards(table(spark, sf_dir, "documents"), shared_folder(spark, "shards"), weights=[1.0] * 24, added=1.0)
    rows = sharding.manifest(shards)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", F.col("grown").alias("grown_shard"))


@query
def op13_conversation_trie(spark, sf_dir):
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))
