"""From raw documents to packed sequences: five stages, each written and read again.

Quality classifier, line dedup, near-duplicate removal, source mixing, best-fit packing. Every stage
takes ``(spark, docs, sf_dir)`` and, but for the last, returns the columns of ``documents``, further
ones too, whatever they are called. An empty table passes every stage. Repeated rows are documents of
their own; those that share an id share what is decided about it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import line_dedup, minhash_forest, mixing, packing, quality
from shelfline.llm.common import materialized, table
from shelfline.llm.queries import BYTE_BPE, session, tokenizer
from shelfline.plans.lookup import fresh_name, lookup_join

#: Bytes of text that a task of any stage hands over, and one of the last stage encodes, at a time.
HANDED_BYTES = 1 << 20


def shared_session(spark: SparkSession) -> SparkSession:
    """The session of a stage. Less text is handed over at a time than by a query alone: an executor
    keeps what the stages before have touched, so all stages share its memory."""
    session(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(HANDED_BYTES))
    return spark


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model passes; it learns from the labels of the raw table. Null and
    empty texts are scored as empty, null ids like others; a score of exactly 0.5 passes."""
    shared_session(spark)
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; no document goes. Null texts stay null,
    documents without source stay as they are; ``n_chars`` follows where lines went."""
    shared_session(spark)
    counted = fresh_name("dropped", docs)
    cleaned = line_dedup.drop_site_lines(docs, site="source", counted=counted)
    return cleaned.withColumn("n_chars", F.when(F.col(counted) > 0, F.length("text")).otherwise(F.col("n_chars"))).select(docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates, the one with the smallest id. Texts without
    words are nobody's duplicates; rows without id have none to be compared by, and stay. Rows that
    share an id are one document and stay or go together."""
    shared_session(spark)
    gone = minhash_forest.near_duplicates(docs, percent=80).where(~F.col("kept")).select("doc_id").distinct()
    # Written first: while they are few, the texts need not move for them.
    return lookup_join(docs, materialized(gone, "gone"), "doc_id", "left_anti").select(docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Rows that share an id share its copies; a row
    without id stays once, and a null source is one of its own."""
    shared_session(spark)
    return mixing.take(docs).select(docs.columns)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place; a null or empty text is one of its end
    alone. Fewer pieces are remembered than by the query alone, and less text is encoded at a time: the
    other stages share the memory."""
    shared_session(spark)
    return packing.pack_documents(docs, tokenizer(BYTE_BPE), end_id=2, remembered=300_000, batch_bytes=HANDED_BYTES)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_boilerplate),
    ("near_dedup", one_of_each),
    ("mixing", mixed_sources),
    ("packing", packed_sequences),
]

#: A fitted model and hash-drawn copies: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
