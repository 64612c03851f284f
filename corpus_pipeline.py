"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes the rows that the stage before it left, written as Parquet and read
again, and hands on the columns of documents, the last one the pieces of sequences.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import mixing, ngram_join, packing, suffix_dedup, toxicity
from mercato.llm.shared import (
    WORD,
    checkpoint_dir,
    read,
    recorded_tables,
    remove_tables,
    ship,
    text_of,
)

# By application: the stage last called and its intermediate tables.
_STORED: dict[str, tuple[str, list[str]]] = {}


def stage(build):
    """A stage, at whose start the intermediate tables of the one before it in STAGES go.

    A stage's result is written before the next one is called, so they have served.
    Batches for Python are kept small in the session from then on, for stages are lazy and an
    executor holds a batch several times.
    """

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
        application = spark.sparkContext.applicationId
        order = ["", *(f.__name__ for _, f in STAGES)]
        last, tables = _STORED.get(application, ("", []))
        if last and order.index(last) + 1 == order.index(build.__name__):
            remove_tables(spark, tables)
        with recorded_tables() as paths:
            _STORED[application] = build.__name__, paths
            return build(spark, docs, sf_dir)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with a probability of at least a half of being toxic go."""
    return toxicity.without_toxic(docs, toxicity.trained(spark, docs, sf_dir))


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each component of similar documents the one with the least id stays.

    Of equal ids with equal shingles one row stays, the one with the least text. Documents
    without words link with nothing, and all stay; so do null ids where a component has no
    other. Columns of any name come along; an empty table stays empty.
    """
    of_class = ngram_join.joined(docs).select("doc_id", "cls", "n_shingles", "component_id")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "cls")
    linked = of_class.filter("n_shingles > 0")
    kept = (
        linked.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("cls")))
        .agg(F.min(first).alias("first"))
        .select(F.xxhash64("first.doc_id", "first.cls").alias("key"))
    )
    # The row travels as one value, so its columns may have any names. Texts are shuffled
    # once, by a hash of id and class, and are in its order for the choice of one. Which ones
    # are without words Spark tells itself: a filter by class would be a second Python function
    # in each task, with a worker of its own.
    wordless = ~text_of().rlike(WORD)
    keyed = docs.filter(~wordless).select(
        F.struct("*").alias("doc"), ngram_join.class_of(text_of()).alias("cls")
    )
    stay = (
        keyed.select("doc", F.xxhash64(F.col("doc.doc_id").cast("long"), "cls").alias("key"))
        .join(kept, "key", "left_semi")
        .groupBy("key")
        .agg(F.min_by("doc", F.col("doc.text")).alias("doc"))
    )
    rows = stay.select("doc").unionByName(docs.filter(wordless).select(F.struct("*").alias("doc")))
    return rows.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


@stage
def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: stretches of 400 bytes or 51 words that occur elsewhere leave the texts."""
    return suffix_dedup.without_repeats(docs, words=51)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: sources to their target weights; a row for each copy that the mix takes.

    Rows are ordered by the shard they are drawn for, and by hash within it.
    """
    return mixing.mixed(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: pieces of at most 4096 tokens, each with its ids and place in a sequence.

    ``ids`` are the tokens, little-endian unsigned 32-bit numbers. ``copy`` numbers the rows
    of the stage's input, so that the copies which the mix made of a document differ.
    """
    return packing.pack_documents(docs, with_ids=True).withColumnRenamed("row", "copy")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# A classifier's weights, hashed draws and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    try:
        for name, build in STAGES:
            out = build(spark, docs, sf_dir)
            out.write.parquet(f"{folder}/{name}")
            docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    finally:
        remove_tables(spark, _STORED.get(spark.sparkContext.applicationId, ("", []))[1])
    return docs
