"""The corpus pipeline: language ID, near-duplicates, benchmark passages, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import bpe_trie, decontam, language_id, simhash
from corvane.llm._common import tokenizer_path
from corvane.runtime import drop_path, scratch, table

#: Share of a text's letters that its language must hold.
LEAST_SCORE = 0.4
#: Tables that a stage's plan reads; ``run`` deletes them once its result is written.
_made: list[str] = []


def _stored(spark: SparkSession, df: DataFrame, kind: str) -> DataFrame:
    path = scratch(spark, kind)
    _made.append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


def _numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows with a number ``_row`` of their own that every read gives again; ids may repeat or be null.

    Rows of files are numbered by their place in them. Other frames may change
    between reads and are written first.
    """
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        docs = _stored(spark, docs, "rows")
    return docs.withColumn("_row", F.monotonically_increasing_id())


def _without(spark: SparkSession, rows: DataFrame, out: DataFrame, columns: list[str]) -> DataFrame:
    """The rows but those whose numbers are in ``out``, which is written first so that a short list is sent to the rows."""
    return rows.join(_stored(spark, out.select("_row").distinct(), "out"), "_row", "left_anti").select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letter (null and empty texts too), or no language with enough of the letters.

    A document with a null key is dropped too. Rows that repeat are decided each.
    """
    model = language_id.train(docs.where(~language_id.held_out()))
    rows = docs.where("doc_id is not null").select(F.struct(*docs.columns).alias("_doc"), F.col("text").alias("_text"))
    kept = language_id.predict(rows, model, text="_text", key="_doc", spans=False).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE))
    return kept.select("_doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: that with the least id (of rows that repeat it, the least text digest).

    Null, empty and blank texts are copies of each other. Rows with a null key
    are documents of their own and give way to rows with one.
    """
    rows = _numbered(spark, docs)
    comp = simhash.near_copies(rows, key="_row")
    groups = comp.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    many = comp.join(groups, "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "_row")
    ranked = rows.select("_row", order.alias("o")).join(many, "_row")
    keep = ranked.groupBy("component_id").agg(F.min("o").alias("o")).select(F.col("o._row").alias("_row"))
    return _without(spark, rows, many.select("_row").join(keep, "_row", "left_anti"), docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that copy a benchmark item; null and empty texts copy none, rows that repeat are decided each."""
    rows = _numbered(spark, docs)
    return _without(spark, rows, decontam.contaminated(rows, table(spark, sf_dir, "benchmark"), key="_row"), docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, decoded again: (doc_id, n_tokens, ids_sha256, decoded_sha256).

    One row for each row, also if ids repeat; null and empty texts have no ids.
    """
    return bpe_trie.encode_decode(docs, vocabulary=tokenizer_path("word_bpe_49k.json"), digests=True)


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_passages),
    ("BPE encoding and decoding", encode_tokens),
]

#: SQL cannot express the learned model and the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages. Each stage's table is deleted once the next is written; that of the last stays."""
    docs, last = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path, before = scratch(spark, "stage"), len(_made)
        stage(spark, docs, sf_dir).write.parquet(path)
        for old in [last, *_made[before:]]:  # what others made stays theirs
            if old:
                drop_path(spark, old)
        del _made[before:]
        docs, last = spark.read.parquet(path), path
    return docs
