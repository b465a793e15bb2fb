"""Documents to packed training sequences: five stages, each of one corpus operator.

``run`` writes every stage's rows as Parquet in the shared folder and reads them back as the next stage's docs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewave.llm import decontaminate, language_id, line_crf, ngram_join, packing
from tidewave.llm.common import documents, stored, without
from tidewave.session import ship_package, table

#: Columns of documents, which all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Least probability of the predicted language.
LEAST_SURE = 0.5

#: Bytes and rows of a batch that goes to Python and back: texts can be long, and both sides hold whole batches.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 1000

#: Allocator of the Python workers: large buffers go back to the system once freed, so that a worker that waits between stages
#: doesn't hold the most that any stage before took.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage in a session whose Arrow batches are no larger than BATCH_BYTES bytes (or one row) and BATCH_ROWS rows,
    with Python workers that have WORKER_MEMORY. Both stay set for the session.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        spark.conf.set(name, str(min(BATCH_ROWS, int(spark.conf.get(name)) if int(spark.conf.get(name)) > 0 else BATCH_ROWS)))
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        spark.sparkContext.environment.update(WORKER_MEMORY)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in which no language can be told go, and those of which no language is likelier than all others together.

    A document without ``lang`` gets the predicted one.
    """
    found = language_id.languages(docs, F.col("lang").isNotNull(), COLUMNS)
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SURE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


@in_small_batches
def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose probability of good quality is below 0.3."""
    found = line_crf.quality(docs, table(spark, sf_dir, "labels"), F.lit(True), COLUMNS)
    return found.where("score >= 0.3").select(*COLUMNS)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each class of near copies stays, in one row where several bear its id; so do rows without an id.

    Rows of one id are one document to the join; of these the one with the least text stays.
    """
    held = docs.select(*COLUMNS)
    kept = without(held, ngram_join.shingle_classes(docs).where("doc_id != component_id"))
    again = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")  # reads ids only
    if again.isEmpty():
        return kept
    one = kept.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*COLUMNS[1:])).alias("row")).select("doc_id", "row.*")
    return without(kept, again).unionByName(one.select(*COLUMNS))


@in_small_batches
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item go."""
    found = stored(decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id"), "leaks")
    return without(docs.select(*COLUMNS), found)


@in_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences."""
    return packing.packed(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_languages),
    ("quality_classifier", keep_good_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: Trained models and packing can't be told in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
