"""Documents to packed training sequences, one operator of wattloom.llm per stage.

Every stage works on all documents that the stage before kept. A document without text
passes the filters (it has no toxic word, no benchmark word and nothing to redact); of
several such documents one stays, like of any group of equal texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.llm import common, decontaminate, pack, pii, queries, simhash, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
REJECTED_FROM = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``REJECTED_FROM`` for toxicity."""
    common.prepare(spark)
    docs = docs.select(*COLUMNS)
    model = toxicity.train(docs, common.table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model, COLUMNS).where(F.col("_score") < REJECTED_FROM).select(*COLUMNS)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    common.prepare(spark)
    return simhash.keep_one(docs.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    common.prepare(spark)
    return decontaminate.clean(docs.select(*COLUMNS), common.table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with marks in place of personal data; n_chars follows the text."""
    common.prepare(spark)
    redacted = pii.redacted(docs.select(*COLUMNS))
    return redacted.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their ids."""
    common.prepare(spark)
    pieces = pack.pieces(docs.select(*COLUMNS), queries.vocabulary())
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

#: Learning, hashing and tokenizing are not expressible in SQL; tests compare each stage
#: with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.staged(stage(spark, docs, sf_dir), name)
    return docs
