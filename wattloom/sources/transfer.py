"""File areas and transfer records: what was moved, and did every copy arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom import schemas


def list_area(spark: SparkSession, path: str) -> DataFrame:
    """Key and size of every file under ``path``; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("key"), F.col("length").alias("size_bytes"))
    )


def next_file(incoming: DataFrame) -> DataFrame:
    """The waiting file that is due next: first by key."""
    return incoming.orderBy("key").limit(1)


def by_file_name(listing: DataFrame, area: str) -> DataFrame:
    """First key and its size per base name, anywhere under the area."""
    name = F.substring_index(F.col("key"), "/", -1)
    return (
        listing.groupBy(name.alias("file_name"))
        .agg(F.min(F.struct("key", "size_bytes")).alias("_first"))
        .select(
            "file_name",
            F.col("_first.key").alias(f"{area}_key"),
            F.col("_first.size_bytes").alias(f"{area}_size_bytes"),
        )
    )


def reconcile(incoming: DataFrame, landing: DataFrame, archive: DataFrame) -> DataFrame:
    """Where each file is, whether its copies have its size, and whether the
    waiting original may be removed (both copies present and of equal size)."""
    joined = (
        by_file_name(incoming, "incoming")
        .join(by_file_name(landing, "landing"), "file_name", "full_outer")
        .join(by_file_name(archive, "archive"), "file_name", "full_outer")
    )
    in_incoming = F.col("incoming_key").isNotNull()

    def same_size(area: str):
        return F.coalesce(
            F.col(f"{area}_size_bytes") == F.col("incoming_size_bytes"), F.lit(False)
        )

    return joined.select(
        "file_name",
        in_incoming.alias("in_incoming"),
        F.col("landing_key").isNotNull().alias("in_landing"),
        F.col("archive_key").isNotNull().alias("in_archive"),
        "incoming_size_bytes",
        "landing_size_bytes",
        "archive_size_bytes",
        same_size("landing").alias("landing_matches"),
        same_size("archive").alias("archive_matches"),
        (in_incoming & same_size("landing") & same_size("archive")).alias("safe_to_remove"),
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Transfer records, one JSON document per run under ``yyyy/mm/dd/``."""
    return (
        spark.read.schema(schemas.TRANSFER_RECORD)
        .option("recursiveFileLookup", "true")
        .json(path)
    )


def summarize_runs(records: DataFrame) -> DataFrame:
    """Runs by date and outcome: files and bytes moved, copies reused from earlier tries."""
    return records.groupBy("run_date", "status").agg(
        F.count("*").alias("runs"),
        F.coalesce(F.sum("files_transferred"), F.lit(0)).alias("files_transferred"),
        F.coalesce(F.sum("source_size_bytes"), F.lit(0)).alias("bytes_transferred"),
        F.count_if("landing_reused").alias("landing_reused"),
        F.count_if("archive_reused").alias("archive_reused"),
        F.count_if(
            (F.col("landing_size_bytes") != F.col("source_size_bytes"))
            | (F.col("archive_size_bytes") != F.col("source_size_bytes"))
        ).alias("size_mismatches"),
    )
