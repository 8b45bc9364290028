"""Incremental loading: landing files to the raw layer, micro-batches to hours.

Both sinks are parquet tables of the session catalog. The stream itself only remembers
which files it has handed out; a micro-batch becomes visible by a catalog statement.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom import schemas
from wattloom.functions.measures import exact_sum
from wattloom.operators import conform, rollup
from wattloom.operators.upsert import (
    Staging,
    add_columns,
    add_partitions,
    create_table,
    read_table,
    upsert,
)
from wattloom.sources import landing

#: Files in one micro-batch at most; their names are collected on the driver.
FILES_PER_BATCH = 10_000
BATCH = "ingest_batch"


def _run(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> None:
    """Hand all that is new to ``apply``, batch by batch, then stop."""
    query = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that Spark gave the stream of this checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def ingest(
    spark: SparkSession,
    landing_path: str,
    table: str,
    root: str,
    checkpoint: str,
    declared: T.StructType,
    max_files_per_trigger: int = FILES_PER_BATCH,
    new_columns: bool = False,
) -> None:
    """Append the landing files not seen before to the raw layer, then stop.

    Progress lives in ``checkpoint``; a second run over the same files adds nothing. The
    stream lists files without opening them, and only the footers of a batch's own files
    are read. Files that store a column in different types are read apart, each by its own
    types. Values that do not fit the declared types are kept in ``_rescued_data``; columns
    that are not declared become columns of the raw layer (``new_columns``) or are kept in
    ``_rescued_data`` too.

    ``table`` holds the raw layer, its files lie below ``root``. The catalog keeps its
    columns, which only grow: a later file without a column reads null there, one with
    another type is cast or rescued. A batch appears as a whole by one statement, and a
    batch that was interrupted is written again.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        paths = [row["path"] for row in batch.collect()]
        if not paths:
            return
        groups = landing.schema_groups(spark, sorted(paths), landing_path)
        kept = read_table(spark, table)
        shape = declared
        if kept is not None:
            names = {*landing.PROVENANCE, landing.RESCUED, BATCH}
            shape = landing.with_new_columns(
                shape, T.StructType([f for f in kept.schema.fields if f.name not in names])
            )
        if new_columns:
            for _, physical in groups:
                shape = landing.with_new_columns(shape, physical)
        bronze = landing.read_rescued(spark, groups, landing_path, shape)
        name = f"{stream_id(spark, checkpoint)}-{batch_id}"
        folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
        bronze.withColumn(BATCH, F.lit(name)).write.partitionBy(BATCH, "ingest_date").parquet(folder)
        if kept is None:
            layout = T.StructType([*bronze.schema.fields, T.StructField(BATCH, T.StringType())])
            create_table(spark, table, layout, folder, (BATCH, "ingest_date"))
        else:
            add_columns(spark, table, [f for f in bronze.schema.fields if f.name not in kept.columns])
        # Read by the file names only. The calendar bounds the dates of a batch.
        days = spark.read.schema("ingest_date date").parquet(f"{folder}/{BATCH}={name}").distinct()
        specs = [{BATCH: name, "ingest_date": row[0]} for row in days.collect()]
        add_partitions(spark, table, folder, specs)

    _run(landing.stream_paths(spark, landing_path, max_files_per_trigger), checkpoint, apply)


def read_bronze(spark: SparkSession, table: str) -> DataFrame:
    """The raw layer: declared and later columns, provenance and rescued values."""
    bronze = read_table(spark, table)
    if bronze is None:
        raise ValueError(f"table {table} has not been written")
    return bronze.drop(BATCH)


def hourly_partials(readings: DataFrame, digits: int | None = None) -> DataFrame:
    """Hour totals of one micro-batch."""
    return rollup.hourly_rollup(readings, digits)


def combine_partials(partials: DataFrame, digits: int | None = None) -> DataFrame:
    """Hourly rows from the totals of any number of micro-batches."""
    return partials.groupBy("building_id", "source_hour_end").agg(
        F.sum("interval_count").alias("interval_count"),
        *[exact_sum(m, digits).alias(m) for m in schemas.READING_MEASURES],
        F.max("peak_15min_average_kw").alias("peak_15min_average_kw"),
    )


def upsert_stream(
    spark: SparkSession,
    landing_path: str,
    table: str,
    root: str,
    checkpoint: str,
    declared: T.StructType,
    max_files_per_trigger: int | None = None,
    digits: int | None = None,
) -> None:
    """Keep the hourly table current from micro-batches of landing files.

    The hour totals of a batch are added to the hours that the table holds, and the sums
    upserted; a late reading corrects its hour. Every row carries the last batch that
    changed it: a batch that was interrupted halfway is applied again only to the rows it
    had not reached, so replays change nothing. Batch numbers belong to one checkpoint. A
    table that another stream has filled is refused, as its files would count twice.
    ``digits``: see ``measures.exact_sum``.
    """
    keys = ["building_id", "source_hour_end"]

    def apply(batch: DataFrame, batch_id: int) -> None:
        totals = hourly_partials(conform.project_consumption(batch), digits)
        with Staging(spark) as stage:
            fresh = stage(totals, "hour-totals").withColumn(
                "part_month", F.trunc(F.col("source_hour_end").cast("date"), "month")
            )
            months = [r[0] for r in fresh.select("part_month").distinct().collect()]
            if not months:
                return
            stream = stream_id(spark, checkpoint)
            held = read_table(spark, table)
            if held is not None:
                _same_stream(held, table, stream)
                held = held.filter(F.col("part_month").isin(months))
                applied = held.filter(F.col("last_batch") >= batch_id).select(*keys)
                fresh = fresh.join(applied, keys, "left_anti")
                before = held.join(fresh.select(*keys), keys, "left_semi").select(*fresh.columns)
                fresh = before.unionByName(fresh)
            hours = combine_partials(fresh, digits).withColumns(
                {
                    "stream": F.lit(stream),
                    "last_batch": F.lit(batch_id).cast("bigint"),
                    "part_month": F.trunc(F.col("source_hour_end").cast("date"), "month"),
                }
            )
            upsert(hours, table, keys, root, "part_month", keys_unique=True)

    _run(landing.stream_landing(spark, landing_path, declared, max_files_per_trigger), checkpoint, apply)


def _same_stream(held: DataFrame, table: str, stream: str) -> None:
    """Any row tells which stream fills the table."""
    row = held.select("stream").first()
    if row is not None and row["stream"] != stream:
        raise ValueError(f"table {table} is filled by another stream, {row['stream']}")
