"""Keyed upserts: update matching rows, insert the others.

On a catalog with row-level operations this is ``DataFrame.mergeInto``. A parquet table
of the session catalog is kept current by a join: the partitions that the source touches
are merged, written to a fresh folder, and handed to the catalog, which from then on reads
them there. Files that a reader may hold are never touched, so what was read before an
upsert still reads; the replaced folders are the caller's to delete. A job that dies
before the switch leaves the old rows; one that dies between two partitions leaves each
of them whole, old or new, and running it again completes it. One writer at a time.

The columns of a table are those its catalog entry lists, and they only grow: columns that
are new in a source are added, columns that a source lacks keep their values.
"""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.operators import gates
from wattloom.operators.conform import quoted
from wattloom.session import delete_path, scratch_dir


def key_conflicts(source: DataFrame, keys: list[str]) -> gates.Gate:
    """Keys that would update one target row twice."""
    return gates.Gate("source keys occur twice", gates.duplicate_keys(source, keys))


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows without a match in the source, plus all source rows.

    A matched row keeps what the target has in columns that the source lacks. Columns
    that the target lacks are null in its other rows.
    """
    lacking = [c for c in target.columns if c not in source.columns]
    if lacking:
        kept = target.select(*[F.col(quoted(c)) for c in [*keys, *lacking]])
        source = source.join(kept, keys, "left")
    untouched = target.join(source.select(*keys), keys, "left_anti")
    return untouched.unionByName(source, allowMissingColumns=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Everything that follows (gates, counts, the upsert) reads the written rows
    instead of computing them again, and no longer depends on any executor.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_together(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """``stage`` as a bucketed table of the session catalog: the rows of a ``key`` lie in one
    bucket, so that what groups, ranks or joins them by it needs no shuffle.

    A bucket is read by one task, so no key may have many rows. Rows that
    ``repartition(buckets, key)`` has dealt already make one file a bucket.
    """
    spark = df.sparkSession
    table = f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, key).option("path", scratch_dir(spark, label)).saveAsTable(table)
    return spark.table(table)


class Staging:
    """``stage`` for a flow that ends: what it staged is deleted with it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Staging:
        return self

    def __call__(self, df: DataFrame, label: str, *checks: gates.Check) -> DataFrame:
        """``df`` written and read back. ``checks`` are counted by the write itself, and
        raise if they found anything."""
        path = scratch_dir(self.spark, label)
        self.paths.append(path)
        counted = gates.Counted(checks)
        counted.over(df).write.parquet(path)
        counted.enforce()
        return self.spark.read.schema(df.schema).parquet(path)

    def by_partition(self, df: DataFrame, folder: str, partition_by: str, *checks: gates.Check) -> DataFrame:
        """``df`` written to ``folder`` in the folders of a table, where ``upsert`` may leave
        it; then it is kept."""
        self.paths.append(folder)
        counted = gates.Counted(checks)
        counted.over(df).write.partitionBy(partition_by).parquet(folder)
        counted.enforce()
        return self.spark.read.schema(df.schema).parquet(folder)

    def keep(self, path: str) -> None:
        """Do not delete ``path``: it has become part of a table."""
        self.paths.remove(path)

    def __exit__(self, *failure: object) -> None:
        for path in self.paths:
            delete_path(self.spark, path)


# --- parquet tables of the session catalog -------------------------------------


def _name(table: str) -> str:
    return ".".join(quoted(part) for part in table.split("."))


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The table as the catalog has it now, or None before its first write."""
    if not table_exists(spark, table):
        return None
    # Another session of the application (a stream has its own) may have changed it.
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _columns(fields: list[T.StructField]) -> str:
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, folder: str, partition_by: tuple[str, ...] = ()
) -> None:
    """A parquet table at ``folder``; one with partitions starts without any."""
    fields = [f for f in schema.fields if f.name not in partition_by]
    fields += [schema[c] for c in partition_by]
    by = f"PARTITIONED BY ({', '.join(map(quoted, partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE {_name(table)} ({_columns(fields)}) USING parquet {by} LOCATION '{folder}'")


def add_columns(spark: SparkSession, table: str, fields: list[T.StructField]) -> None:
    """Widen a table; its older files read null in the new columns."""
    if fields:
        spark.sql(f"ALTER TABLE {_name(table)} ADD COLUMNS ({_columns(fields)})")


def partition_spec(values: dict[str, object]) -> str:
    """``PARTITION (...)`` of a catalog statement; dates, texts and null."""

    def literal(value: object) -> str:
        if value is None:
            return "null"
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"

    return f"PARTITION ({', '.join(f'{quoted(k)} = {literal(v)}' for k, v in values.items())})"


def partition_folder(folder: str, values: dict[str, object]) -> str:
    """Where Spark writes a partition below ``folder``."""
    return "/".join(
        [folder, *(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in values.items())]
    )


def _known_partitions(spark: SparkSession, table: str) -> set[str]:
    """Partitions that the catalog lists, as folder names. The calendar bounds them."""
    return {row[0] for row in spark.sql(f"SHOW PARTITIONS {_name(table)}").collect()}


def add_partitions(spark: SparkSession, table: str, folder: str, specs: list[dict[str, object]]) -> None:
    """Make new partitions below ``folder`` visible, all in one step; known ones stay."""
    if specs:
        added = " ".join(f"{partition_spec(s)} LOCATION '{partition_folder(folder, s)}'" for s in specs)
        spark.sql(f"ALTER TABLE {_name(table)} ADD IF NOT EXISTS {added}")


def _switch(spark: SparkSession, table: str, folder: str, partition_by: str | None, values: list[object]) -> None:
    """Let the catalog read the written rows in place of the old ones."""
    if partition_by is None:
        spark.sql(f"ALTER TABLE {_name(table)} SET LOCATION '{folder}'")
        return
    known = _known_partitions(spark, table)
    specs = [{partition_by: v} for v in values]
    for spec in specs:
        if partition_folder("", spec)[1:] in known:
            spark.sql(
                f"ALTER TABLE {_name(table)} {partition_spec(spec)} SET LOCATION '{partition_folder(folder, spec)}'"
            )
    add_partitions(spark, table, folder, [s for s in specs if partition_folder("", s)[1:] not in known])


def _write(rows: DataFrame, folder: str, partition_by: str | None) -> None:
    if partition_by is None:
        rows.write.parquet(folder)
        return
    # Rebalancing brings the rows of a partition value together, and AQE splits a
    # large one over several tasks: few files per folder, no overloaded task.
    rows.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(folder)


def upsert(
    source: DataFrame,
    table: str,
    keys: list[str],
    root: str,
    partition_by: str | None = None,
    *,
    staged: bool = False,
    keys_unique: bool = False,
    laid_out: str | None = None,
) -> str | None:
    """Upsert into a parquet table of the session catalog, creating it at first.

    Rows are written to a new folder below ``root``; its path is returned (None if there
    was nothing to write). ``partition_by`` names a date column that is a function of the
    keys (the month of a time key), so a row never moves between partitions; only
    partitions with source rows are read and rewritten. Their list is bounded by the
    calendar.

    ``staged`` says that the source already is a written table, and ``keys_unique`` that
    it was grouped by exactly the keys; both save a pass. ``laid_out`` is the folder below
    which the source already lies by ``partition_by``, see ``Staging.by_partition``: where the
    table has none of these partitions that folder becomes part of it and is returned, and no
    row is written a second time.
    """
    spark = source.sparkSession
    with Staging(spark) as staging:
        if not staged:
            source = staging(source, "upsert-source")
        if not keys_unique:
            key_conflicts(source, keys).enforce()
        return _upsert(spark, source, table, keys, root, partition_by, laid_out)


def _upsert(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    keys: list[str],
    root: str,
    partition_by: str | None,
    laid_out: str | None,
) -> str | None:
    values: list[object] = []
    if partition_by:
        values = [row[0] for row in source.select(partition_by).distinct().collect()]
        if not values and table_exists(spark, table):
            return None
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    target = read_table(spark, table)
    if target is None:
        if laid_out:
            folder = laid_out
        else:
            _write(source, folder, partition_by)
        create_table(spark, table, source.schema, folder, (partition_by,) if partition_by else ())
        add_partitions(spark, table, folder, [{partition_by: v} for v in values])
        return folder
    kinds = {f.name: f.dataType for f in target.schema.fields}
    if laid_out and _only_new(spark, source, table, kinds, partition_by, values):
        add_columns(spark, table, [f for f in source.schema.fields if f.name not in kinds])
        add_partitions(spark, table, laid_out, [{partition_by: v} for v in values])
        return laid_out
    source = source.select(
        *[F.col(quoted(f.name)).cast(kinds.get(f.name, f.dataType)).alias(f.name) for f in source.schema.fields]
    )
    added = [f for f in source.schema.fields if f.name not in kinds]
    if partition_by:
        target = target.filter(_among(partition_by, values))
    _write(merge_rows(target, source, keys), folder, partition_by)
    add_columns(spark, table, added)
    _switch(spark, table, folder, partition_by, values)
    return folder


def _only_new(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    kinds: dict[str, T.DataType],
    partition_by: str,
    values: list[object],
) -> bool:
    """Has the table none of these partitions, and the source the table's types?"""
    known = _known_partitions(spark, table)
    return all(kinds.get(f.name, f.dataType) == f.dataType for f in source.schema.fields) and not any(
        partition_folder("", {partition_by: v})[1:] in known for v in values
    )


def _among(name: str, values: list[object]) -> Column:
    """Is the partition one of ``values``? Answered by the catalog's list alone."""
    found = F.col(name).isin([v for v in values if v is not None])
    return found | F.col(name).isNull() if None in values else found


def upsert_rows(source: DataFrame, table: str, keys: list[str]) -> None:
    """Upsert into a catalog table whose format supports row-level operations."""
    key_conflicts(source, keys).enforce()
    target = table.split(".")[-1]
    matches = [F.col(f"{target}.{k}") == F.col(f"_source.{k}") for k in keys]
    (
        source.alias("_source")
        .mergeInto(table, reduce(and_, matches))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
