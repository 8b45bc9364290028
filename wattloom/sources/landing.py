"""Reading landing files: declared schema, provenance, rescued values."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.operators.conform import quoted

RESCUED = "_rescued_data"
PROVENANCE = {
    "source_file_path": "_metadata.file_path",
    "source_file_name": "_metadata.file_name",
    "source_file_size": "_metadata.file_size",
}


def with_provenance(files: DataFrame) -> DataFrame:
    """Add path, name and size of the file each row came from."""
    return files.select("*", *[F.col(src).alias(name) for name, src in PROVENANCE.items()])


def _typed(raw: Column, kind: T.DataType) -> Column:
    value = raw.try_cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # NaN and infinities are not readings; they are rescued like bad text.
        bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")).cast(kind))
        return F.when(~bad, value)
    return value


def rescue(raw: DataFrame, declared: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """Cast to the declared schema; keep everything that does not fit as JSON.

    ``_rescued_data`` is null for a clean row. Otherwise it is a JSON object of the
    values that failed the cast and of the columns the schema does not declare,
    all as text. Columns in ``keep`` pass through untouched.
    """
    keep = keep or []
    present = {f.name: f.dataType for f in raw.schema.fields}
    columns: list[Column] = []
    misfits: list[Column] = []
    for field in declared.fields:
        if field.name not in present:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = F.col(quoted(field.name))
        typed = _typed(source, field.dataType)
        columns.append(typed.alias(field.name))
        may_fail = present[field.name] != field.dataType or isinstance(
            field.dataType, (T.DoubleType, T.FloatType)
        )
        if may_fail:
            misfits.append(F.when(typed.isNull(), source.cast("string")).alias(field.name))
    declared_names = set(declared.fieldNames())
    extras = [c for c in raw.columns if c not in declared_names and c not in keep]
    misfits += [F.col(quoted(c)).cast("string").alias(c) for c in extras]
    if misfits:
        text = F.to_json(F.struct(*misfits))
        rescued = F.when(text != F.lit("{}"), text)
    else:
        rescued = F.lit(None).cast("string")
    return raw.select(*columns, *[F.col(quoted(c)) for c in keep], rescued.alias(RESCUED))


#: Footers read one by one where files of one list disagree, and at the same time.
FILES_APART = 500
READERS = 16


def schema_groups(
    spark: SparkSession, paths: list[str], root: str
) -> list[tuple[list[str], T.StructType]]:
    """Files in groups that agree on the type of every column, with the columns of each.

    Spark merges the footers of a whole list in one distributed job. Only if they do not
    merge are shorter lists tried, and the files of those that still disagree one by one.
    Files that agree are put together again, so there are as many groups as there are ways
    to store the columns.
    """

    def columns(part: list[str]) -> T.StructType | None:
        reader = spark.read.option("mergeSchema", "true").option("basePath", root)
        try:
            return reader.parquet(*part).schema
        except (Py4JJavaError, PySparkException) as failure:
            if len(part) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(failure):
                raise
            return None

    whole = columns(paths)
    if whole is not None:
        return [(paths, whole)]
    read: list[tuple[list[str], T.StructType]] = []
    with ThreadPoolExecutor(READERS) as threads:
        for k in range(0, len(paths), FILES_APART):
            part = paths[k : k + FILES_APART]
            merged = columns(part) if len(part) < len(paths) else None
            if merged is not None:
                read.append((part, merged))
            else:
                read += [([file], schema) for file, schema in zip(part, threads.map(lambda f: columns([f]), part))]
    found: list[tuple[list[str], T.StructType]] = []
    for files, schema in read:
        for k, (others, known) in enumerate(found):
            merged = _merged(known, schema)
            if merged is not None:
                found[k] = (others + files, merged)
                break
        else:
            found.append((files, schema))
    return found


def _merged(one: T.StructType, other: T.StructType) -> T.StructType | None:
    """Columns of both, or None if one column has two types."""
    kinds = {f.name: f.dataType for f in one.fields}
    if any(kinds.get(f.name, f.dataType) != f.dataType for f in other.fields):
        return None
    return T.StructType(one.fields + [f for f in other.fields if f.name not in kinds])


def with_new_columns(declared: T.StructType, physical: T.StructType) -> T.StructType:
    """The declared schema and the columns it lacks."""
    names = set(declared.fieldNames())
    return T.StructType(declared.fields + [f for f in physical.fields if f.name not in names])


def read_rescued(
    spark: SparkSession,
    groups: list[tuple[list[str], T.StructType]],
    root: str,
    declared: T.StructType,
) -> DataFrame:
    """All files of the groups under one schema: each group is read by its own types, then
    cast; what does not fit is kept in ``_rescued_data``."""
    parts = []
    for files, schema in groups:
        read = spark.read.schema(schema).option("basePath", root).parquet(*files)
        parts.append(rescue(with_provenance(read), declared, keep=list(PROVENANCE)))
    return reduce(DataFrame.unionByName, parts)


def read_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Batch read of landing files under a declared schema.

    ``ingest_date=YYYY-MM-DD`` folders become a column; a declared column that
    older files lack reads null.
    """
    return spark.read.schema(schema).option("mergeSchema", "true").parquet(path)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming read of landing files under a declared schema."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def stream_paths(spark: SparkSession, path: str, max_files_per_trigger: int) -> DataFrame:
    """Streaming list of landing files, as rows of ``path``; no file is opened."""
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    return (
        spark.readStream.format("binaryFile")
        .schema(listing)
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(path)
        .select("path")
    )
