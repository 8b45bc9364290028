"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.session import apply_defaults, scratch_dir

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def prepare(spark: SparkSession) -> SparkSession:
    """Session defaults, and Arrow batches small enough for very long texts."""
    apply_defaults(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch | None], fields: list[T.StructField]
) -> DataFrame:
    """``mapInArrow`` of a function from batch to batch; None for a batch without rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, T.StructType(fields))


def renamed(field: T.StructField, name: str) -> T.StructField:
    return T.StructField(name, field.dataType, True)


def sheltered(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with every column but ``used`` under a name that clashes with none of an
    operator's, and a function that gives the columns back as they were."""
    places = {c: c if c in used else f"_kept{k}_" for k, c in enumerate(docs.columns)}
    hidden = docs.toDF(*places.values())
    return hidden, lambda out: out.select(*[F.col(p).alias(c) for c, p in places.items()])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components: edges (a, b) of longs to (node, root), root being the
    smallest node reachable. Roots themselves and nodes without an edge to another node
    are not listed.

    Alternating large-star and small-star rounds; each keeps one row per edge, reduces
    to minima before the shuffle and ends as a table in the shared folder. A round that
    changes nothing ends the loop; the number of rounds grows with the logarithm of the
    longest path.
    """
    clean = edges.where("a is not null and b is not null and a <> b")
    current = staged(
        clean.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    for _ in range(max_rounds):
        digest = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if digest == state or digest[0] == 0:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = digest
        both = current.union(current.select("v", "u"))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        turned = large.join(low, "u").select("u", "v", "m")
        small = turned.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        current = staged(small.distinct(), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def local_forest(count: int, near: Callable[[int, object], object]) -> list[tuple[int, int]]:
    """Edges that connect what ``near`` connects among items 0..count-1.

    ``near(i, rest)`` gives the members of the index array ``rest`` linked with item i.
    Each item is taken once and compared with those not yet reached, so a group of
    copies costs one comparison per member, and yields one edge per member.
    """
    import numpy as np

    rest = np.arange(count)
    edges = []
    while len(rest):
        root, rest = int(rest[0]), rest[1:]
        queue = [root]
        while queue and len(rest):
            hit = near(queue.pop(), rest)
            if len(hit):
                edges.extend((root, int(k)) for k in hit)
                queue.extend(int(k) for k in hit)
                rest = np.setdiff1d(rest, hit, assume_unique=True)
    return edges
