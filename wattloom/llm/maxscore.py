"""Exact top-k search by integer inner product: MaxScore over sharded postings.

Every dimension is a term, every vector a document whose postings are its components
other than 0. A task reads its part of the vectors in shards of bounded size and builds,
for each shard, the postings of every dimension with their largest and smallest value.
Weight times value bounds what a dimension can add to a score. For one query the
dimensions are ordered by that bound; the longest tail whose bounds add up to less than
the query's k-th best score so far is non-essential: a vector that stands in no essential
posting cannot compete. Essential postings are traversed and added up, the others are
probed for the vectors still competitive, one dimension after the other, and a vector is
given up as soon as its sum and the bounds left fall short. Scores are exact integers.
The best k of each task are merged by score and id.

Queries travel to the tasks in blocks of bounded size, one job a block; vectors are never
shuffled. Each query starts from the k-th best score over a bounded sample of candidates.
These are candidates themselves, so the bound is safe: it saves work and changes no result.

Vectors that are null or hold null or non-finite components take no part, nor do rows
without an id. Components that a shorter vector lacks count as 0, and an empty vector
scores 0. A candidate is every row with another id than the query; a repeated row counts
as often as it occurs, a repeated query row is answered once. Fewer than k candidates give
fewer rows; an empty table gives none. Ties go to the smaller id. Other columns are not
looked at, whatever their names. A score beyond a long raises ``OverflowError``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm import common
from wattloom.session import scratch_dir

K = 10
SCALE = 1024
#: Components in one broadcast block of queries (32 MiB), in the sample that starts the
#: bounds (2 MiB), and in one shard (4 MiB).
QUERY_CELLS = 1 << 22
SEED_CELLS = 1 << 18
SHARD_CELLS = 1 << 19
#: Below any score: a query without a bound yet.
NO_BOUND = -(1 << 62)
#: A posting list is kept as rows and values if at most this share of a shard is in it.
SPARSE_SHARE = 0.25


def usable(vector: str) -> Column:
    """Is the vector there, with finite components only?"""
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    )
    return F.col(vector).isNotNull() & finite


def integers(vectors: DataFrame, scale: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Usable vectors as (_id, _x): floor(scale * component) of each component."""
    floored = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.where(usable(vector)).select(F.col(key).cast("long").alias("_id"), floored.alias("_x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of integers as rows of ``width``; shorter lists are filled up with 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(values) == len(sizes) * width:
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Postings:
    """One shard: for each dimension its values by row, and the bounds they set."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids = ids
        self.columns = np.ascontiguousarray(rows.T)
        self.high = self.columns.max(axis=1)
        self.low = self.columns.min(axis=1)
        filled = np.count_nonzero(self.columns, axis=1)
        self.listed = [
            np.flatnonzero(column) if n <= SPARSE_SHARE * len(ids) else None
            for column, n in zip(self.columns, filled)
        ]

    def search(self, terms: np.ndarray, weights: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that score ``least`` or more, and their scores.

        ``terms`` are the dimensions of the query that are not 0, ``weights`` its
        components there.
        """
        top = np.maximum(weights * self.high[terms], weights * self.low[terms])
        bounds = np.maximum(top, 0)
        order = np.argsort(-bounds, kind="stable")
        terms, weights, bounds = terms[order], weights[order], bounds[order]
        # left[i]: what the terms from i on can add at most.
        left = np.zeros(len(terms) + 1, np.int64)
        left[:-1] = np.cumsum(bounds[::-1])[::-1]
        essential = int(np.searchsorted(-left, -least, side="right"))
        sums = np.zeros(len(self.ids), np.int64)
        if essential > len(terms):
            # Even a row without any posting, of score 0, competes.
            essential, seen = len(terms), None
        elif any(self.listed[t] is None for t in terms[:essential]):
            seen = None
        else:
            seen = np.zeros(len(self.ids), bool)
        for term, weight in zip(terms[:essential], weights[:essential]):
            rows = self.listed[term]
            if rows is None:
                sums += weight * self.columns[term]
            else:
                sums[rows] += weight * self.columns[term][rows]
                if seen is not None:
                    seen[rows] = True
        alive = np.flatnonzero(sums + left[essential] >= least if seen is None else seen & (sums + left[essential] >= least))
        sums = sums[alive]
        for i in range(essential, len(terms)):
            if not len(alive):
                break
            sums = sums + weights[i] * self.columns[terms[i]][alive]
            competes = sums + left[i + 1] >= least
            alive, sums = alive[competes], sums[competes]
        return alive, sums


class Block:
    """Queries of one block with their best rows so far."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, least: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, rows, k
        self.least = [int(x) for x in least]
        self.terms = [np.flatnonzero(row) for row in rows]
        self.scores = [np.empty(0, np.int64) for _ in ids]
        self.found = [np.empty(0, np.int64) for _ in ids]

    def search(self, shard: Postings) -> None:
        largest = np.maximum(np.abs(shard.high.astype(float)), np.abs(shard.low.astype(float)))
        if len(self.ids) and (np.abs(self.rows.astype(float)) @ largest).max(initial=0.0) >= 2.0**62:
            raise OverflowError("an inner product may not fit a long")
        for i, (own, terms) in enumerate(zip(self.ids, self.terms)):
            rows, scores = shard.search(terms, self.rows[i][terms], self.least[i])
            if len(rows):
                self._keep(i, own, shard.ids[rows], scores)

    def _keep(self, i: int, own: int, ids: np.ndarray, scores: np.ndarray) -> None:
        other = ids != own
        scores = np.concatenate([self.scores[i], scores[other]])
        ids = np.concatenate([self.found[i], ids[other]])
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores[i], self.found[i] = scores[best], ids[best]
        if len(best) == self.k:
            self.least[i] = max(self.least[i], int(self.scores[i][-1]))


def _shards(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Postings]:
    """The rows of a task in shards of at most ``SHARD_CELLS`` components."""
    size = max(1, SHARD_CELLS // max(1, width))
    ids: list[np.ndarray] = []
    rows: list[np.ndarray] = []
    held = 0
    for batch in batches:
        new_ids = batch.column(0).to_numpy(zero_copy_only=False)
        new_rows = matrix(batch.column(1), width)
        start = 0
        while start < len(new_ids):
            take = min(size - held, len(new_ids) - start)
            ids.append(new_ids[start : start + take])
            rows.append(new_rows[start : start + take])
            held += take
            start += take
            if held == size:
                yield Postings(np.concatenate(ids), np.concatenate(rows))
                ids, rows, held = [], [], 0
    if held:
        yield Postings(np.concatenate(ids), np.concatenate(rows))


def _with_bounds(queries: DataFrame, sample: tuple[np.ndarray, np.ndarray], width: int, k: int) -> DataFrame:
    """Queries with the k-th best score over the sampled candidates (``_least``)."""

    def start(batch: pa.RecordBatch) -> pa.RecordBatch:
        block = Block(
            batch.column(0).to_numpy(zero_copy_only=False),
            matrix(batch.column(1), width),
            np.full(batch.num_rows, NO_BOUND, np.int64),
            k,
        )
        if len(sample[0]):
            block.search(Postings(*sample))
        return pa.record_batch(
            [batch.column(0), batch.column(1), pa.array(block.least, pa.int64())], names=["_id", "_x", "_least"]
        )

    fields = [*queries.schema.fields, common.renamed(queries.schema["_id"], "_least")]
    return common.map_batches(queries, start, fields)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k best candidates of every query: query_id, rank (from 1), vec_id, score.

    ``is_query`` is a condition on ``_id``, the id as a long. See the module for the
    treatment of nulls, ties, repeats and short vectors.
    """
    spark = vectors.sparkSession
    candidates = integers(vectors, scale, key, vector).where("_id is not null")
    asked = candidates.where(is_query).distinct()
    width, n_queries = (
        candidates.agg(F.max(F.size("_x")).alias("width"), F.count_if(is_query).alias("queries")).first()
    )
    width = max(1, width or 1)
    sample = (
        candidates.orderBy(F.xxhash64("_id"), "_id").limit(max(2 * k, SEED_CELLS // width)).toArrow()
    )
    seed = (sample.column("_id").to_numpy(), matrix(sample.column("_x"), width))
    per_block = max(1, QUERY_CELLS // width)
    blocks = -(-n_queries // per_block)
    queries = common.staged(
        _with_bounds(asked, seed, width, k).withColumn("_block", F.pmod(F.xxhash64("_id"), F.lit(max(1, blocks)))),
        "queries",
    )
    found = scratch_dir(spark, "top-k")
    layout = "query_id long, query_hash long, vec_id long, score long"
    spark.createDataFrame([], layout).write.parquet(found)
    for number in range(blocks):
        block = queries.where(F.col("_block") == number)
        chosen = block.select("_id", "_x", "_least", F.xxhash64("_x").alias("_hash")).toArrow()
        if not chosen.num_rows:
            continue
        shared = spark.sparkContext.broadcast(
            (
                chosen.column("_id").to_numpy(),
                matrix(chosen.column("_x"), width),
                chosen.column("_least").to_numpy(),
                chosen.column("_hash").to_numpy(),
            )
        )

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, rows, least, hashes = shared.value
            state = Block(ids, rows, least, k)
            for shard in _shards(batches, width):
                state.search(shard)
            sizes = [len(f) for f in state.found]
            yield pa.record_batch(
                [
                    pa.array(np.repeat(ids, sizes), pa.int64()),
                    pa.array(np.repeat(hashes, sizes), pa.int64()),
                    pa.array(np.concatenate(state.found), pa.int64()),
                    pa.array(np.concatenate(state.scores), pa.int64()),
                ],
                names=["query_id", "query_hash", "vec_id", "score"],
            )

        candidates.mapInArrow(search, layout).write.mode("append").parquet(found)
        shared.destroy()
    # A query has at most k rows from each task; the k best of them are its answer.
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (
        spark.read.schema(layout)
        .parquet(found)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
