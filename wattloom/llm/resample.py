"""Importance resampling of documents towards a target text collection.

Features are runs of 1 to ``longest`` consecutive words, hashed into buckets. Bucket counts
over all documents and over all target texts give a gain per bucket, a document's weight is
the sum of its features' gains, and a keyed Gumbel draw of the weights without replacement
takes a percentage of the documents that are long enough.

Interning is an open-addressed numpy table per batch of text: a run's xxhash64 chooses its
slot, equal keys are verified by their bytes, collisions go on to the next slot. A slot
stores the bucket (computed once for each different run) and the count; every occurrence
keeps the number of its slot, by which counts are added up and gains gathered. The table
lives as long as its batch. The two passes over the text (counts, weights) move one row per
bucket and task, and three numbers per document.

Ranks come from a range-partitioned sort and one prefix sum over partition totals; no task
holds more than its range, and only one number per partition comes to the driver.

Upper-case A-Z is lowered, other letters stay. A null or empty text has no words, weight 0
and is too short to be drawn. A row without doc_id gets its weight, but no score and no
rank, and does not count among the documents to draw from. Rows that repeat a doc_id are
scored each by its own text; rows equal in score and doc_id share their places in any order.
Empty tables give no rows; an empty target makes every gain follow from the counts of the
documents alone. Texts are taken whole. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm import common

BUCKETS = 10_000
LONGEST = 1
PERCENT = 10
LEAST_WORDS = 20
KEY = "2024"
#: Text of this many bytes, or one longer document, is interned in one table.
TABLE_BYTES = 4 << 20

# The primes of the 64-bit hash.
P1, P2, P3, P4, P5 = (
    np.uint64(11400714785074694791),
    np.uint64(14029467366897019727),
    np.uint64(1609587929392839161),
    np.uint64(9650029242287828579),
    np.uint64(2870177450012600261),
)

#: Byte by byte: A-Z lowered, and which bytes belong to words (0-9, a-z, all beyond ASCII).
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


# --- hashing --------------------------------------------------------------------


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(state: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotated(state + lane * P2, 31) * P1


class Bytes:
    """A buffer whose 1, 4 and 8 byte words can be read at any place."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        self.data = padded
        self.lanes = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
        self.halves = np.ndarray((len(data) + 1,), "<u4", padded.data, strides=(1,))


def xxhash64(text: Bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes, seed 0, of many byte runs at once."""
    at = starts.copy()
    left = sizes.copy()
    h = np.full(len(starts), P5)
    long = np.flatnonzero(left >= 32)
    if len(long):
        zero = np.zeros(len(long), np.uint64)
        lanes = [zero + P1 + P2, zero + P2, zero.copy(), zero - P1]
        place, rest = at[long], left[long]
        going = np.arange(len(long))
        while len(going):
            for i, state in enumerate(lanes):
                state[going] = _round(state[going], text.lanes[place[going] + 8 * i])
            place[going] += 32
            rest[going] -= 32
            going = going[rest[going] >= 32]
        mixed = sum((_rotated(s, b) for s, b in zip(lanes, (1, 7, 12, 18))), zero)
        for state in lanes:
            mixed = (mixed ^ _round(zero, state)) * P1 + P4
        h[long], at[long], left[long] = mixed, place, rest
    h += sizes.astype(np.uint64)
    going = np.flatnonzero(left >= 8)
    while len(going):
        h[going] = _rotated(h[going] ^ _round(np.uint64(0), text.lanes[at[going]]), 27) * P1 + P4
        at[going] += 8
        left[going] -= 8
        going = going[left[going] >= 8]
    going = np.flatnonzero(left >= 4)
    if len(going):
        h[going] = _rotated(h[going] ^ text.halves[at[going]].astype(np.uint64) * P1, 23) * P2 + P3
        at[going] += 4
        left[going] -= 4
    going = np.flatnonzero(left > 0)
    while len(going):
        h[going] = _rotated(h[going] ^ text.data[at[going]].astype(np.uint64) * P5, 11) * P1
        at[going] += 1
        left[going] -= 1
        going = going[left[going] > 0]
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def _same_bytes(text: Bytes, one: np.ndarray, other: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Do the runs at ``one`` and ``other`` hold the same bytes?"""
    same = np.ones(len(one), bool)
    going = np.arange(len(one))
    done = 0
    while len(going):
        left = sizes[going] - done
        # Of a last lane only the first bytes count: the others are shifted out.
        shift = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
        differ = (text.lanes[one[going] + done] ^ text.lanes[other[going] + done]) << shift
        same[going] = differ == 0
        going = going[(differ == 0) & (left > 8)]
        done += 8
    return same


# --- interning --------------------------------------------------------------------


class Table:
    """Open-addressed table of the runs of one batch: bucket and count by slot, and the
    slot of every occurrence."""

    def __init__(self, text: Bytes, starts: np.ndarray, sizes: np.ndarray, buckets: int):
        keys = xxhash64(text, starts, sizes)
        capacity = 1 << max(4, (2 * len(starts) - 1).bit_length() if len(starts) else 0)
        wrap = np.uint64(capacity - 1)
        owner = np.full(capacity, -1, np.int64)
        self.slots = (keys & wrap).astype(np.int64)
        pending = np.arange(len(starts))
        while len(pending):
            slot = self.slots[pending]
            free = owner[slot] < 0
            # Of several occurrences that claim a slot one remains; the rest compare with it.
            owner[slot[free]] = pending[free]
            holder = owner[slot]
            same = (keys[holder] == keys[pending]) & (sizes[holder] == sizes[pending])
            near = np.flatnonzero(same & (holder != pending))
            same[near] = _same_bytes(text, starts[holder[near]], starts[pending[near]], sizes[pending[near]])
            pending = pending[~same]
            self.slots[pending] = (self.slots[pending] + 1) & (capacity - 1)
        used = np.flatnonzero(owner >= 0)
        first = owner[used]
        view = memoryview(text.data)
        self.buckets = np.zeros(capacity, np.int32)
        self.buckets[used] = [
            zlib.crc32(view[a:b]) % buckets for a, b in zip(starts[first].tolist(), (starts + sizes)[first].tolist())
        ]
        self.counts = np.bincount(self.slots, minlength=capacity)

    def gathered(self, gains: np.ndarray) -> np.ndarray:
        """The gain of every occurrence."""
        return gains[self.buckets][self.slots]


def runs(texts: pa.Array, longest: int) -> tuple[Bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of 1 to ``longest`` words: buffer, starts, sizes, document of each, words by document.

    In the buffer the words of a document are joined by single spaces.
    """
    joined = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", "\n").cast(pa.large_string())
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = LOWER[np.frombuffer(joined.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
    inside = IN_WORD[data]
    # A line feed ends every text, so each word that starts ends in the same document.
    change = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=np.int8(0)))
    starts, ends = change[0::2], change[1::2]
    document = np.searchsorted(offsets - offsets[0], starts, side="right") - 1
    words = np.bincount(document, minlength=len(texts))
    if longest == 1:
        return Bytes(data), starts, ends - starts, document, words
    keep = inside.copy()
    keep[ends] = True
    data[ends] = 32
    sizes = ends - starts
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1].astype(np.int64)
    ends = starts + sizes
    all_starts, all_sizes, all_documents = [], [], []
    for n in range(1, longest + 1):
        first = np.arange(max(0, len(starts) - n + 1))
        first = first[document[first] == document[first + n - 1]]
        all_starts.append(starts[first])
        all_sizes.append(ends[first + n - 1] - starts[first])
        all_documents.append(document[first])
    return Bytes(data[keep]), np.concatenate(all_starts), np.concatenate(all_sizes), np.concatenate(all_documents), words


def _pieces(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """A batch in slices of about ``TABLE_BYTES`` of text, with the first row of each."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > TABLE_BYTES:
            yield start, texts.slice(start, i - start)
            start, held = i, 0
        held += int(size)
    yield start, texts.slice(start)


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """Features by bucket over all rows: bucket, features."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, piece in _pieces(batch.column(0)):
                buffer, starts, sizes, _, _ = runs(piece, longest)
                table = Table(buffer, starts, sizes, buckets)
                np.add.at(total, table.buckets, table.counts)
        used = np.flatnonzero(total)
        yield pa.record_batch(
            [pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "features"]
        )

    counted = texts.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, features long")
    return counted.groupBy("bucket").agg(F.sum("features").alias("features"))


def _collected(counts: DataFrame, buckets: int) -> list[int]:
    """Counts of all buckets: as many numbers as there are buckets."""
    found = {r["bucket"]: r["features"] for r in counts.collect()}
    return [found.get(b, 0) for b in range(buckets)]


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of each bucket, both smoothed by one."""
    buckets, s, t = len(corpus), sum(corpus), sum(target)
    return np.array(
        [
            math.floor(1000 * math.log((float(b + 1) * float(s + buckets)) / (float(a + 1) * float(t + buckets))))
            for a, b in zip(corpus, target)
        ],
        np.int64,
    )


def gumbel(doc_id: int, key: str = KEY) -> int:
    """Keyed draw: floor(-1000 ln(-ln(u))), u from the first 32 bits of a SHA-256."""
    h = int(hashlib.sha256(f"{key}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(
    docs: DataFrame, gain: np.ndarray, text: str = "text", doc_id: str = "doc_id", longest: int = LONGEST, key: str = KEY
) -> DataFrame:
    """Every document's doc_id, n_words, n_features, weight and score."""

    def weigh(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.num_rows
        weights, features, n_words = (np.zeros(rows, np.int64) for _ in range(3))
        for first, piece in _pieces(batch.column(1)):
            buffer, starts, sizes, document, words = runs(piece, longest)
            found = Table(buffer, starts, sizes, len(gain)).gathered(gain)
            here = slice(first, first + len(piece))
            np.add.at(weights[here], document, found)
            features[here] = np.bincount(document, minlength=len(piece))
            n_words[here] = words
        ids = batch.column(0).to_pylist()
        scores = [None if i is None else int(w) + gumbel(i, key) for i, w in zip(ids, weights)]
        return pa.record_batch(
            [batch.column(0), *(pa.array(a, pa.int64()) for a in (n_words, features, weights, scores))],
            names=["doc_id", "n_words", "n_features", "weight", "score"],
        )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string")).mapInArrow(
        lambda batches: (weigh(b) for b in batches if b.num_rows),
        "doc_id long, n_words long, n_features long, weight long, score long",
    )


def _ranked(rows: DataFrame, may_be_drawn: Column, percent: int) -> DataFrame:
    """Add the rank of the highest scores; null for rows that are not drawn."""
    spark = rows.sparkSession
    placed = common.staged(
        rows.where(may_be_drawn)
        .repartitionByRange(F.desc("score"), F.asc("doc_id"))
        .withColumn("_range", F.spark_partition_id()),
        "draw",
    )
    # Ranges follow each other in the order of the draw; one number each.
    sizes = {r["_range"]: r["count"] for r in placed.groupBy("_range").count().collect()}
    drawn = percent * sum(sizes.values()) // 100
    before, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    starts = spark.createDataFrame(offsets, "_range int, _before long")
    order = Window.partitionBy("_range").orderBy(F.desc("score"), F.asc("doc_id"))
    rank = F.col("_before") + F.row_number().over(order)
    ranked = (
        placed.join(F.broadcast(starts), "_range")
        .withColumn("rank", rank)
        .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
        .drop("_range", "_before")
    )
    rest = rows.where(~F.coalesce(may_be_drawn, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def resampled(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    key: str = KEY,
) -> DataFrame:
    """Every document with doc_id, n_features, weight, score and rank in the draw."""
    gain = gains(
        _collected(bucket_counts(docs, "text", longest, buckets), buckets),
        _collected(bucket_counts(target, "text", longest, buckets), buckets),
    )
    scored = common.staged(weighed(docs, gain, longest=longest, key=key), "weighed")
    may_be_drawn = F.col("doc_id").isNotNull() & (F.col("n_words") >= least_words)
    return _ranked(scored, may_be_drawn, percent).select("doc_id", "n_features", "weight", "score", "rank")
