"""Benchmark passages in documents by a prefix-filtered join of word shingles.

A window is ten consecutive words of a benchmark item (a shorter item is one window). A
window occurs in a document only if all its five-word shingles do, one after another.

1. A bitmap of fixed size holds the shingles of all windows. Every document is read
   once; stretches of consecutive shingles in the bitmap that are long enough for a
   window become segments. Equal segments are checked once, whatever their number.
2. Shingles are ordered by how often they occur over all documents. Exact containment
   needs every shingle, so the prefix of a window is its rarest one; segments and
   windows are joined on it.
3. The position of the shingle in both gives the only place where the window can stand
   (positional bound); it must lie in the segment (length bound); the words there are
   compared with the window's.

Rows: null or wordless texts have no words and no hits; so have null or wordless items.
Repeated documents keep their rows. A benchmark without windows hits nothing. Only key
and text are read of either table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import common

WINDOW_WORDS = 10
SHINGLE_WORDS = 5
#: The bitmap has two to this power bits: 2 MiB, however large the benchmark.
BITMAP_POWER = 24
_CACHED_WORDS = 500_000

# Words are runs of ASCII letters and digits and of all bytes of other characters.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TO_WORDS).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _Hashes()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """One 64-bit value for each run of ``size`` words."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total = total * _BASE + each[k : k + count]
    return (total ^ (total >> np.uint64(29))) * _MIX


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITMAP_POWER)).astype(np.int64)


_WINDOW_FIELDS = [
    T.StructField("words", T.StringType()),
    T.StructField("length", T.IntegerType()),
    T.StructField("size", T.IntegerType()),
    T.StructField("tokens", T.ArrayType(T.LongType())),
    T.StructField("slots", T.ArrayType(T.LongType())),
]


def _windows(items: DataFrame, key: str, text: str) -> DataFrame:
    """(item, words, length, size, tokens, slots) of every window of every item."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for item, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(value)
            length = min(WINDOW_WORDS, len(words))
            size = min(SHINGLE_WORDS, length)
            if not words:
                continue
            hashes = shingle_hashes(words, size)
            for k in range(len(words) - length + 1):
                tokens = hashes[k : k + length - size + 1]
                rows.append((item, b" ".join(words[k : k + length]).decode(), length, size, tokens.view(np.int64), _slots(tokens)))
        item, *columns = zip(*rows) if rows else [()] * 6
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(item, batch.column(0).type), *(pa.array(c, t) for c, t in zip(columns, kinds))],
            names=["item", *(f.name for f in _WINDOW_FIELDS)],
        )

    return common.map_batches(items.select(key, text), run, [common.renamed(items.schema[key], "item"), *_WINDOW_FIELDS])


def _bitmap(windows: DataFrame) -> np.ndarray:
    """Bit per slot, gathered as at most 2**(BITMAP_POWER - 6) integers."""
    slots = windows.select(F.explode("slots").alias("slot"))
    packed = slots.groupBy(F.shiftright("slot", 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")
    )
    out = np.zeros(1 << (BITMAP_POWER - 6), np.uint64)
    rows = packed.collect()
    if rows:
        at, bits = zip(*rows)
        out[np.array(at)] = np.array(bits, np.int64).view(np.uint64)
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def stretches(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, length) of the runs of true values of at least that length."""
    if not inside.any():
        return []
    turns = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    starts, ends = turns[::2], turns[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), (ends - starts)[long].tolist()))


def _segments(docs: DataFrame, text: str, kept: list[str], bitmap: np.ndarray, least: dict[int, int]) -> DataFrame:
    """(_row, kept columns, _n_words, _segments) of every document."""
    kind = pa.list_(pa.struct([("size", pa.int32()), ("start", pa.int32()), ("words", pa.string())]))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, found = [], []
        for value in batch.column(text).to_pylist():
            words = words_of(value)
            counts.append(len(words))
            here = []
            for size, shortest in least.items():
                inside = bitmap[_slots(shingle_hashes(words, size))].astype(bool)
                here += [
                    {"size": size, "start": start, "words": b" ".join(words[start : start + n + size - 1]).decode()}
                    for start, n in stretches(inside, shortest)
                ]
            found.append(here)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *(batch.column(c) for c in kept), pa.array(counts, pa.int64()), pa.array(found, kind)],
            names=["_row", *kept, "_n_words", "_segments"],
        )

    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), *dict.fromkeys([*kept, text]))
    fields = [
        T.StructField("_row", T.LongType()),
        *(common.renamed(docs.schema[c], c) for c in kept),
        T.StructField("_n_words", T.LongType()),
        T.StructField("_segments", T.ArrayType(_segment_type())),
    ]
    return common.staged(common.map_batches(numbered, run, fields), "segments")


def _segment_type() -> T.StructType:
    return T.StructType(
        [T.StructField("size", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("words", T.StringType())]
    )


def _occurrences(segments: DataFrame) -> DataFrame:
    """(segment, copies, at, token, size, before, context) of every shingle of the
    distinct segments; the context holds every window that can contain the shingle."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(7)]
        for row in batch.to_pylist():
            words = row["words"].encode().split(b" ")
            size = row["size"]
            reach = WINDOW_WORDS - size
            for at, token in enumerate(shingle_hashes(words, size).view(np.int64).tolist()):
                begin = max(0, at - reach)
                context = b" ".join(words[begin : at + WINDOW_WORDS]).decode()
                for column, value in zip(columns, (row["segment"], row["copies"], at, token, size, at - begin, context)):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_OCCURRENCE_NAMES)

    kinds = [T.LongType(), T.LongType(), T.IntegerType(), T.LongType(), T.IntegerType(), T.IntegerType(), T.StringType()]
    fields = [T.StructField(n, k) for n, k in zip(_OCCURRENCE_NAMES, kinds)]
    return common.staged(common.map_batches(segments.select("segment", "copies", "size", "words"), run, fields), "shingles")


_OCCURRENCE_NAMES = ["segment", "copies", "at", "token", "size", "before", "context"]


def _merged(spans: DataFrame, *keys: str) -> DataFrame:
    """The union of the spans [low, high) of each key as disjoint spans."""
    before = Window.partitionBy(*keys).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*keys).orderBy("low", "high")
    opened = spans.withColumn("reached", F.max("high").over(before)).withColumn(
        "opens", F.when(F.col("reached") >= F.col("low"), 0).otherwise(1)
    )
    return (
        opened.withColumn("island", F.sum("opens").over(upto))
        .groupBy(*keys, "island")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"))
        .drop("island")
    )


def matches(
    docs: DataFrame, items: DataFrame, kept: list[str], text: str = "text", item_key: str = "item_id", item_text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, spans, items found): the kept columns with ``_row`` and ``_n_words``;
    the disjoint hit spans [low, high) of word positions per row; the item keys per row."""
    raw = common.staged(_windows(items, item_key, item_text), "windows")
    least = {
        r["size"]: r["least"] for r in raw.groupBy("size").agg(F.min(F.col("length") - F.col("size") + 1).alias("least")).collect()
    }
    rows = _segments(docs, text, kept, _bitmap(raw), least)
    placed = rows.select(F.col("_row").alias("row"), F.explode("_segments").alias("s")).select("row", "s.size", "s.start", "s.words")
    distinct = common.staged(
        placed.groupBy("size", "words").agg(F.count("*").alias("copies")).withColumn("segment", F.monotonically_increasing_id()),
        "distinct",
    )
    shingles = _occurrences(distinct)
    windows = raw.groupBy("words", "length", "size").agg(F.first("tokens").alias("tokens"))
    frequency = shingles.groupBy("token").agg(F.sum("copies").alias("frequency"))
    prefix = (
        windows.select("words", "length", F.posexplode("tokens").alias("offset", "token"))
        .join(frequency, "token")
        .groupBy("words", "length")
        .agg(F.min(F.struct("frequency", "offset", "token")).alias("rarest"))
        .select("words", "length", "rarest.offset", "rarest.token")
    )
    there = F.slice(F.split("context", " "), F.col("before") - F.col("offset") + 1, F.col("length"))
    hits = common.staged(
        shingles.join(prefix, "token")
        .where("before >= offset")
        .where(F.array_join(there, " ") == F.col("words"))
        .select("segment", (F.col("at") - F.col("offset")).alias("low"), (F.col("at") - F.col("offset") + F.col("length")).alias("high"), "words"),
        "hits",
    )
    cover = _merged(hits.select("segment", "low", "high"), "segment")
    named = hits.select("segment", "words").join(raw.select("item", "words"), "words").select("segment", "item").distinct()
    where = placed.join(distinct.select("size", "words", "segment"), ["size", "words"]).select("row", "start", "segment")
    spans = _merged(
        where.join(cover, "segment").select("row", (F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high")),
        "row",
    )
    found = where.join(named, "segment").select("row", "item").distinct()
    return rows.drop("_segments"), spans, found


def report(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: key, ``n_words``, ``n_hit`` (words inside an occurrence of a
    window), ``items`` (their keys as sorted strings) and ``contaminated``."""
    rows, spans, found = matches(docs, items, [key], text, item_key, item_text)
    hit = spans.groupBy("row").agg(F.sum(F.col("high") - F.col("low")).cast("long").alias("n_hit"))
    named = found.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item").cast("string"))).alias("items"))
    facts = hit.join(named, "row").withColumnRenamed("row", "_row")
    joined = rows.join(facts, "_row", "left")
    return joined.select(
        key,
        F.col("_n_words").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no window occurs, with all their columns."""
    hidden, back = common.sheltered(docs, text)
    rows, spans, _ = matches(hidden, items, hidden.columns, text, item_key, item_text)
    hit = spans.select(F.col("row").alias("_row")).distinct()
    return back(rows.join(hit, "_row", "left_anti"))
