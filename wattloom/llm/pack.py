"""Token sequences of fixed length by concatenating and cutting.

Two passes over partition totals. The first encodes every text once, ends it with id 0,
and writes the ids with the partition and the place in it. The totals of the partitions
are summed up in order, which gives every document its place in one long stream of ids.
The second pass cuts that stream into windows: a document that crosses a border is cut
there, and both pieces say so. Only the last sequence has padding, and none if its
length is a power of two.

Rows: a null or empty text is just its end id. Repeated rows are packed as often as they
occur. An empty table gives no piece. Only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import bpe, common

SEQUENCE_TOKENS = 1024


def id_width(vocabulary: str) -> int:
    """Bytes that hold any id of a vocabulary in intermediate data."""
    return 2 if bpe.encoder(vocabulary).tokenizer.get_vocab_size() <= 1 << 16 else 4


def encoded(docs: DataFrame, vocabulary: str, key: str, text: str) -> DataFrame:
    """(key, part, start, n_tokens, ids): ids with the end id as little-endian integers
    of ``id_width`` bytes, ``start`` counted within the partition ``part``."""
    width = id_width(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, start = TaskContext.get().partitionId(), 0
        encode = bpe.encoder(vocabulary).encode
        for batch in batches:
            ids = [np.append(one, np.uint32(bpe.END_ID)) for one in encode(batch.column(1))]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            starts = start + np.cumsum(counts) - counts
            start += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(starts),
                    pa.array(counts),
                    pa.array([one.astype(f"<u{width}").tobytes() for one in ids], pa.binary()),
                ],
                names=[key, "part", "start", "n_tokens", "ids"],
            )

    fields = [
        common.renamed(docs.schema[key], key),
        T.StructField("part", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    return common.staged(docs.select(key, text).mapInArrow(run, T.StructType(fields)), "ids", "zstd")


def part_offsets(encoded_docs: DataFrame) -> tuple[dict[int, int], int]:
    """Ids before each partition, and in all: one number per partition on the driver."""
    totals = encoded_docs.groupBy("part").agg(F.sum("n_tokens")).collect()
    offsets, total = {}, 0
    for part, count in sorted(tuple(r) for r in totals):
        offsets[part] = total
        total += count
    return offsets, total


def cut(begin: int, count: int, window: int) -> list[tuple[int, int, int, int]]:
    """(start in the document, length, sequence, offset in it) of the pieces of a
    document whose ids take the places from ``begin`` on."""
    pieces = []
    at = begin
    while at < begin + count:
        length = min(begin + count, (at // window + 1) * window) - at
        pieces.append((at - begin, length, at // window, at % window))
        at += length
    return pieces


def padded_length(used: int, window: int) -> int:
    """Length of a sequence with ``used`` ids after padding."""
    return used if used & (used - 1) == 0 else window


def pieces(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", window: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: key, ``start``, ``length``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``cut_before`` and ``cut_after`` (the document goes on in the sequence
    before or after), ``padded_to`` (length of the sequence with padding) and ``ids``
    (little-endian unsigned 32-bit)."""
    width = id_width(vocabulary)
    tokens = encoded(docs, vocabulary, key, text)
    offsets, total = part_offsets(tokens)
    last, rest = divmod(total, window)
    last_padded = padded_length(rest, window)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, columns, data = [], [[] for _ in range(4)], []
        parts, starts, counts = (batch.column(c).to_pylist() for c in ("part", "start", "n_tokens"))
        for k, ids in enumerate(batch.column("ids").to_pylist()):
            wide = np.frombuffer(ids, f"<u{width}").astype("<u4")
            for piece in cut(offsets[parts[k]] + starts[k], counts[k], window):
                row.append(k)
                for column, value in zip(columns, piece):
                    column.append(value)
                data.append(wide[piece[0] : piece[0] + piece[1]].tobytes())
        start, length, sequence, offset = (np.array(c, np.int64) for c in columns)
        tokens = np.array(counts, np.int64)[row]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(key).take(pa.array(row)),
                *(pa.array(x) for x in (start, length, tokens, sequence, offset, start > 0, start + length < tokens)),
                pa.array(np.where(sequence == last, last_padded, window)),
                pa.array(data, pa.binary()),
            ],
            names=[key, *_NAMES],
        )

    kinds = [T.LongType()] * 5 + [T.BooleanType()] * 2 + [T.LongType(), T.BinaryType()]
    fields = [common.renamed(docs.schema[key], key), *(T.StructField(n, t) for n, t in zip(_NAMES, kinds))]
    return common.map_batches(tokens.select(key, "part", "start", "n_tokens", "ids"), run, fields)


_NAMES = ["start", "length", "doc_tokens", "sequence_id", "offset", "cut_before", "cut_after", "padded_to", "ids"]
