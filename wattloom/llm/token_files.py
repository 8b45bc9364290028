"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code.

Ids are replaced by their rank of frequency over the whole corpus, so that frequent ids
take few bytes. A rank takes one to four bytes; the number of bytes of four successive
ranks stands in one control byte, two bits each, and control bytes are kept apart from
data bytes. A decoder reads control bytes through a table of 256 rows and moves all
data bytes at once.

Documents are dealt out by ranges of keys in ascending order; a range that outgrows a
file goes on in another. So a file holds at most ``file_tokens`` ids or one document,
whatever the keys, and a task holds one file. A file: header (magic and version, number
of documents, ids, control bytes, ranks), the keys with a null mark, the ids and control
bytes of each document, the table of ids by rank, control bytes, data bytes and a
checksum. Its folder's name says range, file and number of ids, so a reader knows the
ids before each file without opening any.

Documents of equal keys stand by length, then by a hash of their ids; null keys come
first. Keys are integers. A null or empty text is just its end id; an empty table makes
no file.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import common, pack
from wattloom.session import scratch_dir

MAGIC = b"TOKRANK2"
#: Most ids in a file, unless it holds a single document.
FILE_TOKENS = 4_000_000
_HEADER = "<8sqqqq"  # magic, documents, ids, control bytes, ranks
#: Partition column whose value names a file: range of keys, file in it, number of ids.
_NAME = "part_file_ids"
_SHIFTS = np.arange(4, dtype=np.uint8) * 2
#: Bytes of each of the four ranks, by control byte.
LENGTHS = ((np.arange(256, dtype=np.uint8)[:, None] >> _SHIFTS) & 3) + 1
_PLACES = np.arange(4, dtype=np.uint8)


def encode_ranks(ranks: np.ndarray, counts: np.ndarray | None = None) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of documents of so many ranks, by default of one; the
    control bytes of each start at a byte of their own."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    counts = np.array([len(ranks)]) if counts is None else counts
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    spare = -counts % 4
    codes = np.zeros(len(ranks) + int(spare.sum()), np.uint8)
    codes[np.arange(len(ranks)) + np.repeat(np.cumsum(spare) - spare, counts)] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    octets = ranks.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), octets[_PLACES <= extra[:, None]].tobytes()


def _flat(column: pa.Array, width: int) -> np.ndarray:
    """The ids of all rows of a binary column, one after the other."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return np.ascontiguousarray(data).view(f"<u{width}")


def decode_ranks(control: np.ndarray, data: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ranks of all documents of a file; ``counts``: ranks of each document, whose
    control bytes start at a byte of their own."""
    lengths = LENGTHS[control].reshape(-1)
    # The last control byte of a document may have up to three places to spare.
    spare = -counts % 4
    ends = np.cumsum(counts + spare)
    first = np.cumsum(spare) - spare
    real = np.ones(len(lengths), bool)
    real[np.repeat(ends - spare - first, spare) + np.arange(spare.sum())] = False
    lengths = lengths[real]
    out = np.zeros((len(lengths), 4), np.uint8)
    out[_PLACES < lengths[:, None]] = data
    return out.reshape(-1).view("<u4")


def _ranking(tokens: DataFrame, width: int) -> np.ndarray:
    """Ids by falling frequency over all documents; at most one row per vocabulary entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            here = np.bincount(_flat(batch.column(0), width))
            if len(here) > len(counts):
                counts, here = here, counts
            counts[: len(here)] += here
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["id", "n"])

    counted = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted(counted.collect(), key=lambda r: (-r["n"], r["id"]))
    return np.array([r["id"] for r in rows], "<u4")


def write(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", file_tokens: int = FILE_TOKENS) -> None:
    """Write the token files of ``docs`` below ``path``."""
    width = pack.id_width(vocabulary)
    tokens = pack.encoded(docs, vocabulary, key, text)
    by_rank = _ranking(tokens, width)
    rank = np.zeros(int(by_rank.max(initial=0)) + 1, "<u4")
    rank[by_rank] = np.arange(len(by_rank), dtype="<u4")
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, math.ceil(total / file_tokens))

    # Dealing out by range looks at its input twice, so ids are coded only after it. Place
    # in the encoded table makes every row different: a repeated key fills many ranges.
    order = ["key", "n_tokens", "print", "part", "start"]
    placed = (
        tokens.select(F.col(key).cast("long").alias("key"), "n_tokens", F.xxhash64("ids").alias("print"), "part", "start", "ids")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("key", "n_tokens", "ids")
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, files = TaskContext.get().partitionId(), 0
        keys, counts, coded, held = [], [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal files, held
            body = _file(pa.concat_arrays(keys), np.concatenate(counts), coded, by_rank)
            name = f"p{part}-f{files}-n{held}"
            files, held = files + 1, 0
            for pieces in (keys, counts, coded):
                pieces.clear()
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary()), pa.array([name])], names=["file", _NAME])

        for batch in batches:
            count = batch.column("n_tokens").to_numpy()
            ends = np.concatenate([[0], np.cumsum(count)])
            ranks = rank[_flat(batch.column("ids"), width)]
            at = 0
            while at < len(count):
                # As many documents as the file has room for, one at least.
                to = int(np.searchsorted(ends, ends[at] + file_tokens - held, "right")) - 1
                if to <= at and keys:
                    yield closed()
                    continue
                to = max(to, at + 1)
                keys.append(batch.column("key").slice(at, to - at))
                counts.append(count[at:to])
                coded.append(encode_ranks(ranks[ends[at] : ends[to]], count[at:to]))
                held += int(ends[to] - ends[at])
                at = to
        if keys:
            yield closed()

    # The text writer puts out the bytes as they are, and one line feed after them.
    files_df = placed.mapInArrow(assemble, f"file binary, {_NAME} string").select(F.col("file").cast("string"), _NAME)
    files_df.write.partitionBy(_NAME).text(path)


def _file(keys: pa.Array, counts: np.ndarray, coded: list[tuple[bytes, bytes]], by_rank: np.ndarray) -> bytes:
    """The bytes of a file: documents by key and ids, and their (control bytes, data
    bytes) in pieces."""
    control = b"".join(c for c, _ in coded)
    head = struct.pack(_HEADER, MAGIC, len(keys), int(counts.sum()), len(control), len(by_rank))
    parts = [
        keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
        keys.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
        counts.astype("<i8").tobytes(),
        by_rank.tobytes(),
        control,
        *(d for _, d in coded),
    ]
    body = b"".join([head, *parts])
    return body + struct.pack("<I", zlib.crc32(body))


def parse(content: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(keys, ids per document, all ids) of a file."""
    body, check = content[:-5], content[-5:-1]
    if struct.pack("<I", zlib.crc32(body)) != check:
        raise ValueError("token file with a wrong checksum")
    magic, documents, total, controls, ranks = struct.unpack_from(_HEADER, body)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = struct.calcsize(_HEADER)

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, count, at)
        at += out.nbytes
        return out

    keys, nulls = take("<i8", documents), take("u1", documents)
    counts, by_rank, control = take("<i8", documents), take("<u4", ranks), take("u1", controls)
    ids = by_rank[decode_ranks(control, take("u1", len(body) - at), counts)]
    if len(ids) != total:
        raise ValueError("token file with a wrong number of ids")
    return pa.array(keys, mask=nulls.astype(bool)), counts, ids


def read(spark: SparkSession, path: str) -> DataFrame:
    """(key, start, n_tokens, ids) of every document in the files below ``path``: ids
    little-endian unsigned 32-bit, ``start`` the ids of all documents before it."""
    schema = "key long, start long, n_tokens long, ids binary"
    found = spark.read.format("binaryFile").load(path)
    if _NAME not in found.columns:
        return spark.createDataFrame([], schema)
    # Folder names alone answer this: one row per file, no file is opened.
    names = [r[0] for r in found.select(_NAME).distinct().collect()]
    offsets, total = {}, 0
    for name in sorted(names, key=lambda name: _facts(name)[:2]):
        offsets[name] = total
        total += _facts(name)[2]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], []]
        for content, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            keys, counts, ids = parse(content)
            if len(ids) != _facts(name)[2]:
                raise ValueError("token file in a folder of another number of ids")
            ends = np.cumsum(counts)
            columns[0].append(keys)
            columns[1].append(offsets[name] + ends - counts)
            columns[2].append(counts)
            columns[3] += [ids[e - n : e].tobytes() for e, n in zip(ends.tolist(), counts.tolist())]
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(columns[0]),
                pa.array(np.concatenate(columns[1])),
                pa.array(np.concatenate(columns[2])),
                pa.array(columns[3], pa.binary()),
            ],
            names=["key", "start", "n_tokens", "ids"],
        )

    return common.map_batches(found.select("content", _NAME), run, T._parse_datatype_string(schema).fields)


def _facts(name: str) -> tuple[int, int, int]:
    """(range, file in it, ids) by the name of a file's folder."""
    part, file, count = (int(x[1:]) for x in name.split("-"))
    return part, file, count


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files into the shared folder and read them back."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-files")
    write(docs, path, vocabulary, key, text)
    return read(spark, path)
