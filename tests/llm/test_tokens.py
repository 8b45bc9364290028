import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattloom.llm import bpe, pack, queries, token_files

ROWS = [(5, "one two three " * 900), (2, None), (9, ""), (2, "again two"), (None, "no key"), (7, "x y\n z " * 40), (5, "short")]


@pytest.fixture(scope="module")
def expected():
    encoder = bpe.Encoder(queries.vocabulary())
    return [(k, np.append(i, np.uint32(0)).astype("<u4")) for (k, _), i in zip(ROWS, encoder.encode(pa.array([t for _, t in ROWS])))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, 1, b"") for k, t in ROWS], "doc_id long, text string, start int, ids binary").repartition(3)


@pytest.mark.parametrize("window", [8, 1024])
def test_pieces_give_back_every_document(docs, expected, window):
    rows = pack.pieces(docs, queries.vocabulary(), window=window).collect()
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    at = 0
    for sequence, offset, length in places:
        assert (sequence, offset) == divmod(at, window) and offset + length <= window
        at += length
    assert at == sum(len(i) for _, i in expected)
    whole = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"]
        assert r["cut_before"] == (r["start"] > 0) and r["cut_after"] == (r["start"] + r["length"] < r["doc_tokens"])
        whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], ids.tolist()))
    got = sorted((str(k), sum((ids for _, ids in sorted(parts)), [])) for (k, _), parts in whole.items())
    assert got == sorted((str(k), i.tolist()) for k, i in expected)
    last = max(r["sequence_id"] for r in rows)
    used = at - last * window
    assert {r["padded_to"] for r in rows if r["sequence_id"] == last} == {used if used & (used - 1) == 0 else window}
    assert {r["padded_to"] for r in rows if r["sequence_id"] < last} <= {window}


def test_cut_and_padding():
    assert pack.cut(6, 11, 8) == [(0, 2, 0, 6), (2, 8, 1, 0), (10, 1, 2, 0)]
    assert [pack.padded_length(n, 1024) for n in (1, 3, 512, 513, 1000)] == [1, 1024, 512, 1024, 1024]


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 70_000), max_size=9), max_size=5))
def test_variable_length_code(docs):
    coded = [token_files.encode_ranks(np.array(d, np.uint32)) for d in docs]
    control, data = (np.frombuffer(b"".join(x), np.uint8) for x in zip(*coded)) if coded else (np.zeros(0, np.uint8),) * 2
    counts = np.array([len(d) for d in docs], np.int64)
    assert token_files.decode_ranks(control, data, counts).tolist() == sum(docs, [])
    at_once = token_files.encode_ranks(np.array(sum(docs, []), np.uint32), counts)
    assert at_once == (control.tobytes(), data.tobytes())


def test_files_round_trip(spark, docs, expected):
    rows = token_files.round_trip(docs, queries.vocabulary()).collect()
    order = sorted(expected, key=lambda e: (e[0] is not None, e[0] or 0))
    rows.sort(key=lambda r: r["start"])
    assert [r["key"] for r in rows] == [k for k, _ in order]
    assert sorted((str(r["key"]), r["ids"]) for r in rows) == sorted((str(k), i.tobytes()) for k, i in order)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] * 4 == len(r["ids"])
        at += r["n_tokens"]


def test_many_files_keep_the_order(spark, tmp_path, docs):
    path = str(tmp_path / "files")
    token_files.write(docs, path, queries.vocabulary(), file_tokens=50)
    rows = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    assert [r["key"] for r in rows] == [None, 2, 2, 5, 5, 7, 9]


def test_a_repeated_key_fills_many_small_files(spark, tmp_path):
    rows = [(4, "the same words")] * 400 + [(4, "other " * k) for k in range(200)] + [(1, "first"), (9, "a long one " * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = str(tmp_path / "files")
    token_files.write(docs, path, queries.vocabulary(), file_tokens=1000)
    encoder = bpe.Encoder(queries.vocabulary())
    expected = sorted((k, len(i) + 1) for (k, _), i in zip(rows, encoder.encode(pa.array([t for _, t in rows]))))
    found = sorted(token_files.read(spark, path).collect(), key=lambda r: r["start"])
    assert [(r["key"], r["n_tokens"]) for r in found] == expected
    assert [r["start"] for r in found] == np.cumsum([0, *(n for _, n in expected[:-1])]).tolist()
    files = [token_files.parse(f.read_bytes()) for f in (tmp_path / "files").glob("*/*.txt")]
    assert len(files) > 10 and all(len(ids) <= 1000 or len(counts) == 1 for _, counts, ids in files)


def test_damage_is_noticed():
    body = token_files.MAGIC + bytes(60)
    with pytest.raises(ValueError, match="checksum"):
        token_files.parse(body + zlib.crc32(b"other").to_bytes(4, "little") + b"\n")


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack.pieces(docs, queries.vocabulary()).collect() == []
    assert token_files.round_trip(docs, queries.vocabulary()).collect() == []
